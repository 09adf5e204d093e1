"""Evaluating a detector against chat records whose assistant message is the truth."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamis.functions.parsing import format_ok, parse_flags
from tamis.functions.prompts import first_content
from tamis.operators import metrics as M
from tamis.operators.detection import Detector, detect
from tamis.schemas import Taxonomy
from tamis.workspace import written


def predict(chats: DataFrame, make_detector: Callable[[], Detector], taxonomy: Taxonomy, in_flight: int = 1) -> DataFrame:
    """chats (messages) as results: predicted, ground_truth, raw_output, raw_ground_truth, format_ok. Each chunk is asked for once."""
    vocabulary = taxonomy.vocabulary()
    asked = chats.select(first_content(F.col("messages"), "user").alias("prompt"), first_content(F.col("messages"), "assistant").alias("raw_ground_truth"))
    raw = F.coalesce("raw", F.lit(""))
    out = detect(asked, make_detector, taxonomy, attempts=1, in_flight=in_flight)
    return out.select(parse_flags(raw, vocabulary).alias("predicted"), parse_flags(F.col("raw_ground_truth"), vocabulary).alias("ground_truth"), raw.alias("raw_output"), "raw_ground_truth", format_ok(raw, vocabulary).alias("format_ok"))


def evaluate(results: DataFrame) -> dict[str, DataFrame]:
    """micro, per_flag and no_flag metrics of written results."""
    return {"micro": M.micro_metrics(results), "per_flag": M.per_flag_metrics(results), "no_flag": M.no_flag_accuracy(results)}


MODES = ("finetuned", "base", "compare")


def run(chats: DataFrame, taxonomy: Taxonomy, base: Callable[[], Detector] | None = None, tuned: Callable[[], Detector] | None = None, mode: str = "finetuned", in_flight: int = 1) -> DataFrame:
    """What an evaluation run reports: the micro metrics of one model, or, in mode `compare`, the four metrics of both side by side. The modes exclude each other; a model that the mode does not name is not asked. Predictions are written before they are read."""
    if mode not in MODES:
        raise ValueError(f"a mode is one of {', '.join(MODES)}: {mode}")
    wanted = {"finetuned": [("tuned", tuned)], "base": [("base", base)], "compare": [("base", base), ("tuned", tuned)]}[mode]
    if missing := [name for name, make in wanted if make is None]:
        raise ValueError(f"mode {mode} needs the model: {', '.join(missing)}")
    found = [M.micro_metrics(written(predict(chats, make, taxonomy, in_flight), f"predictions-{name}")) for name, make in wanted]
    return M.compare_models(*found) if mode == "compare" else found[0]


#: Texts, and what an answer to each must hold, for a first look at an endpoint.
SMOKE_CASES = (
    ("Offers are considered from small firms only; all work is set aside for them.", "small_business_set_aside"),
    ("The award goes to the lowest price among offers that are technically acceptable.", "lpta_source_selection"),
    ("Only participants of the 8(a) business development program may make an offer.", "8a_set_aside"),
    ("Teams work in two-week sprints with a backlog, reviews and retrospectives.", "agile_methodology"),
    ("The cafeteria is open from eight to five.", "no_flag"),
)


def smoke(spark: SparkSession, make_detector: Callable[[], Detector], taxonomy: Taxonomy, cases: tuple[tuple[str, str], ...] = SMOKE_CASES) -> DataFrame:
    """The cases (prompt, expected) with raw answers and errors; M.pass_rate counts them."""
    return ask_cases(spark.createDataFrame(list(cases), "prompt string, expected string").coalesce(1), make_detector, taxonomy)


def ask_cases(cases: DataFrame, make_detector: Callable[[], Detector], taxonomy: Taxonomy, in_flight: int = 1) -> DataFrame:
    """Any table of cases (prompt, expected) with raw answers and errors."""
    return detect(cases, make_detector, taxonomy, attempts=1, in_flight=in_flight)


def token_lengths(chats: DataFrame, make_tokenizer: Callable[[], object], render: Callable[[list], str] | None = None) -> DataFrame:
    """(n): tokens of each chat record after the template; make_tokenizer() gives an object with encode, once per task."""
    render = render or (lambda messages: "".join(f"<|start_header_id|>{m['role']}<|end_header_id|>\n\n{m['content']}<|eot_id|>" for m in messages))

    @F.pandas_udf("bigint")
    def n(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tok = make_tokenizer()
        for s in parts:
            yield s.map(lambda messages: len(tok.encode(render(list(messages)))))

    return chats.select(n("messages").alias("n"))


def length_check(chats: DataFrame, make_tokenizer: Callable[[], object]) -> tuple[DataFrame, DataFrame]:
    """Length statistics of chat records in tokens, and what follows from them for a model's length."""
    stats = M.length_stats(token_lengths(chats, make_tokenizer))
    return stats, M.length_advice(stats)
