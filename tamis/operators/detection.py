"""Flag detectors: the port that a model fills, offline implementations, and the run with retries over chunks.

A detector is an object with detect(chunk) -> str. It is made once per task, from a function that is sent to the executors.
"""

from __future__ import annotations

import json
import threading
import time
from collections import deque
from collections.abc import Callable, Iterator
from concurrent.futures import Future, ThreadPoolExecutor
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamis.functions.parsing import parse_flags, parse_ok
from tamis.functions.prompts import chat_template, context_block
from tamis.functions.text import let
from tamis.schemas import NO_FLAG, Taxonomy, literals


class Detector(Protocol):
    def detect(self, chunk: str) -> str: ...


class ScriptedDetector:
    """Answers from a list, in call order, the last one again and again; an exception in it is raised."""

    def __init__(self, answers: list[str | Exception]):
        self.answers, self.calls = answers, 0

    def detect(self, chunk: str) -> str:
        answer = self.answers[min(self.calls, len(self.answers) - 1)]
        self.calls += 1
        if isinstance(answer, Exception):
            raise answer
        return answer


class Backoff:
    """When the next call may start; one for all calls of a task, so that a service that refuses one is left alone by all."""

    def __init__(self, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep):
        self.clock, self.sleep, self.until, self.lock = clock, sleep, 0.0, threading.Lock()

    def wait(self) -> None:
        while (left := self.until - self.clock()) > 0:
            self.sleep(left)

    def refused(self, seconds: float) -> None:
        with self.lock:
            self.until = max(self.until, self.clock() + seconds)


class ServiceDetector:
    """A hosted model behind invoke(body) -> body, both JSON; the client is made by the caller's function. Rate limits, as is_throttled says, are waited for: 2, 4, 8 seconds, by all that share its backoff."""

    def __init__(self, invoke: Callable[[str], str], max_gen_len: int = 64, temperature: float = 0.1, is_throttled: Callable[[Exception], bool] = lambda e: False, waits: tuple[float, ...] = (2, 4, 8), template: Callable[[str], str] = lambda chunk: chunk):
        self.invoke, self.settings, self.is_throttled, self.waits, self.template = invoke, {"max_gen_len": max_gen_len, "temperature": temperature}, is_throttled, waits, template
        self.backoff = Backoff()

    def detect(self, chunk: str) -> str:
        body = json.dumps({"prompt": self.template(chunk), **self.settings})
        for wait in (*self.waits, None):
            self.backoff.wait()
            try:
                return json.loads(self.invoke(body)).get("generation", "")
            except Exception as e:
                if wait is None or not self.is_throttled(e):
                    raise
                self.backoff.refused(wait)
        raise AssertionError


class Pool:
    """At most `size` calls at a time, each by a detector of its own thread; detectors that have a backoff share one. Results come in the order of the prompts, and no more than AHEAD * size wait for an earlier one."""

    AHEAD = 4

    def __init__(self, make_detector: Callable[[], Detector], size: int):
        self.make, self.size, self.own, self.backoff = make_detector, size, threading.local(), None
        self.lock = threading.Lock()

    def detector(self) -> Detector:
        if not hasattr(self.own, "detector"):
            with self.lock:  # clients are made one by one
                made = self.own.detector = self.make()
                if isinstance(getattr(made, "backoff", None), Backoff):
                    self.backoff = made.backoff = self.backoff or made.backoff
        return self.own.detector

    def map(self, ask: Callable[[Detector, str], tuple], batches: Iterator[pd.Series]) -> Iterator[list[tuple]]:
        """The answers of each batch; calls of the next ones are under way meanwhile."""
        with ThreadPoolExecutor(self.size) as threads:
            waiting: deque[Future] = deque()
            sizes: deque[int] = deque()
            done: list[tuple] = []

            def finished() -> Iterator[list[tuple]]:
                nonlocal done
                while sizes and len(done) >= sizes[0]:
                    n = sizes.popleft()
                    yield done[:n]
                    done = done[n:]

            for batch in batches:
                sizes.append(len(batch))
                for prompt in batch:
                    waiting.append(threads.submit(lambda p: ask(self.detector(), p), prompt))
                    while len(waiting) >= self.AHEAD * self.size:
                        done.append(waiting.popleft().result())
                yield from finished()
            while waiting:
                done.append(waiting.popleft().result())
                yield from finished()
            yield from finished()


def lexicon_flags(chunk: Column, lexicon: dict[str, str]) -> Column:
    """The flags whose term the lower-cased chunk contains; a null chunk has none."""
    terms = lambda low: F.array(*(F.when(F.contains(low, F.lit(term)), F.lit(flag)) for flag, term in lexicon.items()))
    return F.filter(let(F.lower(F.coalesce(chunk, F.lit(""))), terms), lambda f: f.isNotNull())


def lexicon_answer(chunk: Column, lexicon: dict[str, str]) -> Column:
    """A detector without a model, as an expression: the flags whose term the lower-cased chunk contains, a line each, or no_flag."""
    return let(lexicon_flags(chunk, lexicon), lambda found: F.when(F.size(found) > 0, F.array_join(found, "\n")).otherwise(F.lit(NO_FLAG)))


def detect_native(chunks: DataFrame, answer: Column, taxonomy: Taxonomy, keep: list[str]) -> DataFrame:
    """keep, raw, flags, parsed of chunks whose answer is an expression; retrying one would give the same answer."""
    vocabulary = taxonomy.vocabulary()
    rows = chunks.select(*keep, answer.alias("raw"))
    return rows.select(*keep, "raw", parse_flags(F.col("raw"), vocabulary).alias("flags"), parse_ok(F.col("raw"), vocabulary).alias("parsed"))


def detect(chunks: DataFrame, make_detector: Callable[[], Detector], taxonomy: Taxonomy, attempts: int = 2, spread: int | None = None, read: Callable[[str | None], list[str] | None] | None = None, in_flight: int = 1) -> DataFrame:
    """chunks (with column prompt) and raw, flags, attempts, parsed, error.

    An answer that does not parse is asked for again, up to `attempts` times, then the chunk is unparsed. An exception is not
    retried and comes back as `error`, so that it fails no job. in_flight: calls that a task has under way at a time, each by a
    detector of its own thread; chunks keep their order. spread: partitions to deal chunks to, so that a long document does not
    keep one task busy; with the tasks that run at a time, in_flight bounds the calls to a service. read: what an answer says,
    None to ask again, in place of the flag lines that a detector writes. Write the result before it is read twice: calls cost
    money.
    """
    if in_flight < 1:
        raise ValueError("in_flight must be 1 or more")
    flags = set(taxonomy.flags)

    def names(raw: str) -> list[str]:
        if (raw or "").strip().lower() in (NO_FLAG, "none"):
            return []
        return [f for f in (p.strip() for line in (raw or "").split("\n") for p in line.split(",")) if f in flags]

    def lines(raw: str | None) -> list[str] | None:
        found = names(raw)
        return found if found or (raw or "").strip().lower() in (NO_FLAG, "none") else None

    understood = read or lines

    def answer(detector: Detector, prompt: str) -> tuple:
        raw, found, n = None, None, 0
        try:
            while found is None and n < attempts:
                n += 1
                raw = detector.detect(prompt)
                found = understood(raw)
        except Exception as e:
            return raw, [], n, False, f"{type(e).__name__}: {e}"
        return raw, found or [], n, found is not None, None

    def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        if in_flight > 1:
            answers = Pool(make_detector, in_flight).map(answer, parts)
        else:
            detector = make_detector()
            answers = ([answer(detector, prompt) for prompt in s] for s in parts)
        for out in answers:
            yield pd.DataFrame(out, columns=["raw", "flags", "attempts", "parsed", "error"])

    ask = F.pandas_udf(run, "raw string, flags array<string>, attempts int, parsed boolean, error string").asNondeterministic()
    dealt = chunks.repartition(spread) if spread else chunks
    return dealt.withColumn("_a", ask("prompt")).select(*chunks.columns, "_a.*")


def json_answer(raw: str | None) -> list[str] | None:
    """The strings of a JSON list, or of the `flags` of a JSON object, in a code fence or not; None if the answer is no JSON."""
    text = (raw or "").strip()
    if text.startswith("```"):
        text = text.partition("\n")[2].rpartition("```")[0] or text.partition("\n")[2]
    for part in (text, text[text.find("{") : text.rfind("}") + 1]):
        try:
            found = json.loads(part)
        except ValueError:
            continue
        found = found.get("flags") if isinstance(found, dict) else found
        return [f for f in found if isinstance(f, str)] if isinstance(found, list) else []
    return None


def with_prompts(chunks: DataFrame, passages: Column | None = None, text_col: str = "chunk_text", template: bool = False) -> DataFrame:
    """prompt: the chunk, in its context block where passages are given and there are any, in the chat template if asked for."""
    chunk = F.col(text_col)
    body = chunk if passages is None else F.when(F.size(F.coalesce(passages, literals([]))) > 0, context_block(passages, chunk)).otherwise(chunk)
    return chunks.withColumn("prompt", chat_template(body) if template else body)
