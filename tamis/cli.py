"""Runs as commands: python -m tamis.cli build|label|validate|evaluate|screen --help. With --dry-run a run is planned and counted, and nothing is written or asked."""

from __future__ import annotations

import argparse
import importlib
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tamis.operators import metrics as M
from tamis.operators.passage_index import PassageIndex
from tamis.operators.retrieval import hashed_embedding
from tamis.plans import evaluation as E
from tamis.plans import labeling as B
from tamis.plans import screening as S
from tamis.plans import training_set as T
from tamis.schemas import RUNTIME_TIERS, Screening, Taxonomy, normalise_records
from tamis.shipping import ship
from tamis.sources.files import extract_files, folder_texts, read_jsonl, read_ordered, write_jsonl

RECORD = "pos bigint, rfp_id string, chunk_index int, chunk_text string, flags array<string>, confidence string, adversarial boolean, validation string"
CHAT = "messages array<struct<role:string,content:string>>"
SEED = "flag string, passage string"
DEFINITIONS = {f: f.replace("_", " ") for f in RUNTIME_TIERS}


def named(path: str):
    """The object that `module:name` names: a function that makes a detector, or an embedding."""
    module, _, name = path.partition(":")
    return getattr(importlib.import_module(module), name)


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="tamis")
    jobs = out.add_subparsers(dest="job", required=True)
    about = {
        "build": "a training set from labelled records (JSON lines)",
        "label": "records from folders of PDF and DOCX files, by a model, in two passes",
        "validate": "a review of records (JSON lines) in batches, by a model",
        "evaluate": "metrics of one model, or of two side by side",
        "screen": "decisions on PDF and DOCX files",
    }
    for name, text in about.items():
        job = jobs.add_parser(name, help=text)
        job.add_argument("input")
        job.add_argument("output")
        job.add_argument("--dry-run", action="store_true")
        if name != "build":
            job.add_argument("--in-flight", type=int, default={"screen": 4, "evaluate": 1, "label": 10, "validate": 5}[name], help="calls that a task has under way at a time")
        if name in ("label", "validate", "screen"):
            job.add_argument("--detector", required=True, type=named, metavar="MODULE:NAME")
        if name in ("label", "validate"):
            job.add_argument("--resume", action="store_true", help="go on from the answers that an earlier run wrote; without it, there must be none")
    build, label, validate, evaluate, screen = (jobs.choices[n] for n in about)
    build.add_argument("--seed", type=int, default=42)
    build.add_argument("--split", default="80/10/10")
    build.add_argument("--negative-ratio", type=float, default=1.0)
    build.add_argument("--top-k", type=int, default=T.TrainingSet().top_k)
    build.add_argument("--no-rag", action="store_true")
    build.add_argument("--exact-split", action="store_true")
    label.add_argument("--phase", choices=("1", "2", "both"), default="both", help="1: propose flags; 2: check those of the records that were written")
    label.add_argument("--max-rfps", type=int, default=0, help="of the packages, the first so many by id")
    label.add_argument("--max-flagged", type=int, default=0, help="end the first pass at so many records with flags")
    label.add_argument("--black", nargs="*", default=[], metavar="FLAG", help="flags that the second pass marks")
    validate.add_argument("--batch-size", type=int, default=10)
    validate.add_argument("--limit", type=int, default=0, help="of the records, the first so many")
    modes = evaluate.add_mutually_exclusive_group()
    for mode in E.MODES:
        modes.add_argument(f"--{mode}", dest="mode", action="store_const", const=mode, default="finetuned")
    evaluate.add_argument("--base-detector", type=named, metavar="MODULE:NAME")
    evaluate.add_argument("--tuned-detector", type=named, metavar="MODULE:NAME")
    screen.add_argument("--red-threshold", type=int, default=Screening().red_threshold)
    screen.add_argument("--max-tokens", type=int, default=Screening().max_tokens)
    screen.add_argument("--overlap", type=int, default=Screening().overlap_tokens)
    screen.add_argument("--store", help="a folder with the index of passages that chunks get as context")
    screen.add_argument("--seeds", help="passages (JSON lines) that an empty store is filled with")
    screen.add_argument("--embedding", type=named, default=hashed_embedding, metavar="MODULE:NAME")
    screen.add_argument("--top-k", type=int, default=Screening().top_k)
    screen.add_argument("--no-rag", action="store_true", help="chunks without context, whatever the store")
    return out


def run(spark: SparkSession, argv: list[str]) -> dict:
    """What a command did: its counts, and rows per minute of what it wrote."""
    args = parser().parse_args(argv)
    ship(spark)
    return {"build": build, "label": label, "validate": validate, "evaluate": evaluate, "screen": screen}[args.job](spark, args)


def build(spark: SparkSession, args) -> dict:
    records = read_ordered(spark, args.input, RECORD)
    if not records.take(1):
        raise SystemExit(f"{args.input} has no records")
    settings = T.TrainingSet(use_context=not args.no_rag, negative_ratio=args.negative_ratio, split=args.split, exact_split=args.exact_split, seed=args.seed, top_k=args.top_k)
    built = T.build(records, settings)
    counts = {(r["split"], r["flag"]): r["n"] for r in built.counts().collect()}
    if not counts:
        raise SystemExit(f"no record of {args.input} is left to train on")
    if not args.dry_run:
        for split, chats in built.chats.items():
            write_jsonl(chats.select("messages"), f"{args.output}/{split}")
    return {"counts": counts}


def _fresh_answers(spark: SparkSession, args, path: str) -> str:
    if not args.resume and B.exists(spark, path):
        raise SystemExit(f"{path} holds answers: go on with --resume, or choose another output")
    return path


def _write(df, path: str, name: str) -> dict:
    began = time.monotonic()
    df, seen = M.observed(df, f"tamis-{name}", flagged=F.size("flags") > 0)
    write_jsonl(df, path)
    return M.throughput(seen, time.monotonic() - began)


def label(spark: SparkSession, args) -> dict:
    records, done = f"{args.output}/records", {}
    if args.phase != "2":
        packages = folder_texts(extract_files(spark, args.input))
        if args.max_rfps:
            packages = packages.orderBy("rfp_id").limit(args.max_rfps)
        if args.dry_run:
            return {"rows": B.paragraph_chunks(packages).count()}
        answers = _fresh_answers(spark, args, f"{args.output}/answers")
        if args.max_flagged:
            out = B.propose_until(packages, args.detector, DEFINITIONS, answers, args.max_flagged, in_flight=args.in_flight)
        else:
            out = B.propose(packages, args.detector, DEFINITIONS, answers, in_flight=args.in_flight)
        done = _write(out, records, "propose")
    if args.phase != "1":
        proposed = read_jsonl(spark, records, "rfp_id string, chunk_index int, chunk_text string, flags array<string>")
        if args.dry_run:
            return {"rows": proposed.where(F.size("flags") > 0).count()}
        checks = _fresh_answers(spark, args, f"{args.output}/checks")
        done = {"proposed": done, **_write(B.check(proposed, args.detector, DEFINITIONS, checks, args.black, args.in_flight), f"{args.output}/final", "check")}
    return done


def validate(spark: SparkSession, args) -> dict:
    records = normalise_records(read_ordered(spark, args.input, RECORD))
    if args.limit:
        records = records.orderBy("pos").limit(args.limit)
    if args.dry_run:
        return {"rows": records.count()}
    answers = _fresh_answers(spark, args, f"{args.output}/answers")
    out = B.validate(records, args.detector, list(RUNTIME_TIERS), answers, args.batch_size, args.in_flight)
    return _write(out.drop("pos"), f"{args.output}/validated", "validate")


def evaluate(spark: SparkSession, args) -> dict:
    chats = read_jsonl(spark, args.input, CHAT)
    if args.dry_run:
        return {"rows": chats.count()}
    found = E.run(chats, Taxonomy(), args.base_detector, args.tuned_detector, args.mode, args.in_flight)
    write_jsonl(found, args.output)
    return {"metrics": [r.asDict() for r in read_jsonl(spark, args.output, found.schema).collect()]}


def screen(spark: SparkSession, args) -> dict:
    files = extract_files(spark, args.input)
    good = files.where(F.col("error").isNull())
    if args.dry_run:
        return {"rows": good.count(), "rejected": files.count() - good.count()}
    retrieve = None
    if args.store and not args.no_rag:
        index = PassageIndex(spark, args.store, args.embedding)
        index.fill_once(lambda: read_ordered(spark, args.seeds, SEED) if args.seeds else None)
        retrieve = S.context_of(index, args.top_k, "path")
    settings = Screening(max_tokens=args.max_tokens, overlap_tokens=args.overlap, red_threshold=args.red_threshold)
    return _write(S.screen(good.select("path", "text"), args.detector, settings, retrieve, id_col="path", in_flight=args.in_flight), f"{args.output}/decisions", "screen")


if __name__ == "__main__":
    import sys

    print(run(SparkSession.builder.appName("tamis").getOrCreate(), sys.argv[1:]))
