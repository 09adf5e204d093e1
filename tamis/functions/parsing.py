"""Decoding of model answers: flag lists, JSON with fences and prose around it, verdicts."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from tamis.functions.text import let, strip
from tamis.schemas import CHUNKS, EMPTY_ANSWERS, NO_FLAG, VERDICT, literals


def says_nothing(raw: Column) -> Column:
    """The whole answer is one of the words for no flag."""
    return F.coalesce(F.lower(strip(raw)).isin(*EMPTY_ANSWERS), F.lit(False))


def parse_flags(raw: Column, vocabulary: Column) -> Column:
    """Names of the vocabulary in an answer split at newlines and commas; order and repetitions stay. Null and blank: none."""
    names = lambda r: F.transform(F.split(r, "[\n,]+"), strip)
    return let(F.coalesce(raw, F.lit("")), lambda r: F.when(says_nothing(r), literals([])).otherwise(F.filter(names(r), lambda f: F.array_contains(vocabulary, f))))


def parse_ok(raw: Column, vocabulary: Column) -> Column:
    """An answer that names a flag or says that there is none."""
    return let(raw, lambda r: says_nothing(r) | (F.size(parse_flags(r, vocabulary)) > 0))


def format_ok(raw: Column, vocabulary: Column) -> Column:
    """Stricter, for evaluation: names a flag, or is exactly `no_flag`."""
    return let(raw, lambda r: F.coalesce(strip(r) == NO_FLAG, F.lit(False)) | (F.size(parse_flags(r, vocabulary)) > 0))


def render_label(flags: Column) -> Column:
    return F.when(F.size(flags) > 0, F.array_join(flags, "\n")).otherwise(F.lit(NO_FLAG))


def strip_fence(x: Column) -> Column:
    """Without a code fence: of an answer that starts with one, the first line goes, and the last one if it is a fence."""
    lines = F.split(strip(x), "\n", -1)
    inner = F.slice(lines, 2, F.greatest(F.size(lines) - 1, F.lit(0)))
    closed = F.when((F.size(inner) > 0) & (strip(F.element_at(inner, -1)) == "```"), F.slice(inner, 1, F.size(inner) - 1)).otherwise(inner)
    return F.when(F.startswith(strip(x), F.lit("```")), F.when(F.size(lines) > 1, F.array_join(closed, "\n")).otherwise(F.lit(""))).otherwise(strip(x))


def salvage_object(x: Column) -> Column:
    """From the first { to the last }, if they come in this order; else the text."""
    inner = F.regexp_extract(x, r"(?s)\{.*\}", 0)
    return F.when(inner != "", inner).otherwise(x)


def json_flags(x: Column) -> Column:
    """The `flags` of a JSON object, or a bare JSON list; anything else: none."""
    clean = strip_fence(x)
    return F.coalesce(F.from_json(salvage_object(clean), "flags array<string>")["flags"], F.from_json(clean, "array<string>"), literals([]))


def json_records(x: Column, schema: str = CHUNKS) -> Column:
    """A JSON list of records; anything else: an empty one. Missing fields are null."""
    clean = strip_fence(x)
    # a single object would be read as a list of one
    return F.coalesce(F.when(F.startswith(clean, F.lit("[")), F.from_json(clean, schema)), F.array().cast(schema))


def json_verdicts(x: Column) -> Column:
    return json_records(x, VERDICT)


def service_text(body: Column) -> Column:
    """The generated text of a service's response body; empty where it has none."""
    return F.coalesce(F.get_json_object(body, "$.generation"), F.lit(""))


def salvaged_strings(text: str | None) -> list[str] | None:
    """Strings of a JSON list that may be cut off: complete ones up to the first fault; None if there is not one."""
    text = (text or "").strip()
    if text.startswith("```"):
        lines = text.split("\n")[1:]
        text = "\n".join(lines[:-1] if lines and lines[-1].strip() == "```" else lines)
    try:
        whole = json.loads(text)
        return [x for x in whole if isinstance(x, str)] if isinstance(whole, list) else None
    except ValueError:
        pass
    at, out, decoder = text.find("[") + 1, [], json.JSONDecoder()
    while at:
        while at < len(text) and text[at] in " \t\r\n,":
            at += 1
        try:
            value, at = decoder.raw_decode(text, at)
        except ValueError:
            break
        if isinstance(value, str):
            out.append(value)
    return out or None


def salvage_strings(x: Column) -> Column:
    """salvaged_strings of each answer; built-in JSON functions give null for a list that is cut off."""

    def salvage(answers: pd.Series) -> pd.Series:
        return answers.map(salvaged_strings)

    return F.pandas_udf(salvage, "array<string>")(x)


def in_vocabulary(flags: Column, vocabulary: Column) -> Column:
    """Only known flags; order and repetitions stay."""
    return F.filter(flags, lambda f: F.array_contains(vocabulary, f))


def only_original(flags: Column, original: Column) -> Column:
    """Only flags that were there before."""
    return F.filter(flags, lambda f: F.array_contains(original, f))


def strictly_valid(chunk_text: Column, flags: Column, vocabulary: Column) -> Column:
    """Text and flags are there and all flags known; an empty list will do."""
    return chunk_text.isNotNull() & flags.isNotNull() & F.coalesce(F.forall(flags, lambda f: F.array_contains(vocabulary, f)), F.lit(False))
