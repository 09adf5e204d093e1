"""Prompts and chat records as string expressions; the wording is this engine's own, the frames are data contracts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tamis.functions.parsing import render_label
from tamis.functions.text import word_count
from tamis.schemas import RUNTIME_TIERS

# Frames that trained models expect.
CONTEXT_HEAD = "[Retrieved context]"
CHUNK_MARK = "RFP chunk to analyze:\n"
TEMPLATE = ("<|begin_of_text|><|start_header_id|>system<|end_header_id|>\n\n", "<|eot_id|><|start_header_id|>user<|end_header_id|>\n\n", "<|eot_id|><|start_header_id|>assistant<|end_header_id|>\n\n")

SYSTEM_PROMPT = "Name the flags that the given text shows, one per line, by these exact names: " + ", ".join([*RUNTIME_TIERS, "no_flag"]) + ". Write no_flag if there are none, and nothing else."
MOST_PROMPT_WORDS = 600_000


def context_block(passages: Column, chunk: Column) -> Column:
    """Numbered example passages, a rule, and the chunk; without passages the frame remains."""
    examples = F.transform(F.coalesce(passages, F.array().cast("array<string>")), lambda p, i: F.concat(F.lit("\nExample "), (i + 1).cast("string"), F.lit(":\n"), p))
    return F.array_join(F.concat(F.array(F.lit(CONTEXT_HEAD)), examples, F.array(F.concat(F.lit("\n---\n\n" + CHUNK_MARK), chunk))), "\n")


def extract_chunk(prompt: Column) -> Column:
    """What follows the first chunk mark; a prompt without one is a chunk."""
    at = F.locate(CHUNK_MARK, prompt)
    return F.when(at > 0, F.substring(prompt, at + len(CHUNK_MARK), F.length(prompt))).otherwise(prompt)


def chat_template(chunk: Column, system: str = SYSTEM_PROMPT) -> Column:
    a, b, c = TEMPLATE
    return F.concat(F.lit(a + system + b), chunk, F.lit(c))


def message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def chat_record(user: Column, flags: Column, system: str = SYSTEM_PROMPT) -> Column:
    """Three messages: system, user, and the flags as the assistant's answer."""
    return F.array(message("system", F.lit(system)), message("user", user), message("assistant", render_label(flags)))


def of_roles(messages: Column, *roles: str) -> Column:
    return F.filter(messages, lambda m: m["role"].isin(*roles))


def first_content(messages: Column, role: str) -> Column:
    """Content of the first message of a role; null without one."""
    return F.get(of_roles(messages, role), F.lit(0))["content"]


def _listed(flags: Column, definitions: Column, mark: Column | None = None) -> Column:
    """A line per flag with its definition in the map, or its own name where it has none."""
    line = lambda f: F.concat(F.lit("- "), F.when(F.array_contains(mark, f), F.lit("BLACK ")).otherwise(F.lit("")) if mark is not None else F.lit(""), f, F.lit(": "), F.coalesce(F.try_element_at(definitions, f), f))
    return F.array_join(F.transform(flags, line), "\n")


def extraction_prompt(text: Column, needed: Column, filled: Column, definitions: Column) -> Column:
    """Asks for passages that show the flags still needed."""
    return F.concat(F.lit("Quote passages that show any of these flags, as a JSON list of {chunk_text, flags, confidence, adversarial}.\n"), _listed(needed, definitions), F.lit("\nDo not quote passages for: "), F.array_join(filled, ", "), F.lit("\n\nText:\n"), text)


def fits_prompt(text: Column) -> Column:
    return word_count(text) <= MOST_PROMPT_WORDS


def validation_prompt(items: Column) -> Column:
    """Asks for one verdict per item of a batch: array<struct<chunk_text, flags, confidence, adversarial>>."""
    one = lambda x, i: F.concat(F.lit("["), i.cast("string"), F.lit("] flags: "), F.array_join(x["flags"], ", "), F.lit("; confidence: "), F.coalesce(x["confidence"], F.lit("medium")), F.lit("; adversarial: "), F.coalesce(x["adversarial"], F.lit(False)).cast("string"), F.lit("\n"), x["chunk_text"])
    return F.concat(F.lit("Judge each item: KEEP, FIX with corrected_flags, or DROP with a reason, as a JSON list of {index, verdict, corrected_flags, reason}.\n\n"), F.array_join(F.transform(items, one), "\n\n"))


def labelling_prompt(chunk: Column, definitions: Column) -> Column:
    return F.concat(F.lit('Which of these flags does the text show? Answer {"flags": [...]}.\n'), _listed(F.map_keys(definitions), definitions), F.lit("\n\nText:\n"), chunk)


def flag_check_prompt(chunk: Column, flags: Column, definitions: Column, black: Column) -> Column:
    """Asks which of a chunk's own flags hold; those of the black tier are marked."""
    return F.concat(F.lit('Which of these flags hold for the text? Answer {"flags": [...]}.\n'), _listed(flags, definitions, black), F.lit("\n\nText:\n"), chunk)


def generation_prompt(flag: Column, definition: Column, examples: Column, n: Column) -> Column:
    return F.concat(F.lit("Write "), n.cast("string"), F.lit(" passages, as a JSON list of strings, that show "), flag, F.lit(" ("), definition, F.lit("). Examples:\n"), F.array_join(examples, "\n"))
