"""Words, chunks and text signals, all as built-in expressions but for tokenizers."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from tamis.schemas import literals

#: White space as Unicode has it, and the separators 0x1C-0x1F.
SPACE = r"(?U)[\s\x1c-\x1f]+"
TOKENS_PER_WORD = 1.3


def let(x: Column, body: Callable[[Column], Column]) -> Column:
    """body(x) with x evaluated once, however often the body names it: expressions with lambdas share no subexpressions, and the optimiser copies what a projection defines into every use of it."""
    return F.get(F.transform(F.array(x), body), F.lit(0))


def strip(x: Column) -> Column:
    return F.regexp_replace(x, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")


def words(x: Column) -> Column:
    """The words of a text; blank and null: none."""
    return F.filter(F.split(F.coalesce(x, F.lit("")), SPACE), lambda w: w != "")


def word_count(x: Column) -> Column:
    return F.size(words(x))


def approximate_tokens(x: Column) -> Column:
    return word_count(x) * F.lit(TOKENS_PER_WORD)


def window_sizes(max_tokens: int, overlap_tokens: int, per: float = TOKENS_PER_WORD) -> tuple[int, int]:
    """(window, step) in words. A step below 1 would never end and is refused."""
    window, overlap = int(max_tokens / per), int(overlap_tokens / per)
    if window < 1 or overlap < 0 or window - overlap < 1:
        raise ValueError(f"a window of {window} with an overlap of {overlap} makes no progress")
    return window, window - overlap


def _starts(n: Column, window: int, step: int) -> Column:
    """0-based window numbers: 1 if all fits, else until a window reaches the end."""
    return F.when(n <= window, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.ceil((n - window) / F.lit(step)).cast("int")))


def chunk_words(x: Column, max_tokens: int = 512, overlap_tokens: int = 64) -> Column:
    """Overlapping windows of words; a text that fits is one chunk as it stands, a blank one none."""
    window, step = window_sizes(max_tokens, overlap_tokens)
    # bound once by a lambda: the words are not split again for every window
    cut = lambda w: F.when(F.size(w) <= window, F.array(x)).otherwise(F.transform(_starts(F.size(w), window, step), lambda i: F.array_join(F.slice(w, i * step + 1, F.lit(window)), " ")))
    return F.when(word_count(x) == 0, literals([])).otherwise(F.flatten(F.transform(F.array(words(x)), cut)))


def chunk_characters(x: Column, max_tokens: int, overlap_tokens: int) -> Column:
    """Token windows under a tokenizer that makes each character a token."""
    window, step = window_sizes(max_tokens, overlap_tokens, per=1)
    n = F.length(x)
    windows = F.transform(_starts(n, window, step), lambda i: F.substring(x, i * step + 1, F.lit(window)))
    return F.when(F.coalesce(word_count(x), F.lit(0)) == 0, literals([])).otherwise(F.when(n <= window, F.array(x)).otherwise(windows))


def chunk_tokens(make_tokenizer: Callable[[], object], max_tokens: int = 512, overlap_tokens: int = 64) -> Callable[[Column], Column]:
    """A pandas UDF that cuts texts into token windows; make_tokenizer() gives an object with encode and decode, once per task."""
    window, step = window_sizes(max_tokens, overlap_tokens, per=1)

    @F.pandas_udf("array<string>")
    def chunks(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tok = make_tokenizer()

        def cut(text: str | None) -> list[str]:
            if not text or not text.strip():
                return []
            ids = tok.encode(text)
            if len(ids) <= window:
                return [text]
            last = -(-(len(ids) - window) // step)
            return [tok.decode(ids[i * step : i * step + window]) for i in range(last + 1)]

        for s in parts:
            yield s.map(cut)

    return chunks


def _sized(x: Column, separator: str) -> Column:
    part = F.split(F.coalesce(x, F.lit("")), "\\Q" + separator + "\\E", -1)
    return F.transform(part, lambda p: F.struct(p.alias("p"), word_count(p).alias("n")))


def _range(a: Column, b: Column, hard: Column) -> Column:
    return F.struct(a.cast("int").alias("a"), b.cast("int").alias("b"), hard.alias("hard"))


_RANGES = "array<struct<a:int,b:int,hard:boolean>>"


def flushed(s: Column) -> Column:
    """The complete ranges of a fold's state, and the open one."""
    return F.when(s["s"] < s["i"], F.concat(s["out"], F.array(_range(s["s"], s["i"], F.lit(False))))).otherwise(s["out"])


def _texts(paras: Column, ranges: Column, separator: str, hard: Callable[[Column], Column] | None = None) -> Column:
    """The texts of ranges of paragraphs; one marked hard is a single paragraph that hard() cuts into texts."""
    joined = lambda r: F.array(F.array_join(F.transform(F.slice(paras, r["a"] + 1, r["b"] - r["a"]), lambda s: s["p"]), separator))
    one = lambda r: F.get(paras, r["a"])["p"]
    return F.flatten(F.transform(ranges, lambda r: F.when(r["hard"], hard(one(r))).otherwise(joined(r)) if hard else joined(r)))


#: Paragraphs that are folded at a time: a fold copies what it carries with every element, so the ranges of a block are carried apart from those before.
_BLOCK = 256


def _fold(n: Column, step: Callable[[Column, Column], Column]) -> Column:
    """struct(out, s, i, w) after all of n: out the ranges that are complete, s where the open one starts, i the position, w the words of the open one."""
    state = lambda out, t: F.struct(out.alias("out"), *(t[c].alias(c) for c in ("s", "i", "w")))
    none, zero = F.array().cast(_RANGES), F.struct(*(F.lit(0).alias(c) for c in ("s", "i", "w")))
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(n) - 1) / F.lit(_BLOCK)).cast("int")), lambda j: F.slice(n, j * _BLOCK + 1, F.lit(_BLOCK)))
    return F.aggregate(F.when(F.size(n) > 0, blocks).otherwise(F.array(n)), state(none, zero), lambda t, block: let(F.aggregate(block, state(none, t), step), lambda u: state(F.concat(t["out"], u["out"]), u)))


def pack_paragraphs(x: Column, max_words: int = 400, overlap_words: int = 50, separator: str = "\n\n") -> Column:
    """Greedy packs of whole non-blank paragraphs up to max_words; the next pack starts with the last whole paragraphs that hold overlap_words together. An oversize paragraph is a pack of its own size. What is carried from paragraph to paragraph is numbers: the ranges of the packs, from which the texts are cut once."""

    def back(n: Column, s: Column) -> Column:
        """(k, w): the last paragraphs of the pack that hold overlap_words together; each has a word, so few are looked at."""
        near = F.greatest(s["s"], s["i"] - overlap_words)
        last = F.reverse(F.slice(n, near + 1, s["i"] - near))
        start = F.struct(F.lit(0).alias("k"), F.lit(0).alias("w"), F.lit(True).alias("go"))
        return F.aggregate(last, start, lambda t, y: F.when(t["go"] & (t["w"] + y <= overlap_words), F.struct((t["k"] + 1).alias("k"), (t["w"] + y).alias("w"), F.lit(True).alias("go"))).otherwise(F.struct(t["k"].alias("k"), t["w"].alias("w"), F.lit(False).alias("go"))))

    def ranges(n: Column) -> Column:
        def step(s: Column, y: Column) -> Column:
            emit = let(back(n, s), lambda t: F.struct(F.concat(s["out"], F.array(_range(s["s"], s["i"], F.lit(False)))).alias("out"), (s["i"] - t["k"]).alias("s"), (s["i"] + 1).alias("i"), (t["w"] + y).alias("w")))
            add = F.struct(s["out"].alias("out"), s["s"].alias("s"), (s["i"] + 1).alias("i"), (s["w"] + y).alias("w"))
            return F.when((s["w"] + y > max_words) & (s["s"] < s["i"]), emit).otherwise(add)

        return let(_fold(n, step), flushed)

    numbers = lambda paras: let(F.transform(paras, lambda s: s["n"]), ranges)
    return let(F.filter(_sized(x, separator), lambda s: s["n"] > 0), lambda paras: let(numbers(paras), lambda r: _texts(paras, r, separator)))


def split_sections(x: Column, max_words: int = 30000, separator: str = "\n\n") -> Column:
    """Sections of up to max_words: a text that fits as it stands, else packs of paragraphs (blank ones kept) without overlap; a longer paragraph is cut every max_words."""

    def step(s: Column, y: Column) -> Column:
        after = s["i"] + 1
        over = F.struct(F.concat(flushed(s), F.array(_range(s["i"], after, F.lit(True)))).alias("out"), after.alias("s"), after.alias("i"), F.lit(0).alias("w"))
        emit = F.struct(flushed(s).alias("out"), s["i"].alias("s"), after.alias("i"), y.alias("w"))
        add = F.struct(s["out"].alias("out"), s["s"].alias("s"), after.alias("i"), (s["w"] + y).alias("w"))
        return F.when(y > max_words, over).when((s["w"] + y > max_words) & (s["s"] < s["i"]), emit).otherwise(add)

    cut = lambda p: let(words(p), lambda w: F.transform(F.sequence(F.lit(0), F.floor((F.size(w) - 1) / F.lit(max_words)).cast("int")), lambda i: F.array_join(F.slice(w, i * max_words + 1, F.lit(max_words)), " ")))
    numbers = lambda paras: let(let(F.transform(paras, lambda s: s["n"]), lambda n: _fold(n, step)), flushed)
    packed = let(_sized(x, separator), lambda paras: let(numbers(paras), lambda r: _texts(paras, r, separator, cut)))
    return F.when(word_count(x) <= max_words, F.array(F.coalesce(x, F.lit("")))).otherwise(packed)


# Patterns and word lists of the text signals.
DOLLAR_AMOUNT = r"\$\s*[\d,]+(?:\.\d+)?"
_STAFF = r"(?:personnel|staff|fte|ftes|contractor|contractors|position|positions|role|roles|people|employee|employees|worker|workers|team\s*member|team\s*members)"
_TEN_OR_MORE = r"(?:1[0-9]|[2-9][0-9]|[1-9]\d{2,})"
HEADCOUNT = rf"(?i)(?:{_TEN_OR_MORE}\s*{_STAFF}|{_STAFF}\D{{0,30}}{_TEN_OR_MORE})"
ONSITE_TERMS = ["onsite", "on-site", "on site", "in-person", "in person", "physically present", "physical presence", "place of performance"]
ROLE_KEYWORDS = ["manager", "engineer", "analyst", "specialist", "lead", "architect", "developer", "sme", "administrator", "director", "technician", "coordinator", "programmer", "scientist", "advisor"]


def has_dollar_amount(x: Column) -> Column:
    return F.coalesce(x.rlike(DOLLAR_AMOUNT), F.lit(False))


def has_headcount(x: Column) -> Column:
    """At least ten of a staff noun, the number before or after it. Texts without a number of two digits need no search for nouns."""
    return F.coalesce(x.rlike("[1-9][0-9]") & x.rlike(HEADCOUNT), F.lit(False))


def _any_of(x: Column, terms: list[str]) -> Column:
    return F.exists(literals(terms), lambda t: F.contains(x, t))


def has_onsite_term(x: Column) -> Column:
    return F.coalesce(_any_of(F.lower(x), ONSITE_TERMS), F.lit(False))


def role_lines(x: Column) -> Column:
    """Number of lines that name a role."""
    return F.size(F.filter(F.split(F.lower(F.coalesce(x, F.lit(""))), "\n", -1), lambda line: _any_of(line, ROLE_KEYWORDS)))


def has_enumerated_roles(x: Column, threshold: int = 10) -> Column:
    return role_lines(x) >= threshold


def has_large_team(x: Column) -> Column:
    return has_headcount(x) | has_enumerated_roles(x)
