"""Secret scan: fixed patterns, and a token-efficiency test for random strings.

Text that a public byte-level BPE vocabulary knows packs several characters into a token; keys and passwords do not. A run of
key characters with few characters per token is reported as `random`, unless it is a digest of a known length, a UUID, a
number or a date; names, also with a number at the end, are measured by their letters against a stricter limit. What the fixed
patterns find is reported in any case.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame


#: The patterns of the base kinds and the least lengths of what they match.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_LEAST, ACCESS_LEAST = 6, 20
WORDS = ("passw", "secret", "token", "api")
KINDS = ("assign", "access", "hex", "random")

#: Runs that the token-efficiency test looks at, and what it leaves out: digests of usual lengths and identifiers.
#: Runs below LONG characters are tested as a whole only, need a digit and a letter, and must stay below SHORT_SHARE times the ratio.
SHORT, LONG, SHORT_SHARE = 12, 16, 0.85
RUN = re.compile(r"[A-Za-z0-9+/_-]{12,}={0,2}")
DIGEST = re.compile(r"(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{56}|[0-9a-f]{64}|[0-9a-f]{96}|[0-9a-f]{128})\Z", re.IGNORECASE)
IDENTIFIER = re.compile(
    r"(?:[0-9a-f]{8}-(?:[0-9a-f]{4}-){3}[0-9a-f]{12}"  # UUID
    r"|[0-9+/_-]+)\Z",  # numbers, dates, phone and card numbers, rules
    re.IGNORECASE,
)
#: What windows pass over within a run.
KNOWN = re.compile(r"(?<![0-9a-f])(?:[0-9a-f]{8}-(?:[0-9a-f]{4}-){3}[0-9a-f]{12}|[0-9a-f]{32,128})(?![0-9a-f])", re.IGNORECASE)
#: Names: left out only if their letters read as words, that is at STRICT times the ratio or more.
NAME = re.compile(
    r"(?:[A-Za-z+/_-]+"  # words, paths and names without a digit
    r"|[A-Za-z]+[_-]?[0-9]{1,6}|[0-9]{1,6}[A-Za-z]+"  # name and number
    r"|(?:[A-Za-z]+[_/-])+[0-9]{1,6})\Z",  # names joined by marks, and a number
)
STRICT = 0.95
#: Windows that find keys glued to words, or with marks of their own in a path: both halves stay below WINDOW_SHARE times the ratio.
WINDOW, WINDOW_SHARE = 20, 0.9
LETTERS, PART = re.compile(r"[A-Za-z]+"), re.compile(r"[A-Za-z0-9+]+")


def load_tokenizer(path: str, pattern: str):
    """The tiktoken encoding of a rank file, without special tokens."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns: leftmost matches per kind that do not overlap, without those too short."""
    low, out = text.lower(), []
    if any(w in low for w in WORDS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LEAST]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    return out + [(m.start(), 2, m.end()) for m in HEX.finditer(text)]


def is_random(run: str, count_tokens, most_ratio: float) -> bool:
    """Whether a run of SHORT characters and more stays below most_ratio characters per token and is no digest or identifier."""
    if len(run) < SHORT or DIGEST.match(run) or IDENTIFIER.match(run):
        return False
    if len(run) < LONG:
        return not NAME.match(run) and len(run) < SHORT_SHARE * most_ratio * count_tokens(run)
    if NAME.match(run):
        words = LETTERS.findall(run)
        return sum(map(len, words)) < STRICT * most_ratio * sum(map(count_tokens, words))
    return len(run) < most_ratio * count_tokens(run)


def random_windows(run: str, count_tokens, most_ratio: float) -> list[tuple[int, int]]:
    """(start, end) of the stretches of a run that random windows cover: windows with a digit, and letters for half of their characters at least. Digests and UUIDs within the run are passed over."""
    half, out, ratio = WINDOW // 2, [], {}

    def low(at: int) -> bool:
        if at not in ratio:
            parts = PART.findall(run[at : at + half])
            ratio[at] = sum(map(len, parts)) < WINDOW_SHARE * most_ratio * sum(map(count_tokens, parts))
        return ratio[at]

    known = [m.span() for m in KNOWN.finditer(run)]
    for at in range(len(run) - WINDOW + 1):
        w = run[at : at + WINDOW]
        letters = sum(c.isalpha() for c in w)
        if letters * 2 >= WINDOW and any(c.isdigit() for c in w) and low(at) and low(at + half) and not any(a < at + WINDOW and at < b for a, b in known):
            if out and at <= out[-1][1]:
                out[-1] = (out[-1][0], at + WINDOW)
            else:
                out.append((at, at + WINDOW))
    return out


def random_spans(text: str, count_tokens, most_ratio: float) -> list[tuple[int, int, int]]:
    """(start, kind, end) of runs that are random; where a run as a whole is not, of its parts between `/`, `-` and `_` that are, else of its windows."""
    if max(map(len, text.split()), default=0) < SHORT:
        return []
    out = []
    for m in RUN.finditer(text):
        run = m.group().strip("=-_/+")
        if is_random(run, count_tokens, most_ratio):
            out.append((m.start(), 3, m.end()))
        elif len(run) >= LONG and not IDENTIFIER.match(run) and not DIGEST.match(run):
            parts = [p.span() for p in PART.finditer(m.group()) if is_random(p.group().strip("+"), count_tokens, most_ratio)]
            out += [(m.start() + a, 3, m.start() + b) for a, b in parts or random_windows(m.group(), count_tokens, most_ratio)]
    return out


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


def scan_secrets(documents: DataFrame, tokenizer_path: str, pattern: str, most_ratio: float = 2.0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Secrets in every whole text: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random.

    spans lists all spans as kind:start:end by start, then kind (assign, access, hex, random), comma-joined; positions are
    code points, end exclusive. base_sha256 digests the same list without `random`. A null text is read as empty: no spans.
    One row per input row, repeated ids included; other columns are ignored; an empty table gives no rows.
    """

    def scan(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = load_tokenizer(tokenizer_path, pattern)
        count = lambda run: len(enc.encode_ordinary(run))
        for pdf in parts:
            out = []
            for text in pdf["text"]:
                text = text or ""
                base = base_spans(text)
                more = random_spans(text, count, most_ratio)
                kinds = [k for _, k, _ in base]
                out.append((*(kinds.count(k) for k in range(3)), hashlib.sha256(joined(base).encode()).hexdigest(), joined(base + more), len(more)))
            done = pd.DataFrame(out, columns=["n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_random"])
            done.insert(0, "doc_id", pdf["doc_id"].to_numpy())
            yield done

    rows = documents.selectExpr(f"cast(`{id_col}` as bigint) AS doc_id", f"`{text_col}` AS text")
    return rows.mapInPandas(scan, "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string, n_random bigint")
