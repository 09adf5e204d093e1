"""Byte-level BPE encoding and decoding by overlapping chunks.

Texts are cut into chunks of CHUNK characters, each reading OVERLAP characters on. Chunks are pre-tokenised in parallel; only
the first starts at a true pre-token boundary. Where a boundary of one chunk is also a boundary of the next, both agree from
there on, since the pattern never looks back: the chunks are stitched at that place and the pieces between the stitches
encoded. A chunk whose overlap holds no common boundary (a run of letters or spaces longer than OVERLAP) is joined with the
next and split into pre-tokens again. Decoding concatenates the raw bytes of the ids.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamis.llm.secrets import load_tokenizer

CHUNK = 8192
OVERLAP = 512


class ChunkedBpe:
    """Encodes texts as a rank file and a pre-token pattern say, chunk by chunk."""

    def __init__(self, path: str, pattern: str, chunk: int = CHUNK, overlap: int = OVERLAP):
        import regex

        if not 0 < overlap < chunk:
            raise ValueError("overlap must be above 0 and below chunk")
        self.enc, self.pattern, self.chunk, self.overlap = load_tokenizer(path, pattern), regex.compile(pattern), chunk, overlap

    def boundaries(self, text: str) -> np.ndarray:
        """Starts of the pre-tokens of a chunk, which tile it."""
        return np.fromiter((m.start() for m in self.pattern.finditer(text)), np.int64)

    def windows(self, text: str, start: int, last: bool) -> tuple[np.ndarray, np.ndarray]:
        """Of a chunk that starts at `start` of its text and holds chunk + overlap characters: the pre-token starts in its first and in its last `overlap` characters, as positions in the text. The last two starts may owe themselves to the end of what was read and are left out, except at the end of the text."""
        at = self.boundaries(text)
        kept = at if last else at[:-2]
        return at[at < self.overlap] + start, kept[kept >= self.chunk] + start

    @staticmethod
    def stitch(before: np.ndarray, after: np.ndarray, text: str, start: int = 0) -> int | None:
        """The last place that two chunks both take for a boundary; never one after white space, whose pre-token depends on what follows. A space between ASCII letters is preferred, where no two versions of Unicode disagree. text begins at position `start`."""
        both = [b for b in np.intersect1d(before, after)[::-1].tolist() if b > start and not text[b - start - 1].isspace()]
        around = lambda b: text[b - start - 1] + text[b - start + 1 : b - start + 2]
        plain = (b for b in both if text[b - start] == " " and around(b).isalpha() and around(b).isascii())
        return next(plain, both[0] if both else None)

    def cuts(self, text: str) -> list[int]:
        """Where the stitched pieces of a text start, and its length: true pre-token boundaries. Reading goes on from the last boundary that is known; where a run has none, twice as far each time, so that the time is in proportion to the text."""
        out, n, known, b = [0], len(text), 0, self.chunk
        while b < n - self.overlap:
            before = self.boundaries(text[known : b + self.overlap])[:-2] + known
            after = self.boundaries(text[b : b + 2 * self.overlap]) + b
            at = self.stitch(before[before > max(b, out[-1])], after, text)
            if at is None:  # within a long run: what was read from a known boundary shows true ones as well
                at = next((x for x in before[::-1].tolist() if x >= out[-1] + self.chunk and not text[x - 1].isspace()), None)
            if at is not None:
                out.append(at)
            was, known = known, max([known, *before[-1:].tolist(), *([at] if at else [])])
            b += self.chunk if known > was else max(self.chunk, b - known)
        return [*out, n]

    def encode(self, piece: str) -> np.ndarray:
        return np.array(self.enc.encode_ordinary(piece), "<u4")

    def ids(self, text: str) -> np.ndarray:
        """Ids of a whole text."""
        if len(text) <= self.chunk:
            return self.encode(text)
        cuts = self.cuts(text)
        return np.concatenate([self.encode(text[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)])

    def decode(self, ids: np.ndarray) -> bytes:
        """The raw bytes of the ids, concatenated."""
        return self.enc.decode_bytes(ids.tolist())


_TOKENS = "n_tokens bigint, ids binary, decoded binary"


def encode_documents(documents: DataFrame, path: str, pattern: str, chunk: int = CHUNK, overlap: int = OVERLAP, spread: int = 65536, digests: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Token ids of every whole text and what they decode to: doc_id, n_tokens, ids (little-endian unsigned 32-bit), decoded (bytes).

    Texts above `spread` characters have their chunks pre-tokenised, and their pieces encoded, in tasks of their own; others
    are chunked within their task. With digests, ids_sha256 and decoded_sha256 (lowercase hex) stand for the two binaries and
    no ids are shuffled but those of spread texts. A null text is read as empty: no ids. One row per input row, repeated ids
    and rows included; other columns are ignored; an empty table gives no rows.
    """
    out_type = "n_tokens bigint, ids_sha256 string, decoded_sha256 string" if digests else _TOKENS

    def finish(bpe: ChunkedBpe, found: list[np.ndarray]) -> pd.DataFrame:
        out = {"n_tokens": [len(i) for i in found]}
        if digests:
            out |= {"ids_sha256": [hashlib.sha256(i.tobytes()).hexdigest() for i in found], "decoded_sha256": [hashlib.sha256(bpe.decode(i)).hexdigest() for i in found]}
        else:
            out |= {"ids": [i.tobytes() for i in found], "decoded": [bpe.decode(i) for i in found]}
        return pd.DataFrame(out)

    def whole(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = ChunkedBpe(path, pattern, chunk, overlap)
        for pdf in parts:
            for at in range(0, len(pdf), 256):
                some = pdf.iloc[at : at + 256]
                out = finish(bpe, [bpe.ids(t or "") for t in some["text"]])
                out.insert(0, "doc_id", some["doc_id"].to_numpy())
                yield out

    def pretokenise(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = ChunkedBpe(path, pattern, chunk, overlap)
        for pdf in parts:
            both = [bpe.windows(t, s, last) for t, s, last in zip(pdf["part"], pdf["start"], pdf["last"], strict=True)]
            yield pdf[["doc_id", "digest", "start"]].assign(head=[h.astype("<i8").tobytes() for h, _ in both], tail=[t.astype("<i8").tobytes() for _, t in both])

    def join_up(pdf: pd.DataFrame) -> pd.DataFrame:
        bpe = ChunkedBpe(path, pattern, chunk, overlap)
        text, rows = pdf["text"].iloc[0], pdf.sort_values("start").drop_duplicates("start")
        heads, tails = ([np.frombuffer(b, "<i8") for b in rows[c]] for c in ("head", "tail"))
        cuts = [0, *(bpe.stitch(t, h, text) for t, h in zip(tails, heads[1:], strict=False)), len(text)]
        if None in cuts:  # a later chunk may have started amid a run: walk the text from its last true boundary
            cuts = bpe.cuts(text)
        pieces = [text[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
        return pd.DataFrame({"doc_id": pdf["doc_id"].iloc[0], "digest": pdf["digest"].iloc[0], "copies": pdf["copies"].iloc[0], "no": range(len(pieces)), "piece": pieces})

    def encode_pieces(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = ChunkedBpe(path, pattern, chunk, overlap)
        for pdf in parts:
            yield pdf[["doc_id", "digest", "copies", "no"]].assign(ids=[bpe.encode(p).tobytes() for p in pdf["piece"]])

    def concatenate(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = ChunkedBpe(path, pattern, chunk, overlap)
        for pdf in parts:
            for r in pdf.itertuples(index=False):
                out = finish(bpe, [np.frombuffer(b"".join(x["ids"] for x in r.parts), "<u4")])
                out.insert(0, "doc_id", r.doc_id)
                for at in range(0, r.copies, 1024):
                    yield pd.concat([out] * min(1024, r.copies - at))

    rows = documents.selectExpr(f"cast(`{id_col}` as bigint) AS doc_id", f"`{text_col}` AS text")
    long = F.coalesce(F.length("text") > max(spread, chunk), F.lit(False))
    short = rows.where(~long).mapInPandas(whole, f"doc_id bigint, {out_type}")
    texts = rows.where(long).groupBy("doc_id", F.sha2("text", 256).alias("digest")).agg(F.first("text").alias("text"), F.count("*").alias("copies"))
    starts = F.sequence(F.lit(0).cast("bigint"), F.length("text").cast("bigint") - 1 - overlap, F.lit(chunk).cast("bigint"))
    chunks = texts.select("doc_id", "digest", "text", F.explode(starts).alias("start")).select("doc_id", "digest", "start", F.expr(f"substring(text, cast(start + 1 AS int), {chunk + overlap})").alias("part"), (F.col("start") + chunk + overlap >= F.length("text")).alias("last"))
    heads = chunks.repartition("doc_id", "digest", "start").mapInPandas(pretokenise, "doc_id bigint, digest string, start bigint, head binary, tail binary")
    met = texts.join(heads.withColumnRenamed("doc_id", "d").withColumnRenamed("digest", "g"), F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("digest") == F.col("g"))).drop("d", "g")
    met = met.withColumn("text", F.when(F.col("start") == 0, F.col("text")))
    pieces = met.groupBy("doc_id", "digest").applyInPandas(lambda pdf: join_up(pdf.sort_values("start")), "doc_id bigint, digest string, copies bigint, no int, piece string")
    coded = pieces.repartition("doc_id", "digest", "no").mapInPandas(encode_pieces, "doc_id bigint, digest string, copies bigint, no int, ids binary")
    parts = coded.groupBy("doc_id", "digest", "copies").agg(F.array_sort(F.collect_list(F.struct("no", "ids"))).alias("parts"))
    return short.unionByName(parts.select("doc_id", "copies", "parts").mapInPandas(concatenate, f"doc_id bigint, {out_type}"))
