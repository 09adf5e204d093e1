"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

score = sigmoid(w0 + sum w_i x_i + sum over pairs <v_i, v_j> x_i x_j); the pairwise part is computed in linear time as half of
the sum over factors of (sum v_if x_i)^2 - sum (v_if x_i)^2.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamis.llm.common import join_small, stash
from tamis.llm.words import texts_in_blocks, word_hashes

WORD_BITS = 12
FACTORS = 6
#: Bound of the labelled sample that a model is fitted on.
SAMPLE_ROWS = 6000


def structure(data: np.ndarray, raw: np.ndarray, h: np.ndarray, size: np.ndarray, n_chars: float) -> np.ndarray:
    """Statistics of one text from its bytes (lower case and as they were), word hashes and word lengths, and its metadata."""
    n, k = max(1, len(raw)), max(1, len(h))
    c = np.bincount(raw, minlength=256)
    letters = max(1, c[65:91].sum() + c[97:123].sum() + c[128:].sum())
    marks = c[33:48].sum() + c[58:65].sum() + c[91:97].sum() + c[123:127].sum()
    distinct, times = np.unique(h, return_counts=True)
    lines = data.tobytes().split(b"\n")
    full = [x for x in lines if x.strip()]
    return np.array([
        np.log1p(len(raw)), np.log1p(len(h)), np.log1p(len(lines)), np.log1p(len(raw) / max(1, len(full))),
        c[65:91].sum() / letters, c[48:58].sum() / n, marks / n, c[128:].sum() / n, c[33] / k, c[124] / k, (c[35] + c[36] + c[37] + c[38] + c[42]) / k, c[44] / k, c[46] / k,
        size.mean() if len(size) else 0.0, size.std() if len(size) else 0.0, len(distinct) / k, times.max(initial=0) / k, (h[1:] == h[:-1]).sum() / k, 1 - len(set(full)) / max(1, len(full)),
    ] + [np.log1p(max(0.0, n_chars)) if n_chars == n_chars else -1.0])


def rows(texts: list[str | None], n_chars: list[float]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each text: unit-length square roots of hashed word counts, and structure statistics with metadata."""
    for a, _, data, at in texts_in_blocks(texts):
        b = np.frombuffer(data, np.uint8)
        h, start, size = word_hashes(b)
        bound = np.searchsorted(start, at)
        for k, (i, j) in enumerate(zip(at[:-1], at[1:], strict=True)):
            own = slice(bound[k], bound[k + 1])
            x = np.sqrt(np.bincount((h[own] >> np.uint64(64 - WORD_BITS)).astype(np.int64), minlength=1 << WORD_BITS))
            raw = np.frombuffer((texts[a + k] or "").encode("utf-8", "surrogatepass"), np.uint8)
            yield x / (np.linalg.norm(x) or 1.0), structure(b[i : j - 1], raw, h[own], size[own], n_chars[a + k])


class FactorisationMachine:
    """Weights w0, w, v; fitted by Adam on the logistic loss, classes weighing by the square root of their share."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray):
        self.mean, self.scale = mean, scale
        n = (1 << WORD_BITS) + len(mean)
        self.w0, self.w, self.v = 0.0, np.zeros(n), np.random.default_rng(11).normal(0, 0.05, (n, FACTORS))

    def inputs(self, words: np.ndarray, stats: np.ndarray) -> np.ndarray:
        """Words as they are; statistics standardised, cut at 4 deviations and scaled down to the words' range."""
        return np.concatenate([words, np.clip((stats - self.mean) / self.scale, -4, 4) / 4], axis=-1)

    def margin(self, x: np.ndarray) -> np.ndarray:
        return self.w0 + x @ self.w + 0.5 * (((x @ self.v) ** 2).sum(axis=-1) - (x**2 @ self.v**2).sum(axis=-1))

    def score(self, words: np.ndarray, stats: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(self.inputs(words, stats)), -30, 30)))

    def fit(self, get, y: np.ndarray, epochs: int = 12, batch: int = 128, rate: float = 0.02, decay: float = 1e-4) -> FactorisationMachine:
        """get(rows) gives the (words, stats) of some rows."""
        rng, share = np.random.default_rng(13), max(1e-6, float(np.mean(y)))
        weight = np.where(y > 0, np.sqrt(0.5 / share), np.sqrt(0.5 / max(1e-6, 1 - share)))
        moments = [[np.zeros_like(a), np.zeros_like(a)] for a in (np.zeros(1), self.w, self.v)]
        t = 0
        for epoch in range(epochs):
            order = rng.permutation(len(y))
            for at in range(0, len(y), batch):
                some = order[at : at + batch]
                x, t = self.inputs(*get(some)), t + 1
                s = x @ self.v
                p = 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30)))
                e = weight[some] * (p - y[some]) / len(some)
                grads = [np.array([e.sum()]), x.T @ e + decay * self.w, x.T @ (e[:, None] * s) - (x.T**2 @ e)[:, None] * self.v + decay * self.v]
                step = rate * (1 - epoch / epochs)
                for k, g in enumerate(grads):
                    m, q = moments[k]
                    m += 0.1 * (g - m)
                    q += 0.01 * (g * g - q)
                    d = step * (m / (1 - 0.9**t)) / (np.sqrt(q / (1 - 0.99**t)) + 1e-8)
                    if k == 0:
                        self.w0 -= float(d[0])
                    elif k == 1:
                        self.w -= d
                    else:
                        self.v -= d
        return self


def labelled_sample(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE_ROWS) -> DataFrame:
    """At most `sample` labelled documents with crc32(doc_id) mod 3 not 1, the first by a hash of the id: doc_id, y, text, n_chars. An id with several labels, or texts, has the smallest."""
    own = stash(labels.where("quality IS NOT NULL AND doc_id IS NOT NULL AND crc32(cast(doc_id AS string)) % 3 <> 1").groupBy("doc_id").agg((F.min("quality") > 0).cast("int").alias("y")), "quality-labels")
    u = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(1 << 40)) / float(1 << 40)
    n = own.count()
    ids = stash(own.withColumn("u", u).where(F.col("u") * n < 2 * sample).orderBy("u", "doc_id").limit(sample).drop("u"), "quality-sample")
    return join_small(documents.select(F.col("doc_id").cast("bigint"), "text", F.col("n_chars").cast("double")), ids, ["doc_id"], F.col("doc_id"), how="inner").groupBy("doc_id", "y").agg(F.min(F.struct("text", "n_chars")).alias("own")).select("doc_id", "y", "own.*")


def _sparse(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in parts:
        got = list(rows(pdf["text"].tolist(), pdf["n_chars"].tolist()))
        at = [np.flatnonzero(x) for x, _ in got]
        yield pdf[["doc_id", "y"]].assign(at=[a.astype(np.int16).tobytes() for a in at], x=[x[a].astype(np.float32).tobytes() for (x, _), a in zip(got, at, strict=True)], stats=[s.tobytes() for _, s in got])


def fit_quality_model(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE_ROWS) -> FactorisationMachine | None:
    """A machine fitted on at most `sample` labelled documents, of which the features come to the driver; None without labels of both kinds."""
    got = labelled_sample(documents, labels, sample).mapInPandas(_sparse, "doc_id bigint, y int, at binary, x binary, stats binary").toPandas().sort_values("doc_id")
    y = got["y"].to_numpy()
    if len(set(y.tolist())) < 2:
        return None
    stats = np.frombuffer(b"".join(got["stats"]), np.float64).reshape(len(y), -1)
    at, x = [np.frombuffer(b, np.int16) for b in got["at"]], [np.frombuffer(b, np.float32) for b in got["x"]]

    def get(some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        words = np.zeros((len(some), 1 << WORD_BITS))
        for k, i in enumerate(some):
            words[k, at[i]] = x[i]
        return words, stats[some]

    return FactorisationMachine(stats.mean(axis=0), np.maximum(stats.std(axis=0), 1e-6)).fit(get, y)


def score_quality(documents: DataFrame, labels: DataFrame | None = None, model: FactorisationMachine | None = None) -> DataFrame:
    """All columns of the documents and score (0 to 1, higher: better), from text and n_chars alone.

    Null texts are scored as empty ones; without labels of both kinds to learn from every score is 0.5. Every row stays,
    repeated rows included; an existing column score is replaced; an empty table gives no rows. n_chars may be null or absent.
    """
    documents = documents if "n_chars" in documents.columns else documents.withColumn("n_chars", F.lit(None).cast("bigint"))
    if model is None and labels is not None:
        model = fit_quality_model(documents, labels)

    @F.pandas_udf("double")
    def score(texts: pd.Series, n_chars: pd.Series) -> pd.Series:
        if model is None:
            return pd.Series(np.full(len(texts), 0.5))
        return pd.Series([float(model.score(x, s)) for x, s in rows(texts.tolist(), n_chars.tolist())], dtype=float)

    names = [c for c in documents.columns if c.lower() != "score"]
    return documents.select(*(F.col(f"`{c}`") for c in names), score("text", F.col("n_chars").cast("double")).alias("score"))
