"""Language identification in two steps: linear one-versus-rest machines choose a language family, then one-versus-one linear
support vector machines separate the languages within it.

Features are hashed byte trigrams of the lower-cased letters of the whole text, square-rooted and scaled to unit length.

Margins compare learned languages only, so a text in any other one gets a sure answer too. The score is therefore multiplied
by a steep function of the share of the text's trigrams that are usual in the language found.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tamis.llm.common import cols, join_small, stash, unused

DIMENSIONS = 8192
#: Bound of the labelled sample that a model is fitted on, over all languages, and the least per language.
SAMPLE_ROWS = 3000
LEAST_PER_LANGUAGE = 20
#: A hashed trigram is usual in a language at this frequency, as a multiple of the mean one.
USUAL = 0.25
#: Share of usual trigrams that halves the score, and the steepness there; figures of clean and other texts are in the README.
HALF_SHARE, STEEPNESS = 0.5, 40.0

#: Families of common ISO 639-1 codes; any other language is a family of its own.
FAMILIES = {
    "germanic": "af da de en is nb nl nn no sv",
    "romance": "ca es fr gl it pt ro",
    "slavic": "be bg cs hr mk pl ru sk sl sr uk",
    "uralic": "et fi hu",
    "turkic": "az kk tr uz",
    "indo-aryan": "bn gu hi mr ne pa ur",
    "semitic": "ar he mt",
}

#: Every other ASCII byte becomes a space.
_SPACED = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))


def family_of(lang: str) -> str:
    return next((f for f, codes in FAMILIES.items() if lang in codes.split()), lang)


def counts(text: str) -> np.ndarray:
    """Hashed trigram counts of the lower-cased text, with other ASCII characters read as spaces."""
    b = np.frombuffer(b" " + text.lower().encode("utf-8", "replace").translate(_SPACED) + b" ", np.uint8).astype(np.uint32)
    if len(b) < 3:
        return np.zeros(DIMENSIONS)
    h = (b[:-2] << 16 | b[1:-1] << 8 | b[2:]) * np.uint32(2654435761)
    h = h[(b[:-2] != 32) | (b[1:-1] != 32)]  # not within a gap
    return np.bincount(h >> np.uint32(19), minlength=DIMENSIONS).astype(np.float64)


def scaled(seen: np.ndarray) -> np.ndarray:
    x = np.sqrt(seen)
    return x / (np.linalg.norm(x) or 1.0)


def features(text: str) -> np.ndarray:
    return scaled(counts(text))


def linear_svm(x: np.ndarray, y: np.ndarray, c: float = 10.0, rounds: int = 60) -> np.ndarray:
    """Weights (bias last) that minimise |w|^2 / 2 + c * mean squared hinge loss, by accelerated gradients; y is +1 or -1, classes weigh alike."""
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum()))
    w = prev = np.zeros(x.shape[1] + 1)
    step = 1 / (1 + 2 * c * 2)
    for k in range(rounds):
        v = w + k / (k + 3) * (w - prev)
        hinge = np.maximum(0, 1 - y * (x @ v[:-1].astype(x.dtype) + v[-1]))
        g = -2 * c * weight * hinge * y
        prev, w = w, v - step * (v * np.append(np.ones(x.shape[1]), 0) + np.append(g.astype(x.dtype) @ x, g.sum()))
    return w


class LanguageModel:
    """Two-step discriminator; fit() takes feature rows and their languages."""

    def __init__(self) -> None:
        self.langs: list[str] = []

    def fit(self, x: np.ndarray, langs: list[str]) -> LanguageModel:
        own = np.array(langs, dtype=object)
        self.langs = sorted(set(langs))
        self.family = {a: family_of(a) for a in self.langs}
        of = np.array([self.family[a] for a in langs], dtype=object)
        self.families = sorted(set(of))
        self.members = {f: [a for a in self.langs if self.family[a] == f] for f in self.families}
        w = [linear_svm(x, np.where(of == f, 1.0, -1.0)) for f in self.families] if len(self.families) > 1 else []
        self.pairs = [(a, b) for f in self.families for a, b in combinations(self.members[f], 2)]
        for a, b in self.pairs:
            rows = (own == a) | (own == b)
            w.append(linear_svm(x[rows], np.where(own[rows] == a, 1.0, -1.0)))
        self.usual = {}
        for a in self.langs:
            rows = np.flatnonzero(own == a)
            share = np.zeros(DIMENSIONS)
            for k in rows:  # row by row, so that no second copy of the sample is held
                share += np.square(x[k], dtype=np.float64)
            self.usual[a] = share * DIMENSIONS > USUAL * len(rows)
        w = np.array(w).reshape(-1, DIMENSIONS + 1).T
        self.w, self.bias = np.ascontiguousarray(w[:-1]), w[-1]
        return self

    def usual_share(self, seen: np.ndarray, lang: str) -> float:
        """Share of counted trigrams that are usual in a language."""
        return float(seen[self.usual[lang]].sum() / (seen.sum() or 1.0))

    def predict(self, text: str | None) -> tuple[str, float]:
        """(language, score from 0 to 1); `und` and 0 for null, for a text without letters, or when nothing was learned. A letter is what Unicode has in category L: digits, fractions and Roman or circled numbers are none. The score nears 0 for texts unlike what was learned."""
        if not self.langs or not text or not any(map(str.isalpha, text)):
            return "und", 0.0
        seen = counts(text)
        lang, score = self._nearest(scaled(seen))
        return lang, score / (1 + math.exp(-STEEPNESS * (self.usual_share(seen, lang) - HALF_SHARE)))

    def _nearest(self, x: np.ndarray) -> tuple[str, float]:
        """The learned language that features are nearest to, and how clearly it stands out from the other ones."""
        m = x @ self.w + self.bias
        n = len(self.families) if len(self.families) > 1 else 0
        squash = lambda v: 1 / (1 + np.exp(-4 * float(v)))
        family, score = self.families[int(np.argmax(m[:n]))] if n else self.families[0], 1.0
        if n:
            top = np.sort(m[:n])
            score = squash((top[-1] - top[-2]) / 2)
        members = self.members[family]
        if len(members) == 1:
            return members[0], score
        votes, margin = dict.fromkeys(members, 0), {a: [] for a in members}
        for (a, b), v in zip(self.pairs, m[n:], strict=True):
            if a in votes and b in votes:
                votes[a if v >= 0 else b] += 1
                margin[a].append(v)
                margin[b].append(-v)
        best = max(members, key=lambda a: (votes[a], sum(margin[a])))
        return best, score * squash(min(margin[best]))


def labelled_sample(documents: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """At most `rows` documents with a non-null lang and crc32(doc_id) mod 3 not 1, as doc_id, lang, text: of the most frequent languages, up to rows / LEAST_PER_LANGUAGE of them, the first of each by a hash of the id. An id with several texts of a language has the smallest."""
    own = documents.where("lang IS NOT NULL AND text IS NOT NULL AND doc_id IS NOT NULL AND crc32(cast(doc_id AS string)) % 3 <> 1").select("doc_id", "lang", "text")
    found = stash(own.groupBy("lang").agg(F.count("*").alias("count")).orderBy(F.desc("count"), "lang").limit(max(1, rows // LEAST_PER_LANGUAGE)), "languages")
    each = rows // max(1, found.count())
    # a hash below twice the share that is wanted, so that the ranking meets few rows of any language
    u = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) / float(1 << 40)
    near = join_small(own.select("doc_id", "lang").withColumn("u", u), found, ["lang"], F.col("doc_id"), how="inner").where(F.col("u") * F.col("count") < 2 * each + 64)
    first = Window.partitionBy("lang").orderBy("u", "doc_id")
    ids = stash(near.distinct().withColumn("n", F.row_number().over(first)).where(F.col("n") <= each).select("doc_id", "lang"), "language-sample")
    return join_small(own, ids, ["doc_id", "lang"], F.col("doc_id"), how="inner").groupBy("doc_id", "lang").agg(F.min("text").alias("text"))


def _sparse(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in parts:
        x = [features(t) for t in pdf["text"]]
        at = [np.flatnonzero(v) for v in x]
        yield pd.DataFrame({"doc_id": pdf["doc_id"], "lang": pdf["lang"], "at": [a.astype(np.int16).tobytes() for a in at], "x": [v[a].astype(np.float32).tobytes() for v, a in zip(x, at, strict=True)]})


def fit_language_model(documents: DataFrame, rows: int = SAMPLE_ROWS) -> LanguageModel:
    """A model fitted on a sample of at most `rows` labelled documents; their features, not their texts, come to the driver."""
    got = labelled_sample(documents, rows).mapInPandas(_sparse, "doc_id bigint, lang string, at binary, x binary").toPandas().sort_values(["lang", "doc_id"])
    x = np.zeros((len(got), DIMENSIONS), np.float32)
    for k, (at, v) in enumerate(zip(got["at"], got["x"], strict=True)):
        x[k, np.frombuffer(at, np.int16)] = np.frombuffer(v, np.float32)
    return LanguageModel().fit(x, got["lang"].tolist()) if len(got) else LanguageModel()


def identify_languages(documents: DataFrame, model: LanguageModel | None = None) -> DataFrame:
    """All columns of the documents and lang_pred (a learned language, or `und`), lang_score (0 to 1), from the text alone.

    Texts that are null or have no letter are `und` with score 0, as is everything if there was nothing to learn from. Every
    row stays, repeated rows included; existing columns lang_pred and lang_score are replaced; an empty table gives no rows.
    """
    model = model or fit_language_model(documents)

    @F.pandas_udf("lang_pred string, lang_score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([model.predict(t) for t in texts], columns=["lang_pred", "lang_score"])

    names = [c for c in documents.columns if c.lower() not in ("lang_pred", "lang_score")]
    (found,) = unused(names, "_found")
    return documents.select(*cols(names), predict("text").alias(found)).select(*cols(names), f"{found}.lang_pred", f"{found}.lang_score")
