import random
import time

import pytest
from pyspark.sql import functions as F

from tamis.functions import text as X

ALPHABET = ["a", "bb", " ", "  ", "\n", "\n\n", "\n\n\n", "word", "\t", "é", "x y z", " "]


def random_texts(n, seed, most=60):
    rng = random.Random(seed)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, most))) for _ in range(n)]


def on(spark, texts, expression):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string").coalesce(2)
    return [r["x"] for r in df.select("i", expression(F.col("text")).alias("x")).orderBy("i").collect()]


def model_windows(units, text, window, step, join):
    if not text.strip():
        return []
    if len(units) <= window:
        return [text]
    out, at = [], 0
    while True:
        out.append(join(units[at : at + window]))
        if at + window >= len(units):
            return out
        at += step


def model_pack(text, most, overlap):
    packs, cur = [], []
    n = lambda ps: sum(len(p.split()) for p in ps)
    for p in [p for p in text.split("\n\n") if p.strip()]:
        if cur and n(cur) + n([p]) > most:
            packs.append(cur)
            k = len(cur)
            while k > 0 and n(cur[k - 1 :]) <= overlap:
                k -= 1
            cur = cur[k:]
        cur = [*cur, p]
    return ["\n\n".join(p) for p in [*packs, *([cur] if cur else [])]]


def model_sections(text, most):
    if len(text.split()) <= most:
        return [text]
    out, cur, size = [], [], 0
    for p in text.split("\n\n"):
        ws = p.split()
        if len(ws) > most or (cur and size + len(ws) > most):
            if cur:
                out.append("\n\n".join(cur))
            cur, size = [], 0
        if len(ws) > most:
            out += [" ".join(ws[j : j + most]) for j in range(0, len(ws), most)]
        else:
            cur.append(p)
            size += len(ws)
    return out + (["\n\n".join(cur)] if cur else [])


def test_words_follow_unicode_white_space(spark):
    texts = [None, "", "  \x85", "a\x1cb\x1fc", " a b ", "one two\nthree\t four"]
    assert on(spark, texts, X.words) == [(t or "").split() for t in texts]
    assert on(spark, texts[1:], X.strip) == [t.strip() for t in texts[1:]]


@pytest.mark.parametrize("sizes", [(13, 4), (10, 0), (7, 2)])
def test_word_windows(spark, sizes):
    window, step = X.window_sizes(*sizes)
    texts = random_texts(200, 1)
    assert on(spark, texts, lambda x: X.chunk_words(x, *sizes)) == [model_windows(t.split(), t, window, step, " ".join) for t in texts]


def test_a_text_that_fits_stays_as_it_is_and_blank_ones_give_nothing(spark):
    assert on(spark, ["  a  b\n", " \n", None], X.chunk_words) == [["  a  b\n"], [], []]


@pytest.mark.parametrize("sizes", [(10, 2), (10, 3), (10, 0)])
def test_character_windows_equal_those_of_a_tokenizer(spark, sizes):
    from tamis.queries import CharacterTokenizer

    texts = [*random_texts(100, 2), "x" * 20, "x" * 10]
    want = [model_windows(list(t), t, sizes[0], sizes[0] - sizes[1], "".join) for t in texts]
    assert on(spark, texts, lambda x: X.chunk_characters(x, *sizes)) == want
    assert on(spark, texts, X.chunk_tokens(CharacterTokenizer, *sizes)) == want
    assert len(want[-2]) == {2: 3, 3: 3, 0: 2}[sizes[1]] and len(want[-1]) == 1


def test_windows_that_make_no_progress_are_refused():
    for sizes in ((10, 10), (5, 9), (0, 0)):
        with pytest.raises(ValueError):
            X.window_sizes(*sizes)


@pytest.mark.parametrize("most,overlap", [(6, 2), (4, 0), (10, 5)])
def test_paragraph_packs(spark, most, overlap):
    texts = random_texts(200, 3, 90)
    assert on(spark, texts, lambda x: X.pack_paragraphs(x, most, overlap)) == [model_pack(t, most, overlap) for t in texts]


@pytest.mark.parametrize("most", [3, 5, 12])
def test_sections(spark, most):
    texts = random_texts(200, 4, 90)
    assert on(spark, texts, lambda x: X.split_sections(x, most)) == [model_sections(t, most) for t in texts]


def test_text_signals(spark):
    texts = ["$ 1,200.50", "$", "12 FTE", "9 staff", "staff of about 40", "roles: " + "x" * 31 + "10", "ON-SITE work", "place of performance", "manager\nEngineer\n" * 5, "lead\n" * 9, None]
    assert on(spark, texts, X.has_dollar_amount) == [True] + [False] * 10
    assert on(spark, texts, X.has_headcount) == [False, False, True, False, True, False, False, False, False, False, False]
    assert on(spark, texts, X.has_onsite_term) == [False] * 6 + [True, True] + [False] * 3
    assert on(spark, texts, X.has_enumerated_roles) == [False] * 8 + [True, False, False]
    assert on(spark, texts, X.has_large_team)[8]


def test_approximate_tokens(spark):
    assert on(spark, ["a b c", ""], X.approximate_tokens) == pytest.approx([3.9, 0.0])


@pytest.mark.parametrize("cut", [X.pack_paragraphs, lambda c: X.split_sections(c, 400)])
def test_long_documents_take_time_in_proportion(spark, cut):
    def seconds(n):
        df = spark.createDataFrame([("\n\n".join(f"w{i} a b c d e f g" for i in range(n)),)], "t string")
        began = time.monotonic()
        assert df.select(F.size(cut(F.col("t")))).first()[0] >= n // 50
        return time.monotonic() - began

    seconds(1000)
    assert seconds(80_000) < 3 * min(seconds(40_000), seconds(40_000)) + 1
