import random
import re
from collections import Counter, defaultdict

import pytest

from duck_rows import same
from tillroll.llm import collocations

SF = "/root/testdata/sf0.001"
COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least, limit, holds=50):
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in (1, 2, 3):
                for i in range(len(words) - k + 1):
                    f[lang][tuple(words[i:i + k])] += 1
    out = []
    for lang, own in f.items():
        candidates = {p: a for p, a in own.items() if len(p) > 1 and a >= least}
        found = []
        for p, a in candidates.items():
            if any(len(t) > len(p) and 100 * b >= holds * a and p in [t[i:i + len(p)] for i in range(len(t) - len(p) + 1)]
                   for t, b in candidates.items()):
                continue
            score, _, left, right = min((1_000_000 * a * a // (own[p[:k]] * own[p[k:]]), k, own[p[:k]], own[p[k:]]) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (s, a, p, left, right) in enumerate(sorted(found)[:limit], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


def test_query_against_sql(spark):
    rows = collocations.op13_collocations(spark, SF)
    assert rows.columns == COLUMNS
    assert len(same(rows, collocations.ORACLE, SF)) > 100


@pytest.mark.parametrize("seed, limit, ahead", [(1, 5, 1), (2, 40, 1), (3, 3, 2), (4, 10 ** 6, 1)])
def test_rounds_against_brute_force(spark, seed, limit, ahead, monkeypatch):
    draw = random.Random(seed)
    vocabulary = [f"{c}{i}" for c in "abÀé" for i in range(12)]
    rows = []
    for _ in range(120):
        words = [draw.choice(vocabulary[:int(2 + len(vocabulary) * draw.random() ** 2)]) for _ in range(draw.randint(0, 60))]
        for _ in range(draw.randint(0, 6)):  # planted phrases, some inside others
            words[draw.randint(0, len(words)):0] = draw.choice([["New", "york"], ["new", "YORK", "city"], ["x", "y", "z"], ["y", "z"]])
        rows.append(("".join(w + draw.choice([" ", " ", " ", "\t", ". ", ", ", "\n"]) for w in words), draw.choice(["en", "en", "de", None])))
    # With few bits the filter passes many nodes that aren't open, with many none; the result is the same.
    results = []
    for bits in (1 << 10, 1 << 20):
        got = collocations.mine(spark.createDataFrame(rows, "text string, lang string"), least=3, limit=limit, ahead=ahead,
                                filter_bits=bits, chunk_bytes=2000).collect()
        results.append(sorted(tuple(r) for r in got))
    assert results[0] == results[1] == brute(rows, 3, limit)


def test_not_everything_is_expanded(spark):
    """A language's rounds stop when its best phrases are settled; triples that can't reach them are never counted."""
    rows = [("tick tock. " * 5 + " ".join(f"the w{i % 7} of" for i in range(40)), "en")] * 30
    seen = []
    spark_rows = spark.createDataFrame(rows, "text string, lang string")
    whole = collocations._triples
    collocations._triples = lambda *a: seen.append(whole(*a)) or seen[-1]
    try:
        got = collocations.mine(spark_rows, least=10, limit=1, ahead=1, chunk_bytes=500).collect()
    finally:
        collocations._triples = whole
    assert [tuple(r) for r in got] == brute(rows, 10, 1)
    assert [df.count() for df in seen] == [0]


def test_words_that_share_a_number_get_another_seed(spark, monkeypatch):
    whole = collocations._phrases
    calls = []

    def first_time_alike(docs, seed, chunk_bytes):
        calls.append(seed)
        found = whole(docs, seed, chunk_bytes)
        return found.selectExpr("lang", "word", "IF(w2 IS NULL, 0, w1) AS w1", "w2", "f") if seed == 0 else found

    monkeypatch.setattr(collocations, "_phrases", first_time_alike)
    rows = [("a b c d", "en")] * 12
    got = collocations.mine(spark.createDataFrame(rows, "text string, lang string")).collect()
    assert sorted(tuple(r) for r in got) == brute(rows, 10, 2000) and calls == [0, 1]


def test_nulls_empty_long_repeated_and_clashing_columns(spark):
    rows = [(None, "en"), ("", None), ("A b " * 12, None), ("A b " * 12, None), ("x" * 100_000 + " y " + "A b " * 12, "en"), (".,;", "fr"), ("a b c " * 10, "")]
    clash = "words f a l r n score rank phrase count held least flags pair w block bit".split()
    frame = spark.createDataFrame([(*r, *["x"] * len(clash)) for r in rows], "text string, lang string, " + ", ".join(f"`{c}` string" for c in clash))
    want = brute([r for r in rows if r[1] != ""], 10, 2000) + brute([rows[-1]], 10, 2000)
    assert sorted(tuple(r) for r in collocations.mine(frame).collect()) == sorted(want)


def test_exact_arithmetic_beyond_64_bits(spark):
    made = spark.createDataFrame([(10 ** 13 + 7, 3 * 10 ** 13 + 1, 10 ** 13 + 9)], "a long, l long, r long").select(collocations._score("a", "l", "r"))
    a, left, right = 10 ** 13 + 7, 3 * 10 ** 13 + 1, 10 ** 13 + 9
    assert made.first()[0] == 1_000_000 * a * a // (left * right)


def test_empty_table(spark):
    assert collocations.mine(spark.createDataFrame([], "text string, lang string")).count() == 0
