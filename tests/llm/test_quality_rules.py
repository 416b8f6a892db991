import collections
import re

import pytest

from tillroll.llm import quality

SF = "/root/testdata/sf0.01"


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    count = collections.Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    covered = set()
    for i in range(len(words) - 7):
        if count[tuple(words[i:i + 8])] > 1:
            covered.update(range(i, i + 8))
    n = len(words)
    failed = n < 20 or 100 * len(covered) > 30 * n
    return n, sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(covered), failed


COLS = "n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed".split()


def test_base_columns_against_brute_force(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text for r in df.collect()}
    got = quality.op8_quality(spark, SF).collect()
    assert len(got) == len(texts)
    for r in got:
        assert tuple(r[c] for c in COLS) == brute(texts[r.doc_id])
        assert not (r.base_failed and r.kept)


def test_verdicts_agree_with_labels(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = quality.op8_quality(spark, SF).join(labels, "doc_id").where("not base_failed").collect()
    good = [r.kept for r in got if r.quality == 1]
    bad = [r.kept for r in got if r.quality == 0]
    assert sum(good) / len(good) > 0.98 and sum(bad) / len(bad) < 0.15


def test_votes_scale_with_length(rows):
    lines = [f"line {i} says word{2 * i} and word{2 * i + 1} once" for i in range(100)]
    # Long and clean, long with a few repeated lines, and very long with the vocabulary of natural text.
    few = "\n".join([*lines, *lines[:3]])
    natural = " ".join(f"w{(i * i * 7919 + i) % 99991 % (2 + int(8 * (i + 1) ** 0.55))}" for i in range(60000))
    same = "\n".join([*lines[:4], *lines[:4]])
    poor = " ".join(f"w{i * i % 7}" for i in range(3000))
    got = {r.id: r for r in quality.stats(rows([(1, few), (2, natural), (3, same), (4, poor)], "doc_id long, text string"))
           .select("*", *[c.alias(k) for k, c in quality.votes().items()]).collect()}
    assert got[1].n_dup_lines == 3 and got[1].v_dup_lines == 1
    assert got[2].n_distinct < 0.15 * got[2].n_words and got[2].v_distinct == 1
    assert got[3].v_dup_lines == -1 and got[4].v_distinct == -1


def test_edge_rows(rows):
    data = [(1, None, 1), (2, "", 1), (3, "a b c d e f g h " * 5000, 1), (3, "a b c d e f g h " * 5000, 1), (None, "x\ny\nx\n\n \n", 1),
            (4, " é <b>  *", 1)]
    got = quality.judge(rows(data, "doc_id long, text string, n_words int")).collect()
    assert sorted(str((r.doc_id, *[r[c] for c in COLS])) for r in got) == sorted(str((i, *brute(t))) for i, t, _ in data)


@pytest.mark.parametrize("n", [1, 2, 5, 8, 13])
def test_gram_hashes_tell_runs_apart(rows, n):
    from pyspark.sql import functions as F

    from tillroll.llm.common import gram_hashes, word_hashes
    words = "a b a b a c a b a b a c d a b a b a c a b a".split()
    r = rows([(words,), ([],), (["a"],)], "w array<string>").select(gram_hashes(word_hashes(F.col("w")), n).alias("h")).collect()
    grams = [tuple(words[i:i + n]) for i in range(len(words) - n + 1)]
    assert len(r[0].h) == len(grams) and len(set(zip(grams, r[0].h))) == len(set(grams)) == len(set(r[0].h))
    assert r[1].h == [] and len(r[2].h) == (n == 1)


def test_empty_table(rows):
    assert quality.judge(rows([], "doc_id long, text string")).count() == 0
