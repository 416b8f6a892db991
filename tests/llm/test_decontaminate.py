import hashlib
import os
import random
import re
import sys

from tillroll.llm import decontaminate as D

sys.path.insert(0, os.path.dirname(__file__))
from duck_rows import same  # noqa: E402

SF = "/root/testdata/sf0.01"


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(text, bench):
    w, hit, items = words(text), set(), set()
    for item, t in bench:
        b = words(t)
        n = min(13, len(b))
        if not n or item is None:
            continue
        grams = {tuple(b[i:i + n]) for i in range(len(b) - n + 1)}
        for i in range(len(w) - n + 1):
            if tuple(w[i:i + n]) in grams:
                hit.update(range(i, i + n))
                items.add(str(item))
    sha = hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
    return len(w), len(hit), len(items), sha, bool(hit) and 20 * len(hit) >= len(w)


def test_against_sql(spark):
    got = same(D.op2_decontaminate(spark, SF), D.ORACLE, SF)
    assert any(r[-1] for r in got)


def test_random_texts_and_edges(rows):
    rng = random.Random(5)
    make = lambda n: " ".join(rng.choices(["a", "B", "c", "É", "d1"], k=n))
    bench = [(i, make(rng.choice([1, 2, 3, 5, 8, 12, 13, 14, 20, 40]))) for i in range(12, 30)][2:]
    bench += [(40, None), (41, "--"), (None, "a"), (42, make(30)), (42, make(13))]
    data = [(i, make(rng.randint(0, 60))) for i in range(30)]
    data += [(50 + i, make(20) + ", " + t + ". " + make(200)) for i, t in enumerate(x[1] for x in bench if x[1])]
    data += [(90, None), (91, ""), (91, ""), (92, (bench[-1][1] + " x y z ") * 2000), (None, bench[-1][1]), (93, "É é " * 7)]
    docs = rows([(*r, 7) for r in data], "doc_id long, text string, n_hit int")
    for items in (bench, [b for b in bench if len(words(b[1])) >= 13], []):
        got = D.decontaminate(docs, rows(items, "item_id long, text string")).drop("text_hash").collect()
        assert sorted(str(tuple(r)) for r in got) == sorted(str((i, *brute(t, items))) for i, t in data)


def test_joins_without_broadcast(rows, monkeypatch):
    monkeypatch.setattr(D, "BROADCAST_ROWS", -1)
    item = " ".join(f"w{i}" for i in range(30))
    docs = rows([(1, "x " + item[4:90] + " y"), (2, "z")], "doc_id long, text string")
    got = {r.doc_id: r.n_hit for r in D.decontaminate(docs, rows([(5, item)], "item_id long, text string")).collect()}
    assert got == {1: brute("x " + item[4:90] + " y", [(5, item)])[1], 2: 0} and got[1] > 13


def test_every_shared_span_shares_a_fingerprint(rows):
    from pyspark.sql import functions as F

    from tillroll.llm.common import word_hashes
    rng = random.Random(6)
    data = []
    for i in range(200):
        span = rng.choices("abcdefg", k=13)
        data.append((i, rng.choices("abcdefg", k=rng.randint(0, 20)) + span + rng.choices("abcdefg", k=5),
                     rng.choices("abcdefg", k=rng.randint(0, 20)) + span))
    df = rows(data, "i int, a array<string>, b array<string>")
    got = df.select(*[D.winnow(word_hashes(F.col(c))).alias(c) for c in "ab"]).where(~F.arrays_overlap("a", "b"))
    assert got.count() == 0


def test_empty_documents(rows):
    assert D.decontaminate(rows([], "doc_id long, text string"), rows([(1, "a b")], "item_id long, text string")).count() == 0
