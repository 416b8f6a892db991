import hashlib
import os
import random
import re
import sys

from tillroll.llm import substring_dedup as S
from tillroll.llm.packed import LAST

sys.path.insert(0, os.path.dirname(__file__))
from duck_rows import same  # noqa: E402

SF = "/root/testdata/sf0.01"


def brute(data, k=13):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in data]
    rank = [LAST if d is None else d for d, _ in data]
    least = {}
    for r, w in zip(rank, words):
        for i in range(len(w) - k + 1):
            g = tuple(w[i:i + k])
            least[g] = min(least.get(g, r), r)
    out = []
    for (d, _), r, w in zip(data, rank, words):
        gone = set()
        for i in range(len(w) - k + 1):
            if least[tuple(w[i:i + k])] < r:
                gone.update(range(i, i + k))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(map(str, out))


def test_against_sql(spark):
    got = same(S.op6_substring_dedup(spark, SF), S.ORACLE, SF)
    assert any(r[2] for r in got)


def test_edges_and_many_ranges(rows):
    rng = random.Random(2)
    make = lambda n: " ".join(rng.choices(["a", "B", "é", "日", "-"], k=n))
    passage = " ".join(f"p{i}" for i in range(60))
    data = [(i, make(rng.randint(0, 40)) + "\n" + (passage + "\t" + make(5) if i % 3 == 0 else make(9))) for i in range(1, 60)]
    data += [(70, None), (71, ""), (72, " \t\n"), (None, passage), (None, passage), (3, passage), (0, passage[:300]), (80, "x " * 70000),
             (81, "y " * 70000 + passage), (82, "x " * 100), (83, passage + " " + passage)]
    rng.shuffle(data)
    df = rows([(*r, 1) for r in data], "doc_id long, text string, uid int").repartition(3)
    for options in ({}, {"chunk_bytes": 2000, "range_bytes": 3000}):
        got = sorted(str(tuple(r)) for r in S.remove_repeats(df, **options).collect())
        assert got == brute(data)


def test_texts_and_spans(rows):
    p = " ".join(f"p{i}" for i in range(20))
    df = rows([(1, p), (2, "a b " + p + " c"), (3, p)], "doc_id int, text string")
    got = {r.doc_id: r for r in S.remove_repeats(df, with_text=True).collect()}
    assert got[1].kept_text == p and got[1].spans == [] and got[3].kept_text == ""
    assert got[2].kept_text == "a b c" and [tuple(x) for x in got[2].spans] == [(2, 22)]


def test_empty_table(rows):
    assert S.remove_repeats(rows([], "doc_id long, text string")).count() == 0
