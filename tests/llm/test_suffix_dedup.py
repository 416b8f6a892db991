import hashlib
import os
import random
import sys

import numpy as np

from tillroll.llm import suffix_dedup as S
from tillroll.llm.packed import LAST

sys.path.insert(0, os.path.dirname(__file__))
from duck_rows import same  # noqa: E402

SF = "/root/testdata/sf0.01"


def brute(data, n=100):
    """Rows in corpus order; rows equal in id and text are one document."""
    docs = sorted({(LAST if d is None else d, t or "") for d, t in data}, key=lambda x: x[0])
    seen, result = set(), {}
    for d, t in docs:
        raw = t.encode()
        gone = np.zeros(len(raw), bool)
        for i in range(len(raw) - n + 1):
            g = raw[i:i + n]
            if g in seen:
                gone[i:i + n] = True
            seen.add(g)
        kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
        spans = int((np.diff(np.concatenate(([False], gone)).astype(int)) == 1).sum())
        result[d, t] = (len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    return sorted(str((d, *result[LAST if d is None else d, t or ""])) for d, t in data)


def test_against_sql(spark):
    got = same(S.op9_suffix_dedup(spark, SF), S.ORACLE, SF)
    assert any(r[2] for r in got) and any(r[3] > 1 for r in got)


def test_edges_small_chunks_and_ranges(rows):
    rng = random.Random(9)
    make = lambda n: "".join(rng.choices("ab é日-", k=n))
    text = make(600)
    data = [(i, make(rng.randint(0, 150)) + text[rng.randint(0, 300):rng.randint(310, 600)] + make(60)) for i in range(10, 60)]
    data += [(60 + i, "Z" * rng.randint(90, 400)) for i in range(8)] + [(80, "ab" * 300 + text), (81, "xab" * 200)]
    data += [(90, None), (91, ""), (92, "short"), (None, text), (3, text[:250]), (93, text + text), (94, text), (94, text),
             (95, (text + "q") * 40), (96, make(70000)), (97, "q" * 70000 + text)]
    data += [(100 + i, f"head {i} " + "L" + text[100:180] + f" tail {i} " + make(90)) for i in range(30)]
    rng.shuffle(data)
    df = rows([(*r, 1) for r in data], "doc_id long, text string, rank int").repartition(3)
    want = brute(data)
    for options in ({}, {"chunk_bytes": 1500, "range_bytes": 4000}):
        got = sorted(str(tuple(r)) for r in S.remove_repeats(df, **options).collect())
        assert got == want


def test_first_least():
    rng = np.random.default_rng(3)
    v = rng.integers(0, 5, 300).astype(np.uint64)
    for width in (1, 2, 3, 8, 53):
        assert S.first_least(v, width).tolist() == [i + int(v[i:i + width].argmin()) for i in range(300 - width + 1)]


def test_texts_and_spans(rows):
    p = "".join(chr(97 + i % 26) + str(i) for i in range(60))
    df = rows([(1, p), (2, "é" + p + "é"), (3, p)], "doc_id int, text string")
    got = {r.doc_id: r for r in S.remove_repeats(df, with_text=True).collect()}
    assert got[1].kept_text == p and got[3].kept_text == "" and got[2].kept_text == "éé"
    assert [tuple(x) for x in got[2].spans] == [(2, 2 + len(p))]


def test_empty_table(rows):
    assert S.remove_repeats(rows([], "doc_id long, text string")).count() == 0
