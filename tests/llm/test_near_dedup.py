import random
import re

import numpy as np
import pytest

from tillroll.llm import near_dedup as N
from tillroll.llm.components import components

SF = "/root/testdata/sf0.01"


def shingles(text, k):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    return frozenset(tuple(w[j:j + k]) for j in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def brute(data, k):
    sets = [shingles(t, k) for _, t in data]
    root = list(range(len(data)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    order = sorted(range(len(data)), key=lambda i: len(sets[i]))
    for n, i in enumerate(order):
        for j in order[n + 1:]:
            if 80 * len(sets[j]) > 100 * len(sets[i]):
                break
            both = len(sets[i] & sets[j])
            if sets[i] and data[i][0] is not None and data[j][0] is not None and \
                    100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(data):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    out = []
    for i, (d, _) in enumerate(data):
        c = least.get(find(i)) if d is not None else None
        out.append((d, len(sets[i]), c, d is None or d == c))
    return sorted(map(str, out))


@pytest.mark.parametrize("k", [2, 5])
def test_against_brute_force(spark, k):
    df = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    data = [tuple(r) for r in df.collect()]
    got = sorted(str(tuple(r)) for r in N.near_duplicates(df, shingle=k).drop('text_hash').collect())
    assert got == brute(data, k)


def test_chains_groups_and_edges(rows):
    rng = random.Random(8)
    word = lambda: "w%d" % rng.randint(0, 10**6)
    data, i = [], 0
    base = [word() for _ in range(120)]
    for step in range(30):  # a chain: neighbours alike, ends not
        data.append((i := i + 1, " ".join(base)))
        base[step * 4:step * 4 + 3] = [word() for _ in range(3)]
    seed = [word() for _ in range(100)]
    for _ in range(60):  # near copies of one text, seldom alike among themselves
        copy = list(seed)
        for _ in range(rng.randint(3, 11)):
            copy[rng.randrange(100)] = word()
        data.append((i := i + 1, " ".join(copy)))
    data += [(1000 + j, "Same text here twice") for j in range(20)] + [(7, "SAME text here twice"), (7, "same text  here\ttwice")]
    data += [(2000, None), (2001, ""), (2002, "one"), (2003, "ONE"), (None, "one"), (None, None), (2004, "x " * 50000)]
    rng.shuffle(data)
    df = rows([(*r, 1) for r in data], "doc_id long, text string, c int")
    got = sorted(str(tuple(r)) for r in N.near_duplicates(df, shingle=2).drop('text_hash').collect())
    assert got == brute(data, 2)


def test_sketches_fill_and_estimate():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 2**63, 900, dtype=np.uint64)
    b = np.concatenate((a[:800], rng.integers(0, 2**63, 100, dtype=np.uint64)))
    tiny = a[:1]
    h = np.concatenate((a, b, tiny))
    s = N.sketches(h, np.array([900, 900, 1, 0]))
    assert (s[:3] != 2**64 - 1).all() and (s[3] == 2**64 - 1).all()
    assert abs((s[0] == s[1]).mean() - 0.8) < 0.15


def test_components_of_a_path_and_a_star(rows):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(5, 5)]
    got = {r.node: r.root for r in components(rows(edges, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(1, 41)} | {i: 100 for i in range(101, 140)}


def test_empty_table(rows):
    assert N.near_duplicates(rows([], "doc_id long, text string")).count() == 0
