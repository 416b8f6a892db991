import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from tillroll.llm import periodic_runs

SF = "/root/testdata/sf0.001"
SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def brute(words):
    """All runs by definition: for every period the maximal stretches, without those of a smaller period."""
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        same = np.array([words[i] == words[i + q] for i in range(n - q)] + [False])
        i = 0
        while i < n - q:
            if not same[i]:
                i += 1
                continue
            j = i + int(np.argmin(same[i:]))
            if j - i + q >= max(6, 4 * q) and (i, j - i + q) not in found:
                found[i, j - i + q] = q
            i = j
    return sorted((s, q, n) for (s, n), q in found.items())


def expected(doc_id, text):
    words = SPACE.findall(text or "")
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = brute(words)
    gone = {i for s, q, n in runs for i in range(s + q, s + n)}
    top = min(runs, key=lambda r: (-r[2] / r[1], r[0], r[1])) if runs else None
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    best = (top[0], top[2], top[1], 1000 * top[2] // top[1]) if top else (None,) * 4
    return (doc_id, len(runs), *best, digest("".join(f"{s},{n},{q}\n" for s, q, n in runs)),
            digest(" ".join(w for i, w in enumerate(words) if i not in gone)))


def test_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    short = {r[0] for r in docs if len(SPACE.findall(r[1] or "")) <= 1500}
    got = {tuple(r) for r in periodic_runs.op12_periodic_runs(spark, SF).collect()}
    assert len(got) == len(docs) and any(r[1] for r in got)
    want = {expected(*r) for r in docs if r[0] in short}
    assert {r for r in got if r[0] in short} == want


@pytest.mark.parametrize("seed", range(30))
def test_runs_against_brute_force(seed):
    """Texts of few words, nested repeats, Fibonacci words, powers of random blocks, several texts a chunk."""
    draw = random.Random(seed)

    def block(depth):
        unit = [draw.randrange(draw.choice([1, 2, 3, 50])) for _ in range(draw.randint(1, 40))]
        for _ in range(depth):
            unit = unit * draw.randint(1, 6) + [draw.randrange(3) for _ in range(draw.randint(0, 9))]
        return unit[:900]

    texts = []
    for _ in range(8):
        texts.append([w for _ in range(draw.randint(0, 3)) for w in block(draw.randint(0, 2))])
    a, b = [0], [0, 1]
    while len(b) < 400:
        a, b = b, b + a
    texts += [b, [], [7], [1] * 500, ([0] * 30 + [1]) * 9]
    counts = np.array([len(t) for t in texts])
    text, start, length, period = periodic_runs.find_runs(np.array([w for t in texts for w in t], np.int64), counts)
    got = [[] for _ in texts]
    for i, s, n, q in zip(text.tolist(), start.tolist(), length.tolist(), period.tolist()):
        got[i].append((s, q, n))
    assert got == [brute(t) for t in texts]


def test_null_empty_long_repeated_rows_and_clashing_columns(spark):
    period = " ".join(f"w{i}" for i in range(1500))
    data = [(1, None), (2, ""), (3, " \t\n"), (4, "a a a a a a"), (4, "a a a a a a"), (None, "b c " * 9), (5, "x\x00y " * 7),
            (6, f"one {period} {period} {period} {period} two"), (7, "é " * 5 + "È"), (8, "ab" * 300_000), (9, "k " * 60_000)]
    clash = "doc mark n_runs start length period runs collapsed_text".split()
    frame = spark.createDataFrame([(*r, *["x"] * len(clash)) for r in data], "doc_id long, text string, " + ", ".join(f"{c} string" for c in clash))
    got = {tuple(r)[:8]: r for r in periodic_runs.periodic_runs(frame, with_text=True, chunk_bytes=1 << 12).collect()}
    plain = lambda text: (None, *expected(None, text)[1:])
    long_one = hashlib.sha256(b"0,60000,1\n").hexdigest()
    for key, text in data:
        if key == 9:
            assert (9, 1, 0, 60000, 1, 60000000, long_one, hashlib.sha256(b"k").hexdigest()) in got
        else:
            assert (key, *plain(text)[1:]) in got
    assert len(got) == len(data) - 1  # the repeated row's results are equal
    row = got[(6, *plain(data[7][1])[1:])]
    assert [tuple(x) for x in row["runs"]] == [(1, 6000, 1500)] and row["collapsed_text"] == f"one {period} two"


def test_empty_table(spark):
    assert periodic_runs.periodic_runs(spark.createDataFrame([], "doc_id long, text string")).count() == 0
