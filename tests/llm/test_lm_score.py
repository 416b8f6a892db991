import re
import zlib
from collections import Counter
from math import log10

import numpy as np
import pytest

from tillroll.llm import lm_score as L

SF = "/root/testdata/sf0.01"
low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(data):
    rows = [(d, re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(low)) + [None]) for d, t in data]
    fold = lambda d: None if d is None else zlib.crc32(str(d).encode()) % 10
    c = Counter(w for d, ws in rows if fold(d) for w in ws)
    n, v = sum(c.values()), len(c)
    return [(d, fold(d) == 0, len(ws), sum(c[w] > 0 for w in ws), n,
             sum(log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws)) for d, ws in rows]


def check(got, data):
    key = lambda r: str(tuple(r[:5]))
    want = sorted(brute(data), key=lambda r: (key(r), r[5]))
    got = sorted((tuple(r) for r in got), key=lambda r: (key(r), r[5]))
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert [g[5] for g in got] == pytest.approx([w[5] for w in want], rel=1e-9, abs=1e-9)


def test_counts_base_and_better_than_base(spark, monkeypatch):
    monkeypatch.setattr(L, "CHUNK_BYTES", 200_000)
    monkeypatch.setattr(L, "RANGE_BYTES", 600_000)
    df = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    got = L.score_documents(df).collect()
    check(got, [tuple(r) for r in df.collect()])
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    assert sum(r.score > r.base_score for r in held) / len(held) > 0.9


def test_probabilities_sum_to_one(rows):
    texts = ["a b c a b c a b d " * 20, "b c e f a b c " * 10]
    stream, sizes = L.tokens([t.encode() for t in texts])
    words, counts = np.unique(stream, return_counts=True)
    order = np.argsort(-counts)[:5]
    frame = L.Frame(int(counts.sum()), len(words), [(int(words[i].astype(np.int64)), int(counts[i])) for i in order])
    model = L.Model(frame)
    features = L.Model.history(stream, sizes)
    before = model.log_probabilities(frame.ids(stream), features).sum()
    base = np.log((frame.counts[frame.ids(stream)[frame.ids(stream) < L.TOP]] + 0.1) / (frame.total + 0.1 * (frame.distinct + 1))).sum()
    rare = (frame.ids(stream) == L.TOP).sum() * np.log(frame.rare_mass / (frame.total + 0.1 * (frame.distinct + 1)))
    assert before == pytest.approx(base + rare, rel=1e-5)
    state = [np.zeros_like(model.classes), np.zeros_like(model.words)]
    for _ in range(20):
        model.learn(frame.ids(stream), features, state)
    assert model.log_probabilities(frame.ids(stream), features).sum() > before * 0.8
    one = features[:, :1]
    total = sum(np.exp(model.log_probabilities(np.array([i]), one))[0] for i in [*range(len(order)), L.TOP])
    assert total == pytest.approx(1, abs=1e-4)


def test_edge_rows(rows):
    data = [(i, "the cat sat on the mat", 1) for i in range(1, 30)] + [(40, None, 1), (41, "", 1), (None, "the dog", 1), (None, None, 1),
                                                                       (3, "the cat sat on the mat", 1), (50, "É é e " * 60000, 1)]
    check(L.score_documents(rows(data, "doc_id long, text string, n_tokens int")).collect(), [r[:2] for r in data])


def test_nothing_to_learn_from_and_empty_table(rows):
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0)
    data = [(held, "a b"), (None, "c")]
    got = L.score_documents(rows(data, "doc_id int, text string")).collect()
    check(got, data)
    assert all(np.isfinite(r.score) for r in got)
    assert L.score_documents(rows([], "doc_id long, text string")).count() == 0


def test_every_training_text_is_learned_from(rows, monkeypatch):
    df = rows([(i, f"w{i % 50} v{i % 50}") for i in range(9000)], "doc_id long, text string")
    learned, train = [], L.train
    monkeypatch.setattr(L, "train", lambda texts, *rest: (learned.append(texts.count()), train(texts, *rest))[1])
    L.score_documents(df).count()
    assert learned == [sum(zlib.crc32(str(i).encode()) % 10 != 0 for i in range(9000))]


def test_model_grows_and_rare_words_depend_on_their_history():
    small, large = (L.Frame(n, 0, []) for n in (10**4, 10**10))
    assert large.word_rows > small.word_rows and large.class_rows > small.class_rows
    assert L.sized(10**10, L.LEAVES_ROOT, L.LEAVES) > L.sized(10**4, L.LEAVES_ROOT, L.LEAVES)
    text = " ".join(f"a{i} b{i}" for i in range(300)).encode()
    stream, sizes = L.tokens([text] * 10)
    words, counts = np.unique(stream, return_counts=True)
    leaves = np.zeros((2, 4096), np.int64)
    np.add.at(leaves[0], L.leaf_of(words, 4096), counts)
    np.add.at(leaves[1], L.leaf_of(words, 4096), 1)
    frame = L.Frame(int(counts.sum()), len(words), [(int(L.END.astype(np.int64)), 10)], leaves)
    assert (10 ** frame.leaf_logs).sum() == pytest.approx(frame.rare_mass)
    model, ids, features = L.Model(frame), frame.ids(stream), L.Model.history(stream, sizes)
    rare = ids >= L.TOP
    before = model.log_probabilities(ids, features)
    # Without weights a leaf and the share in it are the base model.
    at = words.searchsorted(stream)
    base = np.log((counts[at] + L.ALPHA) / (frame.total + L.ALPHA * (frame.distinct + 1)))
    share = np.log(counts[at] + L.ALPHA) - np.log(10) * np.where(rare, frame.leaf_logs[np.where(rare, ids - L.TOP, 0)], 0)
    assert (before + share)[rare] == pytest.approx(base[rare], rel=1e-4)
    state = [np.zeros_like(model.classes), np.zeros_like(model.words)]
    for _ in range(20):
        model.learn(ids, features, state)
    after = model.log_probabilities(ids, features)
    assert after[rare].mean() > before[rare].mean() + 3
    one = features[:, 5:6]
    assert sum(np.exp(model.log_probabilities(np.array([i]), one))[0] for i in [0, *range(L.TOP, L.TOP + 4096)]) == pytest.approx(1, abs=1e-3)


def test_one_round_of_updates_against_single_steps(spark):
    """Every task's AdaGrad steps row by row in plain Python, and the mean of each row over the tasks that changed it."""
    texts = [" ".join(f"{c}{(i * k) % 11}" for k in range(1, 260) for c in "ab") for i in range(36)]
    stream, _ = L.tokens([t.encode() for t in texts])
    words, counts = np.unique(stream, return_counts=True)
    leaves = np.zeros((2, 1024), np.int64)
    np.add.at(leaves[0], L.leaf_of(words, 1024), counts)
    np.add.at(leaves[1], L.leaf_of(words, 1024), 1)
    top = np.argsort(-counts, kind="stable")[:9]
    frame = L.Frame(int(counts.sum()), len(words), [(int(words[i].astype(np.int64)), int(counts[i])) for i in top], leaves)
    made = spark.createDataFrame([(i % 3, t) for i, t in enumerate(texts)], "part int, text string").repartitionByRange(3, "part").sortWithinPartitions("text").select("text")
    shares = [[r[0] for r in p] for p in made.rdd.glom().collect()]
    model = L.train(made, frame, 3)

    def softmax(z):
        e = np.exp(z - z.max())
        return e / e.sum()

    sums = [{}, {}]
    for share in shares:
        weights, squares = [{}, {}], [{}, {}]
        size = [frame.class_rows, frame.word_rows]
        width = [L.CLASSES + 1, L.WIDTH]
        stream, sizes = L.tokens([t.encode() for t in share])
        ids, features = frame.ids(stream), L.Model.history(stream, sizes)
        assert len(ids) > L.BATCH
        for at in range(0, len(ids), L.BATCH):
            for kind in (0, 1):
                steps = {}
                for j in range(at, min(at + L.BATCH, len(ids))):
                    i = int(ids[j])
                    if kind == 0:
                        decisions = [(None, min(i // L.WIDTH, L.CLASSES), frame.class_bias)]
                    elif i < L.TOP:
                        decisions = [(i // L.WIDTH, i % L.WIDTH, frame.word_bias[i // L.WIDTH])]
                    else:
                        leaf = i - L.TOP
                        decisions = [(L.CLASSES, leaf >> 5, frame.word_bias[L.CLASSES]),
                                     (L.CLASSES + 1 + (leaf >> 5), leaf & 31, frame.word_bias[L.CLASSES + 1 + (leaf >> 5)])]
                    for node, child, bias in decisions:
                        f = features[:, j] if node is None else L.mix64(features[:L.BELOW, j] + np.uint64(node))
                        rows = [int(x % np.uint64(size[kind])) for x in f]
                        z = bias.astype(np.float64) + sum(weights[kind].get(r, np.zeros(width[kind])) for r in rows)
                        g = softmax(z)
                        g[child] -= 1
                        for r in rows:
                            steps[r] = steps.get(r, 0) + g
                for r, g in steps.items():
                    squares[kind][r] = squares[kind].get(r, 0) + (g * g).sum()
                    weights[kind][r] = weights[kind].get(r, np.zeros(width[kind])) - L.RATE * g / np.sqrt(squares[kind][r] + L.DAMPING)
        for kind in (0, 1):
            for r, w in weights[kind].items():
                sums[kind].setdefault(r, []).append(w)
    for table, want in zip((model.classes, model.words), sums):
        assert set(np.flatnonzero(np.abs(table).sum(axis=1)).tolist()) <= set(want)
        for r, w in want.items():
            assert table[r] == pytest.approx(np.mean(w, axis=0), abs=2e-4)
