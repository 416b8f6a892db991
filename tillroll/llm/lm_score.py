"""Operator 3, scoring by a hashed maximum-entropy language model.

Corpus counts come first: every word of every training text is counted. Tasks count chunk by
chunk and exchange packed (word hash, count) arrays by hash range, so a frequent word costs one
entry a chunk. The counts give the base score (add-0.1 unigrams) and the model's frame.

Model: the TOP most frequent tokens (the end token among them) fall into classes of WIDTH by
frequency; all others form the rare class, a tree of WIDTH children a node whose leaves are chosen by
the word's hash. P(word | history) = P(class | history) * P(word | class, history), and for rare words
P(rare | history) * P(child | node, history) down to the leaf; all are softmaxes over hashed features
of the history: the word before (n-gram of 2), the two before (n-gram of 3) and the one before that
(skip, for classes only). Within a leaf words have their smoothed unigram share, unseen ones included, so the
probabilities sum to one over all words. Weights start at zero, where the model equals the base model.
The leaves and the rows of the weight tables grow with the square root of the counted tokens; a table's rows
up to MOST_ROWS, which is the size of the model: whatever the corpus, all of it is counted and trained on.

Training: distributed gradient updates, one round over all training texts. Every task starts from the same
weights and makes AdaGrad steps over its share of the texts (one step size a row of weights). It sends
the rows it has changed, by blocks of rows; Spark takes each row's mean over the tasks that changed it, in two
levels, so that no group grows with more than the root of the tasks. A task trains on TRAIN_BYTES of text
and sends MOST_ROWS rows at most, so the exchange is linear in the input. Only weights (162 MB at most,
by MOST_ROWS) and leaves go to the driver and to the tasks.

Scoring: texts are scored in numpy batches. Rare words need their corpus counts, which don't fit in
a task; each chunk sends its distinct rare words with the texts they occur in to the word's hash
range, and gets back one sum for each text. Words are told apart by 64-bit hashes.

Defined results: null text is empty, its only token is the end. A row with a null id is in no fold:
it isn't learned from and not held out. Without training texts all counts are 0 and both scores are
those of the empty model. Repeated rows each get their result.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import log10

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Words, chunks, fold, mix64, ranges, read, release, stored
from .packed import LAST, column, named, planes, unplanes

FOLDS, HELD_OUT = 10, 0
ALPHA = 0.1
WIDTH, CLASSES = 32, 32
TOP = WIDTH * CLASSES
#: Least leaves of the rare class and rows of the two weight tables; and their number for each root of the tokens.
LEAVES, CLASS_ROWS, WORD_ROWS = 1 << 10, 1 << 14, 1 << 16
LEAVES_ROOT, CLASS_ROOT, WORD_ROOT = 1, 2, 8
#: The most rows of the two tables together are 5 / 4 of this.
MOST_ROWS = 1 << 20
#: Bytes of training text of a task, and the least tasks.
TRAIN_BYTES, TASKS = 256 << 20, 6
RATE, DAMPING, BATCH = 0.6, 1e-2, 4096
HIGHEST = np.float32(60)  # of a logit, far beyond what is learned
BELOW = 2  # features of the choices below the classes: the skip feature only chooses classes
CHUNK_BYTES, RANGE_BYTES = 2 << 20, 24 << 20
BLOCK = 1 << 16  # leaves of one block of the exchange
BLOCK_ROWS = 1 << 11  # rows of weights of one block
END, START = np.uint64(0x9D39247E33776D41), np.uint64(0x2AF7398005AAA5C7)
_SALT = [np.uint64(x) for x in (0x44DB015024623547, 0x9C15F73E62A76AE2, 0x75834465489C0C89)]


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of all texts, each closed by END; and the number of tokens of each text."""
    words = Words(texts, lower=True)
    out = np.full(len(words.hashes) + len(texts), END, np.uint64)
    out[np.arange(len(words.hashes)) + np.repeat(np.arange(len(texts)), words.counts)] = words.hashes
    return out, words.counts + 1


# ------------------------------------------------------------------ corpus counts


def count_words(rows: DataFrame, parts: int) -> DataFrame:
    """One row a hash range: part, its word hashes (sorted) and their counts over ``rows`` (text)."""
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in chunks(batches, 0, CHUNK_BYTES):
            words, counts = np.unique(tokens(texts)[0], return_counts=True)
            part = (words % np.uint64(parts)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            cuts = np.flatnonzero(np.diff(part[order])) + 1
            own = np.split(order, cuts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([part[o[0]] for o in own], pa.int32()), pa.array([words[o].tobytes() for o in own], pa.binary()),
                 pa.array([counts[o].astype("<i8").tobytes() for o in own], pa.binary())], ["part", "words", "counts"])

    def total(table: pa.Table) -> pa.Table:
        words, counts = column(table, "words", "<u8"), column(table, "counts", "<i8")
        order = np.argsort(words)
        words = words[order]
        first = np.flatnonzero(np.concatenate(([True], words[1:] != words[:-1])))
        words, counts = words[first], np.add.reduceat(counts[order], first)
        return pa.table({"part": table.column("part").slice(0, 1).cast(pa.int32()), "words": pa.array([words.tobytes()], pa.binary()),
                         "counts": pa.array([counts.tobytes()], pa.binary())})

    kinds = "part int, words binary, counts binary"
    return rows.select("text").mapInArrow(partial, kinds).groupBy("part").applyInArrow(total, kinds)


def sized(total: int, root: int, least: int, most: int = 1 << 40) -> int:
    """A power of two, ``least`` or more, that grows with the square root of the tokens (to ``most``)."""
    return min(most, max(least, 1 << max(0, int(root * total ** 0.5) - 1).bit_length()))


def leaves_for(total: int) -> int:
    """Leaves of a tree whose nodes have WIDTH children each, so that no level is wider than it needs."""
    bits = WIDTH.bit_length() - 1
    return 1 << bits * ((sized(total, LEAVES_ROOT, LEAVES).bit_length() - 1) // bits)


def leaf_of(words: np.ndarray, leaves: int) -> np.ndarray:
    return (mix64(words ^ _SALT[1]) % np.uint64(leaves)).astype(np.int64)


class Frame:
    """What the counts fix: totals, sizes, the top tokens with their classes, and the masses of the rare
    class and its leaves. ``leaves``: counts and distinct words of every leaf over all words."""

    def __init__(self, total: int, distinct: int, top: list[tuple[int, int]], leaves: np.ndarray | None = None):
        self.total, self.distinct = total, distinct
        self.class_rows = sized(total, CLASS_ROOT, CLASS_ROWS, MOST_ROWS // 4)
        self.word_rows = sized(total, WORD_ROOT, WORD_ROWS, MOST_ROWS)
        top = sorted(top, key=lambda x: (-x[1], x[0]))
        self.counts = np.array([c for _, c in top], np.int64)
        hashes = np.array([h for h, _ in top], np.int64).view(np.uint64)
        self.order = np.argsort(hashes)
        self.sorted = hashes[self.order]
        self.rare_mass = float(total - self.counts.sum()) + ALPHA * (distinct - len(top)) + ALPHA
        # Natural logs of shares: classes (rare last), and words inside their class.
        mass = np.zeros(CLASSES + 1)
        np.add.at(mass, np.arange(len(top)) // WIDTH, self.counts + ALPHA)
        mass[CLASSES] = self.rare_mass
        with np.errstate(divide="ignore"):
            self.class_bias = np.log(mass / mass.sum()).astype(np.float32)
            words = np.full(TOP, -np.inf)
            words[:len(top)] = np.log(self.counts + ALPHA)
        self.logs = np.log10(self.counts + ALPHA)
        # The rare class's leaves: counts without the top tokens, and a share of the mass of unseen words.
        self.leaves = 1 if leaves is None else leaves.shape[1]
        if leaves is None:
            masses = np.array([self.rare_mass])
        else:
            leaves, own = leaves.copy(), leaf_of(hashes, self.leaves)
            np.subtract.at(leaves[0], own, self.counts)
            np.subtract.at(leaves[1], own, 1)
            masses = leaves[0] + ALPHA * leaves[1] + ALPHA / self.leaves
        self.leaf_logs = np.log10(masses)
        # Nodes: the classes of top tokens, then the tree's levels from its root. (first node, bits below, children's bits).
        self.levels, nodes, bits = [], [np.exp(words).reshape(CLASSES, WIDTH)], self.leaves.bit_length() - 1
        first = CLASSES
        while bits:
            own = min(bits, WIDTH.bit_length() - 1)
            bits -= own
            below = masses.reshape(-1, 1 << own, 1 << bits).sum(axis=2)
            self.levels.append((first, bits, own))
            nodes.append(np.pad(below, ((0, 0), (0, WIDTH - below.shape[1]))))
            first += len(below)
        mass = np.concatenate(nodes)
        with np.errstate(divide="ignore"):
            self.word_bias = (np.log(mass) - np.log(np.maximum(mass.sum(axis=1, keepdims=True), 1e-300))).astype(np.float32)

    def ids(self, words: np.ndarray) -> np.ndarray:
        """Rank among the top tokens; for all others TOP and the leaf."""
        rare = TOP + leaf_of(words, self.leaves)
        if not len(self.sorted):
            return rare
        at = np.minimum(np.searchsorted(self.sorted, words), len(self.sorted) - 1)
        return np.where(self.sorted[at] == words, self.order[at], rare)

    def decisions(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The choices below the classes that lead to the tokens: place of the token, node and child."""
        top, rare = np.flatnonzero(ids < TOP), np.flatnonzero(ids >= TOP)
        at, node, child = [top], [ids[top] // WIDTH], [ids[top] % WIDTH]
        leaf = ids[rare] - TOP
        for first, bits, own in self.levels:
            at.append(rare)
            node.append(first + (leaf >> (bits + own)))
            child.append((leaf >> bits) & ((1 << own) - 1))
        return np.concatenate(at), np.concatenate(node), np.concatenate(child)


def frame_of(counted: DataFrame) -> Frame:
    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for w, c in zip(batch.column(0), batch.column(1)):
                words, counts = np.frombuffer(w.as_py(), "<u8"), np.frombuffer(c.as_py(), "<i8")
                keep = np.lexsort((words, -counts))[:TOP]
                end = np.flatnonzero(words == END)
                keep = np.union1d(keep, end)
                n = len(keep)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(words[keep].view(np.int64)), pa.array(counts[keep]), pa.array([int(counts.sum())] + [0] * (n - 1), pa.int64()),
                     pa.array([len(words)] + [0] * (n - 1), pa.int64())], ["word", "c", "total", "distinct"])

    found = stored(counted.select("words", "counts").mapInArrow(best, "word long, c long, total long, distinct long"), "lm-top")
    sums = found.agg(F.sum("total"), F.sum("distinct")).collect()[0]  # one row
    end = int(END.astype(np.int64))
    rows = found.orderBy((F.col("word") == end).desc(), F.col("c").desc(), "word").limit(TOP).collect()  # the model's vocabulary
    total = sums[0] or 0
    return Frame(total, sums[1] or 0, [(r["word"], r["c"]) for r in rows], _leaves(counted, leaves_for(total)))


def _leaves(counted: DataFrame, leaves: int) -> np.ndarray:
    """Counts and distinct words of every leaf, added up block by block in Spark."""
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = np.zeros((2, leaves), np.int64)
        for batch in batches:
            for w, c in zip(batch.column(0), batch.column(1)):
                own = leaf_of(np.frombuffer(w.as_py(), "<u8"), leaves)
                both[0] += np.bincount(own, np.frombuffer(c.as_py(), "<i8"), leaves).astype(np.int64)
                both[1] += np.bincount(own, minlength=leaves)
        flat = both.reshape(-1)
        for b, at in enumerate(range(0, len(flat), BLOCK)):
            yield pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), pa.array([flat[at:at + BLOCK].tobytes()], pa.binary())], ["block", "n"])

    def add(table: pa.Table) -> pa.Table:
        total = np.sum([np.frombuffer(x, np.int64) for x in table.column("n").to_pylist()], axis=0)
        return pa.table({"block": table.column("block").slice(0, 1).cast(pa.int32()), "n": pa.array([total.tobytes()], pa.binary())})

    kinds = "block int, n binary"
    blocks = counted.select("words", "counts").mapInArrow(partial, kinds).groupBy("block").applyInArrow(add, kinds).collect()  # the leaves
    if not blocks:
        return np.zeros((2, leaves), np.int64)
    return np.frombuffer(b"".join(bytes(r["n"]) for r in sorted(blocks, key=lambda r: r["block"])), np.int64).reshape(2, leaves)


# ------------------------------------------------------------------ the model


class Model:
    def __init__(self, frame: Frame, classes: np.ndarray | None = None, words: np.ndarray | None = None):
        self.frame = frame
        self.classes = np.zeros((frame.class_rows, CLASSES + 1), np.float32) if classes is None else classes
        self.words = np.zeros((frame.word_rows, WIDTH), np.float32) if words is None else words

    @staticmethod
    def history(stream: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Three feature hashes for each token: the word before, the two before, the one before that."""
        first = np.cumsum(sizes) - sizes
        one, two = np.roll(stream, 1), np.roll(stream, 2)
        one[first] = START
        two[first] = START
        second = first[sizes > 1] + 1
        two[second] = START
        return np.stack([mix64(one ^ _SALT[0]), mix64(mix64(two + _SALT[1]) ^ one), mix64(two ^ _SALT[2])])

    def class_logits(self, rows: np.ndarray) -> np.ndarray:
        return _logits(self.classes, rows, self.frame.class_bias)

    def word_logits(self, rows: np.ndarray, own: np.ndarray) -> np.ndarray:
        return _logits(self.words, rows, np.take(self.frame.word_bias, own, axis=0))

    def rows(self, features: np.ndarray, own: np.ndarray | None = None) -> np.ndarray:
        if own is None:
            return (features % np.uint64(len(self.classes))).astype(np.int64)
        return (mix64(features + own.astype(np.uint64)) % np.uint64(len(self.words))).astype(np.int64)

    def log_probabilities(self, ids: np.ndarray, features: np.ndarray) -> np.ndarray:
        """Natural log of P(token | history); of rare tokens that of their leaf."""
        out = np.empty(len(ids), np.float64)
        for at in range(0, len(ids), 1 << 13):
            i, f = ids[at:at + (1 << 13)], features[:, at:at + (1 << 13)]
            part = _chosen(self.class_logits(self.rows(f)), np.minimum(i // WIDTH, CLASSES))
            place, node, child = self.frame.decisions(i)
            if len(place):
                below = _chosen(self.word_logits(self.rows(np.take(f[:BELOW], place, axis=1), node), node), child)
                part = part + np.bincount(place, below, len(i))
            out[at:at + len(i)] = part
        return out

    def learn(self, ids: np.ndarray, features: np.ndarray, state: list[np.ndarray]) -> None:
        """AdaGrad steps over batches of tokens; ``state`` is the sum of squared gradients of each row of the tables."""
        for at in range(0, len(ids), BATCH):
            i, f = ids[at:at + BATCH], features[:, at:at + BATCH]
            rows = self.rows(f)
            _step(self.classes, state[0], rows, _gradient(self.class_logits(rows), np.minimum(i // WIDTH, CLASSES)))
            place, node, child = self.frame.decisions(i)
            if len(place):
                rows = self.rows(np.take(f[:BELOW], place, axis=1), node)
                _step(self.words, state[1], rows, _gradient(self.word_logits(rows, node), child))


def _logits(weights: np.ndarray, rows: np.ndarray, bias: np.ndarray) -> np.ndarray:
    out = np.take(weights, rows[0], axis=0)
    for own in rows[1:]:
        out += np.take(weights, own, axis=0)
    out += bias
    return out


def _chosen(logits: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Log probabilities; uses up ``logits``."""
    np.minimum(logits, HIGHEST, out=logits)
    own = logits[np.arange(len(at)), at].astype(np.float64)
    return own - np.log(np.exp(logits, out=logits) @ np.ones(logits.shape[1], np.float32))


def _gradient(logits: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Probabilities less the chosen ones; uses up ``logits``."""
    np.minimum(logits, HIGHEST, out=logits)
    p = np.exp(logits, out=logits)
    p *= (1 / (p @ np.ones(p.shape[1], np.float32)))[:, None]
    p[np.arange(len(at)), at] -= 1
    return p


def _step(weights: np.ndarray, state: np.ndarray, rows: np.ndarray, gradient: np.ndarray) -> None:
    """One step of every row in ``rows`` (a line a feature) by the sum of its decisions' gradients."""
    n, all_ = rows.shape[1], rows.size
    bits = np.int64(all_.bit_length())
    # Row and place in one number: one sort brings the gradients of a row together, in the order of the tokens.
    keys = rows.reshape(-1) << bits
    keys |= np.arange(all_)
    keys.sort()
    row = keys >> bits
    place = (keys & ((1 << bits) - 1)) % n
    first = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))
    where, times = row[first], np.diff(first, append=all_)
    total = np.take(gradient, place[first], axis=0)
    # Most rows come once; second and third decisions are added for all rows at once, the rest by row.
    seen, more = 1, np.flatnonzero(times > 1)
    while len(more) and seen < 4:
        total[more] += np.take(gradient, place[first[more] + seen], axis=0)
        seen += 1
        more = more[times[more] > seen]
    if len(more):
        own = times[more] - seen
        total[more] += np.add.reduceat(np.take(gradient, place[ranges(first[more] + seen, own)], axis=0), np.cumsum(own) - own, axis=0)
    squares = state.reshape(len(state), -1)[:, 0]
    norm = squares[where] + np.einsum("ij,ij->i", total, total)
    squares[where] = norm
    total *= (RATE / np.sqrt(norm + DAMPING))[:, None].astype(np.float32)
    weights[where] = np.take(weights, where, axis=0) - total


_PART = "kind int, block int, slot int, rows binary, times binary, weights binary"


def _changed(model: Model, state: list[np.ndarray], slot: int) -> Iterator[pa.RecordBatch]:
    """The changed rows of both tables, a record for each block of rows."""
    for kind, (table, seen) in enumerate(zip((model.classes, model.words), state)):
        rows = np.flatnonzero(seen)
        for own in np.split(rows, np.flatnonzero(np.diff(rows // BLOCK_ROWS)) + 1) if len(rows) else []:
            yield _part_row(kind, int(own[0] // BLOCK_ROWS), slot, own % BLOCK_ROWS, np.ones(len(own)), table[own])


def _part_row(kind: int, block: int, slot: int, rows: np.ndarray, times: np.ndarray, weights: np.ndarray) -> pa.RecordBatch:
    values = (kind, block, slot, rows.astype("<u2").tobytes(), times.astype("<i4").tobytes(), weights.astype("<f4").tobytes())
    return pa.RecordBatch.from_arrays([pa.array([v], pa.binary() if i > 2 else pa.int32()) for i, v in enumerate(values)],
                                      [c.split()[0] for c in _PART.split(", ")])


def _mean(table: pa.Table) -> pa.Table:
    """The mean of each row of a block over the tasks that changed it, and their number."""
    kind, block = (table.column(c)[0].as_py() for c in ("kind", "block"))
    width = (CLASSES + 1, WIDTH)[kind]
    times, total = np.zeros(BLOCK_ROWS, np.int64), np.zeros((BLOCK_ROWS, width))
    for r, t, w in zip(*(table.column(c) for c in ("rows", "times", "weights"))):
        rows, own = np.frombuffer(r.as_py(), "<u2"), np.frombuffer(t.as_py(), "<i4")
        times[rows] += own
        total[rows] += own[:, None] * np.frombuffer(w.as_py(), "<f4").reshape(-1, width)
    rows = np.flatnonzero(times)
    return pa.Table.from_batches([_part_row(kind, block, 0, rows, times[rows], total[rows] / times[rows, None])])


def train(texts: DataFrame, frame: Frame, tasks: int = TASKS) -> Model:
    """One round of updates over all ``texts`` (text)."""
    spark = texts.sparkSession
    model = Model(frame)
    texts = texts.select("text")
    # Many splits are put together without a shuffle; too few are dealt out anew.
    texts = texts.coalesce(tasks) if texts.rdd.getNumPartitions() >= tasks else stored(texts.repartition(tasks), "lm-texts")
    slots = max(1, round(tasks ** 0.5))
    sent = spark.sparkContext.broadcast(frame)

    def update(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(sent.value)
        state = [np.zeros(len(own.classes), np.float32), np.zeros(len(own.words), np.float32)]
        for _, texts in chunks(batches, 0, 1 << 20):
            stream, sizes = tokens(texts)
            own.learn(own.frame.ids(stream), Model.history(stream, sizes), state)
        yield from _changed(own, state, TaskContext.get().partitionId() % slots)

    parts = texts.mapInArrow(update, _PART).groupBy("kind", "block", "slot").applyInArrow(_mean, _PART)
    for row in parts.groupBy("kind", "block").applyInArrow(_mean, _PART).toLocalIterator():  # the weights: MOST_ROWS bounds them
        table = model.words if row["kind"] else model.classes
        rows = np.frombuffer(row["rows"], "<u2").astype(np.int64) + row["block"] * BLOCK_ROWS
        table[rows] = np.frombuffer(row["weights"], "<f4").reshape(len(rows), -1)
    return model


# ------------------------------------------------------------------ scoring

_ROW = "part int, words binary, counts binary, sizes binary, texts binary, times binary, ranks binary, uids binary, self binary"
#: Sums for the documents of one reply, and for each document: copies, tokens, known tokens, and the
#: log10 sums of the base model and of the model.
_REPLY = "reply int, ranks binary, uids binary, ints binary, floats binary"
_SUMS = "rank long, uid long, self long, n_tokens long, known long, logs double, lm double"


def _sent(rows: DataFrame, model: Model, parts: int) -> DataFrame:
    """For each chunk and hash range: its rare words, and for each the texts and times it occurs. And
    one row a chunk with what needs no corpus counts (in ``self``)."""
    sent = rows.sparkSession.sparkContext.broadcast((model.frame, model.classes, model.words))
    names = [c.split()[0] for c in _ROW.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(*sent.value)
        logs_of = np.concatenate((m.frame.logs, np.zeros(TOP + 1 - len(m.frame.logs))))
        for batch, texts in chunks(batches, 2, CHUNK_BYTES):
            rank, uid = (np.array(batch.column(c).to_pylist(), np.int64) for c in (0, 1))
            uid = uid.astype("<u4")
            stream, sizes = tokens(texts)
            text = np.repeat(np.arange(len(texts)), sizes)
            ids = m.frame.ids(stream)
            lm = np.bincount(text, m.log_probabilities(ids, Model.history(stream, sizes)), len(texts)) / np.log(10)
            top = ids < TOP
            logs = np.bincount(text, logs_of[np.minimum(ids, TOP)], len(texts))
            known = np.bincount(text, top, len(texts)).astype(np.int64)
            lm -= np.bincount(text[~top], m.frame.leaf_logs[ids[~top] - TOP], len(texts))
            own = b"".join(x.tobytes() for x in (sizes.astype(np.int64), known, logs, lm))
            out = [(int(uid[0]) % parts, b"", b"", b"", b"", b"", planes(rank), uid.tobytes(), own)]
            word, text = stream[~top], text[~top].astype(np.int64)
            if len(word):
                order = np.lexsort((text, word))
                word, text = word[order], text[order]
                new = np.ones(len(word), bool)
                new[1:] = (word[1:] != word[:-1]) | (text[1:] != text[:-1])
                head = np.flatnonzero(new)
                times = np.diff(np.concatenate((head, [len(word)])))
                word, text = word[head], text[head]
                part = (word % np.uint64(parts)).astype(np.int64)
                order = np.argsort(part, kind="stable")
                for o in np.split(order, np.flatnonzero(np.diff(part[order])) + 1):
                    first = np.flatnonzero(np.concatenate(([True], word[o][1:] != word[o][:-1])))
                    used, at = np.unique(text[o], return_inverse=True)
                    out.append((int(part[o[0]]), word[o][first].tobytes(), b"",
                                np.diff(np.concatenate((first, [len(o)]))).astype("<u4").tobytes(), at.astype("<u4").tobytes(),
                                times[o].astype("<u4").tobytes(), planes(rank[used]), uid[used].tobytes(), b""))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary() if k else pa.int32()) for k, c in enumerate(zip(*out))], names)

    return rows.select("rank", "uid", "text").mapInArrow(run, _ROW)


def _sums(parts: int):
    """Of one hash range: the counts meet the chunks' words; a sum for each text, packed by reply."""
    def sums(table: pa.Table) -> pa.Table:
        is_count = pc.greater(pc.binary_length(table.column("counts")), 0)
        counted = table.filter(is_count)
        words, counts = column(counted, "words", "<u8"), column(counted, "counts", "<i8")
        rows = table.filter(pc.invert(is_count))
        del table, counted
        out = []
        for i in range(rows.num_rows):
            row = {c: rows.column(c)[i].as_py() for c in ("ranks", "uids", "self", "words", "sizes", "texts", "times")}
            rank, uid = unplanes(row["ranks"], "<i8"), np.frombuffer(row["uids"], "<u4")
            n = len(rank)
            if row["self"]:
                ints, floats = np.frombuffer(row["self"][:16 * n], "<i8").reshape(2, n), np.frombuffer(row["self"][16 * n:], "<f8").reshape(2, n)
                out.append((rank, uid, np.vstack((np.ones(n, np.int64), ints)), floats))
                continue
            own = np.frombuffer(row["words"], "<u8")
            c = np.zeros(len(own), np.int64)
            if len(words):
                at = np.minimum(np.searchsorted(words, own), len(words) - 1)
                c = np.where(words[at] == own, counts[at], 0)
            c = np.repeat(c, np.frombuffer(row["sizes"], "<u4"))
            text, times = np.frombuffer(row["texts"], "<u4"), np.frombuffer(row["times"], "<u4")
            logs = np.bincount(text, times * np.log10(c + ALPHA), n)
            known = np.bincount(text, times * (c > 0), n).astype(np.int64)
            none = np.zeros(n, np.int64)
            out.append((rank, uid, np.vstack((none, none, known)), np.vstack((logs, logs))))
        release()
        return _by_reply(out, parts)
    return sums


def _added(parts: list[tuple]) -> tuple[np.ndarray, ...]:
    """(rank, uid, ints, floats) with one entry for each document."""
    rank, uid = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
    ints, floats = (np.concatenate([p[i] for p in parts], axis=1) for i in (2, 3))
    order = np.lexsort((uid, rank))
    rank, uid = rank[order], uid[order]
    first = np.flatnonzero(np.concatenate(([True], (rank[1:] != rank[:-1]) | (uid[1:] != uid[:-1]))))
    return rank[first], uid[first], np.add.reduceat(ints[:, order], first, axis=1), np.add.reduceat(floats[:, order], first, axis=1)


def _by_reply(parts_of: list[tuple], parts: int) -> pa.Table:
    cols = [[] for _ in range(5)]
    if parts_of:
        rank, uid, ints, floats = _added(parts_of)
        to = (mix64(rank.astype(np.uint64) ^ (uid.astype(np.uint64) << np.uint64(32))) % np.uint64(parts)).astype(np.int32)
        order = np.argsort(to, kind="stable")
        for own in np.split(order, np.flatnonzero(np.diff(to[order])) + 1):
            row = (int(to[own[0]]), planes(rank[own]), uid[own].astype("<u4").tobytes(), planes(ints[:, own].reshape(-1)),
                   floats[:, own].tobytes())
            for c, value in zip(cols, row):
                c.append(value)
    kinds = [pa.int32()] + [pa.binary()] * 4
    return pa.table({name.split()[0]: pa.array(c, k) for name, c, k in zip(_REPLY.split(", "), cols, kinds)})


def _totals(table: pa.Table) -> pa.Table:
    """One row for each document of a reply."""
    parts_of = []
    for row in table.to_pylist():
        rank, uid = unplanes(row["ranks"], "<i8"), np.frombuffer(row["uids"], "<u4")
        parts_of.append((rank, uid, unplanes(row["ints"], "<i8").reshape(3, -1), np.frombuffer(row["floats"], "<f8").reshape(2, -1)))
    rank, uid, ints, floats = _added(parts_of)
    cols = [rank, uid.astype(np.int64), *ints, *floats]
    return pa.table({name.split()[0]: pa.array(c) for name, c in zip(_SUMS.split(", "), cols)})


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """held_out, n_tokens, n_known, train_tokens, base_score and score of every row of ``docs``."""
    learn = F.coalesce(fold(id_col, FOLDS) != HELD_OUT, F.lit(False))
    rows = named(docs, id_col, text_col, F.col(id_col).alias("doc"), learn.alias("learn"))
    size = rows.agg(F.sum(F.octet_length("text"))).collect()[0][0] or 0
    parts = max(1, -(-int(size) // RANGE_BYTES))
    counted = stored(count_words(rows.where("learn"), parts), "lm-counts")
    frame = frame_of(counted)
    model = train(rows.where("learn").select("text"), frame, max(TASKS, -(-int(size) // TRAIN_BYTES)))
    none = F.lit(None).cast("binary")
    given = counted.select("part", "words", "counts", *[F.coalesce(none, F.lit(b"")).alias(c) for c in
                                                       ("sizes", "texts", "times", "ranks", "uids", "self")])
    sums = (_sent(rows, model, parts).unionByName(given).groupBy("part").applyInArrow(_sums(parts), _REPLY)
            .groupBy("reply").applyInArrow(_totals, _SUMS))
    # Rows equal in id and text were summed together: their number is ``self``.
    each = sums.select("rank", F.explode(F.sequence(F.lit(1), F.col("self").cast("int"))).alias("copy"),
                       *[(F.col(c) / F.col("self")).alias(c) for c in ("n_tokens", "known", "logs", "lm")])
    kind = docs.schema[id_col].dataType
    doc = F.when(F.col("rank") != LAST, F.col("rank")).cast(kind)
    out = each.select(doc.alias(id_col), F.col("n_tokens").cast("long").alias("n_tokens"), F.col("known").cast("long").alias("n_known"),
                      F.lit(frame.total).cast("long").alias("train_tokens"),
                      (F.col("logs") - F.col("n_tokens") * log10(frame.total + ALPHA * (frame.distinct + 1))).alias("base_score"),
                      F.col("lm").alias("score"))
    held = F.coalesce(fold(id_col, FOLDS) == HELD_OUT, F.lit(False))
    return out.select(id_col, held.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(read(spark, sf_dir, "documents"))
