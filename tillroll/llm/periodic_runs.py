"""Operator 12, detection of periodic runs by string synchronising sets.

A run is a stretch of consecutive words of one text with smallest period q and at least
max(LEAST, EXPONENT * q) words that no neighbouring word extends keeping the period.

Method, for all texts of a chunk at once (words are numbered exactly, by a dictionary of the chunk, and
a number of its own ends each text, so nothing matches across texts):

1. Periods below 2 ** FIRST are found directly, as stretches of words equal to the word q before.
2. For each dyadic scale t = 2 ** FIRST, 2 ** (FIRST + 1), ... a synchronising set is chosen: position i
   belongs to it if the least hash of t words among those starting at i .. i + t is the one at i or at i + t.
   Whether i belongs depends on the 2t words from i on, so equal contexts are chosen alike. Positions
   whose t words lie in a run of period t / 4 at most don't compete: in such highly periodic regions all
   hashes repeat. The regions are known, as their periods are smaller than the scale's; their runs
   were found before, and so supply what the set omits.
3. Neighbouring positions of the set with equal contexts (2t words) in one text propose their distance as a
   period, if it is in t .. 2t - 1. A run of such a period q has at least 4q words, so it holds a position i
   of the set and its twin i + q with their contexts; no nearer position has the context, or q would not
   be the smallest period. So every run is proposed by its scale.
4. Proposals of one run are joined, and its ends found by comparing the word numbers themselves.
   Contexts are compared by 64-bit hashes of word numbers, which only propose.

A chunk needs memory in proportion to its words, a scale only reads texts of at least 4t words. Texts are
whole; one longer than a chunk comes alone.

Defined results: null, empty and wordless texts have no words, no run, four nulls, and the digests of empty
strings. Rows with a null id are not rewritten (below); repeated rows each get their result; an empty
table gives no rows. Other columns are not returned.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Words, chunks, mix64, ranges, read

LEAST, EXPONENT = 6, 4
FIRST = 3
CHUNK_BYTES = 2 << 20


def numbered(words: Words) -> tuple[np.ndarray, pa.Array]:
    """Number of each word, and the words by number. Equal numbers mean equal words."""
    lengths = words.ends - words.starts
    packed = words.data[ranges(words.starts, lengths)]
    offsets = np.concatenate(([0], np.cumsum(lengths))).astype(np.int64)
    array = pa.Array.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(packed)])
    coded = array.dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), coded.dictionary


def _laid_out(ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts' word numbers one after the other, each text ended by a number of its own, and where each starts."""
    starts = np.concatenate(([0], np.cumsum(counts + 1)))[:-1]
    out = np.empty(int(counts.sum()) + len(counts), np.int64)
    out[starts + counts] = -1 - np.arange(len(counts))
    out[ranges(starts, counts)] = ids
    return out, starts


def _stretches(equal: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches of True."""
    edge = np.flatnonzero(np.diff(np.concatenate(([False], equal, [False])).view(np.int8)))
    return edge[0::2], edge[1::2]


def _small_periods(x: np.ndarray, q: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of the runs of period ``q``, found by comparing each word with the one q before."""
    start, end = _stretches(x[q:] == x[:-q]) if len(x) > q else (np.empty(0, np.int64),) * 2
    keep = end - start + q >= max(LEAST, EXPONENT * q)
    start, end = start[keep], end[keep]
    smallest = np.ones(len(start), bool)
    for p in range(1, q):
        if q % p == 0:  # a smaller period of so long a run divides q, and then the first 2q words have it
            steps = np.arange(q)
            smallest &= ~(x[start[:, None] + steps] == x[start[:, None] + steps + p]).all(axis=1)
    return start[smallest], (end - start + q)[smallest]


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of ``width`` (a power of two) neighbours from each position on."""
    step = 1
    while step < width:
        values = np.minimum(values[:-step], values[step:])
        step *= 2
    return values


def _context_hashes(x: np.ndarray, t: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the t and of the 2t words from each position on."""
    h = mix64(x.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    step = 1
    while step < t:
        h = mix64(h[:-step] * np.uint64(0xD1342543DE82EF95) + h[step:])
        step *= 2
    return h, mix64(h[:-t] * np.uint64(0xD1342543DE82EF95) + h[t:])


def _synchronised(x: np.ndarray, t: int, runs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the synchronising set of scale ``t`` and the hashes of their contexts; ``runs``
    (start, length, period) are those of smaller periods."""
    names, contexts = _context_hashes(x, t)
    start, length, period = runs
    of = np.flatnonzero((period <= t // 4) & (length >= t))
    covered = np.zeros(len(names) + 1, np.int32)
    np.add.at(covered, start[of], 1)
    np.add.at(covered, start[of] + length[of] - t + 1, -1)
    names[np.cumsum(covered[:-1]) > 0] = np.uint64(2 ** 64 - 1)
    inside = np.minimum(_least(names, t)[:len(contexts)], names[t:][:len(contexts)])
    chosen = (inside < np.uint64(2 ** 64 - 1)) & ((names[:len(contexts)] == inside) | (names[t:][:len(contexts)] == inside))
    at = np.flatnonzero(chosen)
    return at, contexts[at]


def _proposed(at: np.ndarray, contexts: np.ndarray, t: int) -> tuple[np.ndarray, np.ndarray]:
    """(period, position) of the neighbours with equal contexts, sorted."""
    order = np.argsort(contexts, kind="stable")  # positions stay in order among equals
    one, next_one = order[:-1], order[1:]
    q = at[next_one] - at[one]
    keep = (contexts[one] == contexts[next_one]) & (q >= t) & (q < 2 * t)
    q, i = q[keep], at[one][keep]
    order = np.lexsort((i, q))
    return q[order], i[order]


def _reach(x: np.ndarray, at: np.ndarray, q: np.ndarray, step: int) -> np.ndarray:
    """How many words from ``at`` on (in direction ``step``) equal the one q further."""
    width = 16
    found = np.zeros(len(at), np.int64)
    open_ = np.arange(len(at))
    while len(open_):
        width = min(2 * width, max(32, (1 << 20) // len(open_)))
        near = at[open_, None] + step * (found[open_, None] + np.arange(width))
        far = near + q[open_, None]
        inside = (near >= 0) & (far < len(x))
        same = inside & (x[np.clip(near, 0, len(x) - 1)] == x[np.clip(far, 0, len(x) - 1)])
        more = np.where(same.all(axis=1), width, np.argmin(same, axis=1))
        found[open_] += more
        open_ = open_[more == width]
    return found


def _checked(x: np.ndarray, q: np.ndarray, i: np.ndarray, t: int) -> tuple[np.ndarray, ...]:
    """Start, length and period of the runs behind the proposals (period, position)."""
    if not len(q):
        return (np.empty(0, np.int64),) * 3
    # The contexts of proposals of one run overlap; those joined need one look at each end.
    new = np.concatenate(([True], (q[1:] != q[:-1]) | (i[1:] > i[:-1] + 2 * t)))
    head = np.flatnonzero(new)
    q, first = q[head], i[head]
    start = first - _reach(x, first - 1, q, -1)
    end = first + _reach(x, first, q, 1)
    keep = np.flatnonzero(end - start + q >= np.maximum(LEAST, EXPONENT * q))
    start, length, q = start[keep], (end - start + q)[keep], q[keep]
    found = np.unique(np.stack((start, q, length)), axis=1) if len(q) else np.empty((3, 0), np.int64)
    return found[0], found[2], found[1]


def find_runs(ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Text, start, length and period of all runs, by text, start and period. ``ids`` are the word numbers
    of texts of ``counts`` words one after the other."""
    x, starts = _laid_out(ids, counts)
    found = [(s, n, np.full(len(s), q)) for q in range(1, 1 << FIRST) for s, n in [_small_periods(x, q)]]
    t = 1 << FIRST
    while len(counts) and int(counts.max()) >= EXPONENT * t:
        # Only texts that can hold a run of this scale: the others are cut out.
        texts = np.flatnonzero(counts >= EXPONENT * t)
        keep = ranges(starts[texts], counts[texts] + 1)
        part = x[keep]
        own = np.concatenate(([0], np.cumsum(counts[texts] + 1)))
        runs = [np.concatenate(c) for c in zip(*found)]
        text = np.searchsorted(starts, runs[0], "right") - 1
        slot = np.searchsorted(texts, text)
        here = np.flatnonzero((slot < len(texts)) & (texts[np.minimum(slot, len(texts) - 1)] == text))
        moved = own[slot[here]] + runs[0][here] - starts[text[here]]
        start, length, period = _checked(part, *_proposed(*_synchronised(part, t, [moved, runs[1][here], runs[2][here]]), t), t)
        found.append((keep[start], length, period))
        t *= 2
    start, length, period = (np.concatenate(c) for c in zip(*found))
    text = np.searchsorted(starts, start, "right") - 1
    start = start - starts[text] if len(start) else start
    order = np.lexsort((period, start, text))
    return text[order], start[order], length[order], period[order]


def _rewritten(ids: np.ndarray, counts: np.ndarray, offsets: np.ndarray, marks: list[int | None]) -> np.ndarray:
    """The word numbers after word i >= a of every text with mark % 10 = 0 became its word a + (i - a) % p."""
    take = np.arange(len(ids))
    for i, h in enumerate(marks):
        n = int(counts[i])
        if h is not None and h % 10 == 0 and n > 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            take[offsets[i] + a:offsets[i] + n] = offsets[i] + a + np.arange(n - a) % p
    return ids[take]


_RESULT = ("n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string")
_SPANS = "runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed_text string"


def _results(words: Words, ids: np.ndarray, spelled: pa.Array, with_text: bool) -> list[pa.Array]:
    text, start, length, period = find_runs(ids, words.counts)
    bounds = np.searchsorted(text, np.arange(len(words.counts) + 1))
    # Words that a run covers after its first period go.
    drop = np.zeros(len(ids) + 1, np.int32)
    np.add.at(drop, words.offsets[text] + start + period, 1)
    np.add.at(drop, words.offsets[text] + start + length, -1)
    kept = np.flatnonzero(np.cumsum(drop[:-1]) == 0)
    cuts = np.searchsorted(kept, words.offsets)
    lists = pa.LargeListArray.from_arrays(pa.array(cuts, pa.int64()), spelled.take(pa.array(ids[kept])))
    collapsed = pc.binary_join(lists, pa.scalar(b" ", pa.large_binary())).to_pylist()
    best, listed, spans = [], [], []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        own = list(zip(start[a:b].tolist(), length[a:b].tolist(), period[a:b].tolist()))
        listed.append(hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in own).encode()).hexdigest())
        top = None
        for s, n, q in own:  # by start, then period: a later run has to have more repeats
            if top is None or n * top[2] > top[1] * q:
                top = (s, n, q)
        best.append((b - a, *top, 1000 * top[1] // top[2]) if top else (0, None, None, None, None))
        spans.append([{"start": s, "length": n, "period": q} for s, n, q in own])
    out = [pa.array(c, pa.int64()) for c in zip(*best)] + [pa.array(listed), pa.array([hashlib.sha256(c).hexdigest() for c in collapsed])]
    if with_text:
        out += [pa.array(spans, pa.list_(pa.struct([(k, pa.int64()) for k in ("start", "length", "period")]))), pa.array([c.decode() for c in collapsed], pa.string())]
    return out


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", mark: Column | None = None,
                  with_text: bool = False, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Number of runs, the run with most repeats and the digests of all runs and of the collapsed text for every
    row; with ``with_text`` also the runs and that text. Texts whose ``mark`` is a number that 10 divides
    are rewritten first (word i >= a becomes word a + (i - a) % p, see ``_rewritten``)."""
    rows = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"), (F.lit(None) if mark is None else mark).cast("long").alias("mark"))
    schema = f"doc {rows.schema['doc'].dataType.simpleString()}, {_RESULT}" + (f", {_SPANS}" if with_text else "")
    names = ["doc", *"n_runs start length period exponent_milli runs_sha256 collapsed_sha256".split(), *(["runs", "collapsed_text"] if with_text else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in chunks(batches, 1, chunk_bytes):
            words = Words(texts, lower=False)
            ids, spelled = numbered(words)
            ids = _rewritten(ids, words.counts, words.offsets, batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), *_results(words, ids, spelled, with_text)], names)

    return rows.mapInArrow(run, schema).withColumnRenamed("doc", id_col)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return periodic_runs(docs, mark=F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")))
