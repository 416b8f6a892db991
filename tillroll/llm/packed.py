"""Packed rows: runs of positions in documents, as arrays inside binary columns.

A document is named by its rank (its id; null ids last) and 32 bits of its text's hash, which only
tells rows apart that share an id. Positions are kept in segments of 2 ** 16 as 16-bit offsets, and
wider numbers as byte planes, whose high bytes hardly change along a row and compress well.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import mix64, ranges

SEGMENT = 1 << 16
LAST = np.iinfo(np.int64).max


def named(docs: DataFrame, id_col: str, text_col: str, *others: Column) -> DataFrame:
    """rank, uid, text (null as empty), and other columns."""
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("rank"), F.coalesce(text_col, F.lit("")).alias("text"), *others)
    return rows.withColumn("uid", F.xxhash64("text").bitwiseAND(F.lit(0xFFFFFFFF)))


def planes(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values).view(np.uint8).reshape(len(values), -1).T.tobytes()


def unplanes(data: bytes, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(kind).reshape(-1)


def column(rows: pa.Table, name: str, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(rows.column(name).to_pylist()), kind)


def plane_column(rows: pa.Table, name: str, kind: str) -> np.ndarray:
    return np.concatenate([np.empty(0, kind), *[unplanes(x, kind) for x in rows.column(name).to_pylist()]])


#: Columns of the segments of a row: document, segment number, and how many entries it has.
SEGMENTS = "ranks binary, uids binary, bases binary, sizes binary, offsets binary"


def segments(rank: np.ndarray, uid: np.ndarray, doc: np.ndarray, at: np.ndarray) -> tuple[bytes, ...]:
    """SEGMENTS of entries sorted by document and position."""
    segment = at // SEGMENT
    first = np.flatnonzero(np.concatenate(([True], (doc[1:] != doc[:-1]) | (segment[1:] != segment[:-1]))))
    sizes = np.diff(np.concatenate((first, [len(doc)])))
    own = doc[first]
    return (planes(rank[own]), uid[own].astype("<u4").tobytes(), planes(segment[first].astype("<i4")), planes(sizes.astype("<i4")),
            planes((at - segment * SEGMENT).astype("<u2")))


class Segments:
    """SEGMENTS of some rows, opened: a document for each segment, a segment and an offset for each entry."""

    def __init__(self, rows: pa.Table):
        sizes = plane_column(rows, "sizes", "<i4")
        self.segment = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        self.rank, self.uid = plane_column(rows, "ranks", "<i8"), column(rows, "uids", "<u4")
        self.base, self.offset = plane_column(rows, "bases", "<i4"), plane_column(rows, "offsets", "<u2")

    def __len__(self) -> int:
        return len(self.segment)

    def places(self) -> np.ndarray:
        """A number for each segment, in corpus order; segments of equal documents have equal numbers."""
        order = np.lexsort((self.base, self.uid, self.rank))
        same = np.zeros(len(order), bool)
        same[1:] = ((self.rank[order[1:]] == self.rank[order[:-1]]) & (self.uid[order[1:]] == self.uid[order[:-1]])
                    & (self.base[order[1:]] == self.base[order[:-1]]))
        out = np.empty(len(order), np.int64)
        out[order] = np.cumsum(~same)
        return out


#: Answers of one task for the documents of one reply: runs [start, start + count) of positions.
REPLY = "reply int, kind int, ranks binary, uids binary, sizes binary, starts binary, counts binary"


def replies(found: list[tuple], parts: int) -> pa.Table:
    """REPLY rows from (kind, rank, uid, start, count) arrays: at most one row for each kind and reply."""
    cols = [[] for _ in range(7)]
    for kind, rank, uid, start, count in found:
        if not len(rank):
            continue
        to = (mix64(rank.astype(np.uint64) ^ (uid.astype(np.uint64) << np.uint64(32))) % np.uint64(parts)).astype(np.int32)
        order = np.lexsort((start, uid, rank, to))
        rank, uid, start, count, to = rank[order], uid[order], start[order], count[order], to[order]
        for own in np.split(np.arange(len(to)), np.flatnonzero(np.diff(to)) + 1):
            r, u, s, n = rank[own], uid[own], start[own], count[own]
            first = np.flatnonzero(np.concatenate(([True], (r[1:] != r[:-1]) | (u[1:] != u[:-1]))))
            sizes = np.diff(np.concatenate((first, [len(own)])))
            row = (int(to[own[0]]), kind, planes(r[first]), u[first].astype("<u4").tobytes(), planes(sizes.astype("<i4")),
                   planes(s.astype("<i4")), planes(n.astype("<u2")))
            for c, value in zip(cols, row):
                c.append(value)
    kinds = [pa.int32()] * 2 + [pa.binary()] * 5
    return pa.table({name.split()[0]: pa.array(c, k) for name, c, k in zip(REPLY.split(", "), cols, kinds)})


RUNS = "rank long, uid long, kind int, starts binary, counts binary"


def gathered(answers: DataFrame) -> DataFrame:
    """RUNS: for each document and kind one row with its merged runs (starts and counts as int32)."""
    def gather(rows: pa.Table) -> pa.Table:
        cols = [[] for _ in range(5)]
        kinds = np.asarray(rows.column("kind"))
        for kind in np.unique(kinds):
            own = rows.filter(pa.array(kinds == kind))
            sizes = plane_column(own, "sizes", "<i4")
            rank, uid = np.repeat(plane_column(own, "ranks", "<i8"), sizes), np.repeat(column(own, "uids", "<u4"), sizes)
            start, count = plane_column(own, "starts", "<i4").astype(np.int64), plane_column(own, "counts", "<u2").astype(np.int64)
            order = np.lexsort((start, uid, rank))
            rank, uid, start, end = rank[order], uid[order], start[order], (start + count)[order]
            new = np.concatenate(([True], (rank[1:] != rank[:-1]) | (uid[1:] != uid[:-1])))
            # Runs of one document that touch or overlap are one: all ends are set off by document first.
            shift = np.cumsum(new) * np.int64(1 << 40)
            reach = np.maximum.accumulate(end + shift)
            head = np.flatnonzero(np.concatenate(([True], (start + shift)[1:] > reach[:-1])))
            last = np.concatenate((head[1:], [len(start)])) - 1
            start, end = start[head], (reach - shift)[last]
            rank, uid = rank[head], uid[head]
            first = np.flatnonzero(np.concatenate(([True], (rank[1:] != rank[:-1]) | (uid[1:] != uid[:-1]))))
            for a, b in zip(first, np.concatenate((first[1:], [len(rank)]))):
                for c, value in zip(cols, (int(rank[a]), int(uid[a]), int(kind), start[a:b].astype("<i4").tobytes(),
                                           (end - start)[a:b].astype("<i4").tobytes())):
                    c.append(value)
        types = [pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary()]
        return pa.table({name.split()[0]: pa.array(c, k) for name, c, k in zip(RUNS.split(", "), cols, types)})

    return answers.groupBy("reply").applyInArrow(gather, RUNS)


def opened(starts: bytes | None, counts: bytes | None) -> tuple[np.ndarray, np.ndarray]:
    return (np.frombuffer(starts or b"", "<i4").astype(np.int64), np.frombuffer(counts or b"", "<i4").astype(np.int64))


def positions(starts: bytes | None, counts: bytes | None) -> np.ndarray:
    return ranges(*opened(starts, counts))
