"""Operator 9, removal of long repeated byte strings by prefix-free parsing.

Every byte covered by a LENGTH-byte string that also starts earlier in corpus order (smaller id,
or earlier in the same text) is removed.

Parsing: rolling-hash triggers cut the texts. A position is a trigger if its GRAM-byte hash is the
first smallest of some ``LENGTH - KEY + 1`` neighbours, so that every LENGTH-byte string holds a
trigger followed by KEY bytes of it, and equal strings hold it in the same place. The strings
whose trigger is the same form a phrase: the bytes from the first string's start to the last
one's end, about 27 starts and 130 bytes. Phrases depend on their own bytes only, and neither is
a prefix of another without being cut there as well.

Dictionary and parse: equal phrases are one entry of the dictionary; the parse is the order of
their occurrences. All strings of a phrase that occurred before are repeats at once. Entries that
share their trigger's KEY bytes but differ around them may share some strings: the suffixes of
those entries are sorted by their first LENGTH bytes, ties in corpus order, and all but the first
of equal ones are repeats. As only the equality of prefixes matters, the sort orders 128-bit hashes.

How it is spread: phrases are exchanged by ranges of their key's hash as packed arrays (about 19
bytes a phrase, under 1 byte for a byte of text). What a chunk can tell by itself is not sent:
of equal phrases one entry, and of differing phrases with one key one entry, marked as such. So a
passage, line or text that a third of all documents share sends one entry a chunk. The strings of
the entries to be compared are exchanged the same way. Nothing is capped.

Defined results: null text is empty. Rows equal in id and text count as one document and get the
same result; rows that share an id but differ are ordered by their text's hash; null ids come last.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Rolling, chunks, mix64, ranges, read, release, stored
from .packed import REPLY, SEGMENT, SEGMENTS, Segments, column, gathered, named, opened, positions, replies, segments

LENGTH, KEY, GRAM = 100, 48, 8
#: Bytes of text parsed at once, and behind each hash range.
CHUNK_BYTES, RANGE_BYTES = 3 << 19, 32 << 20
_SECOND = 0xD6E8FEB86659FD93


def first_least(values: np.ndarray, width: int) -> np.ndarray:
    """For each run of ``width`` neighbours the position of its first smallest value."""
    at = np.arange(len(values), dtype=np.int32)
    low, have = values, 1
    while have < width:
        by = min(have, width - have)
        right = low[by:] < low[:-by]
        low = np.where(right, low[by:], low[:-by])
        at = np.where(right, at[by:], at[:-by])
        have += by
    return at


class Text:
    """Texts of a chunk as one byte array, with their phrases and string hashes."""

    def __init__(self, texts: list[bytes]):
        self.data = np.frombuffer(b"".join(texts), np.uint8)
        self.sizes = np.array([len(t) for t in texts], np.int64)
        self.offsets = np.cumsum(self.sizes) - self.sizes
        self.first, self.second = Rolling(self.data), Rolling(self.data, _SECOND)

    def strings(self, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self.first.hashes(start, start + LENGTH), self.second.hashes(start, start + LENGTH)

    def phrases(self) -> tuple[np.ndarray, ...]:
        """(text number, first start in the text, number of starts, key, entry) of each phrase."""
        each = np.maximum(self.sizes - (LENGTH - 1), 0)
        start = ranges(self.offsets, each)
        doc = np.repeat(np.arange(len(each), dtype=np.int32), each)
        if len(start) == 0:
            none = np.empty(0, np.int64)
            return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
        n = len(self.data)
        gram = np.zeros(n - GRAM + 1, np.uint64)
        for j in range(GRAM):
            gram |= self.data[j:n - GRAM + 1 + j].astype(np.uint64) << np.uint64(8 * j)
        trigger = first_least(mix64(gram), LENGTH - KEY + 1)[start]
        new = np.ones(len(start), bool)
        new[1:] = (trigger[1:] != trigger[:-1]) | (doc[1:] != doc[:-1])
        head = np.flatnonzero(new)
        count = np.diff(np.concatenate((head, [len(start)])))
        lo, trigger, doc = start[head], trigger[head].astype(np.int64), doc[head].astype(np.int64)
        key = self.first.hashes(trigger, trigger + KEY)
        entry = self.second.hashes(lo, lo + count - 1 + LENGTH)
        entry = mix64(entry + ((trigger - lo) * 256 + count).astype(np.uint64))
        return doc, lo - self.offsets[doc], count, key, entry


# ------------------------------------------------------------------ the two exchanges

_ROW = f"part int, kind int, {SEGMENTS}, counts binary, a binary, b binary"
#: Kinds of rows: answers (repeated; to be compared), and what its range is to find out.
REPEATED, COMPARE, ASKED = 0, 1, -1


def _rows(rank, uid, groups: list[tuple]) -> pa.RecordBatch:
    """One row for each (part, kind, doc, at, count, a, b); entries sorted by document and position."""
    out = [(part, kind, *segments(rank, uid, doc, at), count.astype("u1").tobytes(), a.tobytes(), b.tobytes())
           for part, kind, doc, at, count, a, b in groups]
    kinds = [pa.int32()] * 2 + [pa.binary()] * 8
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], [c.split()[0] for c in _ROW.split(", ")])


def _groups(kind: int, parts: int, chosen: np.ndarray, uid, doc, at, count, a, b) -> list[tuple]:
    """What goes to each range, by the first hash. Answers only pass through a range, any: they go by one of
    their documents, as chunks may all begin with the same passage, without hashes."""
    if not len(chosen):
        return []
    part = (mix64(a[chosen]) % np.uint64(parts)).astype(np.int64)
    if kind != ASKED:
        part[:] = (mix64(uid[doc[chosen[:1]]].astype(np.uint64)) % np.uint64(parts)).astype(np.int64)
    order = np.lexsort((at[chosen], doc[chosen], part))
    part, chosen = part[order], chosen[order]
    none = np.empty(0, np.uint64)
    return [(int(part[own[0]]), kind, doc[chosen[own]], at[chosen[own]], count[chosen[own]],
             *((a[chosen[own]], b[chosen[own]]) if kind == ASKED else (none, none)))
            for own in np.split(np.arange(len(part)), np.flatnonzero(np.diff(part)) + 1)]


class _Opened(Segments):
    """The runs of some rows as arrays."""

    def __init__(self, rows: pa.Table):
        super().__init__(rows)
        self.counts = column(rows, "counts", "u1")

    def corpus_order(self) -> np.ndarray:
        return self.places()[self.segment] * SEGMENT + self.offset

    def answers(self, kind: int, chosen: np.ndarray) -> tuple:
        segment = self.segment[chosen]
        return (kind, self.rank[segment], self.uid[segment], self.base[segment].astype(np.int64) * SEGMENT + self.offset[chosen],
                self.counts[chosen].astype(np.int64))


def _split(rows: pa.Table) -> tuple[pa.Table, list[tuple]]:
    """Rows to be compared, and the answers that came with them."""
    kind, known = rows.column("kind"), []
    for k in (REPEATED, COMPARE):
        own = rows.filter(pc.equal(kind, k))
        if own.num_rows:
            opened_ = _Opened(own)
            known.append(opened_.answers(k, np.arange(len(opened_))))
    return rows.filter(pc.equal(kind, ASKED)), known


def _heads(order: np.ndarray, *keys: np.ndarray) -> np.ndarray:
    new = np.zeros(len(order), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[order[1:]] != k[order[:-1]]
    return new


def _numbers(rank: np.ndarray, uid: np.ndarray) -> np.ndarray:
    """Documents of a chunk in corpus order; equal rows have equal numbers."""
    order = np.lexsort((uid, rank))
    same = np.zeros(len(order), bool)
    same[1:] = (rank[order[1:]] == rank[order[:-1]]) & (uid[order[1:]] == uid[order[:-1]])
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(~same)
    return out


def _phrases(docs: DataFrame, parts: int, chunk_bytes: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in chunks(batches, 2, chunk_bytes):
            rank, uid = (np.array(batch.column(c).to_pylist(), np.int64) for c in (0, 1))
            doc, at, count, key, entry = Text(texts).phrases()
            if len(doc) == 0:
                continue
            number = _numbers(rank, uid)
            order = np.lexsort((at, number[doc], entry, key))
            first = _heads(order, key, entry)
            # Equal rows are one document: an occurrence at the same place of an equal row is no repeat.
            lead = order[np.flatnonzero(first)[np.cumsum(first) - 1]]
            twin = (number[doc[order]] == number[doc[lead]]) & (at[order] == at[lead])
            entries = order[first]  # by key
            head = _heads(entries, key)
            group = np.cumsum(head) - 1
            many = np.bincount(group)[group] > 1
            marked = count.copy()
            marked[entries[many]] = 0  # a key whose entries are compared anyway
            groups = (_groups(REPEATED, parts, order[~first & ~twin], uid, doc, at, count, key, entry)
                      + _groups(COMPARE, parts, entries[many], uid, doc, at, count, key, entry)
                      + _groups(ASKED, parts, entries[~many | head], uid, doc, at, marked, key, entry))
            yield _rows(rank, uid, groups)

    return docs.mapInArrow(run, _ROW)


def _parsed(phrases: DataFrame, parts: int) -> DataFrame:
    def found(rows: pa.Table) -> pa.Table:
        rows, out = _split(rows)
        x = _Opened(rows)
        key, entry = column(rows, "a", "<u8"), column(rows, "b", "<u8")
        del rows
        marked, place = x.counts == 0, x.corpus_order()  # marked ones only tell of their key
        order = np.lexsort((place, entry, key))
        plain = order[~marked[order]]
        first = _heads(plain, key, entry)
        lead = plain[np.flatnonzero(first)[np.cumsum(first) - 1]] if len(plain) else plain
        out.append(x.answers(REPEATED, plain[~first & (place[plain] != place[lead])]))
        entries = plain[first]
        group = np.cumsum(_heads(entries, key)) - 1
        many = np.bincount(group)[group] > 1 if len(entries) else np.empty(0, bool)
        many |= np.isin(key[entries], key[marked])
        out.append(x.answers(COMPARE, entries[many]))
        release()
        return replies(out, parts)

    return phrases.groupBy("part").applyInArrow(found, REPLY)


def _strings(docs: DataFrame, parts: int, chunk_bytes: int) -> DataFrame:
    """docs: rank, uid, text, starts, counts. The strings of the runs to compare, one smallest
    occurrence a chunk."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in chunks(batches, 2, chunk_bytes):
            rank, uid = (np.array(batch.column(c).to_pylist(), np.int64) for c in (0, 1))
            starts = [positions(s, n) for s, n in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist())]
            doc = np.repeat(np.arange(len(texts)), [len(s) for s in starts])
            at = np.concatenate(starts)
            text = Text(texts)
            a, b = text.strings(at + text.offsets[doc])
            number = _numbers(rank, uid)
            order = np.lexsort((at, number[doc], b, a))
            first = _heads(order, a, b)
            lead = order[np.flatnonzero(first)[np.cumsum(first) - 1]]
            twin = (number[doc[order]] == number[doc[lead]]) & (at[order] == at[lead])
            one = np.ones(len(at), np.int64)
            yield _rows(rank, uid, _groups(REPEATED, parts, order[~first & ~twin], uid, doc, at, one, a, b)
                        + _groups(ASKED, parts, order[first], uid, doc, at, one, a, b))

    return docs.mapInArrow(run, _ROW)


def _sorted(strings: DataFrame, parts: int) -> DataFrame:
    def found(rows: pa.Table) -> pa.Table:
        rows, out = _split(rows)
        x = _Opened(rows)
        a, b = column(rows, "a", "<u8"), column(rows, "b", "<u8")
        del rows
        place = x.corpus_order()
        order = np.lexsort((place, b, a))
        first = _heads(order, a, b)
        lead = order[np.flatnonzero(first)[np.cumsum(first) - 1]] if len(order) else order
        out.append(x.answers(REPEATED, order[~first & (place[order] != place[lead])]))
        release()
        return replies(out, parts)

    return strings.groupBy("part").applyInArrow(found, REPLY)


def _removed(docs: DataFrame, with_text: bool) -> DataFrame:
    """Rows (doc, text, starts, counts) to the results; ``doc`` is carried as it is."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in chunks(batches, 1, CHUNK_BYTES):
            out = []
            for text, starts, counts in zip(texts, batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                n, spans, kept = len(text), [], text
                if starts:
                    start, count = opened(starts, counts)
                    step = np.zeros(n + 1, np.int32)
                    np.add.at(step, start, 1)
                    np.add.at(step, start + count + (LENGTH - 1), -1)
                    gone = np.cumsum(step[:n]) > 0
                    edge = np.flatnonzero(np.diff(np.concatenate(([False], gone, [False])).view(np.int8)))
                    spans = list(zip(edge[0::2].tolist(), edge[1::2].tolist()))
                    kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
                row = [n, n - len(kept), len(spans), hashlib.sha256(kept).hexdigest()]
                if with_text:
                    row += [kept.decode("utf-8", "ignore"), [{"start": x, "end": y} for x, y in spans]]
                out.append(row)
            kinds = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))]
            names = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text", "spans"]
            cols = [pa.array(c, k) for c, k in zip(zip(*out), kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *cols], ["doc", *names[:len(cols)]])

    names = ["n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept_text", "spans"] * with_text
    kinds = ["bigint"] * 3 + ["string"] * 2 + ["array<struct<start: bigint, end: bigint>>"]
    own = T.StructType.fromDDL(", ".join(f"{n} {k}" for n, k in zip(names, kinds)))
    return docs.mapInArrow(run, T.StructType([docs.schema["doc"], *own.fields]))


def _results(docs: DataFrame, id_col: str, text_col: str, row: Column, with_text: bool, chunk_bytes: int, range_bytes: int) -> DataFrame:
    rows = named(docs, id_col, text_col, row.alias("doc"))
    size = rows.agg(F.sum(F.octet_length("text"))).collect()[0][0] or 0
    parts = max(1, -(-int(size) // range_bytes))
    given = rows.select("rank", "uid", "text")
    parsed = stored(_parsed(_phrases(given, parts, chunk_bytes), parts), "suffix-parsed")
    compare = gathered(parsed.where(F.col("kind") == COMPARE)).drop("kind")
    again = _sorted(_strings(given.join(compare, ["rank", "uid"]).select("rank", "uid", "text", "starts", "counts"), parts, chunk_bytes), parts)
    runs = gathered(parsed.where(F.col("kind") == REPEATED).unionByName(again)).drop("kind")
    return _removed(rows.join(runs, ["rank", "uid"], "left").select("doc", "text", "starts", "counts"), with_text)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False,
                   chunk_bytes: int = CHUNK_BYTES, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """n_bytes, n_removed, n_spans and kept_sha256 of every row; with ``with_text`` also the remaining
    text (bytes of characters cut in two are left out) and the removed byte intervals."""
    return _results(docs, id_col, text_col, F.col(id_col), with_text, chunk_bytes, range_bytes).withColumnRenamed("doc", id_col)


def cut_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chars_col: str | None = None) -> DataFrame:
    """The rows of ``docs`` with what is left of their texts (null stays null) and, in ``chars_col``, its
    number of characters; all other columns as they were."""
    others = F.struct(*[c for c in docs.columns if c != text_col], F.col(text_col).isNull().alias("__null_text"))
    out = _results(docs, id_col, text_col, others, True, CHUNK_BYTES, RANGE_BYTES)
    text = F.when(~F.col("doc.__null_text"), F.col("kept_text"))
    cols = {c: F.col(f"doc.`{c}`") for c in docs.columns if c != text_col} | {text_col: text}
    if chars_col:
        cols[chars_col] = F.char_length(text).cast(docs.schema[chars_col].dataType)
    return out.select(*[cols[c].alias(c) for c in docs.columns])


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(read(spark, sf_dir, "documents"))


ORACLE = """WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
g AS (SELECT doc_id, i, substr(x, 2 * i + 1, 200) AS s
      FROM (SELECT doc_id, x, unnest(range(0, length(x) // 2 - 99)) AS i FROM d WHERE length(x) >= 200)),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS k FROM g) WHERE k > 1),
ends AS (SELECT doc_id, i, max(i + 100) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
         FROM rep),
runs AS (SELECT doc_id, i, count_if(before IS NULL OR i > before) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM ends),
spans AS (SELECT doc_id, run, min(i) AS a, max(i) + 100 AS b FROM runs GROUP BY doc_id, run),
marked AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS last FROM spans),
pieces AS (SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans, max(b) AS tail,
                  string_agg(substr(x, 2 * last + 1, 2 * (a - last)), '' ORDER BY a) AS kept
           FROM marked JOIN d USING (doc_id) GROUP BY doc_id)
SELECT d.doc_id, CAST(length(x) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(CASE WHEN n_spans IS NULL THEN x ELSE kept || substr(x, 2 * tail + 1) END)) AS kept_sha256
FROM d LEFT JOIN pieces USING (doc_id)"""
