"""Operator 6, substring deduplication by Rabin-Karp hashes of every fixed-length token window.

Every window of WINDOW words of every text is hashed (a rolling polynomial over the word hashes,
two independent ones). The hashes are counted in Spark, and a window whose words also start in a
document with a smaller id is repeated. Repeated windows merge into maximal intervals, which are
removed from the text.

How the count is spread: a task hashes its texts chunk by chunk, keeps of each window the
occurrence in the chunk's smallest document (the others are known to be repeats at once, so a
passage that all documents share leaves a chunk as one entry), and sends the rest by hash range
as packed arrays: 8 bytes of hash and 2 of position for a window. The second hash picks the
range, so a window is told apart by 64 bits and those of the range number. A range's task finds
the smallest document of each hash and answers with the positions that are repeats: one packed
row for each range of documents. Answers are gathered by document and joined with the texts. Nothing is capped. The number of ranges grows with
the input, so that a range's task holds the windows of about ``range_bytes`` of text; with larger
executors both ``range_bytes`` and ``chunk_bytes`` should grow, which keeps the packed rows long.

Defined results: null and wordless texts have no words. Rows that share an id are one document
for the comparison (none of them is smaller), each keeps its own result. A row with a null id
counts as larger than all others.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Rolling, Words, chunks, mix64, ranges, read, release
from .packed import REPLY, SEGMENT, SEGMENTS, Segments, column, gathered, named, opened, replies, segments

WINDOW = 13
#: Bytes of text hashed at once, and behind each hash range.
CHUNK_BYTES, RANGE_BYTES = 2 << 20, 24 << 20
_SECOND = 0xD6E8FEB86659FD93


def window_hashes(words: Words, k: int) -> tuple[np.ndarray, ...]:
    """For all windows of ``k`` words inside the texts: text number, position in it, two hashes."""
    each = np.maximum(words.counts - (k - 1), 0)
    doc = np.repeat(np.arange(len(each)), each)
    start = ranges(words.offsets[:-1], each)
    first = Rolling(words.hashes).hashes(start, start + k)
    second = Rolling(words.hashes, _SECOND).hashes(start, start + k)
    return doc, start - words.offsets[:-1][doc], first, second


_ROW = f"part int, {SEGMENTS}, hashes binary"


def _sent(docs: DataFrame, k: int, parts: int, chunk_bytes: int) -> DataFrame:
    """Rows of the windows of one chunk for one hash range. Rows without hashes hold the repeats that
    are known in the chunk."""
    names = [c.split()[0] for c in _ROW.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in chunks(batches, 2, chunk_bytes):
            rank, uid = (np.array(batch.column(c).to_pylist(), np.int64) for c in (0, 1))
            doc, at, first, second = window_hashes(Words(texts, lower=False), k)
            if len(doc) == 0:
                continue
            part = (second % np.uint64(parts)).astype(np.int32)
            del second
            order = np.lexsort((rank[doc], first, part))
            doc, at, first, part = doc[order], at[order], first[order], part[order]
            new = np.ones(len(doc), bool)
            new[1:] = (first[1:] != first[:-1]) | (part[1:] != part[:-1])
            head = np.flatnonzero(new)[np.cumsum(new) - 1]
            same_document = rank[doc] == rank[doc[head]]
            # Of a window's occurrences in its smallest document all are sent: each may be a repeat.
            rows = []
            known = np.flatnonzero(~same_document)
            if len(known):
                own = known[np.lexsort((at[known], doc[known]))]
                # They only pass through a range, any: by a document, as chunks may all begin with the same passage.
                to = int(mix64(uid[doc[own[:1]]].astype(np.uint64))[0] % np.uint64(parts))
                rows.append((to, *segments(rank, uid, doc[own], at[own]), b""))
            left = np.flatnonzero(same_document)
            left = left[np.lexsort((at[left], doc[left], part[left]))]
            for own in np.split(left, np.flatnonzero(np.diff(part[left])) + 1):
                rows.append((int(part[own[0]]), *segments(rank, uid, doc[own], at[own]), first[own].tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary() if i else pa.int32()) for i, c in enumerate(zip(*rows))], names)

    return docs.mapInArrow(run, _ROW)


def _repeats(sent: DataFrame, parts: int) -> DataFrame:
    """The windows that are repeats; the rows of one range meet in one task."""
    def found(rows: pa.Table) -> pa.Table:
        given = pc.greater(pc.binary_length(rows.column("hashes")), 0)
        known, rows = rows.filter(pc.invert(given)), rows.filter(given)
        x, hashes = Segments(rows), column(rows, "hashes", "<u8")
        del rows
        order = np.argsort(hashes)
        h = hashes[order]
        first = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1]))) if len(h) else np.empty(0, np.int64)
        del hashes, h
        number = np.unique(x.rank, return_inverse=True)[1].astype(np.int32)  # of each segment's document, in order
        own = number[x.segment[order]]
        least = np.repeat(np.minimum.reduceat(own, first), np.diff(np.concatenate((first, [len(own)])))) if len(own) else own
        hit = np.zeros(len(own), bool)
        hit[order[own > least]] = True
        del order, own, least
        release()
        return replies([_entries(x, hit)] + ([_entries(Segments(known), None)] if known.num_rows else []), parts)

    return sent.groupBy("part").applyInArrow(found, REPLY)


def _entries(x: Segments, chosen: np.ndarray | None) -> tuple:
    segment, offset = (x.segment, x.offset) if chosen is None else (x.segment[chosen], x.offset[chosen])
    start = x.base[segment].astype(np.int64) * SEGMENT + offset
    return 0, x.rank[segment], x.uid[segment], start, np.ones(len(start), np.int64)


def _removed(docs: DataFrame, k: int, with_text: bool) -> DataFrame:
    """Rows (doc, text, starts, counts: the document's runs of repeats) to the results."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in chunks(batches, 1, CHUNK_BYTES):
            words = Words(texts, lower=False)
            drop = np.zeros(len(words.starts) + k + 1, np.int32)
            for i, (starts, counts) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())):
                start, count = opened(starts, counts)
                np.add.at(drop, start + words.offsets[i], 1)
                np.add.at(drop, start + count + (k - 1) + words.offsets[i], -1)
            gone = np.cumsum(drop[:len(words.starts)]) > 0
            kept, n_removed, spans = [], [], []
            data = words.data.tobytes()
            starts, ends = words.starts.tolist(), words.ends.tolist()
            for i in range(len(texts)):
                a, b = int(words.offsets[i]), int(words.offsets[i + 1])
                own = gone[a:b]
                n_removed.append(int(own.sum()))
                kept.append(b" ".join([data[starts[j]:ends[j]] for j in (np.flatnonzero(~own) + a).tolist()]))
                if with_text:
                    edge = np.flatnonzero(np.diff(np.concatenate(([False], own, [False])).view(np.int8)))
                    spans.append([{"start": int(x), "end": int(y)} for x, y in zip(edge[0::2], edge[1::2])])
            cols = [batch.column(0), pa.array(words.counts, pa.int64()), pa.array(n_removed, pa.int64()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string())]
            names = ["doc", "n_words", "n_removed", "kept_sha256"]
            if with_text:
                cols += [pa.array([x.decode() for x in kept], pa.string()),
                         pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))]
                names += ["kept_text", "spans"]
            yield pa.RecordBatch.from_arrays(cols, names)

    kind = docs.schema["doc"].dataType.simpleString()
    schema = f"doc {kind}, n_words bigint, n_removed bigint, kept_sha256 string"
    if with_text:
        schema += ", kept_text string, spans array<struct<start: bigint, end: bigint>>"
    return docs.mapInArrow(run, schema)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                   with_text: bool = False, chunk_bytes: int = CHUNK_BYTES, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """n_words, n_removed and kept_sha256 of every row; with ``with_text`` also the kept words and the
    removed intervals of word positions. Ids are integers. Rows equal in id and text get equal answers."""
    rows = named(docs, id_col, text_col, F.col(id_col).alias("doc"))
    size = rows.agg(F.sum(F.octet_length("text"))).collect()[0][0] or 0
    parts = max(1, -(-int(size) // range_bytes))
    runs = gathered(_repeats(_sent(rows.select("rank", "uid", "text"), window, parts, chunk_bytes), parts)).drop("kind")
    marked = rows.join(runs, ["rank", "uid"], "left").select("doc", "text", "starts", "counts")
    return _removed(marked, window, with_text).withColumnRenamed("doc", id_col)


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(read(spark, sf_dir, "documents"))


ORACLE = r"""WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT doc_id, i, hash(array_to_string(w[i:i + 12], ' ')) AS h, array_to_string(w[i:i + 12], ' ') AS s
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13)),
first AS (SELECT s, min(doc_id) AS owner FROM g GROUP BY s),
rep AS (SELECT doc_id, i FROM g JOIN first USING (s) WHERE owner < doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p FROM rep),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS s
         FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(len(d.w) - coalesce(kept.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.s, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)"""
