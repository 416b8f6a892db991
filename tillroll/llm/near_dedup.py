"""Operator 7, near duplicates by fast similarity sketching, banding and exact verification.

Sketch: COORDINATES bins. In round i every element of a document's set is thrown into one bin by
the round's hash with a random value; a bin keeps the smallest value of the first round that
reached it. Rounds COORDINATES + i put every element into bin i, so each coordinate is filled
after at most twice as many rounds, and a large set is done after one or two. Two sets agree on a
coordinate with probability J (their Jaccard similarity), with the concentration of
independent samples.

Banding: BANDS bands of ROWS coordinates; sets that agree on a band share a bucket. At J = 0.8 a
pair misses all 32 buckets with probability (1 - 0.8 ** 4) ** 32 = 5e-8.

Texts with the same set form one class first, so copies cost one row. Within a bucket not all
pairs are made: each member is compared with the bucket's first document. A pair is dropped by
size (n_small / n_large < threshold), or if its sketches agree so rarely that J >= 0.8 would be 5
standard deviations off; what is left is verified on the full sets, and pairs that pass are
linked. A bucket whose members are then connected is done.

The members of the other buckets are finished by an exact join, whose work follows what they
share rarely: every set is ordered by how frequent its elements are, and a pair can only reach
the threshold if the first common element stands early enough in both sets (prefix and position
filter). An element's rows are only joined with those outside the component that holds most of
them, so what is connected already makes no pairs. The frequencies are kept in a table of fixed
size (COUNTERS, by hash); they choose the order, never the result. So no link between two
components is lost, and no bucket or partner list is cut off.

Defined results: a text without words has an empty set and is linked with nothing. A row with a
null id is linked with nothing, has a null component and is kept. Repeated rows share a class.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Words, chunks, mix64, ranges, read, release, stored
from .components import components

COORDINATES, BANDS = 128, 32
ROWS = COORDINATES // BANDS
SHINGLE, THRESHOLD = 5, (80, 100)
AGREE = 0.6
#: Size of the table of element frequencies, and the sets ordered at once.
COUNTERS, SETS = 1 << 20, 500
CHUNK = 1 << 20

_ROUND_KEYS = np.random.Generator(np.random.PCG64(7)).integers(0, 2 ** 63, 2 * COORDINATES, dtype=np.uint64)


def shingle_sets(texts: list[bytes], k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of the k-word shingles of each text, sorted within a text, and their counts.
    A text of fewer words has its whole word sequence as one shingle; without words none."""
    words = Words(texts, lower=True)
    n = words.counts
    each = np.where(n >= k, n - (k - 1), np.minimum(n, 1))
    doc = np.repeat(np.arange(len(texts)), each)
    start = ranges(words.offsets[:-1], each)
    size = np.minimum(n, k)[doc]
    h = np.full(len(start), 0x51ED27, np.uint64)
    for j in range(k):
        inside = j < size
        h[inside] = mix64(h[inside] * np.uint64(31) + words.hashes[start[inside] + j])
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    return h[new], np.bincount(doc[new], minlength=len(texts))


def sketches(h: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """COORDINATES values for each set (rows); empty sets keep the largest value everywhere."""
    t, top = COORDINATES, np.uint64(2 ** 64 - 1)
    out = np.full((len(counts), t), top, np.uint64)
    flat = out.reshape(-1)
    doc = np.repeat(np.arange(len(counts)), counts)
    for i in range(2 * t):
        if len(h) == 0:
            break
        x = mix64(h ^ _ROUND_KEYS[i])
        bins = (x & np.uint64(t - 1)).astype(np.int64) if i < t else i - t
        value = (np.uint64(i) << np.uint64(56)) | (x >> np.uint64(8))
        np.minimum.at(flat, doc * t + bins, value)
        open_ = (out == top).any(axis=1)
        if not open_[doc].all():
            left = open_[doc]
            h, doc = h[left], doc[left]
    return out


def band_keys(sketch: np.ndarray) -> np.ndarray:
    key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), (len(sketch), BANDS)) + np.uint64(1)
    parts = sketch.reshape(len(sketch), BANDS, ROWS)
    for j in range(ROWS):
        key = mix64(key * np.uint64(31) + parts[:, :, j])
    return key


def _class_ids(h: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """128 bits of each set: sums of two independent hashes of its elements, and its size."""
    ends = np.cumsum(counts)
    out = np.empty((len(counts), 2), np.uint64)
    for j, salt in enumerate((0x1D872B41, 0x7A646E19)):
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix64(h ^ np.uint64(salt)))))
        out[:, j] = mix64(sums[ends] - sums[ends - counts] + counts.astype(np.uint64))
    return out


def _binary(rows: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in np.ascontiguousarray(rows)], pa.binary())


def sketched(docs: DataFrame, id_col: str, text_col: str, k: int) -> DataFrame:
    """doc, h (text hash), c (class of the set), n (its size), bands and low (a byte of each coordinate)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in chunks(batches, 2, CHUNK):
            h, counts = shingle_sets(texts, k)
            sketch = sketches(h, counts)
            keys = band_keys(sketch).astype(np.int64)
            low = (mix64(sketch) & np.uint64(255)).astype(np.uint8)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), _binary(_class_ids(h, counts)), pa.array(counts, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(np.arange(len(texts) + 1) * BANDS, pa.int32()), pa.array(keys.reshape(-1))),
                 _binary(low)], ["doc", "h", "c", "n", "bands", "low"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, _text_hash(text_col), text_col).mapInArrow(
        run, f"doc {kind}, h long, c binary, n bigint, bands array<bigint>, low binary")


def _text_hash(text_col: str) -> Column:
    return F.coalesce(F.xxhash64(text_col), F.lit(0)).alias("h")


def _packed_sets(docs: DataFrame, k: int) -> DataFrame:
    """c and its set as 6 bytes of each element's hash, sorted."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in chunks(batches, 1, CHUNK):
            h, counts = shingle_sets(texts, k)
            ends = np.cumsum(counts)
            blobs = [np.sort(h[b - n:b] >> np.uint64(16)).view(np.uint8).reshape(-1, 8)[:, :6].tobytes() for b, n in zip(ends, counts)]
            yield pa.RecordBatch.from_arrays([_binary(_class_ids(h, counts)), pa.array(blobs, pa.binary())], ["c", "blob"])

    return docs.select("doc", "text").mapInArrow(run, "c binary, blob binary")


def _values(blob: bytes) -> np.ndarray:
    out = np.zeros((len(blob) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(blob, np.uint8).reshape(-1, 6)
    return out.view(np.uint64).reshape(-1)


def _agreeing(pairs: DataFrame) -> DataFrame:
    """Pairs (a, b, la, lb) whose sketches agree on at least AGREE of the coordinates."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            la, lb = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(-1, COORDINATES) for i in (2, 3))
            keep = (la == lb).mean(axis=1) >= AGREE
            yield batch.select([0, 1]).filter(pa.array(keep))

    return pairs.mapInArrow(run, "a binary, b binary")


def _verified(pairs: DataFrame, threshold: tuple[int, int]) -> DataFrame:
    part, whole = threshold

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, last, x = [], None, None
            for a, b in zip(batch.column(2), batch.column(3)):
                a, b = a.as_py(), b.as_py()
                if a != last:
                    last, x = a, _values(a)
                y = _values(b)
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(whole * common >= part * (len(x) + len(y) - common))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))
            release()

    return pairs.mapInArrow(run, "u binary, v binary")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    threshold: tuple[int, int] = THRESHOLD) -> DataFrame:
    """n_shingles, component_id, kept and text_hash of every row of ``docs``."""
    rows = stored(sketched(docs, id_col, text_col, shingle), "near-rows")
    classes = stored(rows.where("n > 0 AND doc IS NOT NULL").groupBy("c").agg(
        F.min("doc").alias("rep"), F.first("n").alias("n"), F.first("bands").alias("bands"), F.first("low").alias("low")), "near-classes")
    spread = classes.select("c", "n", "rep", F.explode("bands").alias("key"))
    shared = spread.groupBy("key").agg(F.count(F.lit(1)).alias("m"), F.min(F.struct("rep", "c", "n")).alias("first")).where("m > 1")
    members = stored(spread.join(shared.select("key", F.col("first.c").alias("p"), F.col("first.n").alias("pn")), "key")
                     .where("c <> p").select("key", "c", "n", "p", "pn"), "near-members")
    pairs = members.where(_alike("n", "pn", threshold)).select(F.least("c", "p").alias("a"), F.greatest("c", "p").alias("b")).distinct()
    sets = _sets(docs, id_col, text_col, classes, members, shingle)
    roots = components(_links(pairs, classes, sets, threshold))
    rest = _unconnected(members, roots)
    if not rest.isEmpty():
        roots = _joined(roots, _links(_prefix_pairs(rest, sets, threshold), classes, sets, threshold))
    both = classes.select("c", "rep").join(roots, F.col("c") == F.col("node"), "left").select(
        "c", "rep", F.coalesce("root", "c").alias("root"))
    least = both.groupBy("root").agg(F.min("rep").alias("component_id"))
    group = both.join(least, "root").select(F.col("c").alias("c2"), "component_id")
    out = rows.select("doc", "h", "c", "n").join(group, (F.col("c") == F.col("c2")) & F.col("doc").isNotNull() & (F.col("n") > 0), "left")
    component = F.coalesce("component_id", "doc")
    return out.select(F.col("doc").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.coalesce(F.col("doc") == component, F.lit(True)).alias("kept"), F.col("h").alias("text_hash"))


def kept_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row of each group, unchanged: that with the smallest id, null ids last (then by the text's hash), and
    one of rows equal in id and text. Here rows without an id are linked like others. Rows without words are
    in no group: all of them stay."""
    def key(df: DataFrame) -> Column:
        return F.struct(F.col(id_col).isNull().alias("missing"), F.col(id_col).alias("id"), _text_hash(text_col))

    found = stored(near_duplicates(docs.select(key(docs).alias("key"), text_col), "key", text_col, **options)
                   .where("kept").groupBy("key").agg(F.count(F.lit(1)).alias("times"), F.max("n_shingles").alias("n")), "near-kept")

    def rows(which: str) -> DataFrame:
        kept = found.where(which).select(F.col("key").alias("__near_key"))
        return docs.withColumn("__near_own", key(docs)).join(kept, F.col("__near_own") == F.col("__near_key"), "left_semi")

    # Rows equal in id and text are few: only they are brought together, and only one of each task leaves it.
    once = rows("times = 1 OR n = 0")
    repeated = rows("times > 1 AND n > 0").dropDuplicates(["__near_own"])
    return once.unionByName(repeated).drop("__near_own")


def _alike(n: str, m: str, threshold: tuple[int, int]) -> Column:
    part, whole = threshold
    return (F.col(n) * whole >= F.col(m) * part) & (F.col(m) * whole >= F.col(n) * part)


def _sets(docs: DataFrame, id_col: str, text_col: str, classes: DataFrame, members: DataFrame, k: int) -> DataFrame:
    """(c, blob) of all classes that share a bucket; one text of each class is read again."""
    wanted = stored(members.select("c").unionByName(members.select(F.col("p").alias("c"))).distinct(), "near-wanted")
    reps = classes.join(wanted, "c", "left_semi").select(F.col("rep").alias("doc")).distinct()
    texts = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text")).join(reps, "doc", "left_semi")
    return stored(_packed_sets(texts, k).join(wanted, "c", "left_semi").dropDuplicates(["c"]), "near-sets")


def _links(pairs: DataFrame, classes: DataFrame, sets: DataFrame, threshold: tuple[int, int]) -> DataFrame:
    """The pairs (u, v) of (a, b) whose full sets reach the threshold."""
    low = classes.select("c", "low")
    close = stored(_agreeing(pairs.join(low.withColumnsRenamed({"c": "a", "low": "la"}), "a")
                             .join(low.withColumnsRenamed({"c": "b", "low": "lb"}), "b").select("a", "b", "la", "lb")), "near-close")
    filled = (close.join(sets.withColumnsRenamed({"c": "b", "blob": "y"}), "b")
              .join(sets.withColumnsRenamed({"c": "a", "blob": "x"}), "a").select("a", "b", "x", "y"))
    return stored(_verified(filled, threshold), "near-links")


def _unconnected(members: DataFrame, roots: DataFrame) -> DataFrame:
    """(c, label) of the members of buckets that hold more than one component besides the bucket's
    first document, which has been compared with all of them."""
    named = members.select("key", "c").join(roots.withColumnRenamed("node", "c"), "c", "left").select(
        "key", "c", F.coalesce("root", "c").alias("label"))
    split = named.groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x <> y").select("key")
    return stored(named.join(split, "key", "left_semi").select("c", "label").distinct(), "near-rest")


def _joined(roots: DataFrame, edges: DataFrame) -> DataFrame:
    """Roots after ``edges`` (u, v) are added: only the roots at their ends are joined anew."""
    if edges.isEmpty():
        return roots

    def root_of(c: str) -> DataFrame:
        return roots.select(F.col("node").alias(c), F.col("root").alias(f"r{c}"))

    ends = (edges.join(root_of("u"), "u", "left").join(root_of("v"), "v", "left")
            .select(F.coalesce("ru", "u").alias("u"), F.coalesce("rv", "v").alias("v")))
    above = components(ends)
    moved = roots.join(above.select(F.col("node").alias("root"), F.col("root").alias("top")), "root", "left").select(
        "node", F.coalesce("top", "root").alias("root"))
    return stored(moved.unionByName(above), "near-roots")


def _prefix_pairs(rest: DataFrame, sets: DataFrame, threshold: tuple[int, int]) -> DataFrame:
    """Pairs (a, b) of different labels that pass the prefix and position filter."""
    part, whole = threshold
    spark = rest.sparkSession
    size = rest.groupBy("label").agg(F.count(F.lit(1)).alias("size"))
    own = stored(sets.join(rest.join(size, "label"), "c").select("c", "label", "size", "blob"), "near-rest-sets")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, SETS):
                h = _values(b"".join(batch.column(0).slice(at, SETS).to_pylist()))
                total += np.bincount((h % np.uint64(COUNTERS)).astype(np.int64), minlength=COUNTERS)
        for i, at in enumerate(range(0, COUNTERS, 1 << 16)):
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([total[at:at + (1 << 16)].tobytes()], pa.binary())],
                                             ["block", "n"])

    def add(table: pa.Table) -> pa.Table:
        total = np.sum([np.frombuffer(x, np.int64) for x in table.column("n").to_pylist()], axis=0)
        return pa.table({"block": table.column("block").slice(0, 1), "n": pa.array([total.tobytes()], pa.binary())})

    blocks = own.select("blob").coalesce(8).mapInArrow(count, "block int, n binary").groupBy("block").applyInArrow(add, "block int, n binary")
    frequent = np.frombuffer(b"".join(bytes(r["n"]) for r in sorted(blocks.collect(), key=lambda r: r["block"])), np.int64)  # COUNTERS
    sent = spark.sparkContext.broadcast(frequent)

    def prefix(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = sent.value
        for batch in batches:
            for first in range(0, batch.num_rows, SETS):
                some = batch.slice(first, SETS)
                sizes, kept = [], []
                for blob in some.column(3):
                    h = _values(blob.as_py())
                    n = len(h)
                    order = np.lexsort((h, frequent[(h % np.uint64(COUNTERS)).astype(np.int64)]))
                    kept.append(h[order[:n - -(-part * n // whole) + 1]])
                    sizes.append(n)
                keep = np.array([len(k) for k in kept], np.int64)
                row = pa.array(np.repeat(np.arange(len(kept)), keep))
                yield pa.RecordBatch.from_arrays(
                    [*(some.column(i).take(row) for i in range(3)), pa.array(np.repeat(np.array(sizes, np.int64), keep)),
                     pa.array(np.concatenate(kept).astype(np.int64)), pa.array(ranges(np.zeros(len(keep), np.int64), keep))],
                    ["c", "label", "size", "n", "h", "at"])
            release()

    rows = stored(own.mapInArrow(prefix, "c binary, label binary, size long, n long, h long, at long"), "near-prefix")
    main = (rows.groupBy("h").agg(F.min("label").alias("x"), F.max("label").alias("y"), F.max(F.struct("size", "label")).alias("main"))
            .where("x <> y").select("h", F.col("main.label").alias("main")))
    mixed = rows.join(main, "h")
    probe = mixed.where("label <> main").select("h", F.col("c").alias("c2"), F.col("label").alias("label2"), F.col("n").alias("n2"),
                                                F.col("at").alias("at2"))
    left = F.least(F.col("n") - F.col("at"), F.col("n2") - F.col("at2"))
    early = left * (part + whole) >= (F.col("n") + F.col("n2")) * part
    # Of two probes a pair is made once.
    once = (F.col("label") == F.col("main")) | (F.col("c") < F.col("c2"))
    return (mixed.join(probe, (mixed["h"] == probe["h"]) & (F.col("label") != F.col("label2")) & early & once & _alike("n", "n2", threshold))
            .select(F.least("c", "c2").alias("a"), F.greatest("c", "c2").alias("b")).distinct())


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"), shingle=2).drop("text_hash")
