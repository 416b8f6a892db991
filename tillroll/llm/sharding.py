"""Operator 11, sharding by longest-processing-time scheduling.

Rows of equal texts are a group and stay together. Groups, largest first, go to the least loaded
shard, which a heap yields; so the shards' bytes are as near equal as whole groups allow (a group
larger than a shard's share fills a shard alone).

How it scales: the schedule depends on the groups' sizes only, so the driver gets a histogram, one
entry (group size, number of groups) for each distinct size. Distinct sizes add up to no more than the
corpus, so there are at most the square root of twice its bytes of them (0.25 million at 30 GB, 14
million at 100 TB), whatever the number of rows. All groups of one size are placed at once: few of
them by heap steps, many by first raising the shards to one level, which is where the heap steps
would lead. The answer, how many groups of each size each shard takes, goes back as a table. Groups
of one size are numbered in the order of their digests, in blocks of digests, so that a size shared
by a third of all groups is not one task; rows meet their group in a join whose skewed keys AQE
splits. Slots number the rows of a shard in input order, in blocks of the input's splits.

Defined results: a null text counts as empty (no bytes, checksum 0), in the group of the empty texts.
Rows with null ids and repeated rows each get a slot. Groups of equal size go to shards in the order
of their texts' SHA-256 digests; of equally loaded shards the smallest number is taken. Texts of any
length count whole. An empty table gives no rows. Other columns are not returned.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import read, stored

SHARDS, ROW_BYTES = 40, 16
#: Groups in a block of digests, and how many blocks two bytes of a digest can tell apart.
BLOCK_GROUPS, MOST_BLOCKS = 100_000, 1 << 16


def place(sizes: np.ndarray, counts: np.ndarray, shards: int) -> list[dict[int, int]]:
    """For each size (sizes fall), how many of its ``counts`` groups each shard takes. The loads are
    those of giving the groups one by one to the least loaded shard (ties: the smallest number)."""
    heap = [(0, j) for j in range(shards)]
    out = []
    for size, count in zip(sizes.tolist(), counts.tolist()):
        taken: dict[int, int] = {}
        if count > 4 * shards:
            # Every step that leads to a load below the level is taken; the level is the highest at which these suffice.
            low, high = heap[0][0], heap[0][0] + size * count
            while low < high:
                level = (low + high + 1) // 2
                if sum(max(0, -((load - level) // size)) for load, _ in heap) <= count:
                    low = level
                else:
                    high = level - 1
            steps = [(load, j, max(0, -((load - low) // size))) for load, j in heap]
            taken = {j: n for _, j, n in steps if n}
            heap = [(load + n * size, j) for load, j, n in steps]
            heapq.heapify(heap)
            count -= sum(taken.values())
        for _ in range(count):
            load, j = heap[0]
            heapq.heapreplace(heap, (load + size, j))
            taken[j] = taken.get(j, 0) + 1
        out.append(taken)
    return out


def _schedule(groups: DataFrame, shards: int) -> DataFrame:
    """(bytes, ends, to): of the groups of this size, in order, those before ends[i] and not before
    ends[i - 1] go to shard to[i]."""
    histogram = groups.groupBy("bytes").count().toArrow()  # at most sqrt(2 * bytes of the corpus) rows
    sizes, counts = (histogram.column(c).to_numpy() for c in ("bytes", "count"))
    order = np.argsort(-sizes)
    sizes, counts = sizes[order], counts[order]
    placed = place(sizes, counts, shards)
    ends = [np.cumsum([n for _, n in sorted(taken.items())]) for taken in placed]
    table = pa.table({"bytes": pa.array(sizes, pa.int64()), "ends": pa.array(ends, pa.list_(pa.int64())),
                      "to": pa.array([sorted(taken) for taken in placed], pa.list_(pa.int32()))})
    return stored(groups.sparkSession.createDataFrame(table), "shard-schedule")


def _grouped(groups: DataFrame, shards: int) -> DataFrame:
    """(digest, shard) of every group."""
    blocks = min(MOST_BLOCKS, 1 << (groups.count() // BLOCK_GROUPS).bit_length())
    head = F.conv(F.hex(F.substring("digest", 1, 2)), 16, 10).cast("int")
    groups = groups.select("digest", "bytes", F.floor(head * blocks / MOST_BLOCKS).cast("int").alias("block"))
    of_size = Window.partitionBy("bytes").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = groups.groupBy("bytes", "block").count().select("bytes", "block", F.coalesce(F.sum("count").over(of_size), F.lit(0)).alias("before"))
    blockwise = before.join(_schedule(groups, shards), "bytes")
    number = F.row_number().over(Window.partitionBy("bytes", "block").orderBy("digest")) - 1
    numbered = groups.withColumn("number", number).join(blockwise, ["bytes", "block"])
    passed = F.size(F.filter("ends", lambda end: end <= F.col("before") + F.col("number")))
    return numbered.select("digest", F.element_at("to", passed + 1).alias("shard"))


def assign(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS, row_bytes: int = ROW_BYTES) -> DataFrame:
    """Id, size, text_crc32, shard and slot of every row; a row's size is its text's bytes and ``row_bytes``."""
    text = F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8")
    rows = stored(docs.select(F.col(id_col).alias("doc"), (F.octet_length(text) + F.lit(row_bytes)).cast("long").alias("size"),
                              F.crc32(text).alias("text_crc32"), F.unhex(F.sha2(text, 256)).alias("digest"),
                              F.monotonically_increasing_id().alias("at")), "shard-rows")
    groups = stored(rows.groupBy("digest").agg(F.sum("size").alias("bytes")), "shard-groups")
    # The rows' number is split, position: a split is a block of the input.
    placed = stored(rows.join(_grouped(groups, shards), "digest").withColumn("split", F.shiftright("at", 33)), "shard-placed")
    of_shard = Window.partitionBy("shard").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    before = placed.groupBy("shard", "split").count().select("shard", "split", F.coalesce(F.sum("count").over(of_shard), F.lit(0)).alias("before"))
    number = F.row_number().over(Window.partitionBy("shard", "split").orderBy("at")) - 1
    slots = placed.withColumn("number", number).join(before, ["shard", "split"])
    return slots.select(F.col("doc").alias(id_col), "size", "text_crc32", "shard", (F.col("before") + F.col("number")).alias("slot"))


def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign(read(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
