"""Incremental keyed merge as a Structured Streaming job.

readStream (files landed by the feed) -> ``foreachBatch`` upsert into a merged table. Every row is
merged: rows re-sent within the lookback change nothing (K1 keeps the newest version per key), a
late row counts by its own cursor, and of two versions with one cursor the later load wins, so no
watermark and no state is needed. The streaming checkpoint says which files were read; a
micro-batch is known by (checkpoint id, batch id), so a batch that is run again after a crash
between the table's write and the stream's commit changes nothing. Backfill (T3) = a new
checkpoint, also on an existing table.

The stream itself only follows the files (it reads no column of them). A micro-batch's rows are read from its
files with the columns that these have, so a column that the feed gains, or a wider type, reaches the table
with the first file that has it (K3), and files from before it give null.
"""

from __future__ import annotations

import json
from urllib.parse import unquote

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tillroll.operators.merge import METADATA, MergedTable, aligned

FILES_PER_TRIGGER = 1000


def stream_load_id(spark: SparkSession, checkpoint: str, name: str, batch_id: int) -> str:
    """The identity of one micro-batch: the id that Spark keeps in the checkpoint, and the batch's number."""
    stream = json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0])["id"]
    return f"{name}-{stream}-{batch_id}"


def read_files(spark: SparkSession, files: list[str], known: list[T.StructType]) -> DataFrame:
    """The rows of some files in all the columns that one of them, or of the schemas ``known``, has."""
    try:
        frames = [spark.read.option("mergeSchema", "true").parquet(*files)]
    except PySparkException:  # a column's types differ: they are widened as a merge does it
        frames = [spark.read.parquet(f) for f in files]
    return aligned([*[spark.createDataFrame([], k) for k in known], *frames])


def merge_batch(batch: DataFrame, batch_id: int, table: MergedTable, checkpoint: str, pk: list[str], cursor: str, name: str) -> None:
    table.upsert(batch, list(pk), stream_load_id(batch.sparkSession, checkpoint, name, batch_id), cursor=cursor)


def start_merge_stream(spark: SparkSession, source_path: str, schema: T.StructType, table_root: str,
                       checkpoint: str, pk: list[str], cursor: str = "updated_at",
                       max_files_per_trigger: int | None = None, available_now: bool = True,
                       name: str = "feed") -> StreamingQuery:
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", int(max_files_per_trigger or FILES_PER_TRIGGER))
    table = MergedTable(spark, table_root)

    def merge(batch: DataFrame, batch_id: int) -> None:
        files = sorted(unquote(r[0]) for r in batch.distinct().collect())  # FILES_PER_TRIGGER at most
        if files:
            there = table.manifest()
            known = [schema, *([T.StructType.fromJson(there["schema"])] if there else [])]
            rows = read_files(batch.sparkSession, files, known).drop(*METADATA)
            merge_batch(rows, batch_id, table, checkpoint, pk, cursor, name)

    writer = (reader.parquet(source_path).select("_metadata.file_path").writeStream
              .option("checkpointLocation", checkpoint).foreachBatch(merge))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.queryName(f"merge_{name}").start()


def run_to_completion(query: StreamingQuery) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
