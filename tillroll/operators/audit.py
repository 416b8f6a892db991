"""Audit tables (K7-K12): append-only event rows, current state by folding events per key.

``end_run`` is an update by key in a warehouse; on Parquet it is an appended event and the
current state of a run is, per column, the last non-null value by event sequence. Fold with
``max_by`` (partial aggregation; the audit tables are small but the fold is distributed anyway).

Every event is a small file. ``compact`` folds the events of ended runs into a merged table beside the events, one row a
run, resource rows likewise, and removes the files that hold nothing else; open runs' events stay. A folded row
is an event with the number of its run's last one, so folding it again with events that were not removed yet, or that
come later, gives the same state, and a compaction that broke off is made up for by the next. (A reader that has listed
files which are then removed has to read again.)
"""

from __future__ import annotations

import datetime as _dt
import hashlib
import itertools
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.operators import merge
from tillroll.schemas import AUDIT_SCHEMAS

#: Compacted tables and their keys.
FOLDED = {"pipeline_runs": "run_id", "pipeline_resource_runs": "id"}
_EVENT = [T.StructField("_event_seq", T.LongType(), False)]


def _now() -> _dt.datetime:
    """With its zone: Spark then stores the instant, whatever zone the machine or session has."""
    return _dt.datetime.now(_dt.timezone.utc)


class AuditLog:
    """Three append-only Parquet tables under ``root``: pipeline_runs, pipeline_resource_runs,
    quality_check_results."""

    def __init__(self, spark: SparkSession, root: str, clock=_now):
        self.spark, self.root, self.clock = spark, root.rstrip("/"), clock
        self._seq = itertools.count(int(clock().timestamp() * 1000) * 1000)
        self._pending: list[tuple] = []  # resource rows, written when their run ends

    def _path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def _append(self, table: str, rows: list[tuple], with_event: bool = True) -> None:
        schema = AUDIT_SCHEMAS[table]
        if with_event:
            schema = T.StructType(schema.fields + _EVENT)
            rows = [r + (next(self._seq),) for r in rows]
        self.spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(self._path(table))

    def start_run(self, pipeline_name: str, pipeline_type: str, run_id: str | None = None) -> str:
        """K7: append a 'running' row and return the run id."""
        run_id = run_id or str(uuid.uuid4())
        self._append("pipeline_runs", [(run_id, pipeline_name, pipeline_type, "running", self.clock(),
                                        None, None, 0, None, None)])
        return run_id

    def log_resource(self, run_id: str, resource_name: str, row_count: int = 0, status: str = "success",
                     duration_seconds: float = 0.0, error_message: str | None = None) -> None:
        """K8: one row per loaded resource, written with the end of its run."""
        now = self.clock()
        self._pending.append((str(uuid.uuid4()), run_id, resource_name, int(row_count), status,
                              now, now, float(duration_seconds), error_message))

    def end_run(self, run_id: str, status: str = "success", total_rows: int = 0, duration_seconds: float = 0.0,
                error_message: str | None = None) -> None:
        """K9: completion event; the error is only set when given."""
        rows = [r for r in self._pending if r[1] == run_id]
        if rows:
            self._pending = [r for r in self._pending if r[1] != run_id]
            self._append("pipeline_resource_runs", rows)
        self._append("pipeline_runs", [(run_id, "", "", status, self.clock(), self.clock(), float(duration_seconds),
                                        int(total_rows), error_message or None, None)])

    def store_results(self, results_df: DataFrame) -> None:
        """Append quality check results."""
        results_df.select([f.name for f in AUDIT_SCHEMAS["quality_check_results"].fields]) \
            .write.mode("append").parquet(self._path("quality_check_results"))

    def events(self, table: str) -> DataFrame:
        """The rows of an audit table, folded ones included."""
        folded = self._folded(table).read() if table in FOLDED else None
        if folded is None:
            return self.spark.read.parquet(self._path(table))
        single = self._single(table)
        rows = single.unionByName(folded.select(single.columns))
        return rows.dropDuplicates([FOLDED[table]]) if table == "pipeline_resource_runs" else rows

    def _single(self, table: str) -> DataFrame:
        """What is not folded yet, also if that is nothing."""
        return self.spark.read.schema(T.StructType(AUDIT_SCHEMAS[table].fields + _EVENT)).parquet(self._path(table))

    def _folded(self, table: str) -> merge.MergedTable:
        return merge.MergedTable(self.spark, f"{self.root}/folded/{table}")

    def _has(self, table: str) -> bool:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self._path(table))
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(path)

    def compact(self) -> dict[str, int]:
        """Fold what ended runs have left; returns the number of files removed for each table."""
        return {table: self._compact(table) for table in FOLDED if self._has(table)}

    def _compact(self, table: str) -> int:
        # The files are listed once: events that arrive meanwhile are in none of them.
        listed = self._single(table).inputFiles()
        if not listed:
            return 0
        here = self.spark.read.schema(self._single(table).schema).parquet(*listed).withColumn("_file", F.input_file_name())
        if table == "pipeline_runs":
            runs = here.groupBy("run_id").agg(F.max(F.col("completed_at").isNotNull()).alias("_ended"))
            known = self._folded(table).read()
            if known is not None:  # a later event of a run that is folded already
                runs = runs.join(known.select("run_id", F.lit(True).alias("_known")), "run_id", "left")
                runs = runs.select("run_id", (F.col("_ended") | F.col("_known").isNotNull()).alias("_ended"))
            here = here.join(runs, "run_id")
            ended = here.where("_ended").drop("_ended", "_file")
            if known is not None:
                ended = ended.unionByName(known.join(ended.select("run_id"), "run_id", "left_semi").select(ended.columns))
            rows = current_state(ended, keep_seq=True)
        else:
            here = here.withColumn("_ended", F.lit(True))
            rows = here.drop("_ended", "_file")
        # Names of small files; part names are unique. Files without rows go too.
        needed = {r["_file"].rsplit("/", 1)[-1] for r in here.where(~F.col("_ended")).select("_file").distinct().collect()}
        removable = sorted(f for f in listed if f.rsplit("/", 1)[-1] not in needed)
        if removable:
            name = hashlib.sha1("\n".join(removable).encode()).hexdigest()
            # The rows are whole: those of a later compaction replace earlier ones.
            self._folded(table).upsert(rows.withColumn("_epoch", F.timestamp_seconds(F.lit(0))), [FOLDED[table]], f"files-{name}", cursor="_epoch")
            jvm = self.spark.sparkContext._jvm
            for file in removable:
                at = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file))
                at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(at, False)
        return len(removable)

    def current_runs(self) -> DataFrame:
        return current_state(self.events("pipeline_runs"))


def current_state(events: DataFrame, keep_seq: bool = False) -> DataFrame:
    """Fold run events into one row per run: last non-null value of each column by event seq;
    name, type and start time come from the first (start) event. With ``keep_seq`` the row is an event
    again, with the number of its last one."""
    seq = F.col("_event_seq")
    first_cols = {"pipeline_name", "pipeline_type", "started_at"}
    aggs = []
    for f in AUDIT_SCHEMAS["pipeline_runs"].fields:
        if f.name == "run_id":
            continue
        c = F.col(f.name)
        if f.name in first_cols:
            aggs.append(F.min_by(c, seq).alias(f.name))
        else:
            aggs.append(F.max_by(c, F.when(c.isNotNull(), seq)).alias(f.name))
    names = [f.name for f in AUDIT_SCHEMAS["pipeline_runs"].fields]
    if keep_seq:
        aggs.append(F.max(seq).alias("_event_seq"))
    return events.groupBy("run_id").agg(*aggs).select(*names, *(["_event_seq"] if keep_seq else []))
