"""Keyed merge (K1), load metadata (K2), schema evolution (K3), the merged raw table and the
incremental cursor (S2-S4).

``merge_latest(target, batch)`` keeps, per primary key, the newest version by
(cursor desc, load sequence desc, row hash desc): an older version never replaces a newer one,
and re-applying the same batch changes nothing (idempotent). The batch is reduced per key first
(``max_by`` over a struct, with partial aggregation on the map side, so a hot key crosses the
shuffle as one row per map task), then one null-safe full outer join picks the newer side.

``MergedTable`` stores a table as runs of rows. A load writes the rows it changes and nothing else; runs are
put together when they have grown alike, so every row is rewritten a logarithmic number of times.
"""

from __future__ import annotations

import datetime as _dt
import hashlib
import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOAD_ID = "_load_id"
ROW_ID = "_row_id"
LOAD_SEQ = "_load_seq"
METADATA = (LOAD_ID, ROW_ID, LOAD_SEQ)


def with_load_metadata(batch: DataFrame, load_id: str, load_seq: int, pk: list[str]) -> DataFrame:
    """K2: ``_load_id`` (the load), ``_load_seq`` (monotonic per load) and ``_row_id`` (hash of key + load)."""
    return (batch.withColumn(LOAD_ID, F.lit(load_id))
            .withColumn(LOAD_SEQ, F.lit(int(load_seq)).cast("long"))
            .withColumn(ROW_ID, row_id(pk)))


def row_id(pk: list[str]) -> Column:
    """Hash of key and load of a row that has both."""
    return F.sha2(F.concat_ws("|", *[F.col(k).cast("string") for k in pk], F.col(LOAD_ID)), 256)


_INTEGERS = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]


def _common_type(name: str, a: T.DataType, b: T.DataType) -> T.DataType:
    """The one of two column types that holds the values of both; anything lossy is an error."""
    if a == b:
        return a
    if a in _INTEGERS and b in _INTEGERS:
        return max(a, b, key=_INTEGERS.index)
    if {type(a), type(b)} == {T.FloatType, T.DoubleType}:
        return T.DoubleType()
    if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType):
        scale = max(a.scale, b.scale)
        whole = max(a.precision - a.scale, b.precision - b.scale)
        if whole + scale <= 38:
            return T.DecimalType(whole + scale, scale)
    raise TypeError(f"column {name}: {b.simpleString()} cannot be merged with {a.simpleString()}")


def evolve(target: DataFrame, batch: DataFrame) -> tuple[DataFrame, DataFrame]:
    """K3: align both sides on the union of columns. A new column is null on the old side, a wider
    type of the same kind widens the column; a narrowed or changed type and a removed column raise."""
    old, new = ({f.name: f.dataType for f in df.schema.fields} for df in (target, batch))
    removed = [c for c in old if c not in new and c not in METADATA]
    if removed:
        raise TypeError(f"columns removed from the feed: {', '.join(removed)}")
    kinds = {c: _common_type(c, old[c], new[c]) if c in old and c in new else old.get(c, new.get(c)) for c in [*old, *new]}

    def aligned(df: DataFrame, have: dict) -> DataFrame:
        return df.select(*[(F.col(c) if c in have else F.lit(None)).cast(k).alias(c) for c, k in kinds.items()])

    return aligned(target, old), aligned(batch, new)


def aligned(frames: list[DataFrame]) -> DataFrame:
    """The rows of all ``frames`` in the union of their columns: a column that a frame lacks is null in its
    rows, types are widened as in ``evolve``."""
    kinds: dict[str, T.DataType] = {}
    for df in frames:
        for f in df.schema:
            kinds[f.name] = _common_type(f.name, kinds[f.name], f.dataType) if f.name in kinds else f.dataType
    out = None
    for df in frames:
        part = df.select(*[(F.col(c) if c in df.columns else F.lit(None)).cast(k).alias(c) for c, k in kinds.items()])
        out = part if out is None else out.unionByName(part)
    return out


def _order(columns: list[str], cursor: str) -> list[F.Column]:
    """What makes a version newer, in order."""
    seq = F.col(LOAD_SEQ) if LOAD_SEQ in columns else F.lit(0).cast("long")
    return [F.col(cursor).alias("c"), seq.alias("s"), F.xxhash64(*[F.col(c) for c in columns]).alias("h")]


def latest_per_key(df: DataFrame, pk: list[str], cursor: str = "updated_at") -> DataFrame:
    """One row per key: the max of (cursor, load seq, row hash); ties beyond that are identical rows."""
    order = F.struct(*_order(df.columns, cursor))
    picked = df.groupBy(*pk).agg(F.max_by(F.struct(*[F.col(c) for c in df.columns]), order).alias("_w"))
    return picked.select("_w.*")


def merge_latest(target: DataFrame | None, batch: DataFrame, pk: list[str], cursor: str = "updated_at") -> DataFrame:
    """K1 upsert of ``batch`` into ``target``, which has one row per key (either may carry extra columns: K3)."""
    if target is None:
        return latest_per_key(batch, pk, cursor)
    target, batch = evolve(target, batch)
    cols = target.columns

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(F.struct(*cols).alias(name), F.struct(*_order(cols, cursor)).alias(f"{name}_order"),
                         *[F.col(k).alias(f"{name}_{k}") for k in pk])

    old, new = side(target, "old"), side(latest_per_key(batch, pk, cursor), "new")
    same_key = [F.col(f"old_{k}").eqNullSafe(F.col(f"new_{k}")) for k in pk]
    keep_old = F.col("new").isNull() | (F.col("old").isNotNull() & (F.col("old_order") >= F.col("new_order")))
    return old.join(new, same_key, "full_outer").select(F.when(keep_old, F.col("old")).otherwise(F.col("new")).alias("r")).select("r.*")


# --------------------------------------------------------------------------- the merged table


#: Runs that a table may have before runs of like size are put together, and how much larger a run is left alone.
MOST_RUNS, LARGER = 8, 2
#: A batch of which this part or more are repeats of a key is reduced as a whole.
REPEATED = 4
#: How often a load is merged again because another writer was faster.
ATTEMPTS = 20


class MergedTable:
    """A table merged load by load: folders of rows (``<root>/data/<run>``) and a pointer a version
    (``<root>/versions/<n>.json``: the runs, their keys' number, the load and the cursor).

    A load's batch is written once, as it comes. Its keys are counted: only if some repeat it is reduced to one row
    per key. Its keys and cursors meet the table's: only if some of its rows are older than the table's the others are
    written again. What is left is a run, so the rows of a later run always replace those of an earlier one, and
    to merge 200 rows writes 200 rows: the table's other columns and files are not touched. Load and sequence of
    a run stand in the pointer, and row ids are worked out from key and load as they are read.
    With more than MOST_RUNS runs the last ones are put together, as long as the one before is not LARGER times as
    large: a table has about log2(table / load) runs, and reading it is one anti-join of the first run with the
    keys of the later ones.

    A pointer is written under another name and renamed where no file of its name may be, so data and
    cursor change together, and of two writers that merged into the same version one is refused: it takes the
    new version and merges its rows again. A load is known by its id (``<root>/loads``): applying it again
    changes nothing. ``keep`` versions stay readable; runs that only older ones used are removed.
    """

    def __init__(self, spark: SparkSession, root: str, keep: int = 3):
        self.spark, self.root, self.keep = spark, root.rstrip("/"), keep

    def _path(self, name: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")

    def _fs(self):
        return self._path("versions").getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        fs, at = self._fs(), self._path("versions")
        if not fs.exists(at):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(at)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))

    def current_version(self) -> int | None:
        return max(self.versions(), default=None)

    def manifest(self, version: int | None = None) -> dict | None:
        there = self.versions()
        version = max(there, default=None) if version is None else version
        if version not in there:
            return None
        stream = self._fs().open(self._path(f"versions/{version:08d}.json"))
        try:
            return json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _run(self, run: dict, schema: T.StructType, pk: list[str]) -> DataFrame:
        """A run's rows in the table's columns: those that came later are null, narrower types are widened."""
        own = T.StructType.fromJson(run["schema"])
        rows = self.spark.read.schema(own).parquet(f"{self.root}/data/{run['name']}")
        if "load" in run:
            rows = with_load_metadata(rows, *run["load"], pk)
        elif ROW_ID in schema.names and ROW_ID not in own.names:
            rows = rows.withColumn(ROW_ID, row_id(pk))
        return rows.select(*[(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])

    def _rows(self, runs: list[dict], schema: T.StructType, pk: list[str]) -> DataFrame:
        """Of every key the row of the latest run that has it."""
        if not runs:
            return self.spark.createDataFrame([], schema)
        first, *later = [self._run(r, schema, pk) for r in runs]
        if not later:
            return first
        newer = later[0]
        if len(later) > 1:
            for number, rows in enumerate(later):
                rows = rows.withColumn("__run", F.lit(number))
                newer = newer.unionByName(rows) if number else rows
            newest = F.max_by(F.struct(*schema.names), F.col("__run"))
            newer = newer.groupBy(*pk).agg(newest.alias("__row")).select("__row.*")
        keys = newer.select(*[F.col(k).alias(f"__{k}") for k in pk])
        return first.join(keys, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in pk], "left_anti").unionByName(newer)

    def _frame(self, manifest: dict) -> DataFrame:
        return self._rows(manifest["runs"], T.StructType.fromJson(manifest["schema"]), manifest["pk"])

    def read(self, version: int | None = None) -> DataFrame | None:
        found = self.manifest(version)
        return None if found is None else self._frame(found)

    def row_count(self) -> int:
        found = self.manifest()
        return found["rows"] if found else 0

    def cursor_micros(self) -> int | None:
        """The largest cursor applied, in microseconds since the epoch (no table yet: None)."""
        found = self.manifest()
        return found["cursor"] if found else None

    def _mark(self, load_id: str):
        return self._path(f"loads/{hashlib.sha1(load_id.encode()).hexdigest()}")

    def applied(self, load_id: str) -> bool:
        """Whether a load is part of the table."""
        last = self.manifest()
        return last is not None and (last["load_id"] == load_id or self._fs().exists(self._mark(load_id)))

    def upsert(self, batch: DataFrame, pk: list[str], load_id: str, load_seq: int | None = None, cursor: str = "updated_at") -> DataFrame:
        """Merge one load and publish it as the next version; a load applied before changes nothing.
        ``load_seq`` orders loads (default: the version); another load that has it, or a later one, is an error.
        The batch is evaluated once."""
        given, latest = None, None
        for _ in range(ATTEMPTS):
            last = self.manifest()
            if self.applied(load_id):
                self._drop(given)
                return self.read()
            version = last["version"] + 1 if last else 1
            seq = version if load_seq is None else int(load_seq)
            if last and seq <= last["load_seq"]:
                self._drop(given)
                raise ValueError(f"load {load_id}: sequence {seq} is not after that of {last['load_id']} ({last['load_seq']})")
            if given is None:
                if last:
                    evolve(self._frame(last), with_load_metadata(batch, load_id, seq, pk))  # raises before anything is written
                seen = Observation()
                given = self._written(batch.observe(seen, F.max(F.unix_micros(F.col(cursor).cast("timestamp"))).alias("cursor"),
                                                    F.count(F.lit(1)).alias("rows")))
                latest = seen.get["cursor"]
                given = self._reduced(given, seen.get["rows"], pk, cursor)
            manifest = self._merged(last, given, pk, load_id, seq, cursor, latest) | {"version": version, "load_id": load_id, "load_seq": seq}
            used = [r["name"] for r in manifest["runs"]]
            if self._publish(manifest):
                if given["name"] not in used:
                    self._drop(given)
                self._fs().create(self._mark(load_id), True).close()
                self._retire()
                return self.read(version)
            # Another writer was faster: what was merged into the version before is merged into the new one.
            for run in manifest["runs"]:
                if run not in (last["runs"] if last else []) and run["name"] != given["name"]:
                    self._drop(run)
        raise RuntimeError(f"load {load_id}: {ATTEMPTS} other loads were published first")

    def _written(self, rows: DataFrame) -> dict:
        """``rows`` as a new folder. Its name is nobody else's: a writer never meets another one's files."""
        name = uuid.uuid4().hex
        rows.write.option("compression", "zstd").parquet(f"{self.root}/data/{name}")
        return {"name": name, "bytes": self._fs().getContentSummary(self._path(f"data/{name}")).getLength(), "schema": rows.schema.jsonValue()}

    def _reduced(self, given: dict, count: int, pk: list[str], cursor: str) -> dict:
        """``given`` with one row a key, and the number of its rows. Where no key repeats it is what was written."""
        rows = self._run(given, T.StructType.fromJson(given["schema"]), pk)
        keys = rows.select(*pk).distinct().count()
        if keys == count:
            return given | {"rows": count}
        if REPEATED * (count - keys) > count:
            one = latest_per_key(rows, pk, cursor)
        else:  # few repeat: the other rows stay where they are
            repeated = rows.groupBy(*pk).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").select(*[F.col(k).alias(f"__{k}") for k in pk])
            same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in pk]
            one = rows.join(repeated, same, "left_anti").unionByName(latest_per_key(rows.join(repeated, same, "left_semi"), pk, cursor))
        out = self._written(one) | {"rows": keys}
        self._drop(given)
        return out

    def _drop(self, run: dict | None) -> None:
        if run is not None:
            self._fs().delete(self._path(f"data/{run['name']}"), True)

    def _merged(self, last: dict | None, given: dict, pk: list[str], load_id: str, seq: int, cursor: str, latest: int | None) -> dict:
        """What the table is after the rows of ``given``: its pointer, but for version and load."""
        rows = with_load_metadata(self._run(given, T.StructType.fromJson(given["schema"]), pk), load_id, seq, pk)
        new, older = given["rows"], 0
        if last:
            old, rows = evolve(self._frame(last), rows)
            there = old.select(*[F.col(k).alias(f"__{k}") for k in pk], F.col(cursor).alias("__cursor"))
            key = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in pk]
            # Only keys and cursors meet; of batch and table the smaller one is sent to the other.
            met = rows.select(*dict.fromkeys([*pk, cursor])).join(there, key)
            behind = ~F.coalesce(F.col("__cursor") <= F.col(cursor), F.col("__cursor").isNull())
            found = met.agg(F.count(F.lit(1)).alias("met"), F.count_if(behind).alias("older")).first()
            new, older = given["rows"] - found["met"], found["older"]
        schema, runs = rows.schema, list(last["runs"]) if last else []
        if given["rows"] > older:
            if older:
                rows = rows.join(met.where(behind).select(*[f"__{k}" for k in pk]), key, "left_anti")
            run = given | {"load": [load_id, seq]} if not older and self._plain(schema, pk) else self._written(self._bare(rows, pk))
            runs = self._folded([*runs, run], schema, pk, given)
        known = [c for c in (latest, last["cursor"] if last else None) if c is not None]
        return {"runs": runs, "pk": list(pk), "rows": (last["rows"] if last else 0) + new, "cursor": max(known, default=None),
                "schema": schema.jsonValue()}

    @staticmethod
    def _plain(schema: T.StructType, pk: list[str]) -> bool:
        """Whether the text of a key is the same in any session and after its type was widened."""
        return all(isinstance(schema[k].dataType, (T.StringType, *map(type, _INTEGERS))) for k in pk)

    def _bare(self, rows: DataFrame, pk: list[str]) -> DataFrame:
        """``rows`` as they are written: without row ids where these can be worked out again."""
        return rows.drop(ROW_ID) if self._plain(rows.schema, pk) else rows

    def _folded(self, runs: list[dict], schema: T.StructType, pk: list[str], given: dict) -> list[dict]:
        """``runs``, the last ones put together if there are many. ``given`` stays: an overtaken load needs it again."""
        if len(runs) <= MOST_RUNS:
            return runs
        at, size = len(runs) - 1, runs[-1]["bytes"]
        while at and runs[at - 1]["bytes"] < LARGER * size:
            at -= 1
            size += runs[at]["bytes"]
        if at == len(runs) - 1:
            return runs
        folded = self._written(self._bare(self._rows(runs[at:], schema, pk), pk).hint("rebalance"))
        if runs[-1]["name"] != given["name"]:
            self._drop(runs[-1])  # written for this load: no version has it
        return [*runs[:at], folded]

    def _publish(self, manifest: dict) -> bool:
        """Whether the pointer could be put in place: not if another writer's is there."""
        if self.current_version() not in (None, manifest["version"] - 1):
            return False
        fs, jvm = self._fs(), self.spark.sparkContext._jvm
        made, name = self._path(f"versions/{uuid.uuid4().hex}.tmp"), self._path(f"versions/{manifest['version']:08d}.json")
        stream = fs.create(made, False)
        stream.write(bytearray(json.dumps(manifest).encode()))
        stream.close()
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(made.toUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        try:
            # Without the option to overwrite: one of two writers succeeds.
            files.rename(made, name, self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))
        except Py4JJavaError as error:
            if "FileAlreadyExists" not in str(error.java_exception):
                raise
            fs.delete(made, False)
            return False
        return True

    def _retire(self) -> None:
        """Remove the pointers before the last ``keep``, and the runs that only they used."""
        there = self.versions()
        used = {r["name"] for v in there[-self.keep:] for r in (self.manifest(v) or {"runs": []})["runs"]}
        for v in there[:-self.keep]:
            for run in (self.manifest(v) or {"runs": []})["runs"]:
                if run["name"] not in used:
                    self._drop(run)
            self._fs().delete(self._path(f"versions/{v:08d}.json"), False)


# --------------------------------------------------------------------------- cursor state

EPOCH_CURSOR = "1970-01-01T00:00:00"
LOOKBACK_SECONDS = 3600
_EPOCH = _dt.datetime(1970, 1, 1, tzinfo=_dt.timezone.utc)


def _utc(ts: _dt.datetime) -> _dt.datetime:
    return ts.replace(tzinfo=_dt.timezone.utc) if ts.tzinfo is None else ts.astimezone(_dt.timezone.utc)


def micros(ts: _dt.datetime) -> int:
    """Microseconds since the epoch; a time without a zone is UTC (never the machine's zone)."""
    return (_utc(ts) - _EPOCH) // _dt.timedelta(microseconds=1)


def parse_cursor(value: str | int | None, lookback_seconds: int = LOOKBACK_SECONDS) -> _dt.datetime | None:
    """Null, empty, the initial epoch value or an unparsable value -> None (full load);
    otherwise the cursor (ISO text, UTC unless it names a zone, or epoch microseconds) minus the lookback."""
    if not value or value == EPOCH_CURSOR:
        return None
    try:
        ts = _EPOCH + _dt.timedelta(microseconds=value) if isinstance(value, int) else _utc(_dt.datetime.fromisoformat(str(value)))
    except (TypeError, ValueError):
        return None
    return ts - _dt.timedelta(seconds=lookback_seconds)


def incremental_cut(df: DataFrame, since: _dt.datetime | None, cursor: str = "updated_at") -> DataFrame:
    """S3: strict ``cursor > since``; no filter on a full load. Pushed down to the Parquet scan."""
    if since is None:
        return df
    return df.filter(F.col(cursor) > F.timestamp_micros(F.lit(micros(since)).cast("long")))


def cursor_state(df: DataFrame, cursor: str = "updated_at") -> DataFrame:
    """One-row state, the max cursor seen (initial value when the input is empty)."""
    return df.agg(F.coalesce(F.max(F.col(cursor)), F.timestamp_micros(F.lit(0).cast("long"))).alias("last_value"))


def cursor_micros(df: DataFrame, cursor: str = "updated_at") -> int:
    """The state's value in epoch microseconds, which no time zone touches on its way."""
    return int(cursor_state(df, cursor).select(F.unix_micros("last_value")).first()[0])
