"""Record-level quarantine.

Rules compile to one array of failure messages per row (``array_compact`` of ``when``
expressions, in rule order); a row is valid when the array is empty. The split is two filters
over the same flagged plan; nothing is cached.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

REASONS = "_quarantine_reasons"
QUARANTINED_AT = "_quarantined_at"


@dataclass(frozen=True)
class ValidationRule:
    """A rule on one field of a record. ``params`` depends on the kind (RULE_KINDS)."""
    field: str
    rule_type: str
    params: dict = field(default_factory=dict, hash=False)

    @property
    def message(self) -> str:
        return RULE_KINDS[self.rule_type].format(field=self.field, **self.params)


#: Kind -> message (fixed values: the messages are stored in the quarantine tables).
RULE_KINDS = {
    "not_null": "{field} must not be null",
    "positive": "{field} must be positive",
    "in_list": "{field} must be in {values}",
    "min_value": "{field} must be >= {min}",
    "regex": "{field} must match {pattern}",
}


def rule(field: str, kind: str, **params) -> ValidationRule:
    if kind not in RULE_KINDS:
        raise ValueError(f"unknown rule type {kind!r}")
    return ValidationRule(field, kind, params)


def _value(df: DataFrame, name: str) -> Column:
    # A field missing from the record counts as null.
    return F.col(name) if name in df.columns else F.lit(None)


def failure(df: DataFrame, check: ValidationRule) -> Column:
    """Boolean column: True when the row fails ``check``."""
    v = _value(df, check.field)
    t = check.rule_type
    if t == "not_null":
        return v.isNull()
    if t == "positive":
        return v.isNotNull() & (v <= 0)
    if t == "in_list":
        values = list(check.params["values"])
        allowed = [x for x in values if x is not None]
        null_ok = len(allowed) != len(values)
        member = v.isin(allowed) if allowed else F.lit(False)
        # null or missing fails unless None itself is listed (unlike the table-level check)
        return F.when(v.isNull(), F.lit(not null_ok)).otherwise(~member)
    if t == "min_value":
        return v.isNotNull() & (v < F.lit(check.params["min"]))
    if t == "regex":
        return v.isNotNull() & ~v.cast("string").rlike(check.params["pattern"])
    raise ValueError(f"unknown rule type {t!r}")


def _json_string(msg: str) -> str:
    return json.dumps(msg)


def reasons(df: DataFrame, rules: list[ValidationRule]) -> Column:
    """JSON array text of the failing messages in rule order, formatted like ``json.dumps``."""
    items = [F.when(failure(df, r), F.lit(_json_string(r.message))) for r in rules]
    arr = F.array_compact(F.array(*items)) if items else F.array().cast("array<string>")
    return F.when(F.size(arr) > 0, F.concat(F.lit("["), F.array_join(arr, ", "), F.lit("]")))


def flag(df: DataFrame, rules: list[ValidationRule], run_ts) -> DataFrame:
    """Input columns + ``_quarantine_reasons`` (null when valid) + ``_quarantined_at`` (null when valid)."""
    ts = F.lit(str(run_ts)).cast("timestamp") if run_ts is not None else F.current_timestamp()
    r = reasons(df, rules)
    return df.withColumn(REASONS, r).withColumn(QUARANTINED_AT, F.when(F.col(REASONS).isNotNull(), ts))


def validate_and_split(df: DataFrame, rules: list[ValidationRule], run_ts=None) -> tuple[DataFrame, DataFrame]:
    """(valid rows with the input schema, quarantined rows with two extra columns)."""
    flagged = flag(df, rules, run_ts)
    valid = flagged.filter(F.col(REASONS).isNull()).drop(REASONS, QUARANTINED_AT)
    return valid, flagged.filter(F.col(REASONS).isNotNull())


def write_quarantine(bad: DataFrame, root: str, source_table: str, load_id: str) -> int:
    """The rejected rows of one load, under ``<root>/<table>_quarantine/load_id=<id>`` (schema merged
    on read). A load that is run again replaces its own rows; a load without any leaves no folder. The rows
    are counted as they are written: the load's source is read once for them."""
    spark, table = bad.sparkSession, f"{root.rstrip('/')}/{source_table}_quarantine"
    made, seen = f"{table}/_writing-{load_id}", Observation()
    bad.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(made)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(made).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if seen.get["n"]:  # a load run again without new rows leaves those of its first run
        fs.delete(path(f"{table}/load_id={load_id}"), True)
        fs.rename(path(made), path(f"{table}/load_id={load_id}"))
    else:
        fs.delete(path(made), True)
        if not fs.listStatus(path(table)):  # no empty folder stays
            fs.delete(path(table), False)
    return int(seen.get["n"])
