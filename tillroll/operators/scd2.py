"""Type 2 history with the ``check`` strategy (M6).

A new version opens when any check column differs (null-safe) from the open version of the
same key; the open version is closed with ``valid_to`` = the run time, which is also the new
version's ``valid_from``. Keys missing from the source stay open; rerunning the same source
adds nothing.

Plan at scale: closed history rows are never shuffled (filter + union). Only open rows are
joined with the source, one full outer join on the key (both sides hash-partitioned once).

``changed_versions`` takes extracts in any order. An extract that lies before others splits the interval of
the version that covers its time, if its row differs, up to the key's next sighting, and is made one with the
next version if that is alike; the history is then the one that the extracts give in order. It returns the changed
versions only, for a keyed merge: all others, closed ones above all, are neither rewritten nor shuffled.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCD_ID, UPDATED, VALID_FROM, VALID_TO = "scd_id", "snapshot_updated_at", "valid_from", "valid_to"

# The tracked product columns and the check columns of the product snapshot.
PRODUCT_COLUMNS = ["product_id", "sku", "product_name", "category_id", "brand", "price", "cost_price",
                   "gross_margin", "size", "color", "material", "stock_quantity", "is_active", "updated_at"]
PRODUCT_CHECK_COLUMNS = ["price", "cost_price", "category_id", "is_active", "stock_quantity"]


def _scd_id(key: str, ts: F.Column) -> F.Column:
    return F.md5(F.concat_ws("|", F.col(key).cast("string"), ts.cast("string")))


def _versions(src: DataFrame, key: str, ts: F.Column) -> DataFrame:
    return (src.withColumn(SCD_ID, _scd_id(key, ts)).withColumn(UPDATED, ts)
            .withColumn(VALID_FROM, ts).withColumn(VALID_TO, F.lit(None).cast("timestamp")))


def snapshot_check(snapshot: DataFrame | None, source: DataFrame, key: str, check_cols: list[str],
                   run_ts: str) -> DataFrame:
    """Return the full new snapshot after applying ``source`` at ``run_ts``."""
    ts = F.lit(str(run_ts)).cast("timestamp")
    if snapshot is None:
        return _versions(source, key, ts)
    cols = source.columns
    meta = [SCD_ID, UPDATED, VALID_FROM, VALID_TO]
    closed = snapshot.filter(F.col(VALID_TO).isNotNull())
    open_ = snapshot.filter(F.col(VALID_TO).isNull())

    o = open_.select(*[F.col(c).alias(f"o_{c}") for c in cols + meta])
    s = source.select(*[F.col(c).alias(f"s_{c}") for c in cols])
    j = o.join(s, F.col(f"o_{key}") == F.col(f"s_{key}"), "full_outer")
    same = reduce(lambda a, b: a & b, [F.col(f"o_{c}").eqNullSafe(F.col(f"s_{c}")) for c in check_cols])
    in_open, in_src = F.col(f"o_{key}").isNotNull(), F.col(f"s_{key}").isNotNull()
    j = j.withColumn("_changed", in_open & in_src & ~same)

    # Each joined row gives one or two versions: the open one, kept or closed at run_ts, and the new one.
    versions = [SCD_ID, UPDATED, VALID_FROM, VALID_TO]
    none = F.lit(None).cast("timestamp")
    kept = F.struct(*[F.col(f"o_{c}").alias(c) for c in cols + versions[:3]],
                    F.when(F.col("_changed"), ts).otherwise(F.col(f"o_{VALID_TO}")).alias(VALID_TO))
    fresh = F.struct(*[F.col(f"s_{c}").alias(c) for c in cols], _scd_id(f"s_{key}", ts).alias(SCD_ID), ts.alias(UPDATED),
                     ts.alias(VALID_FROM), none.alias(VALID_TO))
    out = j.select(F.explode(F.array_compact(F.array(F.when(in_open, kept), F.when(F.col("_changed") | (in_src & ~in_open), fresh))))
                   .alias("r")).select("r.*")
    return closed.select(cols + meta).unionByName(out.select(cols + meta))


REMOVED = "removed"


def changed_versions(history: DataFrame | None, later: DataFrame | None, source: DataFrame, key: str, check_cols: list[str],
                     run_ts: str) -> DataFrame:
    """The versions that ``source``, an extract of the time ``run_ts``, adds or changes, identified by key and
    ``valid_from``; those that are no more have ``removed`` set.

    ``history``: the versions so far (None: none). ``later``: the rows of the extracts after ``run_ts`` that
    are part of it, with their time in ``seen_at`` (None: there are none): they tell how long a row holds
    that differs from a version which was there before and after it."""
    ts = F.lit(str(run_ts)).cast("timestamp")
    cols, meta = source.columns, [SCD_ID, UPDATED, VALID_FROM, VALID_TO]
    if history is None:
        return _versions(source, key, ts).withColumn(REMOVED, F.lit(False))

    def named(df: DataFrame, prefix: str, extra: list[str]) -> DataFrame:
        return df.select(*[F.col(c).alias(f"{prefix}_{c}") for c in cols + extra])

    def alike(a: str, b: str) -> F.Column:
        return reduce(lambda x, y: x & y, [F.col(f"{a}_{c}").eqNullSafe(F.col(f"{b}_{c}")) for c in check_cols])

    covers = (F.col(VALID_FROM) <= ts) & (F.col(VALID_TO).isNull() | (F.col(VALID_TO) > ts))
    s, v = named(source, "s", []), named(history.where(covers), "v", meta)
    j = s.join(v, F.col(f"s_{key}") == F.col(f"v_{key}"), "left")
    there = F.col(f"v_{key}").isNotNull()
    j = j.where(~there | ~alike("s", "v")).where(~there | (F.col(f"v_{VALID_FROM}") < ts))

    # The key's next sighting inside the covering version, which then goes on as a version of that time ...
    if later is not None:
        seen = later.join(j.select(F.col(f"s_{key}").alias("__key"), F.col(f"v_{VALID_TO}").alias("__to"), there.alias("__there")),
                          F.col(key) == F.col("__key")).where("__there AND (__to IS NULL OR seen_at < __to)")
        again = seen.groupBy("__key").agg(F.min_by(F.struct(*cols), "seen_at").alias("g_row"), F.min("seen_at").alias("g_at"))
        j = j.join(again, F.col(f"s_{key}") == F.col("__key"), "left").drop("__key")
    else:
        j = j.withColumn("g_row", F.lit(None).cast(source.schema)).withColumn("g_at", F.lit(None).cast("timestamp"))
    # ... or the next version.
    after = history.where(F.col(VALID_FROM) > ts).groupBy(F.col(key).alias("__key")).agg(
        F.min_by(F.struct(*cols, *meta), VALID_FROM).alias("__next")).select("__key", *[F.col(f"__next.{c}").alias(f"n_{c}") for c in cols + meta])
    j = j.join(after, F.col(f"s_{key}") == F.col("__key"), "left").drop("__key")
    joins_next = F.col("g_at").isNull() & F.col(f"n_{key}").isNotNull() & alike("s", "n")

    end = F.when(F.col("g_at").isNotNull(), F.col("g_at")).when(joins_next, F.col(f"n_{VALID_TO}")).otherwise(F.col(f"n_{VALID_FROM}"))

    def version(values: list[F.Column], start: F.Column, scd: F.Column, to: F.Column, removed: bool = False, updated: F.Column | None = None) -> F.Column:
        return F.struct(*[x.alias(c) for x, c in zip(values, cols)], scd.alias(SCD_ID), (start if updated is None else updated).alias(UPDATED),
                        start.alias(VALID_FROM), to.alias(VALID_TO), F.lit(removed).alias(REMOVED))

    def own(prefix: str) -> list[F.Column]:
        return [F.col(f"{prefix}_{c}") for c in cols]

    made = F.array_compact(F.array(
        version(own("s"), ts, _scd_id(f"s_{key}", ts), end),
        F.when(there, version(own("v"), F.col(f"v_{VALID_FROM}"), F.col(f"v_{SCD_ID}"), ts, updated=F.col(f"v_{UPDATED}"))),
        F.when(F.col("g_at").isNotNull(), version([F.col(f"g_row.{c}") for c in cols], F.col("g_at"), _scd_id(f"s_{key}", F.col("g_at")),
                                                  F.col(f"v_{VALID_TO}"))),
        F.when(joins_next, version(own("n"), F.col(f"n_{VALID_FROM}"), F.col(f"n_{SCD_ID}"), F.col(f"n_{VALID_TO}"), removed=True))))
    return j.select(F.explode(made).alias("r")).select("r.*")


def product_snapshot(snapshot: DataFrame | None, stg_products: DataFrame, run_ts: str) -> DataFrame:
    return snapshot_check(snapshot, stg_products.select(PRODUCT_COLUMNS), "product_id", PRODUCT_CHECK_COLUMNS, run_ts)
