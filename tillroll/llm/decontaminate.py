"""Operator 2, benchmark decontamination by winnowing. Native: DataFrame and SQL functions only.

1. Fingerprint: of every ``SPAN - GRAM + 1`` neighbouring GRAM-word hashes of a text the smallest
   is kept. A shared span of SPAN words holds one such window whole, so both sides keep the
   same hash: no shared span is missed. Items shorter than SPAN are one window of their own
   length; for the lengths that occur (at most SPAN - 1 of them) all hashes are kept.
2. Join: documents that share a fingerprint with an item are candidates.
3. Extend: all windows of the candidates are joined with the items' windows by hash and confirmed
   on their words. Only these count; fingerprints never decide.

The benchmark side is broadcast if it has at most ``BROADCAST_ROWS`` rows, which is counted first;
a larger one is joined by shuffling hashes (without texts), where AQE splits a skewed partition.

Defined results: null or wordless texts have no words, no items and are clean; a null doc_id is
kept as null; repeated rows each get the same result. Benchmark rows without words or with a
null item_id are no items. An empty benchmark leaves every document clean.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import gram_hashes, let, lower_ascii, read, slide, stored, word_hashes

SPAN = 13
GRAM = 5
BROADCAST_ROWS = 500_000
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Words of a text with A-Z lower-cased (null: none)."""
    text = F.coalesce(text, F.lit(""))
    plain = F.char_length(text) == F.octet_length(text)  # ASCII only: lower() changes A-Z and nothing else
    lowered = F.when(plain, F.lower(text)).otherwise(lower_ascii(text))
    return F.filter(F.split(lowered, SEPARATORS), lambda w: w != "")


def winnow(hashes: Column, gram: int = GRAM, span: int = SPAN) -> Column:
    """The smallest hash of each run of span - gram + 1 hashes of ``gram`` words."""
    return let(gram_hashes(hashes, gram), lambda h: F.array_distinct(slide(h, span - gram + 1, lambda a, b: F.least(a, b))))


def _probes(hashes: Column, short: list[int], long: bool) -> Column:
    parts = [winnow(hashes)] if long else []
    parts += [F.array_distinct(gram_hashes(hashes, n)) for n in short]
    return F.array_distinct(F.concat(*parts)) if len(parts) > 1 else parts[0]


def _bounded(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def hits(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         item_col: str = "item_id", item_text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(documents, hits): doc_id, text hash, n_words of each row; and per document, position and
    length one row with the items whose window occurs there."""
    items = (benchmark.where(F.col(item_col).isNotNull())
             .select(F.col(item_col).cast("string").alias("item"), words_of(F.col(item_text)).alias("words"))
             .withColumn("n", F.size("words")).where("n > 0")
             .withColumn("size", F.least(F.lit(SPAN), F.col("n")))
             .withColumn("hashes", word_hashes(F.col("words"))))
    sizes = sorted(r["size"] for r in items.select("size").distinct().collect())  # at most SPAN rows
    keyed = docs.select(F.col(id_col).alias("doc"), F.coalesce(F.xxhash64(text_col), F.lit(0)).alias("h"),
                        words_of(F.col(text_col)).alias("words"))
    if not sizes:
        none = "doc string, h long, position int, size int, items array<string>"
        plain = stored(keyed.select("doc", "h", F.size("words").cast("long").alias("n_words")), "decon-docs")
        return plain, docs.sparkSession.createDataFrame([], none).withColumn("doc", F.col("doc").cast(plain.schema["doc"].dataType))
    short, long = [s for s in sizes if s < SPAN], SPAN in sizes

    def grams(df: DataFrame, size: int) -> DataFrame:
        """A row for each window of ``size`` words: g (hash), position, and the window's words."""
        at = df.select("*", F.posexplode(gram_hashes(F.col("hashes"), size)).alias("position", "g"))
        return at.withColumn("span", F.array_join(F.slice("words", F.col("position") + 1, size), " ")).withColumn("size", F.lit(size))

    marks = None
    for size in sizes:
        own = items.where(F.col("size") == size)
        prints = winnow(F.col("hashes")) if size == SPAN else gram_hashes(F.col("hashes"), size)
        part = own.select(F.explode(prints).alias("f"))
        marks = part if marks is None else marks.unionByName(part)
    marks = stored(marks.distinct(), "decon-marks")
    windows = None
    for size in sizes:
        part = grams(items.where(F.col("size") == size).drop("size"), size).select("item", "g", "span", "size")
        windows = part if windows is None else windows.unionByName(part)
    windows = stored(windows.groupBy("g", "span", "size").agg(F.collect_set("item").alias("items")), "decon-windows")

    scanned = stored(keyed.withColumn("hashes", word_hashes(F.col("words")))
                     .select("doc", "h", F.size("words").cast("long").alias("n_words"),
                             _probes(F.col("hashes"), short, long).alias("f")), "decon-prints")
    candidates = (scanned.select("doc", "h", F.explode("f").alias("f")).join(_bounded(marks), "f", "left_semi")
                  .select("doc", "h").distinct())
    c = candidates.select(F.col("doc").alias("d2"), F.col("h").alias("h2"))
    # Each text of a candidate once: repeated rows share doc and h.
    chosen = (docs.select(F.col(id_col).alias("doc"), F.coalesce(F.xxhash64(text_col), F.lit(0)).alias("h"),
                          F.col(text_col).alias("text"))
              .join(c, F.col("doc").eqNullSafe(F.col("d2")) & (F.col("h") == F.col("h2")), "left_semi")
              .withColumn("words", words_of(F.col("text"))).drop("text")
              .withColumn("hashes", word_hashes(F.col("words"))))
    found, known = None, _bounded(windows)
    for size in sizes:
        part = (grams(chosen, size).join(known.where(F.col("size") == size).drop("size").withColumnRenamed("span", "span2"), "g")
                .where("span = span2").select("doc", "h", "position", "size", "items"))
        found = part if found is None else found.unionByName(part)
    return scanned.drop("f"), stored(found.distinct(), "decon-hits")


def decontaminate(docs: DataFrame, benchmark: DataFrame, **columns: str) -> DataFrame:
    """n_words, n_hit, n_items, items_sha256, contaminated and text_hash of every row of ``docs``."""
    id_col = columns.get("id_col", "doc_id")
    rows, found = hits(docs, benchmark, **columns)
    by = W.partitionBy("doc", "h").orderBy("position")  # one document, not a group of them
    end = F.col("position") + F.col("size")
    covered = (found.groupBy("doc", "h", "position").agg(F.max("size").alias("size"))
               .withColumn("before", F.max(end).over(by.rowsBetween(W.unboundedPreceding, -1)))
               .groupBy("doc", "h").agg(F.sum(F.greatest(F.lit(0), end - F.greatest(F.col("position"), F.coalesce("before", "position"))))
                                        .alias("n_hit")))
    named = (found.select("doc", "h", F.explode("items").alias("item")).groupBy("doc", "h")
             .agg(F.array_sort(F.collect_set("item")).alias("items")))
    both = covered.join(named, covered["doc"].eqNullSafe(named["doc"]) & (covered["h"] == named["h"])).select(
        covered["doc"].alias("d2"), covered["h"].alias("h2"), "n_hit", "items")
    out = rows.join(both, F.col("doc").eqNullSafe(F.col("d2")) & (F.col("h") == F.col("h2")), "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    items = F.coalesce("items", F.array().cast("array<string>"))
    return out.select(F.col("doc").alias(id_col), "n_words", n_hit.alias("n_hit"), F.size(items).cast("long").alias("n_items"),
                      F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
                      ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"), F.col("h").alias("text_hash"))


def clean_rows(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, unchanged, that are not contaminated."""
    bad = decontaminate(docs, benchmark, id_col=id_col, text_col=text_col).where("contaminated").select(
        F.col(id_col).alias("__bad_id"), F.col("text_hash").alias("__bad_hash")).distinct()
    own = F.coalesce(F.xxhash64(text_col), F.lit(0))
    return docs.join(bad, F.col(id_col).eqNullSafe(F.col("__bad_id")) & (own == F.col("__bad_hash")), "left_anti")


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")).drop("text_hash")


_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

#: Common table expressions: contamination of ``{docs}``.
HITS_SQL = f"""d AS (SELECT doc_id, {_WORDS} AS w FROM {{docs}}),
b AS (SELECT item_id, w, least(13, len(w)) AS n FROM (SELECT item_id, {_WORDS} AS w FROM benchmark) WHERE len(w) > 0),
bw AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS g
       FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM b)),
dw AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM b) WHERE len(w) >= n)),
hit AS (SELECT doc_id, item_id, i, dw.n FROM dw JOIN bw ON dw.n = bw.n AND dw.g = bw.g),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id),
judged AS (SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
    CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
  FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id))"""
ORACLE = "WITH " + HITS_SQL.format(docs="documents") + " SELECT * FROM judged"
