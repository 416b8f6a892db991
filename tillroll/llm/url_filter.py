"""Operator 5, URL filter by a character language-model ratio. Native: DataFrame and SQL functions only.

A url that a rule covers gets the rule's verdict (the longest rule that fits). These urls are also
the training data: the accepted and the rejected ones each make a variable-order Markov model of
the characters of host and path, of ORDER characters of context, smoothed by Witten-Bell: with n
characters and d distinct ones seen after a context, a character has the probability
(count + d * shorter) / (n + d), where shorter is its probability after the context without its
first character. All other urls get the log ratio of the two models per character, compared
with a threshold that is calibrated on labelled urls held out from the counts (a fifth, by crc32
of the text): the grid value with the smallest sum of the two classes' error rates.

Counting works on distinct texts with multiplicities, and only on (ORDER + 1)-grams; shorter ones
are summed up from those. A gram's log ratio is worked out once and joined with the positions
where it occurs, salted, so that a gram in every url is spread.

Defined results: host and path are empty for a null url or one without "://". If either class
has no labelled url, the method has no evidence and allows. Repeated rows get the same verdict.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import lower_ascii, read, runs, stored

ORDER = 3
#: (verdict, host, path); a rule's name is host + path.
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/"))
HELD_OUT = 5
SALTS = 16
#: Characters that a url may hold, for the order below all contexts.
ALPHABET = 256
#: Grid of the threshold: log10 ratios per character from -LIMIT to LIMIT.
STEP, LIMIT = 0.01, 4.0


def host_and_path(url: Column) -> tuple[Column, Column]:
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    return lower_ascii(F.regexp_extract(rest, r"^[^/?#]*", 0)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(name, verdict) of the longest rule that fits; null without one."""
    name = verdict = F.lit(None).cast("string")
    for kind, own, start in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == own) | host.endswith("." + own)) & path.startswith(start)
        name, verdict = F.when(fits, own + start).otherwise(name), F.when(fits, kind).otherwise(verdict)
    return name, verdict


def _grams(texts: DataFrame) -> DataFrame:
    """A row for each position of the column ``text`` (which is dropped): the (ORDER + 1)-gram that
    ends there. The text is cut into characters first, so that a long one costs in proportion."""
    padded = F.split(F.concat(F.lit("^" * ORDER), F.col("text"), F.lit("$")), "")
    padded = F.filter(padded, lambda c: c != "")
    return (texts.withColumn("chars", padded).drop("text")
            .withColumn("grams", runs(F.col("chars"), ORDER + 1, lambda x, y: F.concat(x, y), True))
            .withColumn("gram", F.explode("grams")).drop("chars", "grams"))


def log_ratios(counts: DataFrame, grams: DataFrame) -> DataFrame:
    """(gram, ratio): log10 of accepted over rejected probability of the last character of each gram.
    ``counts``: gram, a and r, how often it occurs in the accepted and rejected training texts."""
    total = counts.agg(F.sum("a").alias("a"), F.sum("r").alias("r"),
                       F.countDistinct(F.when(F.col("a") > 0, F.right("gram", F.lit(1)))).alias("da"),
                       F.countDistinct(F.when(F.col("r") > 0, F.right("gram", F.lit(1)))).alias("dr")).collect()[0]  # one row
    out, p = grams, {"a": F.lit(1.0 / ALPHABET), "r": F.lit(1.0 / ALPHABET)}
    for k in range(ORDER + 1):
        own = counts.groupBy(F.right("gram", F.lit(k + 1)).alias(f"g{k}")).agg(F.sum("a").alias(f"a{k}"), F.sum("r").alias(f"r{k}"))
        out = out.withColumn(f"g{k}", F.right("gram", F.lit(k + 1))).join(own, f"g{k}", "left")
        if k == 0:
            n = {c: F.lit(float(total[c] or 0)) for c in "ar"}
            d = {c: F.lit(float(total["d" + c] or 0)) for c in "ar"}
        else:
            seen = lambda c: F.sum(F.when(F.col(f"{c}{k}") > 0, 1).otherwise(0))  # noqa: B023, E731
            context = own.groupBy(F.left(f"g{k}", F.lit(k)).alias(f"c{k}")).agg(
                *[F.sum(f"{c}{k}").alias(f"n{c}{k}") for c in "ar"], *[seen(c).alias(f"d{c}{k}") for c in "ar"])
            out = out.withColumn(f"c{k}", F.left(f"g{k}", F.lit(k))).join(context, f"c{k}", "left")
            n = {c: F.coalesce(f"n{c}{k}", F.lit(0)) for c in "ar"}
            d = {c: F.coalesce(f"d{c}{k}", F.lit(0)) for c in "ar"}
        out = out.withColumns({f"p{c}{k}": F.when(n[c] > 0, (F.coalesce(f"{c}{k}", F.lit(0)) + d[c] * p[c]) / (n[c] + d[c])).otherwise(p[c])
                               for c in "ar"})
        p = {c: F.col(f"p{c}{k}") for c in "ar"}
    return out.select("gram", (F.log10(p["a"]) - F.log10(p["r"])).alias("ratio"))


def scores(texts: DataFrame, counts: DataFrame) -> DataFrame:
    """(name, score): log10 ratio per character of each distinct text; name: its MD5."""
    at = _grams(texts.select("text").distinct().withColumn("name", F.md5("text")))
    grams = at.select("gram").distinct()
    ratios = log_ratios(counts, grams).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    placed = at.withColumn("salt", F.pmod(F.xxhash64("name"), F.lit(SALTS)).cast("int"))
    return (placed.join(ratios, ["gram", "salt"]).groupBy("name")
            .agg((F.sum("ratio") / F.count(F.lit(1))).alias("score")))


def threshold(scored: DataFrame) -> float:
    """The grid value that separates held-out accepted (a) and rejected (r) texts best."""
    cell = F.round(F.greatest(F.lit(-LIMIT), F.least(F.lit(LIMIT), F.col("score"))) / STEP).cast("int")
    cells = {x["cell"]: (x["a"], x["r"]) for x in scored.groupBy(cell.alias("cell")).agg(F.sum("a").alias("a"), F.sum("r").alias("r"))
             .collect()}  # at most 2 * LIMIT / STEP + 1 rows
    a, r = (sum(x[i] for x in cells.values()) for i in (0, 1))
    if not a or not r:
        return 0.0
    best, lost, caught = None, 0, 0
    for cell in sorted(cells):
        error = lost / a + (r - caught) / r
        if best is None or error < best[0] or error == best[0] and abs(cell) < abs(best[1]):
            best = (error, cell)
        lost, caught = lost + cells[cell][0], caught + cells[cell][1]
    return (best[1] - 0.5) * STEP


def judge(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES) -> DataFrame:
    """host, path, rule and verdict of every row; score where the method judged."""
    host, path = host_and_path(F.col(url_col))
    base = pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"))
    name, verdict = rule_of(F.col("host"), F.col("path"), rules)
    base = base.select("*", name.alias("rule"), verdict.alias("given"), F.concat("host", lower_ascii(F.col("path"))).alias("text"))
    labelled = (base.where("given IS NOT NULL").groupBy("text")
                .agg(F.count_if(F.col("given") == "allow").alias("a"), F.count_if(F.col("given") == "block").alias("r")))
    labelled = stored(labelled.withColumn("held", F.crc32(F.encode("text", "UTF-8")) % HELD_OUT == 0), "url-labelled")
    counts = stored(_grams(labelled.where("NOT held")).groupBy("gram").agg(F.sum("a").alias("a"), F.sum("r").alias("r")), "url-grams")
    n = counts.agg(F.sum("a"), F.sum("r")).collect()[0]  # one row
    columns = [F.col("id").alias(id_col), "host", "path", "rule"]
    if not n[0] or not n[1]:
        return base.select(*columns, F.coalesce("given", F.lit("allow")).alias("verdict"), F.lit(None).cast("double").alias("score"))
    to_score = base.where("given IS NULL").select("text").unionByName(labelled.where("held").select("text"))
    scored = stored(scores(to_score, counts), "url-scores")
    limit = threshold(labelled.where("held").withColumn("name", F.md5("text")).join(scored, "name"))
    out = base.join(scored, (F.md5("text") == F.col("name")) & F.col("given").isNull(), "left")
    own = F.when(F.col("score") >= limit, "allow").otherwise("block")
    return out.select(*columns, F.coalesce("given", own).alias("verdict"), "score")


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(read(spark, sf_dir, "pages"))
