"""Operator 8, quality rules by weak supervision. Native: DataFrame and SQL functions only.

Each document gets text statistics in one pass over its row. Rules turn them into votes: +1
(good), -1 (bad) or 0 (abstain). Expectation-maximisation then estimates, without labels, each
rule's accuracy on good and on bad documents from the votes of the whole corpus, and a document is kept if its posterior probability of being good is at least
``KEEP``. The votes are counted by pattern first (at most 3 ** rules patterns, however many
documents), so an iteration of EM is one aggregate over a small table and sends one row of
sums to the driver.

Repeated words: the 8-word windows of a text are hashed and sorted inside its row; positions
whose hash occurs twice or more start a repeated window, and the words under those windows are
counted. A text without a repeated hash (the common case) skips the sort.

Defined results: null and empty text have no words (all counts 0, base_failed, not kept). With
an empty table the result is empty. Repeated ids give one row per input row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import gram_hashes, let, read, stored, word_hashes

WINDOW = 8
MIN_WORDS = 20
REPEAT_PERCENT = 30
#: Repeated lines are judged by their share (from so many on), distinct words by what a text of its length has: beyond
#: PLAIN_WORDS words their number grows with a power of the length.
LEAST_REPEATED, LINES_BAD, LINES_GOOD = 3, 0.2, 0.05
PLAIN_WORDS, GROWTH = 200, 0.7
KEEP = 0.5
ROUNDS = 12
#: Start of EM: a rule that votes on a good document votes good with the first probability, and on
#: a bad one votes bad with the second (a bad document breaks some rules, seldom most).
START = (0.995, 0.3)
#: Share of good documents before any evidence. It is given, not estimated: with a small bad class
#: an estimated share drifts to 1 and takes every single violation for noise.
PRIOR = 0.8
#: Pseudo votes for each document that tie a rule to its start: EM moves the accuracies within
#: reach of it, and rules that few documents break cannot be explained away as noise.
TIE = 5.0
#: Limits of the two accuracies: a rule stays better than chance.
GOOD_RANGE, BAD_RANGE = (0.9, 0.999), (0.2, 0.99)


def text_stats(text: Column) -> dict[str, Column]:
    """The base statistics of one text column (null counts as empty)."""
    text = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    solid = F.translate(text, " \t\n\x0b\f\r", "")
    lines = F.filter(F.split(text, r"\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return {"words": words, "word_chars": F.char_length(solid).cast("long"),
            "n_symbols": (F.char_length(text) - F.char_length(F.translate(text, "#*$%&|<>", ""))).cast("long"),
            "n_lines": F.size(lines).cast("long"),
            "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
            "n_letters": F.char_length(F.regexp_replace(text, r"[^\p{L}]+", "")).cast("long")}


def repeat_words(hashes: Column) -> Column:
    """Words covered by windows whose hash occurs twice or more. ``hashes``: one for each window."""
    def covered(h: Column) -> Column:
        placed = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def starts_of(p: Column) -> Column:
            same = lambda i, j: (j >= 0) & (j < F.size(p)) & (F.get(p, j)["h"] == F.get(p, i)["h"])
            found = F.filter(p, lambda x, i: F.coalesce(same(i, i - 1), F.lit(False)) | F.coalesce(same(i, i + 1), F.lit(False)))
            return F.array_sort(F.transform(found, lambda x: x["i"]))

        def width(s: Column) -> Column:
            ends = F.transform(s, lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get(s, i + 1) - x, F.lit(WINDOW))))
            return F.aggregate(ends, F.lit(0), lambda a, b: a + b)

        return let(let(placed, starts_of), width)

    return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), covered(hashes)).otherwise(0).cast("long")


def stats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    s = text_stats(F.col(text_col))
    base = docs.select(F.col(id_col).alias("id"), *[c.alias(k) for k, c in s.items()])
    base = base.withColumn("word_hashes", word_hashes(F.col("words")))
    base = base.withColumn("hashes", gram_hashes(F.col("word_hashes"), WINDOW))
    return base.select("id", F.size("words").cast("long").alias("n_words"), "word_chars", "n_symbols", "n_lines", "n_dup_lines",
                       "n_letters", F.size(F.array_distinct("words")).cast("long").alias("n_distinct"),
                       repeat_words(F.col("hashes")).alias("n_repeat_words"))


def votes() -> dict[str, Column]:
    """The rules over the columns of ``stats``. Each votes bad on one side, good on a clear other
    side, and abstains between and where the text is too short for it to say anything."""
    n, chars = F.col("n_words"), F.col("word_chars")
    per = lambda a, b: a / F.greatest(b, F.lit(1))

    def vote(bad: Column, good: Column) -> Column:
        return F.when(bad, -1).when(good, 1).otherwise(0)

    mean = per(chars, n)
    symbols, letters = per(F.col("n_symbols"), n), per(F.col("n_letters"), chars)
    repeats, lines = per(F.col("n_repeat_words"), n), per(F.col("n_dup_lines"), F.col("n_lines"))
    plain = F.lit(float(PLAIN_WORDS))
    distinct = per(F.col("n_distinct"), F.when(n <= PLAIN_WORDS, n).otherwise(plain * F.pow(n / plain, F.lit(GROWTH))))
    return {
        "v_length": vote(n < MIN_WORDS, n >= 50),
        "v_word_length": vote((mean < 2.5) | (mean > 12), (mean >= 3) & (mean <= 9)),
        "v_symbols": vote(symbols > 0.1, symbols < 0.02),
        "v_letters": vote(letters < 0.75, letters > 0.85),
        "v_dup_lines": vote((F.col("n_dup_lines") >= LEAST_REPEATED) & (lines > LINES_BAD), (lines < LINES_GOOD) & (n >= 50)),
        "v_repeats": vote(repeats > REPEAT_PERCENT / 100, (repeats < 0.02) & (n >= 50)),
        "v_distinct": vote((n >= 50) & (distinct < 0.15), (n >= 50) & (distinct > 0.3)),
    }


def _log_odds(names: list[str], model: dict) -> Column:
    out = F.lit(model["odds"])
    for k in names:
        good, bad = model[k]  # log-odds that a +1 and a -1 vote add
        out = out + F.when(F.col(k) == 1, F.lit(good)).when(F.col(k) == -1, F.lit(bad)).otherwise(F.lit(0.0))
    return out


def posterior(names: list[str], model: dict) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-_log_odds(names, model)))


def fit(voted: DataFrame, names: list[str], rounds: int = ROUNDS) -> dict:
    """Expectation-maximisation over the votes. Returns the log-odds of each vote.

    Model: a document is good with probability PRIOR; given its class a rule votes with a
    probability of its own and, if it votes, is right with probability a (good) or b (bad)."""
    from math import log

    patterns = stored(voted.groupBy(*names).agg(F.count(F.lit(1)).alias("n")).coalesce(1), "quality-patterns")
    right = {k: START for k in names}
    model = {}
    for _ in range(rounds):
        model = {"odds": log(PRIOR / (1 - PRIOR))}
        for k, (a, b) in right.items():
            model[k] = (log(a / (1 - b)), log((1 - a) / b))
        p, n = posterior(names, model), F.col("n")
        sums = [F.sum(n).alias("n")]
        for k in names:
            for v, tag in ((1, "p"), (-1, "m")):
                hit = F.when(F.col(k) == v, n)
                sums += [F.sum(hit * p).alias(f"{k}_{tag}g"), F.sum(hit * (1 - p)).alias(f"{k}_{tag}b")]
        row = patterns.agg(*sums).collect()[0]  # one row
        if not row["n"]:
            break
        for k in names:
            pg, pb, mg, mb = (row[f"{k}_{t}"] or 0.0 for t in ("pg", "pb", "mg", "mb"))
            good, bad = TIE * PRIOR * row["n"], TIE * (1 - PRIOR) * row["n"]
            a = (pg + good * START[0]) / (pg + mg + good)
            b = (mb + bad * START[1]) / (pb + mb + bad)
            right[k] = (min(max(a, GOOD_RANGE[0]), GOOD_RANGE[1]), min(max(b, BAD_RANGE[0]), BAD_RANGE[1]))
    return model


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Statistics, votes, posterior and verdict of every row of ``docs``."""
    rules = votes()
    names = list(rules)
    measured = stored(stats(docs, id_col, text_col), "quality-stats")  # a few numbers a row; the texts are read once
    voted = measured.select("*", *[c.alias(k) for k, c in rules.items()])
    model = fit(voted, names)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    return (voted.withColumn("posterior", posterior(names, model) if model else F.lit(PRIOR))
            .withColumn("base_failed", failed)
            .withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= KEEP))
            .withColumnRenamed("id", id_col))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = judge(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                      "kept", "posterior")
