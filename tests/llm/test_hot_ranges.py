"""A passage that all documents share must not lead all chunks to one range."""
import random
from statistics import median

from pyspark.sql import functions as F

from tillroll.llm import substring_dedup, suffix_dedup
from tillroll.llm.packed import named


def corpus(spark):
    draw = random.Random(5)
    word = lambda: "".join(draw.choice("abcdefghij") for _ in range(6))
    header = " ".join(word() for _ in range(150))
    return spark.createDataFrame([(i, header + " " + " ".join(word() for _ in range(60))) for i in range(800)], "doc_id long, text string")


def bytes_by_range(sent):
    size = sum(F.octet_length(c) for c, kind in sent.dtypes if kind == "binary")
    return [r["n"] for r in sent.groupBy("part").agg(F.sum(size).alias("n")).collect()]


def check(sent):
    sizes = bytes_by_range(sent)
    assert len(sizes) == 20 and max(sizes) < 2 * median(sizes)


def test_words(spark):
    rows = named(corpus(spark), "doc_id", F.col("text")).select("rank", "uid", "text").repartition(4)
    check(substring_dedup._sent(rows, 13, 20, 4000))


def test_bytes(spark):
    rows = named(corpus(spark), "doc_id", F.col("text")).select("rank", "uid", "text").repartition(4)
    check(suffix_dedup._phrases(rows, 20, 4000))
