"""Training-data pipeline over the table ``documents``: five stages, each one operator of tillroll.llm.

Each stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept, which are
written as Parquet in between. All but the last return the columns of ``documents``:

1. language: rows whose language can't be told (null text, or no letter) go, a null lang becomes the predicted
   one; with no labelled row to learn from all others stay.
2. near_duplicates: of each group of near copies (five-word shingles, 0.8) one row stays, also of equal rows and
   of rows without an id.
3. repeats: long byte strings that occur earlier in the corpus are cut out; n_chars follows. A row
   whose text is all repeats stays, with an empty text.
4. benchmark: documents contaminated with benchmark passages go.
5. tokens: token ids of each document, with the digests of ids and decoded text, and its language, given or predicted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillroll.llm import bpe, decontaminate, langid, near_dedup, suffix_dedup
from tillroll.llm.common import read, stored


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.accepted(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.kept_rows(docs)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return suffix_dedup.cut_rows(docs, chars_col="n_chars")


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean_rows(docs, read(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(docs, bpe.vocabulary_text(), with_ids=True, carry=("lang",))


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("repeats", repeats), ("benchmark", benchmark),
          ("tokens", tokens)]

#: SQL can't express language codes, near-duplicate components or BPE; the stages have brute-force tests.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
