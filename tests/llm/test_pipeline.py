import os
import random
import sys

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

import corpus_pipeline as P

sys.path.insert(0, os.path.dirname(__file__))
from test_decontaminate import brute as contaminated  # noqa: E402
from test_near_dedup import brute as components  # noqa: E402

from tillroll.llm import bpe  # noqa: E402
from tillroll.llm.common import read  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def staged(spark):
    docs, out = read(spark, SF, "documents"), []
    for _, stage in P.STAGES:
        before = docs
        docs = stage(spark, docs, SF)
        docs.cache()
        out.append((before, docs))
    yield out
    spark.catalog.clearCache()


def test_stages_return_the_columns_of_documents(staged):
    first = staged[0][0]
    for _, after in staged[:-1]:
        assert after.dtypes == first.dtypes


def test_each_stage_on_its_own_input(staged, spark):
    from tillroll.llm import langid
    (d0, d1), (_, d2), (_, d3), (_, d4), (_, d5) = staged
    rows = {r.doc_id: r for r in d0.collect()}
    told = {r.doc_id: r for r in langid.identify(d0).collect()}
    assert {r.doc_id for r in d1.collect()} == {i for i, r in told.items() if r.lang_pred != "und"}
    assert all(tuple(r) == tuple(rows[r.doc_id]) for r in d1.collect() if rows[r.doc_id].lang is not None)
    assert all(r.lang == told[r.doc_id].lang_pred for r in d1.collect() if rows[r.doc_id].lang is None)
    data = [(r.doc_id, r.text) for r in d1.collect()]
    want = {eval(x)[0] for x in components(data, 5) if eval(x)[3]}
    assert {r.doc_id for r in d2.collect()} == want
    seen, texts = set(), {}
    for r in sorted(d2.collect(), key=lambda r: r.doc_id):
        raw = (r.text or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - 99):
            if raw[i:i + 100] in seen:
                gone[i:i + 100] = b"\1" * 100
            seen.add(raw[i:i + 100])
        texts[r.doc_id] = bytes(b for b, g in zip(raw, gone) if not g).decode("utf-8", "ignore")
    assert {r.doc_id: r.text for r in d3.collect()} == texts
    assert all(r.n_chars == len(r.text) for r in d3.collect())
    bench = [(r.item_id, r.text) for r in read(spark, SF, "benchmark").collect()]
    assert {r.doc_id for r in d4.collect()} == {i for i, t in texts.items() if not contaminated(t, bench)[4]}
    tables = bpe.Bpe(bpe.vocabulary_text())
    for r in d5.collect():
        assert tables.decode(r.token_ids) == texts[r.doc_id] and len(r.token_ids) == r.n_tokens
    assert d5.count() == d4.count()


def test_run_is_the_stages_in_order(staged, spark):
    assert sorted(map(str, P.run(spark, SF).collect())) == sorted(map(str, staged[-1][1].collect()))


def test_null_ids_repeated_rows_and_extra_columns(spark, tmp_path):
    rng = random.Random(1)
    prose = [r.text for r in read(spark, SF, "documents").collect() if r.text and len(r.text) > 300][:12]
    data = [(i, t, "en", "s", len(t), "x") for i, t in enumerate(prose, 1)]
    data += [(None, prose[0] + " extra", None, None, None, None), (50, None, "en", "s", 0, "y"), (51, "", "en", "s", 0, "y"),
             (52, "12345 !!", "en", "s", 8, "z"), (1, prose[0], "en", "s", len(prose[0]), "x")]
    rng.shuffle(data)
    names = ["doc_id", "text", "lang", "source", "n_chars", "score"]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string()]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long, score string")
    for n in (len(data), 0):
        pq.write_table(pa.table([pa.array([r[i] for r in data[:n]], k) for i, k in enumerate(kinds)], names), tmp_path / "documents.parquet")
        pq.write_table(pa.table({"item_id": pa.array([], pa.int64()), "text": pa.array([], pa.string())}), tmp_path / "benchmark.parquet")
        got = P.run(spark, str(tmp_path)).collect()
        ids = [r.doc_id for r in got]
        assert not n and not got or {50, 51, 52}.isdisjoint(ids) and ids.count(1) == 1 and None not in ids
    del docs


def test_predicted_language_fills_null_and_one_row_of_equals_stays(spark):
    from pyspark.sql import functions as F
    from tillroll.llm import langid, near_dedup
    docs = read(spark, SF, "documents").withColumn("score", F.lit("own")).withColumn("lang_pred", F.lit(7))
    gone = docs.withColumn("lang", F.when(F.col("doc_id") % 5 != 0, F.col("lang")))
    got = {r.doc_id: r for r in P.language(spark, gone, SF).collect()}
    told = {r.doc_id: r.lang_pred for r in langid.identify(gone).collect()}
    for r in gone.collect():
        if r.doc_id in got:
            assert tuple(got[r.doc_id]) == tuple({**r.asDict(), "lang": r.lang or told[r.doc_id]}.values())
    text = "one two three four five six seven eight"
    rows = [(3, text, "a"), (3, text, "b"), (None, text, "c"), (None, text, "d"), (None, "other words stand here and here alone", "e"),
            (None, "other words stand here and here alone", "f"), (9, None, "g"), (9, None, "h"), (None, "", "i")]
    kept = near_dedup.kept_rows(spark.createDataFrame(rows, "doc_id long, text string, mark string")).collect()
    assert sorted(str((r.doc_id, r.text)) for r in kept) == sorted(str(r[:2]) for r in [rows[0], rows[4], *rows[6:]])


def test_the_predicted_language_reaches_the_result(spark, tmp_path):
    table = pq.read_table(f"{SF}/documents.parquet")
    ids, langs = table["doc_id"].to_pylist(), table["lang"].to_pylist()
    shown = pa.array([x if i % 3 else None for i, x in zip(ids, langs)], pa.string())
    pq.write_table(table.set_column(table.column_names.index("lang"), "lang", shown), tmp_path / "documents.parquet")
    pq.write_table(pq.read_table(f"{SF}/benchmark.parquet"), tmp_path / "benchmark.parquet")
    got = {r.doc_id: r.lang for r in P.run(spark, str(tmp_path)).collect()}
    given = dict(zip(ids, langs))
    assert any(i % 3 == 0 for i in got) and all(got.values())
    assert sum(got[i] == given[i] for i in got) >= 0.95 * len(got)
