"""Every operator with extra columns that bear the names it uses itself."""
import pytest

from tillroll.llm import bpe, decontaminate, html_text, langid, lm_score, near_dedup, quality, substring_dedup, suffix_dedup, url_filter

NAMES = ("doc h c n key rep bands low label words hashes f g position size span items item row t rank uid part kind starts counts reply "
         "n_words n_hit kept score lang_pred posterior component_id text_hash host path rule verdict given gram name salt a b p u v learn "
         "bad_id near_id word_chars n_shingles token_ids id").split()
WORDS = "the quick brown fox jumps over the lazy dog and runs away from the other animals of the wood at night"


@pytest.fixture(scope="module")
def frames(spark):
    extra = ", ".join(f"'x' AS `{n}`" for n in NAMES)
    spark.sql(f"SELECT * FROM VALUES (1L, '{WORDS}', 'en'), (2L, '{WORDS} x', 'en'), (3L, null, 'fr') t(doc_id, text, lang)") \
        .createOrReplaceTempView("clash_docs")
    docs = spark.sql(f"SELECT doc_id, text, lang, {extra} FROM clash_docs")
    pages = spark.sql(f"SELECT doc_id AS page_id, concat('https://a.com/', doc_id) AS url, concat('<p>', text) AS html, {extra} FROM clash_docs")
    bench = spark.sql(f"SELECT 7L AS item_id, '{WORDS}' AS text, {extra}")
    yield docs, pages, bench
    spark.catalog.dropTempView("clash_docs")


@pytest.mark.parametrize("run, n", [
    (lambda d, p, b: html_text.extract(p), 3), (lambda d, p, b: decontaminate.decontaminate(d, b), 3),
    (lambda d, p, b: decontaminate.clean_rows(d, b), 1), (lambda d, p, b: lm_score.score_documents(d), 3),
    (lambda d, p, b: bpe.encode_documents(d, bpe.vocabulary_text()), 3), (lambda d, p, b: url_filter.judge(p), 3),
    (lambda d, p, b: substring_dedup.remove_repeats(d), 3), (lambda d, p, b: near_dedup.near_duplicates(d), 3),
    (lambda d, p, b: near_dedup.kept_rows(d), 2), (lambda d, p, b: quality.judge(d), 3), (lambda d, p, b: suffix_dedup.remove_repeats(d), 3),
    (lambda d, p, b: suffix_dedup.cut_rows(d), 3), (lambda d, p, b: langid.identify(d), 3), (lambda d, p, b: langid.accepted(d), 2),
])
def test_operator(frames, run, n):
    assert len(run(*frames).collect()) == n
