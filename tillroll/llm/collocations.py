"""Operator 13, phrase collocation mining by best-first branch-and-bound growth.

Texts are lower-cased (A-Z), split into pieces at punctuation and line ends, and pieces into words. Per
language, n counts all words and f(phrase) all contiguous occurrences inside pieces. Phrases of 2 to 3
words with a = f >= LEAST are candidates; their score is the least over the cuts of
floor(SCALE * a * a / (f(first part) * f(rest))). A candidate inside a longer one with at least HOLDS percent
of its occurrences is dropped, and each language's best ``limit`` are kept, by score, a and phrase.

Growth: words and pairs are counted first. A pair is a node that grows into triples, and its counts
bound what it can grow into. A triple xyz occurs at most as often as its prefix xy and its suffix yz, so its
score is at most SCALE * f(xy) / f(x) by the first cut and SCALE * f(yz) / f(z) by the second: both bounds are
admissible. Nodes are expanded best first, in rounds: a language's threshold is the score of its
``ahead``-th best pair, and a round counts every triple whose prefix's and whose suffix's bounds reach the
threshold, and those that hold a pair whose score does (they may drop it). All other triples score less
than the threshold. A language is settled when ``limit`` survivors reach its threshold, ties included,
for then nothing that wasn't expanded can be among them; for the others ``ahead`` is quadrupled, until the
threshold is 0 and all nodes are expanded. A round counts only what earlier rounds did not.

At scale: chunks count their phrases by themselves, Spark adds the counts up by phrase (partial aggregation on
the map side), so frequent words, phrases and languages leave a task as one row a chunk. Pairs and triples are
named by the 64-bit numbers of their words; that no two words (of one or two languages) share a number is checked
on the whole vocabulary, and another seed is taken if they do. Open nodes reach the tasks as a Bloom filter of at
most ``filter_bits`` bits (16 MB); it is made in blocks, by a shuffle. What it passes wrongly is counted in full as
well, and so does no harm. Scores are exact decimals. Triples meet their pairs in joins, whose skewed keys AQE
splits. Thresholds come from a histogram of scores (at most SCALE + 1 of them a language). Only the rounds' verdict
(how many languages are open) and the filter go to the driver.

Defined results: a null text is empty, a null language is `und`. Repeated rows and rows with null ids count
each time. Pieces and words of any length count whole. Languages without candidates, and empty tables,
give no rows. Only text and language are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import chunks, mix64, ranges, read, stored

LEAST, SCALE, HOLDS, LIMIT = 10, 1_000_000, 50, 2000
CHUNK_BYTES = 2 << 20
#: A round opens the nodes that score as its AHEAD * limit-th pair; AHEAD grows by GROWTH.
AHEAD, GROWTH = 2, 4
#: Bits of the filter for each pair, and at most; bytes of the blocks that it is made in.
PAIR_BITS, FILTER_BITS, BLOCK_BYTES = 16, 1 << 27, 1 << 16
OPENS, CLOSES, NAMED = 1, 2, 3  # a pair whose prefix bound, suffix bound or score reaches the threshold

_KIND = np.zeros(256, np.uint8)  # 0: part of a word
_KIND[[0x20, 0x09]] = 1          # ends a word
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2  # ends a piece
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _seeded(names: list[str], seed: int) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(x, seed) for x in names], np.uint64)


class Pieces:
    """Words of a chunk: ``word`` is the place of each in the chunk's vocabulary (``lang_of``, ``spelling``, and
    ``ids``, the words' numbers in the corpus), ``follows`` says that a word has the piece of the one before it."""

    def __init__(self, texts: list[bytes], langs: list[str], seed: int):
        data = _LOWER[np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)]
        kind = _KIND[data]
        edge = np.flatnonzero(np.diff(np.concatenate(([False], kind == 0)).view(np.int8)))
        starts, ends = edge[0::2], edge[1::2]
        piece = np.cumsum(kind == 2, dtype=np.int32)[starts]
        text_ends = np.cumsum(np.array([len(t) + 1 for t in texts], np.int64))
        self.langs, code = np.unique(np.array(langs, object), return_inverse=True)
        lang = code[np.searchsorted(text_ends, starts, "right")]
        lengths = ends - starts
        packed, offsets = data[ranges(starts, lengths)], np.concatenate(([0], np.cumsum(lengths))).astype(np.int64)
        del data, kind, edge, starts, ends
        coded = pa.Array.from_buffers(pa.large_string(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(packed)]).dictionary_encode()
        self.spelled, n = coded.dictionary, max(len(coded.dictionary), 1)
        both, self.word = np.unique(lang * n + coded.indices.to_numpy(), return_inverse=True)
        self.lang_of, self.spelling = both // n, both % n
        self.follows = np.concatenate(([False], piece[1:] == piece[:-1])) if len(piece) else np.empty(0, bool)
        self.ids = mix64(_seeded(self.spelled.to_pylist(), seed)[self.spelling] ^ mix64(_seeded(self.langs.tolist(), seed))[self.lang_of])

    def __len__(self) -> int:
        return len(self.word)

    def pairs(self) -> np.ndarray:
        """Positions of the second words of the pairs."""
        return np.flatnonzero(self.follows)

    def triples(self) -> np.ndarray:
        """Positions of the last words of the triples."""
        return np.flatnonzero(self.follows[1:] & self.follows[:-1]) + 1

    def counted(self, last: np.ndarray, width: int) -> tuple[list[np.ndarray], np.ndarray]:
        """Numbers of the words of the distinct phrases of ``width`` words that end at ``last``, and the phrases' counts."""
        code, n = self.word[last - (width - 1)], max(len(self.ids), 1)
        for back in reversed(range(width - 1)):
            if back < width - 2:  # the words so far are numbered anew, so that codes stay small
                code = np.unique(code, return_inverse=True)[1]
            code = code * n + self.word[last - back]
        _, first, count = np.unique(code, return_index=True, return_counts=True)
        return [self.ids[self.word[last[first] - back]] for back in reversed(range(width))], count


def _signed(ids: np.ndarray) -> pa.Array:
    return pa.array(ids.view(np.int64))


def _phrases(docs: DataFrame, seed: int, chunk_bytes: int) -> DataFrame:
    """Counts f of the words (lang, word, w1: its number) and of the pairs (w1, w2: the words' numbers)."""
    kinds = "lang string, word string, w1 long, w2 long, count long"
    names = [c.split()[0] for c in kinds.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in chunks(batches, 1, chunk_bytes):
            x = Pieces(texts, batch.column(0).to_pylist(), seed)
            if not len(x):
                continue
            yield pa.RecordBatch.from_arrays([pa.array(x.langs, pa.string()).take(pa.array(x.lang_of)), x.spelled.take(pa.array(x.spelling)).cast(pa.string()),
                                              _signed(x.ids), pa.nulls(len(x.ids), pa.int64()), pa.array(np.bincount(x.word))], names)
            (one, two), count = x.counted(x.pairs(), 2)
            none = pa.nulls(len(count), pa.string())
            yield pa.RecordBatch.from_arrays([none, none, _signed(one), _signed(two), pa.array(count)], names)

    return docs.mapInArrow(run, kinds).groupBy("lang", "word", "w1", "w2").agg(F.sum("count").alias("f"))


def _triples(docs: DataFrame, seed: int, old, new, least: int, chunk_bytes: int) -> DataFrame:
    """Triples (w1, w2, w3, a) of ``least`` occurrences that the filter ``new`` passes and ``old`` doesn't
    (broadcasts of bits)."""
    kinds = "w1 long, w2 long, w3 long, count long"
    names = [c.split()[0] for c in kinds.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = [(np.frombuffer(f.value, np.uint8), keep) for f, keep in ((new, True), (old, False)) if f is not None]
        for batch, texts in chunks(batches, 1, chunk_bytes):
            x = Pieces(texts, batch.column(0).to_pylist(), seed)
            words, count = x.counted(x.triples(), 3)
            take = np.ones(len(count), bool)
            for bits, keep in filters:
                opens, first = (_passes(bits, _pair_hash(words[0], words[1], flag)) for flag in (OPENS, NAMED))
                closes, second = (_passes(bits, _pair_hash(words[1], words[2], flag)) for flag in (CLOSES, NAMED))
                passed = (opens & closes) | first | second
                take &= passed if keep else ~passed
            if take.any():
                yield pa.RecordBatch.from_arrays([*[_signed(w[take]) for w in words], pa.array(count[take])], names)

    return docs.mapInArrow(run, kinds).groupBy("w1", "w2", "w3").agg(F.sum("count").alias("a")).where(F.col("a") >= least)


def _pair_hash(one: np.ndarray, two: np.ndarray, flag: int) -> np.ndarray:
    return mix64(mix64(one + np.uint64(flag)) + two)


def _bit_places(h: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Two bits for each hash; ``bits`` is a power of two."""
    return h & np.uint64(bits - 1), (h >> np.uint64(32)) & np.uint64(bits - 1)


def _passes(filter_: np.ndarray, h: np.ndarray) -> np.ndarray:
    out = np.ones(len(h), bool)
    for at in _bit_places(h, 8 * len(filter_)):
        out &= (filter_[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0
    return out


def _filter(open_pairs: DataFrame, bits: int) -> np.ndarray:
    """The filter of (w1, w2, flags), bit flag - 1 of ``flags`` for each of its kinds. A block of bits is put
    together by one task from positions that were made distinct; the driver gets ``bits`` at most."""
    block = 8 * min(BLOCK_BYTES, bits // 8)

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, two, flags = (batch.column(i).to_numpy() for i in range(3))
            found = []
            for flag in (OPENS, CLOSES, NAMED):
                own = flags >> (flag - 1) & 1 > 0
                found += _bit_places(_pair_hash(one[own].view(np.uint64), two[own].view(np.uint64), flag), bits)
            at = np.unique(np.concatenate(found)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array((at // block).astype(np.int32)), pa.array((at % block).astype(np.int32))], ["block", "bit"])

    def made(rows: pa.Table) -> pa.Table:
        own = np.zeros(block, np.uint8)
        own[rows.column("bit").to_numpy()] = 1
        return pa.table({"block": pa.array([rows.column("block")[0].as_py()], pa.int32()),
                         "bits": pa.array([np.packbits(own, bitorder="little").tobytes()], pa.binary())})

    out = np.zeros(bits // 8, np.uint8)
    blocks = open_pairs.mapInArrow(places, "block int, bit int").distinct().groupBy("block").applyInArrow(made, "block int, bits binary")
    for row in blocks.toLocalIterator():
        out[row["block"] * block // 8:(row["block"] + 1) * block // 8] = np.frombuffer(row["bits"], np.uint8)
    return out


def _score(a: str, left: str, right: str) -> Column:
    """floor(SCALE * a * a / (left * right)), exact: counts to 1e15 keep the products within 38 digits."""
    big = "DECIMAL(16, 0)"
    return F.expr(f"(CAST({SCALE} * CAST({a} AS {big}) AS DECIMAL(22, 0)) * CAST({a} AS {big})) DIV (CAST({left} AS {big}) * CAST({right} AS {big}))")


def _vocabulary(docs: DataFrame, chunk_bytes: int) -> tuple[DataFrame, int]:
    """The counted phrases, and the seed under which no two words share a number."""
    for seed in range(16):
        phrases = stored(_phrases(docs, seed, chunk_bytes), "phrases")
        if not phrases.where("w2 IS NULL").groupBy("w1").count().where("count > 1").limit(1).count():
            return phrases, seed
    raise RuntimeError("words share their 64-bit numbers under 16 seeds")


def _pair_table(phrases: DataFrame, least: int) -> DataFrame:
    """Pairs that are candidates: lang, w1, w2, a, l, r, score and the bounds of their growth."""
    words = phrases.where((F.col("f") >= least) & F.col("w2").isNull())
    pairs = phrases.where((F.col("f") >= least) & F.col("w2").isNotNull()).select("w1", "w2", F.col("f").alias("a"))
    pairs = (pairs.join(words.select("w1", "lang", F.col("f").alias("l")), "w1")
             .join(words.select(F.col("w1").alias("w2"), F.col("f").alias("r")), "w2"))
    return pairs.select("lang", "w1", "w2", "a", "l", "r", _score("a", "l", "r").alias("score"),
                        F.expr(f"{SCALE} * CAST(a AS DECIMAL(16, 0)) DIV l").alias("opens"),
                        F.expr(f"{SCALE} * CAST(a AS DECIMAL(16, 0)) DIV r").alias("closes"))


def _thresholds(pairs: DataFrame, open_langs: DataFrame, rank: int) -> DataFrame:
    """(lang, least): the score of each open language's ``rank``-th best pair, 0 if it has fewer."""
    levels = pairs.join(open_langs, "lang", "left_semi").groupBy("lang", "score").count()
    above = levels.withColumn("n", F.sum("count").over(Window.partitionBy("lang").orderBy(F.desc("score"))))
    return above.groupBy("lang").agg(F.coalesce(F.max(F.when(F.col("n") >= rank, F.col("score"))), F.lit(0).cast("long")).alias("least"))


def _scored(triples: DataFrame, pairs: DataFrame) -> DataFrame:
    """Triples with the lesser of their two cuts (ties: the first)."""
    front = pairs.select("lang", "w1", "w2", F.col("a").alias("f12"), F.col("l").alias("f1"))
    back = pairs.select(F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("a").alias("f23"), F.col("r").alias("f3"))
    both = triples.join(front, ["w1", "w2"]).join(back, ["w2", "w3"])
    cut = F.least(F.struct(_score("a", "f1", "f23").alias("score"), F.lit(1).alias("k"), F.col("f1").alias("l"), F.col("f23").alias("r")),
                  F.struct(_score("a", "f12", "f3").alias("score"), F.lit(2).alias("k"), F.col("f12").alias("l"), F.col("f3").alias("r")))
    return both.select("lang", "w1", "w2", "w3", "a", cut.alias("cut")).select("lang", "w1", "w2", "w3", "a", "cut.l", "cut.r", "cut.score")


def _survivors(pairs: DataFrame, triples: DataFrame, thresholds: DataFrame, holds: int) -> DataFrame:
    """Candidates that score their language's threshold at least and aren't dropped."""
    reached = pairs.join(thresholds, "lang").where("score >= least")
    holders = triples.select("w1", "w2", F.col("a").alias("held")).unionByName(
        triples.select(F.col("w2").alias("w1"), F.col("w3").alias("w2"), F.col("a").alias("held")))
    held = holders.groupBy("w1", "w2").agg(F.max("held").alias("held"))
    left = reached.join(held, ["w1", "w2"], "left").where(f"held IS NULL OR 100 * held < {holds} * a").withColumn("w3", F.lit(None).cast("long"))
    cols = ["lang", "w1", "w2", "w3", "a", "l", "r", "score"]
    return left.select(*cols).unionByName(triples.join(thresholds, "lang").where("score >= least").select(*cols))


def mine(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, limit: int = LIMIT, holds: int = HOLDS,
         ahead: int = AHEAD, filter_bits: int = FILTER_BITS, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Each language's best ``limit`` phrases: lang, rank, phrase, a, l, r, n, score. ``filter_bits`` is a power of two."""
    spark = docs.sparkSession
    docs = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    phrases, seed = _vocabulary(docs, chunk_bytes)
    words = phrases.where("w2 IS NULL")
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    pairs = stored(_pair_table(phrases, least), "phrase-pairs")
    bits = min(filter_bits, 1 << max(10, (PAIR_BITS * pairs.count()).bit_length()))
    open_langs = stored(pairs.select("lang").distinct(), "phrase-langs")
    filter_, triples, old, rank = np.zeros(bits // 8, np.uint8), None, None, ahead * limit
    rows = spark.createDataFrame([], "lang string, w1 long, w2 long, w3 long, a long, l long, r long, score long")
    while open_langs.count():
        thresholds = stored(_thresholds(pairs, open_langs, rank), "phrase-least")
        flags = sum(F.when(F.col(c) >= F.col("least"), 1 << (flag - 1)).otherwise(0) for flag, c in ((OPENS, "opens"), (CLOSES, "closes"), (NAMED, "score")))
        frontier = pairs.join(thresholds, "lang").select("w1", "w2", flags.alias("flags")).where("flags > 0")
        filter_ = filter_ | _filter(frontier, bits)
        new = spark.sparkContext.broadcast(filter_.tobytes())
        more = stored(_scored(_triples(docs.join(open_langs, "lang", "left_semi"), seed, old, new, least, chunk_bytes), pairs), "phrase-triples")
        triples, old = more if triples is None else triples.unionByName(more), new
        left = stored(_survivors(pairs, triples.join(open_langs, "lang", "left_semi"), thresholds, holds), "phrase-survivors")
        enough = left.groupBy("lang").count().where(F.col("count") >= limit)
        done = thresholds.join(enough, "lang", "left").where("least = 0 OR count IS NOT NULL").select("lang")
        rows = rows.unionByName(left.join(done, "lang", "left_semi"))
        open_langs = stored(open_langs.join(done, "lang", "left_anti"), "phrase-langs")
        rank *= GROWTH
    for i in (1, 2, 3):
        rows = rows.join(words.select(F.col("w1").alias(f"w{i}"), F.col("word").alias(f"s{i}")), f"w{i}", "left")
    rows = rows.withColumn("phrase", F.concat_ws(" ", "s1", "s2", "s3"))
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = rows.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= limit)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine(read(spark, sf_dir, "documents"))


ORACLE = r"""WITH d AS (SELECT row_number() OVER () AS doc, coalesce(lang, 'und') AS lang,
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
g AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, w[i:i + k - 1] AS words
      FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (VALUES (1), (2), (3)) v(k))),
f AS (SELECT lang, k, phrase, any_value(words) AS words, count(*)::HUGEINT AS f FROM g GROUP BY lang, k, phrase),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, phrase, words, f AS a FROM f WHERE k >= 2 AND f >= 10),
cuts AS (SELECT lang, k, phrase, words, a, unnest(range(1, k)) AS cut FROM c),
s AS (SELECT cuts.*, l.f AS l, r.f AS r, 1000000 * a * a // (l.f * r.f) AS score FROM cuts
      JOIN f l ON l.lang = cuts.lang AND l.phrase = array_to_string(cuts.words[1:cut], ' ')
      JOIN f r ON r.lang = cuts.lang AND r.phrase = array_to_string(cuts.words[cut + 1:], ' ')),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
h AS (SELECT lang, phrase, max(a) AS held FROM (
        SELECT lang, array_to_string(words[1:2], ' ') AS phrase, a FROM c WHERE k = 3
        UNION ALL SELECT lang, array_to_string(words[2:3], ' '), a FROM c WHERE k = 3) GROUP BY lang, phrase),
kept AS (SELECT b.* FROM b LEFT JOIN h USING (lang, phrase) WHERE b.k = 3 OR held IS NULL OR 100 * held < 50 * a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score
FROM ranked JOIN n USING (lang) WHERE rank <= 2000"""
