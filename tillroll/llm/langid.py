"""Operator 10, language identification by prediction by partial matching (PPM).

Every language has a byte context tree of order 3 with frozen counts. A byte after a context is
coded by PPM with escape method C: with n counts and d distinct successors in a context, a seen
byte has probability count / (n + d), and the escape d / (n + d) leads to the next shorter
context, down to a uniform code over the alphabet. The exact code length of a text in a language
is the sum over its bytes. Texts quote passages of other languages, whose code lengths would
drown the rest; so code lengths are compared block by block (BLOCK bytes), a block says at most
MOST bits against a language, and the language with the least said against it is predicted.

The statistics are frozen, so the cost of a byte depends on the last four bytes only. Every language has
sorted tables of the contexts and grams that it has seen, order by order; a task works out the costs of
each run of four bytes that it meets once and keeps them in a table of bounded size, by the run's hash.
Texts are first reduced to words: ASCII letters are lower-cased, and every run of other ASCII bytes is
one separator, so that shouting, numbers and markup say nothing about the language. Every byte seen in
training is a symbol of its own; those that no language has seen share one symbol and pay a uniform code
among themselves, the same in all languages. Every language with training rows is learned.

Training takes a bounded sample of labelled rows: about ``TRAIN_ROWS`` whole texts of each
language, chosen by a hash of the id. Prediction covers every row and whole texts.

Defined results: null text or a text without a letter is ``und`` with score 0; a null id is in
no fold (it is scored as not held out, and not learned from); with no training rows every text
is ``und``. Ties go to the language that sorts first. Score: the posterior probability of the
predicted language, from the mean evidence of a block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fold, read, release, stored

#: Symbols of the alphabet: all bytes, and one for those not seen.
SYMBOLS = 257
ORDER = 3
#: Training texts taken of each language.
TRAIN_ROWS = 400
FOLDS, HELD_OUT = 4, 2
#: Bytes of a block, and the most bits that one block can say against a language.
BLOCK, MOST = 48, 16.0
CHUNK = 1 << 20
#: Costs that a task keeps, at most so many runs of bytes; languages whose costs are added up at once.
KEPT, RUNS, AT_ONCE = 1 << 23, 1 << 19, 8

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[:128] = 32  # white space, digits and punctuation: all are one separator
_LOWER[97:123] = np.arange(97, 123)
_LOWER[65:91] = _LOWER[97:123]


class Model:
    """Languages in sorted order, the byte classes, and each language's tables (see ``_tables``)."""

    def __init__(self, languages: list[str], classes: np.ndarray, tables: list[list[tuple]]):
        self.languages, self.classes, self.tables = languages, classes, tables
        self.uniform = np.log2(max(2, 256 - np.count_nonzero(classes)))
        bits = max(10, min(RUNS, KEPT // max(1, len(languages))).bit_length() - 1)
        self.shift = np.uint64(64 - bits)
        self.runs = np.full(1 << bits, -1, np.int64)
        self.kept = np.zeros((1 << bits, len(languages)), np.float32)

    def costs(self, codes: np.ndarray) -> np.ndarray:
        """Bits of the last symbol of each run of ORDER + 1, in each language."""
        out = np.empty((len(codes), len(self.languages)), np.float32)
        for j, levels in enumerate(self.tables):
            cost = np.full(len(codes), np.log2(SYMBOLS))  # order -1
            for order, (grams, bits, contexts, escape) in enumerate(levels):
                gram = codes % SYMBOLS ** (order + 1)
                at, known = _found(contexts, gram // SYMBOLS)
                cost[known] += escape[at[known]]
                at, seen = _found(grams, gram)
                cost[seen] = bits[at[seen]]
            out[:, j] = cost
        out[codes % SYMBOLS == 0] += self.uniform
        return out

    def block_lengths(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bits of each block of BLOCK bytes in each language, and each block's text. ``data``: what ``_joined`` makes of the
        texts; the separators before each are the context that it starts with."""
        code = _codes(self.classes[data], SYMBOLS)
        slot = (code.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)
        miss = np.flatnonzero(self.runs[slot] != code)
        new, which = np.unique(code[miss], return_inverse=True)
        fresh = self.costs(new)
        starts = np.concatenate(([0], ends[:-1]))
        sizes = ends - ORDER - starts
        # Blocks of each text; the codes between two texts (of the next one's separators) are left out.
        blocks = -(-sizes // BLOCK)
        text = np.repeat(np.arange(len(ends)), blocks + 1)
        first = np.cumsum(blocks + 1) - (blocks + 1)
        number = np.arange(len(text)) - first[text]
        at = np.where(number < blocks[text], starts[text] + number * BLOCK, ends[text] - ORDER)
        inside = number < blocks[text]
        size = np.diff(np.concatenate((at, [len(code)])))
        some = size > 0
        sums = np.zeros((len(at), len(self.languages)))
        for lo in range(0, len(self.languages) if some.any() else 0, AT_ONCE):
            own = slice(lo, lo + AT_ONCE)
            bits = self.kept[:, own][slot]
            bits[miss] = fresh[:, own][which]
            sums[some, own] = np.add.reduceat(bits, at[some], axis=0, dtype=np.float64)
        place = np.zeros(len(new), np.int64)
        place[which] = slot[miss]
        place, one = np.unique(place, return_index=True)  # one run for each place
        self.runs[place], self.kept[place] = new[one], fresh[one]
        return sums[inside], text[inside]

    def code_lengths(self, data: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Bits of each text (rows) in each language (columns)."""
        sums, text = self.block_lengths(data, ends)
        return np.stack([np.bincount(text, sums[:, j], len(ends)) for j in range(len(self.languages))], axis=1)

    def evidence(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each text and language how many bits its blocks are longer than in their best language,
        at most MOST bits a block; and the number of blocks."""
        sums, text = self.block_lengths(data, ends)
        gap = np.minimum(sums - sums.min(axis=1, keepdims=True), MOST)
        return (np.stack([np.bincount(text, gap[:, j], len(ends)) for j in range(len(self.languages))], axis=1),
                np.bincount(text, minlength=len(ends)))


def _joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The texts' letters with one separator between words, each text after ORDER separators; and where
    each ends."""
    data = _LOWER[np.frombuffer(b"".join(b" " + t for t in texts), np.uint8)]
    first = np.cumsum([0] + [len(t) + 1 for t in texts[:-1]])
    keep = data != 32
    keep[1:] |= data[:-1] != 32
    keep[first] = True
    times = keep.astype(np.int64)
    times[first] = ORDER
    return np.repeat(data, times), np.add.reduceat(times, first).cumsum()


def _codes(symbols: np.ndarray, width: int) -> np.ndarray:
    """One number for each run of ORDER + 1 symbols; the last one counts least."""
    symbols = symbols.astype(np.int64)
    code = symbols[ORDER:].copy()
    for back in range(1, ORDER + 1):
        code += symbols[ORDER - back:len(symbols) - back] * width ** back
    return code


def _found(table: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of ``values`` in a sorted table, and which of them are in it."""
    at = np.minimum(np.searchsorted(table, values), len(table) - 1)
    return at, table[at] == values


def _tables(codes: np.ndarray, counts: np.ndarray) -> list[tuple]:
    """PPM tables of one language from the counts of its (ORDER + 1)-grams of classes, for each order: the
    grams seen and their bits, the contexts seen and the bits that their escape adds to the shorter one's."""
    levels: list[tuple] = []
    below = np.empty(0)
    for order in range(ORDER + 1):
        grams, which = np.unique(codes % SYMBOLS ** (order + 1), return_inverse=True)
        own = np.bincount(which, counts)
        contexts, first = np.unique(grams // SYMBOLS, return_index=True)
        n, d = np.add.reduceat(own, first), np.diff(np.concatenate((first, [len(grams)])))
        p = own / np.repeat(np.where(d < SYMBOLS, n + d, n), d)
        # A seen symbol is excluded below its context: what the escape leaves is shared by the others.
        lower = below[_found(levels[-1][0], grams % SYMBOLS ** order)[0]] if order else np.full(len(grams), 1.0 / SYMBOLS)
        rest = np.maximum(1.0 - np.add.reduceat(lower, first), 1e-12)
        levels.append((grams, -np.log2(p), contexts, np.log2(rest) - np.log2(d / (n + d))))
        below = p
    return levels


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          rows: int = TRAIN_ROWS) -> Model | None:
    """Model from the labelled ``docs``. The sample is bounded by ``rows`` texts a language; counting
    the sample's n-grams is done in the tasks, and the driver gets the grams that occur in it."""
    labelled = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    sizes = labelled.groupBy(F.col(lang_col).alias("l")).count().collect()  # a row a language
    if not sizes:
        return None
    grain = 1 << 30
    share = {r["l"]: min(grain, int(grain * rows / r["count"]) + 1) for r in sizes}
    bar = F.create_map(*[x for k, v in share.items() for x in (F.lit(k), F.lit(v))])
    sample = stored(labelled.where(F.pmod(F.xxhash64(F.col(id_col)), F.lit(grain)) < bar[F.col(lang_col)])
              .select(F.col(lang_col).alias("l"), F.encode(F.col(text_col), "UTF-8").alias("t")), "langid-sample")

    def bytes_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(256, np.int64)
        for batch in batches:
            total += np.bincount(_joined(batch.column(1).to_pylist())[0], minlength=256)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(total[seen], pa.int64())], ["b", "n"])

    counted = sample.mapInArrow(bytes_of, "b int, n long").groupBy("b").agg(F.sum("n").alias("n")).collect()  # 256 rows at most
    common = [r["b"] for r in sorted(counted, key=lambda r: (-r["n"], r["b"]))][:SYMBOLS - 1]
    classes = np.zeros(256, np.uint16)  # class 0: all other bytes
    for k, b in enumerate(sorted(common), 1):
        classes[b] = k

    labels = sorted(share)
    number = {lang: i for i, lang in enumerate(labels)}

    def grams_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found.setdefault(number[lang], []).append(_codes(classes[_joined([text])[0]], SYMBOLS))
        for lang, codes in found.items():
            seen, counts = np.unique(np.concatenate(codes), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(seen), lang), pa.int32()), pa.array(seen, pa.int64()),
                                              pa.array(counts, pa.int64())], ["l", "c", "n"])

    grams = sample.mapInArrow(grams_of, "l int, c long, n long").groupBy("l", "c").agg(F.sum("n").alias("n")).toArrow()
    lang_of, code_of, count_of = (grams.column(i).to_numpy() for i in range(3))
    order = np.argsort(lang_of, kind="stable")
    seen, first = np.unique(lang_of[order], return_index=True)
    tables = [_tables(code_of[own], count_of[own]) for own in np.split(order, first[1:])] if len(seen) else []
    return Model([labels[i] for i in seen], classes, tables) if tables else None


def _lettered(text_col: str) -> Column:
    return F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))


def predict(docs: DataFrame, model: Model | None, text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """The columns ``carry`` (default: all) with lang_pred and score of every row; a map over the
    rows, without a shuffle. Own columns of those names are left out."""
    carry = [c for c in (docs.columns if carry is None else carry) if c not in ("lang_pred", "score")]
    known = _lettered(text_col)
    row = F.struct(*carry).alias("row")
    # The text goes to the workers once: within the row if it is carried, else beside it.
    cols = docs.select(row, known.alias("known"), *([] if text_col in carry else [F.when(known, F.col(text_col)).alias("t")]))
    if model is None:
        return cols.select("row.*", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    sent = docs.sparkSession.sparkContext.broadcast((model.languages, model.classes, model.tables))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(*sent.value)
        for batch in batches:
            known, texts = batch.column(1), batch.column(0).field(text_col) if text_col in carry else batch.column(2)
            at = 0
            while at < batch.num_rows:
                part, size, first = [], 0, at
                while at < batch.num_rows and (not part or size < CHUNK):
                    text = texts[at].as_py().encode() if known[at].as_py() else None
                    part.append(text)
                    size += len(text or b"")
                    at += 1
                have = [t for t in part if t]
                names, scores = iter(()), iter(())
                if have:
                    gap, blocks = m.evidence(*_joined(have))
                    best = gap.argmin(axis=1)
                    gap = (gap - gap.min(axis=1, keepdims=True)) / np.maximum(1, blocks)[:, None]
                    names = iter([m.languages[b] for b in best])
                    scores = iter((1 / np.exp2(-np.minimum(gap, 1000)).sum(axis=1)).tolist())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, at - first),
                     pa.array([next(names) if t else "und" for t in part], pa.string()),
                     pa.array([next(scores) if t else 0.0 for t in part], pa.float64())], ["row", "lang_pred", "score"])
                del part, have
                release()

    schema = T.StructType([cols.schema["row"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return cols.mapInArrow(run, schema).select("row.*", "lang_pred", "score")


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Train on the folds that aren't held out, then predict every row."""
    learn = docs.where(fold(id_col, FOLDS) != HELD_OUT)
    found = predict(docs, train(learn, id_col, text_col, lang_col), text_col, [id_col])
    held = F.coalesce(fold(id_col, FOLDS) == HELD_OUT, F.lit(False))
    return found.select(id_col, held.alias("held_out"), "lang_pred", "score")


def accepted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             least: float = 0.0) -> DataFrame:
    """The rows of ``docs`` whose language can be told (with a score of ``least`` or more); a null language becomes
    the predicted one, all else is unchanged. Without a row to learn from nothing is told by a model: all texts
    with a letter stay."""
    learn = docs.where(fold(id_col, FOLDS) != HELD_OUT)
    model = train(learn, id_col, text_col, lang_col)
    if model is None:
        return docs.where(_lettered(text_col))
    own = {c: f"__own_{c}" for c in ("lang_pred", "score") if c in docs.columns}
    found = predict(docs.withColumnsRenamed(own), model, text_col).where((F.col("lang_pred") != "und") & (F.col("score") >= least))
    lang = F.coalesce(lang_col, F.col("lang_pred").cast(docs.schema[lang_col].dataType))
    return found.select(*[lang.alias(c) if c == lang_col else F.col(own.get(c, c)).alias(c) for c in docs.columns])


def op10_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(read(spark, sf_dir, "documents"))
