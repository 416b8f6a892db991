"""Helpers shared by the operators: typed column access, shared tables, byte hashing."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.session import ensure_checkpoint_dir


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def stored(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back: later jobs start from
    replicated files, so a lost executor never makes them repeat what made the table."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tillroll-llm/{tag}-{uuid.uuid4().hex[:12]}"
    schema = df.schema
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def id_text(spark_col: Column) -> Column:
    """A document id as text, as the contracts' crc32 folds take it."""
    return spark_col.cast("string")


def fold(doc_id: str, parts: int) -> Column:
    """crc32 of the id's text, modulo ``parts`` (null id: null)."""
    return F.crc32(F.encode(id_text(F.col(doc_id)), "UTF-8")) % parts


def lower_ascii(col: Column) -> Column:
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once: a lambda variable stands for it."""
    return F.element_at(F.transform(F.array(value), lambda v: use(v)), 1)


def word_hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def _ahead(h: Column, by: int) -> Column:
    return F.slice(h, by + 1, F.greatest(F.size(h) - by, F.lit(0)))


def runs(h: Column, k: int, join, disjoint: bool) -> Column:
    """For each run of ``k`` neighbours of ``h`` the value that ``join`` makes of them, in a few steps
    over the array: runs of 1, 2, 4, ... are doubled, then put together to ``k`` (side by side if
    ``disjoint``, else the last two may overlap)."""
    def step(levels: list[Column]) -> Column:
        width = 1 << (len(levels) - 1)
        if 2 * width <= k:
            return let(F.zip_with(levels[-1], _ahead(levels[-1], width), join), lambda twice: step([*levels, twice]))
        out, done = levels[-1], width
        if not disjoint:
            return out if done == k else F.zip_with(out, _ahead(out, k - width), join)
        for bit in reversed(range(len(levels) - 1)):
            if k >> bit & 1:
                out = F.zip_with(out, _ahead(levels[bit], done), join)
                done += 1 << bit
        return out

    # What reaches beyond the end of the array is cut off.
    return F.slice(step([h]), 1, F.greatest(F.size(h) - (k - 1), F.lit(0)))


def gram_hashes(hashes: Column, k: int) -> Column:
    """64-bit hashes of all runs of ``k`` neighbours of an array of word hashes (empty if it is shorter)."""
    return runs(hashes, k, lambda a, b: F.xxhash64(a, b), True)


def slide(values: Column, k: int, pick) -> Column:
    """``pick`` (least or greatest) over all runs of ``k`` neighbours."""
    return runs(values, k, pick, False)


# ------------------------------------------------------------------ numpy pieces used inside tasks

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser: spreads every input bit over the 64 output bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenation of arange(s, s + n) for each pair."""
    total = int(lengths.sum())
    if total == 0:
        return np.empty(0, np.int64)
    ends = np.cumsum(lengths)
    out = np.arange(total, dtype=np.int64)
    out += np.repeat(np.asarray(starts, np.int64) - (ends - lengths), lengths)
    return out


# Polynomial hashing modulo 2**64 with an odd base: the hash of bytes [a, b) is
# (sum[b] - sum[a]) * base ** -a, so that any substring's hash takes two look-ups.
_RNG = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _RNG.integers(1, 2 ** 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2 ** 64)
_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1), modulo 2**64; kept for the process."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, 1 << 18), base, np.uint64)
        have[0] = 1
        have = _POWERS[base] = np.cumprod(have, dtype=np.uint64)
    return have[:n]


class Rolling:
    """Hashes of substrings of one array, values given by ``table`` (bytes) or as they are (uint64)."""

    def __init__(self, values: np.ndarray, base: int = _BASE):
        values = _BYTE[values] if values.dtype == np.uint8 else values
        self.base, self.inverse = base, pow(base, -1, 2 ** 64)
        self.sums = np.empty(len(values) + 1, np.uint64)
        self.sums[0] = 0
        np.cumsum(values * powers(base, len(values)), out=self.sums[1:])

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if len(starts) == 0:
            return np.empty(0, np.uint64)
        return mix64((self.sums[ends] - self.sums[starts]) * powers(self.inverse, len(self.sums))[starts])


_IS_WHITE = np.zeros(256, bool)
_IS_WHITE[[32, *range(9, 14)]] = True
_LOWERED = np.arange(256, dtype=np.uint8)
_LOWERED[65:91] += 32


#: Words of more blocks of 8 bytes are hashed one by one.
_BLOCKS = 16
_MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def word_keys(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte ranges, eight bytes at a time through a non-linear mix: unlike polynomials
    modulo a power of two it has no texts known to collide by their structure."""
    lengths = ends - starts
    out = mix64(lengths.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    blocks = np.ndarray((len(data),), "<u8", padded, strides=(1,))
    left = np.flatnonzero(lengths <= 8 * _BLOCKS)
    for k in range(_BLOCKS):
        left = left[lengths[left] > 8 * k]
        if not len(left):
            break
        own = blocks[starts[left] + 8 * k] & _MASKS[np.minimum(lengths[left] - 8 * k, 8)]
        out[left] = mix64((out[left] ^ own) * np.uint64(0xD1342543DE82EF95))
    for i in np.flatnonzero(lengths > 8 * _BLOCKS).tolist():
        out[i] = xxhash.xxh3_64_intdigest(data[starts[i]:ends[i]].tobytes())
    return out


class Words:
    """Words `[^\\x20\\x09-\\x0D]+` of a list of texts (UTF-8 bytes): byte range and 64-bit hash of each
    word in order, and for each text the number of its words."""

    def __init__(self, texts: list[bytes], lower: bool):
        self.data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        solid = ~_IS_WHITE[self.data]
        edge = np.flatnonzero(np.diff(np.concatenate(([False], solid)).view(np.int8)))
        self.starts, self.ends = edge[0::2], edge[1::2]
        self.hashes = word_keys(_LOWERED[self.data] if lower else self.data, self.starts, self.ends)
        ends = np.cumsum(np.array([len(t) + 1 for t in texts], np.int64))
        upto = np.searchsorted(self.starts, ends)
        self.counts = np.diff(np.concatenate(([0], upto)))
        self.offsets = np.concatenate(([0], upto))


def _trimmer():
    import ctypes

    try:
        return ctypes.CDLL(None).malloc_trim
    except (AttributeError, OSError):  # another C library
        return None


_TRIM = _trimmer()


def release() -> None:
    """Give freed memory back to the system. A Python worker lives on between tasks, and what its
    allocators keep for later counts against its executor."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


def chunks(batches, column: int, size: int):
    """(record batch slice, its texts as bytes, null as empty) of about ``size`` bytes each; a
    longer text comes alone."""
    for batch in batches:
        texts, at = batch.column(column), 0
        while at < batch.num_rows:
            first, part, total = at, [], 0
            while at < batch.num_rows:
                text = texts[at].as_py()
                text = b"" if text is None else text.encode() if isinstance(text, str) else text
                if part and total + len(text) > size:
                    break
                part.append(text)
                total += len(text)
                at += 1
            yield batch.slice(first, at - first), part
            del part
            release()
