"""Operator 4, BPE encoding and decoding.

Encoding is exact byte-pair merging without running merges: an Aho-Corasick automaton gives the
longest token at each position, and a pair-compatibility test says whether two neighbours can
stand side by side in a merged sequence. If they cannot, the last token is shortened to its
longest proper prefix that is a token, and a token without a usable prefix is taken back. Each
position is given up at most once, so the work is linear in the word. New words of many texts take
these steps side by side, one array operation for all of them. Decoding gathers bytes from one
table through token offsets.

Texts are cut first at the vocabulary's added tokens and then by its pre-tokenizer pattern, as
the byte-level tokenizers do. Null text counts as empty: no tokens, and the hash of no bytes.
"""

from __future__ import annotations

import hashlib
import json
import re
import string
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from .common import ranges, read, release

VOCABULARY = "byte_bpe_50k.json"
#: Pre-tokenizer pattern of byte-level BPE (fixed value). White space is spelled out because
#: the pattern's engine doesn't count the separators U+001C-U+001F.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PATTERN = (rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+"
           rf"|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
#: A run without white space and the one space before it, or white space: the pattern cuts each
#: of these by itself, so they can be looked up whole.
CHUNKS = rf" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
#: Neither letters nor numbers nor white space.
MARKS = string.punctuation
#: Entries of a task's look-up tables of words, pieces and token pairs. A full table becomes the older of two
#: generations, and what is met again there moves to the new one: a task keeps what it uses often and holds at
#: most two tables of each, however large its input is.
CACHE_WORDS = 200_000
CACHE_PIECES = 100_000
CACHE_PAIRS = 200_000
#: Words, of one text or of several, that are looked up at a time.
SLAB_WORDS = 200_000
MAX_WORD = 64
#: Pieces, of MAX_WORD characters at most, that are encoded side by side.
SIDE_BY_SIDE = 10_000
#: Fewer than these are encoded one by one: an array step costs as much for one as for dozens.
FEW = 32
#: Slots (a power of two) of the table in which pieces side by side look up pair tests; a new pair takes the slot's place.
PAIR_SLOTS = 1 << 18
PIECE_BYTES = 2 << 20


def byte_alphabet() -> dict[str, int]:
    """Character of the vocabulary file -> byte. Printable bytes stand for themselves, the
    others follow from code point 256 in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Bpe:
    """Encoder and decoder tables of one byte-level vocabulary (the text of its JSON file)."""

    def __init__(self, vocabulary: str):
        import ahocorasick

        spec = json.loads(vocabulary)
        model, alphabet = spec["model"], byte_alphabet()
        if not set().union(*model["vocab"]) <= alphabet.keys():
            raise ValueError("a byte-level vocabulary has a character for each byte and no others")
        alphabet = str.maketrans({c: chr(b) for c, b in alphabet.items()})
        raw = lambda s: s.translate(alphabet)  # noqa: E731  bytes as Latin-1 text
        self.ids = {raw(t): i for t, i in model["vocab"].items()}
        self.added = {a["content"]: a["id"] for a in spec["added_tokens"]}
        size = max([*self.ids.values(), *self.added.values()]) + 1
        texts = [b""] * size
        for t, i in self.ids.items():
            texts[i] = t.encode("latin-1")
        for t, i in self.added.items():
            texts[i] = t.encode()
        self.texts = texts
        self.widest = max(map(len, self.ids))
        if not all(chr(b) in self.ids for b in range(256)):
            raise ValueError("a byte-level vocabulary has a token for each byte")
        # merged[(a, b)] = (rank, token); parts[token] = (a, b)
        self.merged, self.parts = {}, {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            a, b = raw(a), raw(b)
            key, out = (self.ids[a], self.ids[b]), self.ids[a + b]
            self.merged.setdefault(key, (rank, out))
            self.parts.setdefault(out, (rank, *key))
        self.halves = [self.parts.get(i) for i in range(size)]
        self.lengths = [len(t) for t in texts]
        self.automaton = ahocorasick.Automaton()
        for t, i in self.ids.items():
            self.automaton.add_word(t, i)
        self.automaton.make_automaton()
        self.shorter = {}
        self.fits: dict[tuple[int, int], bool] = {}
        self.words: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        self.older_fits, self.older_words, self.older_pieces = {}, {}, {}
        self.find, self.chunks = regex.compile(PATTERN).findall, re.compile(CHUNKS).findall
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")") \
            if self.added else None
        self.table, self.start, self.size = _table(texts)
        self._arrays()
        self.digits, self.digit_start, self.digit_size = _table([b"%d," % i for i in range(size)])

    def _arrays(self) -> None:
        """The tables of pieces that are encoded side by side."""
        halves = np.array([h or (-1, -1, -1) for h in self.halves], np.int64)
        self.half_rank, self.left, self.right = halves[:, 0].copy(), halves[:, 1].copy(), halves[:, 2].copy()
        pairs = np.array([(a * len(self.texts) + b, rank) for (a, b), (rank, _) in self.merged.items()], np.int64).reshape(-1, 2)
        pairs = np.concatenate((pairs[np.argsort(pairs[:, 0])], [(np.iinfo(np.int64).max, 0)]))
        self.pair_keys, self.pair_ranks = pairs[:, 0].copy(), pairs[:, 1].copy()
        self.prefixes = np.full(len(self.texts), -2)  # not known yet; -1: none
        # Tokens as a trie: edge k leads to node k + 1. Nodes are numbered by depth, so the edges' keys ascend.
        tokens = np.array(sorted(self.ids.values()), np.int64)
        node, edges, self.ends_at = np.zeros(len(tokens), np.int64), [], np.full(1, -1)
        for depth in range(self.widest):
            on = self.size[tokens] > depth
            tokens, node = tokens[on], node[on]
            keys, to = np.unique(node * 256 + self.table[self.start[tokens] + depth], return_inverse=True)
            edges.append(keys)
            node = to + len(self.ends_at)
            ends = np.full(len(keys), -1)
            whole = self.size[tokens] == depth + 1
            ends[to[whole]] = tokens[whole]
            self.ends_at = np.concatenate((self.ends_at, ends))
        self.edges = np.concatenate([*edges, [np.iinfo(np.int64).max]])
        self.slots = np.full(PAIR_SLOTS, -1, np.int64)  # 2 * pair + whether it fits

    # -------------------------------------------------------------- encoding

    def compatible(self, a: int, b: int) -> bool:
        """Whether merging the bytes of ``a`` and ``b`` ends with the boundary between them kept."""
        got = self.fits.get((a, b))
        if got is not None:
            return got
        if len(self.fits) >= CACHE_PAIRS:
            self.older_fits, self.fits = self.fits, {}
        ok = self.older_fits.get((a, b))
        if ok is None:
            ok = self._stay_apart(a, b)
        self.fits[(a, b)] = ok
        return ok

    def _stay_apart(self, a: int, b: int) -> bool:
        """Merges are undone from the last to the first along the boundary; at each step the pair
        that then touches it must not merge before the merge that was undone."""
        merged, halves = self.merged.get, self.halves
        x, y = a, b
        limit, ties = float("inf"), False  # merges of a lower rank happen before; with ties those of this rank, too
        px, py = halves[x], halves[y]
        while True:
            m = merged((x, y))
            if m is not None and (m[0] < limit or ties and m[0] == limit):
                return False
            # Of equal ranks the left one merges first, so the right one is undone first.
            if px is not None and (py is None or px[0] > py[0]):
                limit, ties, x = px[0], False, px[2]
                px = halves[x]
            elif py is not None:
                limit, ties, y = py[0], True, py[1]
                py = halves[y]
            else:
                return True

    def _fit(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """``compatible`` of many pairs."""
        pair = a * len(self.texts) + b
        slot = (pair * 0x9E3779B1 >> 20) & (len(self.slots) - 1)
        kept = self.slots[slot]
        new = np.flatnonzero(kept >> 1 != pair)
        if len(new):
            kept[new] = self.slots[slot[new]] = pair[new] * 2 + self._stay_apart_all(a[new], b[new])
        return (kept & 1).astype(bool)

    def _stay_apart_all(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """``_stay_apart`` of many pairs."""
        ok = np.ones(len(x), bool)
        at = np.arange(len(x))
        limit = np.full(len(x), np.iinfo(np.int64).max)  # twice the rank, one more with ties
        while len(at):
            pair = x * len(self.texts) + y
            k = np.searchsorted(self.pair_keys, pair)
            merges = (self.pair_keys[k] == pair) & (2 * self.pair_ranks[k] < limit)
            ok[at[merges]] = False
            px, py = self.half_rank[x], self.half_rank[y]
            on = np.flatnonzero(~merges & ((px >= 0) | (py >= 0)))
            at, x, y, px, py = at[on], x[on], y[on], px[on], py[on]
            first = px > py
            limit = np.where(first, 2 * px, 2 * py + 1)
            x, y = np.where(first, self.right[x], x), np.where(first, y, self.left[y])
        return ok

    def _prefix(self, token: int) -> int | None:
        """The longest token that is a proper prefix of ``token``."""
        got = self.shorter.get(token, -1)
        if got == -1:
            t = self.texts[token].decode("latin-1")
            got = next((self.ids[t[:n]] for n in range(len(t) - 1, 0, -1) if t[:n] in self.ids), None)
            self.shorter[token] = got
        return got

    def _prefix_all(self, tokens: np.ndarray) -> np.ndarray:
        """``_prefix`` of many tokens, -1 for none."""
        got = self.prefixes[tokens]
        if (got == -2).any():
            for t in np.unique(tokens[got == -2]).tolist():
                shorter = self._prefix(t)
                self.prefixes[t] = -1 if shorter is None else shorter
            got = self.prefixes[tokens]
        return got

    def encode_piece(self, piece: str) -> list[int]:
        word = piece.encode().decode("latin-1")
        one = self.ids.get(word)
        if one is not None:
            return [one]
        matches = list(self.automaton.iter_long(word))
        compatible, fits, last = self.compatible, self.fits, -1
        for n, (_, t) in enumerate(matches):
            if last >= 0:
                ok = fits.get((last, t))
                if ok is None:
                    ok = compatible(last, t)
                if not ok:
                    return self.backtrack(word, matches, n)
            last = t
        return [t for _, t in matches]

    def backtrack(self, word: str, matches: list[tuple[int, int]], good: int = 0) -> list[int]:
        """Tokens of ``word``; the first ``good`` of the automaton's matches are known to fit together."""
        n, lengths, fits = len(word), self.lengths, self.fits
        longest = {}  # position -> longest token there; the automaton has given those of its own path
        for end, t in matches:
            longest[end + 1 - lengths[t]] = t
        usable = bytearray(b"\x01") * (n + 1)
        out = [t for _, t in matches[:good]]
        at = matches[good - 1][0] + 1 if good else 0
        token = longest[at]
        while at < n:
            while True:
                end = at + lengths[token]
                ok = usable[end]
                if ok and out:
                    ok = fits.get((out[-1], token))
                    if ok is None:
                        ok = self.compatible(out[-1], token)
                if ok:
                    out.append(token)
                    at = end
                    token = longest.get(at)
                    if token is None and at < n:
                        token = longest[at] = self._longest(word[at:at + self.widest])
                    break
                shorter = self._prefix(token)
                if shorter is None:
                    usable[at] = 0
                    token = out.pop()
                    at -= lengths[token]
                    break
                token = shorter
        return out

    def encode_pieces(self, pieces: list[str]) -> list[bytes]:
        """Ids of each piece as little-endian uint32."""
        if len(pieces) < FEW:
            return [array("I", self.encode_piece(p)).tobytes() for p in pieces]
        # A byte that no text holds ends each piece; no token has the character that stands for it.
        raw = "\udcff".join([*pieces, ""]).encode("utf-8", "surrogateescape")
        data = np.frombuffer(raw, np.uint8)
        stop = np.flatnonzero(data == 0xFF)
        start = np.concatenate(([0], stop[:-1] + 1))
        text = raw.decode("latin-1").replace("\xff", "\u0100")
        path = np.fromiter(chain.from_iterable(self.automaton.iter_long(text)), np.int64).reshape(-1, 2)
        longest = np.full(len(raw), -1)  # the longest token at a position, as far as known
        longest[path[:, 0] + 1 - self.size[path[:, 1]]] = path[:, 1]
        longest[stop] = 0
        usable, out = np.ones(len(raw), bool), np.zeros(len(raw), np.int64)
        top = start.copy()  # behind the last token of each piece, kept in out from its start
        k, at, token = np.arange(len(start)), start, longest[start]  # pieces in work, where they are, what is tried there
        while len(k) >= FEW:
            first, last = start[k], top[k]
            end = at + self.size[token]
            ok = usable[end]
            test = np.flatnonzero(ok & (last > first))
            ok[test] = self._fit(out[last[test] - 1], token[test])
            out[last[ok]] = token[ok]
            shorter = np.zeros(len(k), np.int64)
            shorter[~ok] = self._prefix_all(token[~ok])
            back = np.flatnonzero(shorter < 0)
            usable[at[back]] = False
            before = out[last[back] - 1]
            top[k] = last = last + ok
            top[k[back]] = last[back] - 1
            at = np.where(ok, end, at)
            new = np.flatnonzero(longest[at] < 0)
            longest[at[new]] = self._longest_all(data, at[new], stop[k[new]])
            token = np.where(ok, longest[at], shorter)
            at[back], token[back] = at[back] - self.size[before], before
            on = np.flatnonzero(at < stop[k])
            k, at, token = k[on], at[on], token[on]
        packed = out.astype("<u4").tobytes()
        got = [packed[4 * a:4 * b] for a, b in zip(start.tolist(), top.tolist())]
        for i in k.tolist():
            got[i] = array("I", self.encode_piece(pieces[i])).tobytes()
        return got

    def _longest(self, word: str) -> int:
        """The longest token that ``word`` begins with."""
        n = self.automaton.longest_prefix(word)  # of a token, not always one
        while (token := self.ids.get(word[:n])) is None:
            n -= 1
        return token

    def _longest_all(self, data: np.ndarray, at: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """The longest token at each of the positions ``at`` of ``data`` that ends by ``stop``."""
        best, k, node = np.zeros(len(at), np.int64), np.arange(len(at)), np.zeros(len(at), np.int64)
        while len(k):
            edge = node * 256 + data[at]
            to = np.searchsorted(self.edges, edge)
            on = np.flatnonzero(self.edges[to] == edge)
            k, at, stop, node = k[on], at[on] + 1, stop[on], to[on] + 1
            token = self.ends_at[node]
            best[k[token >= 0]] = token[token >= 0]
            on = np.flatnonzero(at < stop)
            k, at, stop, node = k[on], at[on], stop[on], node[on]
        return best

    def packed(self, text: str) -> bytes:
        """Ids of one text as little-endian uint32."""
        return self.packed_texts([text])[0]

    def packed_texts(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian uint32. Words are looked up by slabs, whatever texts they are of."""
        found: list[list[bytes]] = [[] for _ in texts]
        slab, runs = [], []  # words; text, number of words and added token behind them

        def look_up():
            ids, at = self._looked_up(slab), 0
            for k, n, behind in runs:
                found[k].extend(ids[at:at + n])
                found[k].append(behind)
                at += n
            slab.clear()
            runs.clear()

        for k, text in enumerate(texts):
            for i, part in enumerate(self.cut.split(text) if self.cut else [text]):
                if i % 2:
                    runs.append((k, 0, np.uint32(self.added[part]).tobytes()))
                    continue
                chunks = self.chunks(part)
                for at in range(0, len(chunks), SLAB_WORDS):
                    some = chunks[at:at + SLAB_WORDS]
                    if len(slab) + len(some) > SLAB_WORDS:
                        look_up()
                    slab.extend(some)
                    runs.append((k, len(some), b""))
        look_up()
        return [b"".join(f) for f in found]

    def _looked_up(self, chunks: list[str]) -> list[bytes]:
        """Ids of each word of ``chunks``."""
        if len(self.words) >= CACHE_WORDS:
            self.older_words, self.words = self.words, {}
        words, older = self.words, self.older_words
        different, cuts = set(chunks), {}
        new = different.difference(words)
        for c in new:
            got = older.get(c)
            if got is None:
                cuts[c] = self._chunk(c)
            else:
                words[c] = got
        ids = self._ids(cuts.values())
        for c, cut in cuts.items():
            words[c] = ids[cut[0]] if len(cut) == 1 else b"".join([ids[p] for p in cut])
        own = dict(zip(different, map(words.__getitem__, different)))  # small: faster for each word than the large one
        for c in new:
            if len(c) > MAX_WORD:  # not kept beyond these words
                del words[c]
        return list(map(own.__getitem__, chunks))

    def _chunk(self, chunk: str) -> tuple[str, ...] | list[str]:
        """The pieces of a word."""
        # Letters are one piece and marks behind them another, whatever the pattern's other branches say.
        body = chunk.rstrip(MARKS)
        if not (body[1:] if body[:1] == " " else body).isalpha():
            return self.find(chunk)
        return (chunk,) if len(body) == len(chunk) else (body, chunk[len(body):])

    def _ids(self, cuts) -> dict[str, bytes]:
        """Ids of the pieces of new words; those of words of several pieces are kept."""
        ids, short, long = {}, [], []
        for cut in cuts:
            for p in cut:
                if p in ids:
                    continue
                got = None
                if len(cut) > 1:  # else kept as a word
                    got = self.pieces.get(p)
                    if got is None:
                        got = self.older_pieces.get(p)
                if got is None:
                    (short if len(p) <= MAX_WORD else long).append(p)
                ids[p] = got
        for at in range(0, len(short), SIDE_BY_SIDE):
            some = short[at:at + SIDE_BY_SIDE]
            ids.update(zip(some, self.encode_pieces(some)))
        for p in long:
            ids[p] = array("I", self.encode_piece(p)).tobytes()
        for cut in cuts:
            if len(cut) > 1:
                for p in cut:
                    if len(p) <= MAX_WORD and p not in self.pieces:
                        if len(self.pieces) >= CACHE_PIECES:
                            self.older_pieces, self.pieces = self.pieces, {}
                        self.pieces[p] = ids[p]
        return ids

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.packed(text), "<u4").tolist()

    # -------------------------------------------------------------- decoding

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        return self.table[ranges(self.start[ids], self.size[ids])].tobytes()

    def decode(self, ids) -> str:
        return self.decode_bytes(np.asarray(ids, np.int64)).decode("utf-8", "replace")

    def decimal(self, ids: np.ndarray) -> bytes:
        return self.digits[ranges(self.digit_start[ids], self.digit_size[ids])].tobytes()[:-1]


def _table(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    size = np.array([len(t) for t in texts], np.int64)
    return np.frombuffer(b"".join(texts), np.uint8), np.cumsum(size) - size, size


def encode_documents(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
                     with_ids: bool = False, with_text: bool = False, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: id, n_tokens, ids_sha256, decoded_sha256, and on demand token_ids,
    decoded_text and the columns ``carry`` as they are. ``vocabulary`` is the text of a tokenizer file (fixed size, so it
    is sent to the workers). Each task streams its rows; nothing is shuffled. A null id stays null."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(vocabulary)
    id_type = docs.schema[id_col].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Tables are built for each task (a third of a second), not kept: the worker goes on to other
        # tasks and stages, and what it holds counts against its executor.
        yield from encode(Bpe(sent.value), batches)
        release()

    def encode(bpe: Bpe, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            at = 0
            while at < batch.num_rows:
                rows, some, size = [], [], 0
                while at < batch.num_rows and (not some or size < PIECE_BYTES):
                    some.append(texts[at].as_py() or "")
                    size += len(some[-1])
                    at += 1
                for packed in bpe.packed_texts(some):
                    ids = np.frombuffer(packed, "<u4").astype(np.int64)
                    back = bpe.decode_bytes(ids)
                    try:
                        back.decode()
                    except UnicodeDecodeError:
                        back = back.decode("utf-8", "replace").encode()
                    row = (len(ids), hashlib.sha256(bpe.decimal(ids)).hexdigest(), hashlib.sha256(back).hexdigest())
                    rows.append(row + (ids.astype(np.int32),) * with_ids + ((back.decode(),) if with_text else ()))
                kinds = [pa.int64(), pa.string(), pa.string()] + [pa.list_(pa.int32())] * with_ids + [pa.string()] * with_text
                cols = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
                own = [batch.column(i).slice(at - len(rows), len(rows)) for i in (0, *range(2, 2 + len(carry)))]
                yield pa.RecordBatch.from_arrays([own[0], *cols, *own[1:]], names)
                del rows, some, cols, own
                release()

    schema = f"`{id_col}` {id_type.simpleString()}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    schema += ", token_ids array<int>" * with_ids + ", decoded_text string" * with_text
    schema += "".join(f", `{c}` {docs.schema[c].dataType.simpleString()}" for c in carry)
    names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256"] + ["token_ids"] * with_ids + ["decoded_text"] * with_text + list(carry)
    return docs.select(id_col, text_col, *carry).mapInArrow(run, schema)


def vocabulary_text(path: str | None = None) -> str:
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(VOCABULARY)
    with open(path, encoding="utf-8") as f:
        return f.read()


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(read(spark, sf_dir, "documents"), vocabulary_text())
