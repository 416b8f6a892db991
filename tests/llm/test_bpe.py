import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tillroll.llm import bpe

PARTS = ["ab", "the", "'s", " ", "  ", "\n", "é", "ß", "1", "23", "!!", "<|endoftext|>", "<|end", "x", "\x1c", "ing",
         "aaaa", "\x85", "日本", "😀", "\t"]


@pytest.fixture(scope="module")
def tables():
    return bpe.Bpe(bpe.vocabulary_text())


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path(bpe.VOCABULARY))


def test_equals_library_and_round_trips(tables, library):
    rng = random.Random(3)
    for _ in range(3000):
        text = "".join(rng.choices(PARTS, k=rng.randint(0, 14)))
        ids = library.encode(text, add_special_tokens=False).ids
        assert tables.encode(text) == ids
        assert tables.decode(ids) == library.decode(ids, skip_special_tokens=False) == text


def test_random_words_take_the_slow_path_too(tables, library):
    rng = random.Random(4)
    for _ in range(3000):
        word = "".join(rng.choices("abcdefghilmnorstu", k=rng.randint(1, 40)))
        assert tables.encode(word) == library.encode(word, add_special_tokens=False).ids


def test_every_code_point_is_cut_as_the_library_does(tables, library):
    points = [chr(c) for c in range(0x3100) if not 0xD800 <= c < 0xE000]
    text = "".join(c + " a\n1!"[i % 5] for i, c in enumerate(points))
    assert tables.encode(text) == library.encode(text, add_special_tokens=False).ids


def test_query_rows_nulls_and_clashing_columns(rows, library):
    long = "wordy texts, " * 20000
    data = [(1, "a b", 5), (2, None, 6), (3, "", 7), (3, "", 7), (None, "x", 8), (4, long, 9)]
    df = rows(data, "doc_id long, text string, n_tokens int")
    got = sorted(bpe.encode_documents(df, bpe.vocabulary_text(), with_ids=True, with_text=True).collect(), key=str)
    assert len(got) == len(data)
    texts = {1: "a b", 2: "", 3: "", None: "x", 4: long}
    for r in got:
        text = texts[r.doc_id]
        ids = library.encode(text, add_special_tokens=False).ids
        assert r.n_tokens == len(ids) and r.token_ids == ids and r.decoded_text == text
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_empty_table(rows):
    df = rows([], "doc_id long, text string")
    assert bpe.encode_documents(df, bpe.vocabulary_text()).count() == 0


def test_a_new_word_costs_no_second_look_up_of_the_others():
    from tillroll.llm import bpe

    class Counted(dict):
        gets = 0

        def get(self, *a):
            Counted.gets += 1
            return dict.get(self, *a)

    b = bpe.Bpe(bpe.vocabulary_text())
    b.words = Counted()
    text, long = "one two three " * 500, "x" * (bpe.MAX_WORD + 9)
    first = b.encode(text)
    assert b.encode(text + long) and Counted.gets == 0 and long not in b.words and " " + long not in b.words
    assert b.decode(first) == text


def test_look_up_tables_stay_small_whatever_the_input(library, monkeypatch):
    limits = {"CACHE_WORDS": 40, "CACHE_PIECES": 30, "CACHE_PAIRS": 50, "SLAB_WORDS": 20}
    for name, n in limits.items():
        monkeypatch.setattr(bpe, name, n, raising=False)
    b, rng = bpe.Bpe(bpe.vocabulary_text()), random.Random(5)

    def words(n):
        return " ".join("".join(rng.choices("aeinorst12,.é", k=rng.randint(1, 9))) for _ in range(n))

    for n in (*range(30), 900, 3, 200):
        text = words(n)
        assert b.encode(text) == library.encode(text, add_special_tokens=False).ids
        for name, most in (("words", 60), ("pieces", 30), ("fits", 50)):
            assert len(getattr(b, name)) <= most and len(getattr(b, f"older_{name}", ())) <= most


def test_a_word_in_use_outlives_a_full_table(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_WORDS", 10)
    b = bpe.Bpe(bpe.vocabulary_text())
    encoded, own = [], b._chunk
    b._chunk = lambda c: encoded.append(c) or own(c)
    for i in range(200):
        b.encode(f"often seen, n{i}")
    assert encoded.count("often") == encoded.count(" seen,") == 1 and len(encoded) == 202


def test_pieces_side_by_side_equal_the_library(tables, library, monkeypatch):
    monkeypatch.setattr(bpe, "FEW", 1, raising=False)
    monkeypatch.setattr(bpe, "PAIR_SLOTS", 64, raising=False)
    b, rng = bpe.Bpe(bpe.vocabulary_text()), random.Random(6)
    words = ["".join(rng.choices("abcdefghilmnorstu éß日😀\xff\xa0\n'$1", k=rng.randint(1, 40))) for _ in range(4000)]
    want = [library.encode(w, add_special_tokens=False).ids for w in words]
    assert [bpe.np.frombuffer(p, "<u4").tolist() for p in b.packed_texts(words)] == want
    pieces = ["".join(rng.choices("aeinorst", k=rng.randint(1, 60))) for _ in range(3000)]
    assert b.encode_pieces(pieces) == [bpe.np.array(b.encode_piece(p), "<u4").tobytes() for p in pieces]


def test_words_of_many_texts_are_encoded_side_by_side(library, monkeypatch):
    b, rng, calls = bpe.Bpe(bpe.vocabulary_text()), random.Random(7), []
    own = b.encode_pieces
    monkeypatch.setattr(b, "encode_pieces", lambda pieces: calls.append(len(pieces)) or own(pieces))
    monkeypatch.setattr(b, "encode_piece", lambda piece, one=b.encode_piece: calls.append(1) or one(piece))
    texts = [" ".join("".join(rng.choices("aeinorst", k=9)) for _ in range(20)) for _ in range(100)]
    texts[50:50] = ["", "<|endoftext|>", "a<|endoftext|><|endoftext|> b", texts[3]]
    got = [bpe.np.frombuffer(p, "<u4").tolist() for p in b.packed_texts(texts)]
    assert got == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert max(calls) > 1900 and len(calls) < 100


def test_letters_and_marks_are_cut_as_the_pattern_does(tables):
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for word in [*points, *(" " + c for c in points), "don't", "it's,", "'s", " 's", "a''s", "x'", "é$$$", " a.%%%", "a1!", " ,,", "!"]:
        assert list(tables._chunk(word)) == tables.find(word)
