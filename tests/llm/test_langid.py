import zlib

import numpy as np
import pytest

from tillroll.llm import langid

SF = "/root/testdata/sf0.01"


def brute_bits(train: bytes, text: bytes, classes) -> float:
    """PPM, escape method C with exclusions, straight from its definition."""
    order, width = langid.ORDER, langid.SYMBOLS
    counts: dict[tuple, dict[int, int]] = {}
    data = [32] * order + list(train)
    symbols = [int(classes[b]) for b in data]
    for i in range(order, len(symbols)):
        for k in range(order + 1):
            slot = counts.setdefault(tuple(symbols[i - k:i]), {})
            slot[symbols[i]] = slot.get(symbols[i], 0) + 1

    def probability(context, s, shut):
        seen = counts.get(context, {})
        if len(context) == 0 and not seen:
            return 1 / width
        if not seen:
            return probability(context[1:], s, shut)
        n, d = sum(seen.values()), len(seen)
        if s in seen:
            return seen[s] / (n + d) if d < width else seen[s] / n
        def lower(x):
            return probability(context[1:], x, None) if context else 1 / width
        rest = sum(lower(x) for x in range(width) if x not in seen)
        return d / (n + d) * lower(s) / rest

    stream = [int(classes[b]) for b in [32] * order + list(text)]
    uniform = np.log2(max(2, 256 - (len(set(classes.tolist())) - 1)))
    return sum(-np.log2(probability(tuple(stream[i - order:i]), stream[i], None)) + (uniform if stream[i] == 0 else 0)
               for i in range(order, len(stream)))


def test_code_length_is_the_ppm_code_length(rows, monkeypatch):
    monkeypatch.setattr(langid, "SYMBOLS", 6)
    train = "abacabadabacaba"
    ids = [i for i in range(40) if zlib.crc32(str(i).encode()) % 4 != 2][:1]
    df = rows([(ids[0], train, "xx")], "doc_id long, text string, lang string")
    model = langid.train(df, rows=10**6)
    for text in ("abacab", "zzab", "a"):
        got = model.code_lengths(*langid._joined([text.encode()]))[0, 0]
        assert got == pytest.approx(brute_bits(train.encode(), text.encode(), model.classes), rel=1e-4)


def test_only_letters_count():
    data, ends = langid._joined([b"Ab, 1!c", b"", "é \n".encode(), b"x"])
    assert data.tobytes() == "   ab c      é    x".encode()
    assert ends.tolist() == [7, 10, 16, 20]


def test_held_out_accuracy(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    got = langid.identify(df).join(df.select("doc_id", "lang", "text"), "doc_id").collect()
    assert len(got) == df.count()
    held = [r for r in got if r.held_out and r.lang and r.lang_pred != "und"]
    assert len(held) > 200 and sum(r.lang == r.lang_pred for r in held) / len(held) > 0.95
    assert all(0 <= r.score <= 1 for r in got)
    assert {r.held_out for r in got} == {True, False}


def test_edge_rows(rows):
    data = [(i, "the cat and the dog " * 3, "en", 1) for i in range(20)] + [(i + 100, "le chat et le chien " * 3, "fr", 1)
                                                                            for i in range(20)]
    data += [(200, None, "en", 1), (201, "", "fr", 1), (202, "123 !!", "fr", 1), (203, "the dog " * 30000, None, 1),
             (None, "le chien", "fr", 1), (1, "the cat", "en", 1)]
    df = rows(data, "doc_id long, text string, lang string, score int")
    got = langid.identify(df).collect()
    assert len(got) == len(data)
    by = {r.doc_id: r for r in got if r.doc_id in (200, 201, 202, 203, None)}
    assert [by[i].lang_pred for i in (200, 201, 202)] == ["und"] * 3
    assert by[203].lang_pred == "en" and by[None].lang_pred == "fr" and by[None].held_out is False
    assert by[201].held_out == (zlib.crc32(b"201") % 4 == 2)


def test_no_training_rows_and_empty_table(rows):
    schema = "doc_id long, text string, lang string"
    assert [r.lang_pred for r in langid.identify(rows([(1, "abc", None)], schema)).collect()] == ["und"]
    assert langid.identify(rows([], schema)).count() == 0


def test_other_scripts_keep_their_bytes_beside_latin(rows):
    """Russian and Bulgarian differ only in bytes that are rare beside a lot of Latin text."""
    latin = "the quick brown fox jumps over lazy dogs and zebras vex wizards " * 20
    text = {"aa": "\u044b\u044d ", "bb": "\u044a\u0449 "}
    data = [(i, latin, "en") for i in range(60)] + [(100 * k + i + 1000, t * 4, lang) for k, (lang, t) in enumerate(text.items())
                                                  for i in range(8)]
    model = langid.train(rows(data, "doc_id long, text string, lang string"), rows=10**6)
    assert np.unique(model.classes[list(range(97, 123)) + [0xD1, 0x8A, 0x8B, 0x89, 0x8D]]).size == 31
    probe = rows([(1, "\u044b\u044b"), (2, "\u0449\u0449")], "doc_id long, text string")
    assert [r.lang_pred for r in langid.predict(probe, model).orderBy("doc_id").collect()] == ["aa", "bb"]


def test_every_language_with_rows_is_learned(rows):
    words = [chr(97 + i // 10) + chr(97 + i % 10) + "xyz"[i % 3] for i in range(80)]
    data = [(1000 * i + k, f"{w} " * 10, f"l{i:02}") for i, w in enumerate(words) for k in range(3)]
    df = rows(data, "doc_id long, text string, lang string")
    model = langid.train(df)
    assert len(model.languages) == 80
    assert all(r.lang == r.lang_pred for r in langid.predict(df, model).collect())


def test_unlabelled_corpus_is_not_deleted(rows):
    data = [(1, "abc", None), (2, "Des mots.", None), (3, "12 !", None), (4, None, None), (None, "x", None), (1, "abc", None)]
    got = langid.accepted(rows(data, "doc_id long, text string, lang string")).collect()
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(str(r) for r in data if r[1] and r[1] != "12 !")
