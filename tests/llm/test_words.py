"""Words are told apart by their bytes, whatever their structure."""
import numpy as np

from tillroll.llm import lm_score, near_dedup, substring_dedup
from tillroll.llm.common import Words


def thue_morse(n):
    return "".join("ab"[bin(i).count("1") % 2] for i in range(n))


ONE = thue_morse(1024)
TWO = ONE.translate(str.maketrans("ab", "ba"))


def test_hashes_of_structured_and_long_words():
    words = [ONE, TWO, ONE * 3, TWO * 3, "a" * 127, "a" * 128, "a" * 129, "", "\x00", "\x00\x00", "é", *[f"w{i}" * (i % 40 + 1) for i in range(3000)]]
    x = Words([" ".join(words).encode()], lower=False)
    spelled = [w for w in words if w]
    assert len(x.hashes) == len(spelled) and len(np.unique(x.hashes)) == len(set(spelled))
    again = Words([w.encode() for w in reversed(spelled)], lower=False)
    assert again.hashes[::-1].tolist() == x.hashes.tolist()
    assert Words([b"ABC xyz"], lower=True).hashes.tolist() == Words([b"abc XYZ"], lower=True).hashes.tolist()


def test_operators_tell_thue_morse_words_apart(rows):
    mine, other = (" ".join(f"{w}{i}" for i in range(20)) for w in (ONE, TWO))
    df = rows([(1, mine), (2, other), (3, mine)], "doc_id long, text string")
    near = {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(df).collect()}
    assert near == {1: 1, 2: 2, 3: 1}
    removed = {r["doc_id"]: r["n_removed"] for r in substring_dedup.remove_repeats(df).collect()}
    assert removed == {1: 0, 2: 0, 3: 20}
    tokens, _ = lm_score.tokens([ONE.encode(), TWO.encode()])
    assert len(set(tokens.tolist())) == 3
