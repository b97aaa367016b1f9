"""Words of a chunk as places in its bytes, against bytes.split()."""

import random

import numpy as np
import pytest

from tallymart.llm.substring_dedup import LONG_WORD, Words

MARKS = b"ab \n\t\x0b\x0c\r\x1c\x85\xc3"


def chunk(docs):
    return Words({"ids": list(range(len(docs))), "sizes": [len(d) for d in docs], "data": b"".join(docs)})


@pytest.mark.parametrize("seed", range(60))
def test_words_bounds_and_kept_texts(seed):
    rng = random.Random(seed)
    docs = [
        bytes(rng.choice(MARKS) for _ in range(rng.randint(0, 30))).decode("latin1").encode()
        for _ in range(rng.randint(1, 7))
    ]
    words, split = chunk(docs), [d.split() for d in docs]
    flat = [w for ws in split for w in ws]
    assert [words.data[a:b].tobytes() for a, b in zip(words.first, words.last)] == flat
    assert (words.ends - words.begins).tolist() == list(map(len, split))
    keep = np.array([rng.random() < 0.6 for _ in flat], bool)
    rest = iter(keep)
    want = [b" ".join(w for w in ws if next(rest)) for ws in split]
    assert [t.encode() for t in words.kept_texts(keep).to_pylist()] == want


def test_equal_words_have_equal_marks_and_others_do_not():
    rng = random.Random(9)
    flat = [bytes(rng.choice(b"ab") for _ in range(rng.randint(1, 12))) for _ in range(4000)]
    flat += [b"a" * n for n in range(1, 300)] + [b"b" * (LONG_WORD + 1), b"a" * 5000] * 2
    words = chunk([b" ".join(flat[:2000]), b"  ".join(flat[2000:])])
    seen = {}
    for word, mark in zip(flat, words.marks.tolist()):
        assert seen.setdefault(word, mark) == mark
    assert len(set(seen.values())) == len(seen)


def test_long_words_that_sums_cannot_tell_apart():
    """Thue-Morse words and their complements have equal polynomial sums modulo 2^64."""
    word = b"a"
    for _ in range(11):
        word += word.translate(bytes.maketrans(b"ab", b"ba"))
    other = word.translate(bytes.maketrans(b"ab", b"ba"))
    marks = chunk([word + b" " + other + b" " + word]).marks
    assert marks[0] == marks[2] != marks[1]
