import random

import numpy as np

from trackspark.llm import common
from trackspark.llm.common import word_hashes


def test_words_are_those_of_a_split_and_equal_words_have_equal_hashes(monkeypatch):
    rng = random.Random(4)
    letters = ["a", "b", "é", "中", " ", "\n", "\t", "\r", "\x0b", "\x0c", "\x1c", "\x85", "\xa0", "\x00"]
    names: dict[bytes, int] = {}
    for piece in (1 << 20, 5):
        monkeypatch.setattr(common, "PIECE", piece)
        for _ in range(300):
            text = "".join(rng.choice(letters) for _ in range(rng.randrange(60))).encode()
            words = text.split()
            hashes = word_hashes(text)
            assert len(hashes) == len(words)
            for word, value in zip(words, hashes.tolist(), strict=True):
                assert names.setdefault(word, value) == value
    assert len(set(names.values())) == len(names) > 1000


def test_no_collisions_among_many_words():
    words = b" ".join(b"%d" % i for i in range(300_000)) + b" " + b" ".join(bytes([97 + i % 2] * (i + 1)) for i in range(500))
    assert len(np.unique(word_hashes(words))) == 300_500
