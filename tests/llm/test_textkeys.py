"""Vectorised word and shingle keys against plain Python."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from marginlens.llm import textkeys

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def ascii_lower(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


@pytest.mark.parametrize("stretch", [7, 64, 1 << 21])
def test_keys_name_words(monkeypatch, stretch):
    monkeypatch.setattr(textkeys, "STRETCH", stretch)
    rnd = random.Random(1)
    texts = [None, "", " \t\n", "One"] + ["".join(rnd.choice(["A", "a", "É", "é", " ", "\n", "中", "\x85", "\x1c", "b"])
                                         for _ in range(rnd.randint(0, 60))) for _ in range(300)]
    column = pa.array(["skipped", *texts]).slice(1)
    name = {}
    for lower in (True, False):
        for text, keys in zip(texts, textkeys.word_keys(column, lower), strict=True):
            words = WORD.findall(ascii_lower(text or "") if lower else text or "")
            assert len(words) == len(keys)
            for w, k in zip(words, keys.tolist()):
                assert name.setdefault(w, k) == k
    assert len(set(name.values())) == len(name)


def test_shingles():
    words = np.array([5, 6, 7, 5, 6, 7], np.uint64)
    keys = textkeys.shingle_keys(words, 3)
    assert len(keys) == 4 and keys[0] == keys[3] and len(set(keys.tolist())) == 3
    assert len(textkeys.shingle_keys(words[:2], 3)) == 1 and len(textkeys.shingle_keys(words[:0], 3)) == 0
