"""Best-fit packing against the tokenizer itself and a brute-force packer."""

import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from marginlens.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, sequence_id string"


def brute(lengths, capacity, open_bins):
    """The same rules over a plain list of open bins (last opened or filled first among equals)."""
    out, bins, made = [], [], 0
    for n in lengths:
        fit = [b for b in bins if b[1] >= n]
        if fit:
            best = min(b[1] for b in fit)
            b = [x for x in bins if x[1] == best][-1]
            bins.remove(b)
        else:
            if len(bins) >= open_bins:
                least = min(b[1] for b in bins)
                bins.remove([x for x in bins if x[1] == least][-1])
            b, made = [made, capacity], made + 1
        out.append((b[0], capacity - b[1]))
        b[1] -= n
        if b[1]:
            bins.append(b)
    return out


def test_best_fit_equals_brute_force():
    rnd = random.Random(3)
    for open_bins in (1, 3, 50):
        lengths = [rnd.choice([rnd.randint(1, 16), 16, rnd.randint(1, 4)]) for _ in range(400)]
        bins, offsets = packing.best_fit(lengths, 16, open_bins)
        assert list(zip(bins.tolist(), offsets.tolist())) == brute(lengths, 16, open_bins)


def test_encoder_equals_tokenizer_on_odd_white_space_and_specials():
    rnd = random.Random(5)
    tokenizer, encode = Tokenizer.from_file(PATH), packing.text_encoder(PATH)
    alphabet = ["a", "Word", "'s", "'", "é", "中", "7", " ", "  ", "\n", "\t", "\r\n", "\xa0", "　", "\x1c", "!!", "."]
    for _ in range(3000):
        text = "".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 12)))
        assert np.frombuffer(encode(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)
    for text in ("x<|endoftext|>y", ""):
        assert np.frombuffer(encode(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_pieces_cover_documents_and_sequences(spark):
    texts = [None, "", "a b c", "word " * 3000, "word " * 3000, "x" * 1021]
    rows = [(i if i != 2 else None, t, "clash") for i, t in enumerate(texts)] + [(1, "", "clash")]
    got = packing.pack_documents(spark.createDataFrame(rows, SCHEMA), PATH, capacity=64, keep_ids=True).collect()
    tokenizer = Tokenizer.from_file(PATH)
    want = {}
    for i, t, _ in rows:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [2]
        want.setdefault((i, tuple(ids)), 0)
        want[(i, tuple(ids))] += 1
    docs = {}
    for r in got:
        docs.setdefault((r.doc_id, r.piece, r.start, r.length, bytes(r.ids)), 0)
        docs[(r.doc_id, r.piece, r.start, r.length, bytes(r.ids))] += 1
        assert zlib.crc32(r.ids) == r.ids_crc32 and 1 <= r.length <= 64
    for (i, ids), n in want.items():
        for k, (start, length) in enumerate(packing.cut_points(len(ids), 64)):
            part = np.asarray(ids[start:start + length], "<u4").tobytes()
            assert docs.pop((i, k, start, length, part)) == n
            assert length == 64 or k == 0
    assert not docs
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in by.values():
        end = 0
        for offset, length in sorted(spans):
            assert offset == end
            end += length
        assert end <= 64


def test_empty_table(spark):
    assert packing.pack_documents(spark.createDataFrame([], SCHEMA), PATH).collect() == []
