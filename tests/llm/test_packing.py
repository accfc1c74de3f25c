from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from tarmac.llm import packing
from tarmac.llm.queries import VOCABULARY


def padding(lengths, size=1024):
    """Ids added: none if a sequence is as long as a power of two."""
    return sum(0 if n & (n - 1) == 0 else size - n for n in lengths)


@pytest.mark.parametrize("buckets", (100_000, 10))
def test_round_trip(docs_of, monkeypatch, buckets):
    from tokenizers import Tokenizer

    monkeypatch.setattr(packing, "BUCKET", buckets)
    rng = random.Random(1)
    texts = ["", "a", "<|endoftext|>", "é\n\n漢字   x", *("word " * rng.randrange(1, 3000) for _ in range(200))]
    tokenizer = Tokenizer.from_file(VOCABULARY)
    ids = [[*tokenizer.encode(t, add_special_tokens=False).ids, 0] for t in texts]
    got = packing.pack(docs_of(*texts), VOCABULARY).collect()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        part = np.array(ids[r["doc_id"]][r["start"] : r["start"] + r["length"]], "<u4")
        assert zlib.crc32(part.tobytes()) == r["ids_crc32"] and r["doc_tokens"] == len(ids[r["doc_id"]])
        pieces[r["doc_id"]].append((r["start"], r["length"]))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for k, own in enumerate(ids):
        at = 0
        for start, length in sorted(pieces[k]):
            assert start == at
            at += length
        assert at == len(own)
    filled = []
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 1024
        filled.append(at)
    assert sorted(sequences) == list(range(len(sequences)))
    assert padding(filled) < 0.05 * sum(map(len, ids))


def test_patterns_place_every_piece():
    rng = random.Random(2)
    histogram = {rng.randrange(1, 1025): rng.randrange(1, 50_000) for _ in range(700)}
    packs = packing.patterns(histogram)
    placed = defaultdict(int)
    for n, pattern in packs:
        assert n > 0 and sum(pattern) <= 1024
        for length in pattern:
            placed[length] += n
    assert placed == histogram
    assert len(packs) < 5_000


def test_ids_equal_those_of_tokenizers():
    from hypothesis import given, settings
    from hypothesis import strategies as st
    from tokenizers import Tokenizer

    tokenizer, encode = Tokenizer.from_file(VOCABULARY), packing.encoder(VOCABULARY)

    @settings(max_examples=300, deadline=None)
    @given(st.text(st.characters(exclude_categories=("Cs", "Cn", "Co"))))
    def same(text):
        assert list(encode(text)) == tokenizer.encode(text, add_special_tokens=False).ids

    same()
