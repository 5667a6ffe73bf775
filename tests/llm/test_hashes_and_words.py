"""Hashes of many slices at once, partial fingerprints and the words of the toxicity scorer, against plain ways."""

from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash

from tests.llm.frames import texts
from tidalbook.llm import simhash, toxicity

ODD = [text for _, text in texts()] + ["Ä_ß9x²y İstanbul ×a÷b «c» naïve’s – 東京タワー abc٣def", "x\x1cy\x85z ªµº ǅungla ɐbc", " a\x0b\x0cb  c\r\nd ", "idio idiots İdiots"]


@pytest.mark.parametrize("seed", [0, 42, 2**64 - 1])
def test_slices_hash_as_one_by_one(seed):
    rng = random.Random(seed)
    data = rng.randbytes(3000)
    bounds = [sorted((rng.randrange(3001), rng.randrange(3001))) for _ in range(300)] + [(k, min(k + n, 3000)) for n in range(70) for k in (0, 5, 2999)] + [(3000, 3000), (0, 3000)]
    starts, ends = (np.array(side) for side in zip(*bounds, strict=True))
    assert simhash.xxh64_slices(data, starts, ends, seed).tolist() == [xxhash.xxh64_intdigest(data[a:b], seed) for a, b in bounds]
    assert len(simhash.xxh64_slices(b"", starts[:0], ends[:0])) == 0


@pytest.mark.parametrize("size", [1, 3, 5])
@pytest.mark.parametrize("at_once", [1, 20, 1 << 13])
def test_shingles_of_many_texts_hash_as_one_by_one(monkeypatch, size, at_once):
    monkeypatch.setattr(simhash, "WORDS_AT_ONCE", at_once)
    got = [h.tolist() for h in simhash.shingle_hashes_of(ODD, size)]
    for text, hashes in zip(ODD, got, strict=True):
        words = (text or "").encode().lower().split()
        shingles = [b" ".join(words[k : k + size]) for k in range(max(len(words) - size + 1, 1))] if words else []
        assert hashes == [xxhash.xxh64_intdigest(s, 42) for s in shingles]


def test_partial_fingerprints_are_majorities_of_the_least():
    rng = np.random.default_rng(3)
    for n in (1, 3, 4, 5, 400):
        distinct = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
        least = [distinct[np.argsort(distinct * factor)[: simhash.LEAST]] for factor in simhash.FACTORS]
        assert simhash.partial_fingerprints(distinct) == [simhash.majority(part) for part in least]


def test_words_of_a_text_in_bytes_are_those_of_the_features():
    for text in ODD:
        assert {w.decode() for w in toxicity.encoded_words(text)} == toxicity.features(text)[0]
