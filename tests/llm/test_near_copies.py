"""Near copies of similarity 0.8: recall against brute force, on layouts that are hard for buckets."""

from __future__ import annotations

import random
from itertools import combinations

import pytest

from tests.llm.frames import documents
from tidalbook.llm import simhash


def words_of(rng: random.Random, n: int) -> list[str]:
    return ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=7)) for _ in range(n)]


def changed(rng: random.Random, words: list[str], n: int) -> list[str]:
    out = list(words)
    for place in rng.sample(range(len(out)), n):
        out[place] = words_of(rng, 1)[0]
    return out


def shingles(text: str) -> set[tuple[str, ...]]:
    words = text.lower().split()
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))}


def brute(rows: list[tuple[int, str]], similarity: float = 0.8) -> dict[int, int]:
    root = {i: i for i, _ in rows}

    def top(i: int) -> int:
        while root[i] != i:
            i = root[i]
        return i

    sets = {i: shingles(t) for i, t in rows}
    prints = {i: simhash.fingerprint(t, 5) for i, t in rows}
    for a, b in combinations(sorted(root), 2):
        common = len(sets[a] & sets[b])
        if common >= similarity * (len(sets[a]) + len(sets[b]) - common) or (prints[a] ^ prints[b]).bit_count() <= 2:
            low, high = sorted((top(a), top(b)))
            root[high] = low
    return {i: top(i) for i in root}


def found(spark, rows: list[tuple[int, str]]) -> dict[int, int]:
    return {r.doc_id: r.component_id for r in simhash.near_duplicates(documents(spark, rows), 5, similarity=0.8).collect()}


@pytest.mark.parametrize("share", [0.5, 0.7, 0.78, 0.84, 0.88])
def test_pairs_are_found_among_texts_that_share_a_long_passage(spark, share):
    rng = random.Random(7)
    passage = words_of(rng, int(200 * share))
    rows = []
    for k in range(120):
        own = words_of(rng, 200 - len(passage))
        for copy in range(2):
            rows.append((2 * k + copy, " ".join(passage + changed(rng, own, min(3, len(own) // 8) * copy))))
    rng.shuffle(rows)
    want, got = brute(rows), found(spark, rows)
    linked = [i for i, r in want.items() if i != r]
    assert len(linked) >= 100
    assert sum(got[i] != i for i in linked) >= 0.99 * len(linked)
    assert all(got[i] == i for i, r in want.items() if i == r)


def test_a_family_is_joined_whatever_place_its_hub_has(spark):
    rng = random.Random(11)
    base = words_of(rng, 200)
    rows = [(k, " ".join(base if k == 20 else changed(rng, base, 4))) for k in range(41)]
    got = found(spark, rows)
    assert set(got.values()) == {0}


def test_components_equal_brute_force_on_mixed_texts(spark):
    rng = random.Random(3)
    rows, pool = [], [words_of(rng, n) for n in (3, 5, 6, 12, 40, 90, 300)]
    for k in range(150):
        base = rng.choice(pool)
        rows.append((k, " ".join(changed(rng, base, rng.choice([0, 0, 1, 2, len(base) // 3])))))
    assert found(spark, rows) == brute(rows)


def test_pairs_of_the_prefix_join_are_complete(spark):
    rng = random.Random(5)
    base = words_of(rng, 60)
    texts = [" ".join(changed(rng, base, rng.randrange(5))) for _ in range(60)]
    rows = list(enumerate(texts))
    docs = documents(spark, rows)
    ids = spark.createDataFrame([(i, i) for i, _ in rows], "node bigint, root bigint")
    sets = simhash._shingle_sets(docs, ids.select("node"), 5)
    pairs = simhash._similar(sets, simhash._prefix_pairs(sets, ids, 0.8), 0.8)
    own = [shingles(t) for t in texts]
    want = {(a, b) for a, b in combinations(range(60), 2) if len(own[a] & own[b]) >= 0.8 * len(own[a] | own[b])}
    assert {(r.a, r.b) for r in pairs.collect()} == want
