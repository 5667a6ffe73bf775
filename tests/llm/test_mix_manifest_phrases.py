"""Mixing, the Merkle manifest and phrase mining against plain versions, on tables with the cases that they must survive."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL, rows_of
from tests.llm.frames import documents, nothing
from tidalbook.llm import merkle, mixing, ordering, phrases
from tidalbook.llm.queries import CURRICULUM

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint, tree string, idx int, row_id string, carried_text int"


def odd_docs(spark):
    """Null columns, repeated rows, equal ids, a large source, empty and long texts, columns that clash."""
    rng = random.Random(5)
    words = ["Red", "blue", "green", "tea", "Ä", "of", "the", "b\x85c"]
    rows = []
    for k in range(160):
        text = " ".join(rng.choice(words) + rng.choice(["", "", "", ",", ".\n", "\t", "!"]) for _ in range(rng.randrange(30)))
        rows.append((k, text, ("en", "de", None, "é", "und")[min(k % 7, 4)], ("web", "web", "web", "code", None, "zoo")[k % 6], len(text)))
    rows += [rows[3], rows[3], (3, "other text", "en", "web", 1), (None, None, None, None, None), (None, "the tea", "en", "web", None), (900, "", "x", "empty", 0)]
    rows.append((901, "blue tea of " * 4000, "en", "tiny", 48_000))
    return spark.createDataFrame([(*r, "t", 1, "r", 2) for r in rows], COLUMNS).repartition(5)


@pytest.mark.parametrize("keys", [[], ["lang"]])
def test_numbers_are_places_in_the_order(spark, keys):
    got = ordering.numbered(odd_docs(spark), keys, ["n_chars", "text"], "place").collect()
    seen = defaultdict(list)
    for r in got:
        seen[r.lang if keys else 0].append((r.place, r.n_chars is not None, r.n_chars, r.text is not None, r.text))
    for rows in seen.values():
        rows.sort()
        assert [r[0] for r in rows] == list(range(len(rows)))
        assert [r[1:] for r in rows] == sorted([r[1:] for r in rows], key=lambda r: (r[0], r[1] or 0, r[2], (r[3] or "").encode()))
    assert ordering.numbered(nothing(odd_docs(spark)), keys, ["n_chars"], "place").count() == 0


def plain_targets(size_of, weights, repeats=3):
    """Sharing again and again until no target is above its bound."""
    names = sorted(size_of, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    closed, total = {}, sum(size_of.values())
    while True:
        rest, open_w = total - sum(closed.values()), sum(w for s, w in weight.items() if s not in closed)
        got = {s: closed[s] if s in closed else rest * weight[s] / open_w for s in names}
        above = [s for s in names if s not in closed and got[s] >= repeats * size_of[s]]
        if not above:
            return got
        closed.update({s: repeats * size_of[s] for s in above})


def test_mix_fills_targets_and_bounds(spark):
    docs = odd_docs(spark)
    size = lambda t: len(re.findall(r"[^ \t-\r]+", t or ""))
    size_of = Counter()
    for r in docs.collect():
        size_of[r.source] += size(r.text)
    want = plain_targets(size_of, [mixing.integral(s) for s in CURRICULUM])
    report = mixing.mix_report(docs, CURRICULUM)
    got = report.collect()
    assert sorted((r.doc_id is not None, r.doc_id, r.size) for r in got) == sorted((r.doc_id is not None, r.doc_id, size(r.text)) for r in docs.collect())
    assert all(0 <= r.taken <= 3 * r.size for r in got)
    assert {round(r.target, 6) for r in got} == {round(t, 6) for t in want.values()}
    for target in {r.target for r in got}:
        named = [s for s, t in want.items() if abs(t - target) < 1e-6]
        assert abs(sum(r.taken for r in got if r.target == target) - target * len(named)) <= 0.5 * len(named)
    again = mixing.mix_report(docs.repartition(3), CURRICULUM)
    assert rows_of(again) == rows_of(report)
    empty = mixing.mix_report(nothing(docs), CURRICULUM)
    assert empty.count() == 0 and empty.schema == report.schema


def test_mix_follows_the_schedules(spark):
    rows = [(k, " ".join(["w"] * 20), "en", "abc"[k % 3], 1, "t", 1, "r", 2) for k in range(900)]
    docs = spark.createDataFrame(rows, COLUMNS)
    schedules = (((0, 4), (1, 0)), ((0, 1), (0.5, 1), (1, 3)), ((0, 0), (0.25, 2), (1, 2)))
    order = mixing.mix(docs, schedules, carry=["text"]).collect()
    assert [r.position for r in order] == sorted(r.position for r in order)
    assert all(r.carried_text == rows[0][1] for r in order)
    total = 900 * 20
    weights = [mixing.integral(s) for s in schedules]
    assert weights == [2.0, 1.5, 1.75]
    for name, schedule, weight in zip("abc", schedules, weights, strict=True):
        of = [r for r in order if r.source == name]
        assert abs(sum(r.words for r in of) - total * weight / sum(weights)) < 1
        for t in (0.1, 0.25, 0.5, 0.8):
            knots = [(a, b) for a, b in schedule if a < t]
            (t0, w0), (t1, w1) = knots[-1], next(k for k in schedule if k[0] >= t)
            at = w0 + (w1 - w0) * (t - t0) / (t1 - t0)
            reached = mixing.integral([*[((a - 0) / t, b) for a, b in knots], (1, at)]) * t
            assert abs(sum(r.words for r in of if r.position < t) - total * reached / sum(weights)) < 25, (name, t)
    with pytest.raises(ValueError, match="not a schedule"):
        mixing.integral(((0, 1), (0.5, 2)))


def plain_manifest(rows, fanout):
    told = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    sha = lambda *parts: hashlib.sha256("".join(parts).encode()).hexdigest()
    trees, out = defaultdict(list), []
    for r in rows:
        leaf = sha(*[told(v) for v in (r.doc_id, r.source, r.lang, r.n_chars, r.text)])
        cut = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 7 == 0 and r.n_chars is not None
        trees[r.lang].append((r.doc_id, leaf, sha(*[told(v) for v in (r.doc_id, r.source, r.lang, r.n_chars + 1, r.text)]) if cut else leaf))

    def build(leaves):
        levels = [leaves]
        while len(levels[-1]) > 1:
            levels.append([sha(*levels[-1][k : k + fanout]) for k in range(0, len(levels[-1]), fanout)])
        return levels

    def fold(levels, at, cur):
        proof = []
        for level in levels[:-1]:
            first = at - at % fanout
            run = level[first : first + fanout]
            proof += [d for k, d in enumerate(run) if k != at - first]
            run[at - first] = cur
            cur, at = sha(*run), at // fanout
        return proof, cur

    names = sorted(trees, key=lambda n: (n is not None, (n or "").encode()))
    built = {}
    for name in names:
        trees[name].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        built[name] = build([leaf for _, leaf, _ in trees[name]])
    top = build([built[n][-1][0] for n in names])
    for no, name in enumerate(names):
        for at, (doc_id, leaf, other) in enumerate(trees[name]):
            low, cur = fold(built[name], at, other)
            high, cur = fold(top, no, cur)
            out.append((doc_id, leaf, built[name][-1][0], top[-1][0], sha(*low, *high), cur, cur == top[-1][0]))
    return sorted(out, key=str)


@pytest.mark.parametrize("fanout", [2, 3, 8])
def test_manifest_equals_plain_trees(spark, fanout):
    docs = odd_docs(spark)
    changed = F.when(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    got = merkle.verified_manifest(docs, changed, fanout=fanout)
    assert sorted([tuple(r) for r in got.collect()], key=str) == plain_manifest(docs.collect(), fanout)


def test_manifest_of_little(spark):
    docs = odd_docs(spark)
    assert merkle.verified_manifest(nothing(docs)).count() == 0
    one = merkle.verified_manifest(docs.where("doc_id = 900")).first()
    assert one.leaf == one.subroot == one.root == one.folded_root and one.verified
    assert one.proof_sha256 == hashlib.sha256(b"").hexdigest()
    assert merkle.verified_manifest(docs).where("verified").count() == docs.count()
    long = documents(spark)
    assert merkle.verified_manifest(long).where("verified").count() == long.count()


def plain_phrases(rows, min_count, max_words, top, covered):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n-\r]", low):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for k in range(1, max_words + 1):
                f.update((lang, tuple(words[s : s + k])) for s in range(len(words) - k + 1))
    found = {p: a for p, a in f.items() if len(p[1]) > 1 and a >= min_count}
    inside = lambda p, q: len(q) > len(p) and any(q[s : s + len(p)] == p for s in range(len(q) - len(p) + 1))
    out = defaultdict(list)
    for (lang, p), a in found.items():
        if any(la == lang and inside(p, q) and 100 * b >= covered * a for (la, q), b in found.items()):
            continue
        cuts = [(1_000_000 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        out[lang].append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return sorted((lang, rank, p.decode(), -a, left, right, n[lang], -score) for lang, rows in out.items() for rank, (score, a, p, left, right) in enumerate(sorted(rows)[:top], 1))


@pytest.mark.parametrize(("min_count", "max_words", "top", "covered"), [(10, 3, 2000, 50), (3, 4, 2000, 50), (2, 2, 7, 90), (4, 3, 3, 30)])
def test_phrases_equal_plain_counts(spark, min_count, max_words, top, covered):
    docs = odd_docs(spark)
    want = plain_phrases([(r.lang, r.text) for r in docs.collect()], min_count, max_words, top, covered)
    for block in (phrases.BLOCK_BYTES, 200):
        got = phrases.collocations(docs, min_count, max_words, top, covered, block)
        assert sorted(tuple(r) for r in got.collect()) == want and want


def test_phrases_whatever_the_bitmap_lets_through(spark, monkeypatch):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    want = rows_of(phrases.collocations(docs))
    monkeypatch.setattr(phrases, "_bitmap", lambda spark, frequent: b"\xff" * 1024)
    assert rows_of(phrases.collocations(docs)) == want
    assert phrases.collocations(nothing(docs)).count() == 0
    assert phrases.collocations(documents(spark, [(1, None), (2, ""), (None, " .,! \n")])).count() == 0


def test_phrase_products_pass_64_bits(spark):
    level = lambda *rows: spark.createDataFrame(list(rows), "lang string, phrase string, f bigint")
    big = 3_000_000_000
    got = phrases.scored([level(("en", "a", big + 1), ("en", "b", big + 7)), level(("en", "a b", big))]).first()
    assert got.score == 1_000_000 * big * big // ((big + 1) * (big + 7)) and (got.l, got.r) == (big + 1, big + 7)
