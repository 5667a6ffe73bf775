"""Toxicity, line dedup, SimHash and the pipeline: against brute force and held-out labels."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tests.conftest import SMALL, rows_of
from tests.llm.frames import documents, nothing, texts
from tidalbook.llm import decontam, line_dedup, queries, simhash, toxicity
from tidalbook.llm._shared import table, with_mark

MIDDLE, LARGE = "/root/testdata/sf0.01", "/root/testdata/sf0.1"


def test_toxicity_on_held_out_rows(spark):
    got = {r.doc_id: r for r in queries.op3_toxicity(spark, MIDDLE).collect()}
    labels = [r for r in spark.read.parquet(f"{MIDDLE}/labels.parquet").collect() if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert all(got[r.doc_id].held_out for r in labels)
    assert len(got) == spark.read.parquet(f"{MIDDLE}/documents.parquet").count()
    right = sum(got[r.doc_id].predicted == r.toxic for r in labels)
    assert right >= 0.9 * len(labels)
    got = {r.doc_id: r for r in queries.op3_toxicity(spark, LARGE).collect()}
    labels = [r for r in spark.read.parquet(f"{LARGE}/labels.parquet").collect() if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    for side in (0, 1):
        said, true = ({r.doc_id for r in labels if (got[r.doc_id].predicted if which else r.toxic) == side} for which in (1, 0))
        assert len(said & true) >= 0.85 * len(said) and len(said & true) >= 0.85 * len(true)
    assert all(r.predicted == (r.score >= 0.5) and 0 <= r.score <= 1 for r in got.values())


def test_toxicity_outvotes_wrong_labels(spark):
    docs, labels = table(spark, "/root/testdata/sf0.1", "documents"), table(spark, "/root/testdata/sf0.1", "labels")
    wrong = "pmod(xxhash64(doc_id, 3), 12) = 0 and crc32(cast(doc_id as string)) % 5 <> 0"
    noisy = labels.selectExpr("doc_id", f"case when {wrong} then 1 - toxic else toxic end as toxic")
    sample = toxicity.stored(toxicity.training_sample(docs, noisy), "sample")
    votes, gold, weight = toxicity._vote_table(sample, *toxicity.mine_voters(sample))
    posterior, _ = toxicity.label_model(votes, gold, weight=weight)
    assert ((posterior > 0.5) != (gold == 1)).mean() > 0.02
    got = toxicity.score_toxicity(docs, noisy).where("held_out").join(labels, "doc_id").groupBy("toxic", "predicted").count().collect()
    n = {(r.toxic, r.predicted): r["count"] for r in got}
    assert n[1, 1] >= 0.65 * (n[1, 1] + n.get((1, 0), 0)) and n[1, 1] >= 0.9 * (n[1, 1] + n.get((0, 1), 0))


def brute_em(votes, gold, rounds):
    """The model's independent case in plain loops: voters that never fire together have no share to give away."""
    right, wrong = toxicity.GOLD_PRIOR
    post = [(right if g else wrong) / (right + wrong) for g in gold]
    for _ in range(rounds):
        toxic, clean = sum(post), sum(1 - p for p in post)
        rates = [((sum(v[k] * p for v, p in zip(votes, post, strict=True)) + 0.5) / (toxic + 1), (sum(v[k] * (1 - p) for v, p in zip(votes, post, strict=True)) + 0.5) / (clean + 1)) for k in range(len(votes[0]))]
        sides = []
        for v in votes:
            yes, no = toxic, clean
            for x, (a, b) in zip(v, rates, strict=True):
                yes, no = yes * (a if x else 1 - a), no * (b if x else 1 - b)
            sides.append((yes, no))
        voted = [yes / (yes + no) for yes, no in sides]
        caught = (sum(p * g for p, g in zip(voted, gold, strict=True)) + right) / (sum(voted) + right + wrong)
        blamed = (sum((1 - p) * g for p, g in zip(voted, gold, strict=True)) + wrong) / (sum(1 - p for p in voted) + right + wrong)
        post = []
        for (yes, no), g in zip(sides, gold, strict=True):
            yes, no = yes * (caught if g else 1 - caught), no * (blamed if g else 1 - blamed)
            post.append(yes / (yes + no))
    return post


def test_label_model_equals_plain_loops():
    votes = np.array([[1.0]] * 30 + [[0.0]] * 70)
    gold = np.array([1] * 25 + [0] * 5 + [1] * 3 + [0] * 67)
    got, _ = toxicity.label_model(votes, gold, rounds=5)
    assert got == pytest.approx(brute_em(votes.tolist(), gold.tolist(), 5), abs=1e-3)
    rng = np.random.default_rng(6)
    hidden = rng.random(1500) < 0.3
    votes = np.column_stack([np.where(hidden, rng.random(1500) < 0.8, rng.random(1500) < 0.05) for _ in range(6)]).astype(float)
    gold = np.where(rng.random(1500) < 0.2, ~hidden, hidden).astype(int)
    posterior, _ = toxicity.label_model(votes, gold)
    assert ((posterior > 0.5) == hidden).mean() > 0.95 > (gold == hidden).mean()


def test_a_doc_id_with_very_many_rows_is_one_row_of_the_sample(spark):
    docs = spark.range(5000).selectExpr("1 as doc_id", "concat('text ', id) as text").union(spark.sql("select 2, 'other'"))
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id bigint, toxic int")
    assert toxicity.training_sample(docs, labels).count() <= 2


def test_toxicity_learns_nothing_from_held_out_labels(spark):
    docs, labels = table(spark, SMALL, "documents"), table(spark, SMALL, "labels")
    turned = labels.selectExpr("doc_id", "quality", "case when crc32(cast(doc_id as string)) % 5 = 0 then 1 - toxic else toxic end as toxic")
    assert rows_of(toxicity.score_toxicity(docs, labels)) == rows_of(toxicity.score_toxicity(docs, turned))


def test_toxicity_cases(spark):
    docs = documents(spark)
    for labels in ("doc_id bigint, toxic int",):
        none = spark.createDataFrame([], labels)
        assert toxicity.score_toxicity(docs, none).count() == len(texts())
        some = spark.createDataFrame([(1, 1), (1, None), (None, 1), (8, 0), (77, 1)], labels)
        got = toxicity.score_toxicity(docs, some)
        assert got.where("score is null").count() == 0
        kept = toxicity.drop_toxic(docs, some)
        assert kept.schema == docs.schema
        assert toxicity.score_toxicity(nothing(docs), some).count() == 0


def test_label_model_finds_hidden_labels():
    rng = np.random.default_rng(5)
    hidden = rng.random(2000) < 0.3
    votes = np.column_stack([np.where(hidden, rng.random(2000) < a, rng.random(2000) < b) for a, b in ((0.8, 0.05), (0.6, 0.02), (0.7, 0.1), (0.5, 0.01))]).astype(float)
    votes = np.column_stack([votes, votes[:, 0]])  # a voter that repeats another
    gold = np.where(rng.random(2000) < 0.05, ~hidden, hidden).astype(int)
    posterior, correlated = toxicity.label_model(votes, gold)
    assert ((posterior > 0.5) == hidden).mean() > (gold == hidden).mean()
    assert correlated[0, 4] > 0.95


def test_toxicity_rejects_alike_whatever_the_bound_of_the_sample(spark):
    docs, labels = (table(spark, "/root/testdata/sf0.1", name) for name in ("documents", "labels"))
    share = {r.rows: r.share for rows in (300, 8000) for r in toxicity.score_toxicity(docs, labels, rows).agg(F.lit(rows).alias("rows"), F.avg("predicted").alias("share")).collect()}
    assert share[300] == pytest.approx(share[8000], rel=0.15)


def check_lines(rows, got, depth=3, similarity=0.8):
    """Hold texts without their recurring lines against all pairs of lines of a leaf.

    Whatever goes has an earlier line of its template, or one of a founder that
    it is like and whose family recurs. Of what stays, no recurring template has
    two lines, and no two lines of one leaf, of other documents and long enough,
    are alike.
    """
    left = dict(got)
    assert len(left) == len(got) == len(rows) == len({doc for doc, _ in rows})
    lines = []
    for doc, text in rows:
        assert (text is None) == (left[doc] is None)
        stays = (left[doc] or "").split("\n") if left[doc] != "" else []
        at = 0
        for number, line in enumerate((text or "").split("\n")):
            whole = tuple(t for t in line.split() if t)
            tokens = tuple("<*>" if re.search("[0-9]", t) else t for t in whole)
            kept = at < len(stays) and stays[at] == line
            at += kept
            if whole:
                lines.append(((doc is not None, doc or 0), number, whole if set(tokens) == {"<*>"} else tokens, kept))
            else:
                assert kept or (text or "") == line
        assert at == len(stays)
    where, first, kept_lines = defaultdict(set), {}, defaultdict(list)
    for doc, number, t, kept in lines:
        where[t].add(doc)
        first[t] = min(first.get(t, (doc, number)), (doc, number))
        if kept:
            kept_lines[t].append((doc, number))
    enough = lambda t: 2 if len(t) >= 8 else 20
    leaves = defaultdict(list)
    for t in where:
        leaves[(len(t), t[:depth])].append(t)
    for (size, _), leaf in leaves.items():
        need = -(-round(similarity * size * 10**6) // 10**6)
        alike = defaultdict(list)
        for k, t in enumerate(leaf):
            for u in leaf[:k] if size > depth else ():
                if sum(a == b != "<*>" for a, b in zip(t, u, strict=True)) >= need:
                    alike[t].append(u)
                    alike[u].append(t)
        families = {t: set().union(where[t], *(where[u] for u in alike[t])) for t in leaf}
        for t in leaf:
            founders = [u for u in alike[t] if first[u] < first[t] and len(families[u]) >= enough(t)]
            for doc, number, u, kept in lines:
                if u == t and not kept:
                    assert (doc, number) > first[t] and (len(where[t]) >= enough(t) or len(families[t]) >= enough(t) or founders) or founders, (t, doc)
            if len(where[t]) >= enough(t):
                assert len(kept_lines[t]) <= 1, t
            if size >= 8 and kept_lines[t]:
                twins = [u for u in alike[t] if kept_lines[u] and len(where[t] | where[u]) > 1]
                assert not twins, (t, twins)
    return sum(not kept for *_, kept in lines)


def made_lines(seed):
    rng = random.Random(seed)
    words = "alpha beta gamma delta".split()
    out = []
    for doc in range(40):
        lines = []
        for _ in range(rng.randint(0, 6)):
            line = [rng.choice(words[:2]) for _ in range(3)] + [rng.choice(["x", "y", "9", "k7"]) if rng.random() < 0.3 else w for w in "one two three four five six seven".split()[: rng.choice([2, 6, 7])]]
            lines.append((" " * rng.randint(1, 2)).join(line))
        out.append((doc, "\n".join(lines)))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_line_dedup_equals_brute_force(spark, seed):
    rows = made_lines(seed) + [(100, None), (101, ""), (102, "\n\n"), (None, "alpha beta gamma one two three four five six")]
    got = line_dedup.drop_recurring_lines(documents(spark, rows)).select("doc_id", "text").collect()
    assert check_lines(rows, [(r.doc_id, r.text) for r in got]) > 10


def test_two_families_of_lines_in_one_leaf_are_both_dropped(spark):
    names = [f"{a}{b}" for a in "bcdfg" for b in ("ar", "el")]
    one = [f"all users saw {n} leave the main office before noon today" for n in names]
    two = [f"all users saw rain fall on every\troof of {n} last night" for n in names]
    rows = list(enumerate(one + two)) + [(50, "all users saw something else that stands in no other line at all"), (51, None)]
    got = {r.doc_id: r.text for r in line_dedup.drop_recurring_lines(documents(spark, rows)).collect()}
    assert {i for i, t in got.items() if t} == {0, 10, 50}


@pytest.mark.parametrize(("size", "places"), [(10, (5, 7)), (10, (4, 6)), (10, (4, 10)), (30, range(4, 10)), (30, range(25, 31)), (30, (4, 8, 13, 17, 22, 30)), (101, range(9, 100, 5))])
def test_families_are_found_wherever_their_words_vary(spark, size, places):
    rng = random.Random(size)
    base = ["the", "old", "mill", *[rng.choice(["of", "grey", "stone", "by", "a", "brook"]) + rng.choice("xyz") for _ in range(size - 3)]]
    rows = [(doc, " ".join(f"v{'abcdefghijkl'[doc]}{'qrstuvwxyz'[k % 10]}" if k + 1 in places else t for k, t in enumerate(base))) for doc in range(12)]
    other = [(doc + 50, " ".join(t if k < 3 else t + "u" for k, t in enumerate(text.split()))) for doc, text in rows]  # a second family of the same leaf
    mixed = [*rows, *other, (99, " ".join([*base[:3], *reversed(base[3:])]))]
    got = [(r.doc_id, r.text) for r in line_dedup.drop_recurring_lines(documents(spark, mixed)).collect()]
    assert {doc for doc, text in got if text} == {0, 50, 99}
    assert check_lines(mixed, got) == 22


def test_line_dedup_without_broadcasts_is_the_same(spark, monkeypatch):
    rows = made_lines(3)
    want = rows_of(line_dedup.drop_recurring_lines(documents(spark, rows)))
    monkeypatch.setattr(line_dedup, "SMALL_PAIRS", 0)
    assert rows_of(line_dedup.drop_recurring_lines(documents(spark, rows))) == want


def test_line_dedup_query(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    got = queries.op5_line_dedup(spark, SMALL).collect()
    assert check_lines([(r.doc_id, r.text) for r in docs], [(r.doc_id, r.text) for r in got]) > 40
    assert all(r.n_chars == len(r.text) for r in got if r.text is not None and r.text not in {d.text for d in docs})


def test_line_dedup_cases(spark):
    docs = documents(spark)
    got = line_dedup.drop_recurring_lines(docs)
    assert got.schema.names == docs.schema.names
    kept = {(r.doc_id, r.text) for r in got.collect()}
    assert (14, "") in kept and (5, None) in kept and (6, "") in kept
    assert got.count() == docs.count()
    assert line_dedup.drop_recurring_lines(nothing(docs)).count() == 0


def test_different_lines_of_fields_alone_stay(spark):
    row = lambda k: " ".join(str(1000 * k + j) for j in range(9))
    rows = [(k, f"{row(k)}\n{row(k + 500)}\n東京{k}番地\n{row(-1)}") for k in range(30)]
    got = {r.doc_id: r.text for r in line_dedup.drop_recurring_lines(documents(spark, rows)).collect()}
    assert got == {k: text if k == 0 else text.rsplit("\n", 1)[0] for k, text in rows}


def test_marks_hold_for_every_wanted_key_and_for_hardly_any_other(spark):
    keys = spark.range(40_000).selectExpr("xxhash64(id) AS key", "id")
    wanted = keys.where("id % 3 = 0").select("key")
    got = with_mark(keys, F.col("key"), wanted, "mark").selectExpr("count_if(mark and id % 3 = 0)", "count_if(mark and id % 3 <> 0)", "count(*)").first()
    assert got[0] == 13_334 and got[1] < 100 and got[2] == 40_000
    assert with_mark(keys, F.col("key"), wanted.limit(0), "mark").where("mark").count() == 0


def brute_print(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[k : k + size]) for k in range(max(1, len(words) - size + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def similarity_of(a, b):
    x, y = ({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set() for w in (a.lower().split(), b.lower().split()))
    return len(x & y) / max(1, len(x | y))


def brute_components(prints, radius=2, texts=None):
    """prints: (doc_id, fingerprint) -> doc_id -> smallest doc_id reachable; texts: also by similarity."""
    root = {i: i for i, _ in prints}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for k, (i, a) in enumerate(prints):
        for j, b in prints[:k]:
            if (a ^ b).bit_count() <= radius or texts and similarity_of(texts[i], texts[j]) >= 0.8:
                x, y = sorted((top(i), top(j)))
                root[y] = x
    return {i: top(i) for i in root}


def test_simhash_query(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    prints = [(r.doc_id, brute_print(r.text, 3)) for r in docs]
    want = brute_components(prints)
    got = queries.op10_simhash(spark, SMALL).collect()
    assert sorted((r.doc_id, r.fingerprint, r.component_id) for r in got) == sorted((i, f"{p:016x}", want[i]) for i, p in prints)


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def test_keep_one_finds_similar_texts(spark):
    rng = random.Random(8)
    rows, bases = [], [[f"w{rng.randrange(5000)}" for _ in range(n)] for n in (60, 120, 200, 400, 900)]
    for base in bases:
        rows += [(len(rows) + k, edited(rng, base, k % 4 * len(base) // 100)) for k in range(40)]
    rows += [(1000 + k, edited(rng, bases[k % 5], len(bases[k % 5]) // 4)) for k in range(20)]  # too different
    kept = {r.doc_id for r in simhash.keep_one(documents(spark, rows)).collect()}
    roots = brute_components([(i, brute_print(t, 5)) for i, t in rows], texts=dict(rows))
    assert kept == {i for i, root in roots.items() if i == root}
    assert len(kept) < len(rows) // 2


@pytest.mark.parametrize("variants", [40, 200])
def test_keep_one_joins_a_family_whose_hub_has_a_middle_id(spark, variants):
    rng = random.Random(21)
    base = [f"w{rng.randrange(5000)}" for _ in range(200)]
    rows = [(k, edited(rng, base, 4)) for k in range(variants)]
    rows = [(k, t) for k, t in rows if similarity_of(t, " ".join(base)) >= 0.8]
    rows.append((1000, " ".join(base)))
    rows = [(k if k < variants // 2 or k == 1000 else k + 2000, t) for k, t in rows]
    assert sorted(i for i, _ in rows).index(1000) in range(variants // 3, len(rows) - variants // 3)
    kept = {r.doc_id for r in simhash.keep_one(documents(spark, rows)).collect()}
    assert len(rows) > variants * 0.9 and len(kept) <= 1 + variants // 100


def test_keep_one_compares_all_members_that_differ(spark):
    rng = random.Random(22)
    shared = [f"w{k}" for k in range(120)]
    rows, pairs = [], 12
    for k in range(pairs):  # all share a passage; each has one near copy among the others
        words = [f"own{k}x{j}" for j in range(100)] + shared
        rows += [(k, " ".join(words)), (100 + k * 7 % pairs, edited(rng, words, 2))]
    kept = {r.doc_id for r in simhash.keep_one(documents(spark, rows)).collect()}
    roots = brute_components([(i, brute_print(t, 5)) for i, t in rows], texts=dict(rows))
    assert kept == {i for i, root in roots.items() if i == root} == set(range(pairs))


def test_keep_one_links_equal_sets_and_near_copies_of_texts_with_equal_fingerprints(spark):
    rng = random.Random(23)
    phrases = ["one red fox ran home", "ten old men sat down"]
    own = [[f"w{rng.randrange(10**6)}" for _ in range(200)] for _ in range(3)]
    rows = [(k, " ".join(own[2] + [phrases[0]] * (3, 60)[k] + [phrases[1]] * (60, 3)[k])) for k in range(2)]
    ruled = [" ".join(o) + " " + " ".join(["all work and no play"] * 900) for o in own[:2]]
    rows += [(10, ruled[0]), (11, ruled[1]), (12, edited(rng, own[1], 2) + " " + " ".join(["all work and no play"] * 3))]
    prints = {i: brute_print(t, 5) for i, t in rows}
    assert (prints[0] ^ prints[1]).bit_count() > 24 and prints[10] == prints[11]
    assert similarity_of(rows[0][1], rows[1][1]) == 1 and similarity_of(rows[3][1], rows[4][1]) >= 0.8
    assert {r.doc_id for r in simhash.keep_one(documents(spark, rows)).collect()} == {0, 10}


def test_near_chains_of_fingerprints(spark):
    rng = random.Random(11)
    prints, value = [], rng.getrandbits(64)
    for k in range(300):
        value = rng.getrandbits(64) if rng.random() < 0.05 else value ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64))
        prints.append((k * 7 % 300, value))
    want = brute_components(sorted(prints))
    nodes = spark.createDataFrame([(i, v - (1 << 64) if v >> 63 else v) for i, v in prints], "node bigint, fp bigint")
    found = {r.node: r.root for r in simhash.components(simhash.links(nodes)).collect()}
    assert {i: found.get(i, i) for i, _ in prints} == want


def test_bk_tree_finds_all_within_radius():
    rng = random.Random(2)
    values = list({rng.getrandbits(12) for _ in range(400)})
    tree = simhash.BKTree()
    for k, v in enumerate(values):
        assert sorted(tree.near_and_add(v, 2)) == [j for j in range(k) if (values[j] ^ v).bit_count() <= 2]


def test_simhash_cases(spark):
    docs = documents(spark)
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == len(texts())
    empty = {r.component_id for r in got if r.fp == 0}
    assert len(empty) == 1
    assert simhash.keep_one(docs).schema == docs.schema
    assert simhash.near_duplicates(nothing(docs)).count() == 0
    assert simhash.keep_one(nothing(docs)).count() == 0


def test_pipeline_stages_one_by_one(spark):
    pipeline = pytest.importorskip("corpus_pipeline")
    assert [name for name, _ in pipeline.STAGES] == ["toxicity", "line_dedup", "near_dedup", "decontamination", "byte_bpe"]
    docs = table(spark, SMALL, "documents")
    labels, benchmark = table(spark, SMALL, "labels"), table(spark, SMALL, "benchmark")
    stages = dict(pipeline.STAGES)
    pairs = lambda df: sorted((r.doc_id, str(r.text)) for r in df.select("doc_id", "text").collect())

    model = toxicity.fit(docs, labels)
    clean = stages["toxicity"](spark, docs, SMALL)
    assert clean.columns == docs.columns
    assert pairs(clean) == sorted((r.doc_id, str(r.text)) for r in docs.collect() if model.score(r.text) < 0.5)

    lines = stages["line_dedup"](spark, clean, SMALL)
    assert check_lines([(r.doc_id, r.text) for r in clean.collect()], [(r.doc_id, r.text) for r in lines.collect()]) > 40

    near = stages["near_dedup"](spark, lines, SMALL)
    roots = brute_components([(r.doc_id, brute_print(r.text, 5)) for r in lines.collect()], texts={r.doc_id: r.text or "" for r in lines.collect()})
    assert near.columns == docs.columns
    assert {r.doc_id for r in near.collect()} == {i for i, root in roots.items() if i == root}

    left = stages["decontamination"](spark, near, SMALL)
    dirty = {r.doc_id for r in decontam.find_contamination(near, benchmark).where("contaminated").collect()}
    assert {r.doc_id for r in left.collect()} == {r.doc_id for r in near.collect()} - dirty

    tokens = stages["byte_bpe"](spark, left, SMALL)
    assert tokens.count() == left.count()
    assert rows_of(pipeline.run(spark, SMALL)) == rows_of(tokens)


def test_pipeline_without_documents(spark, tmp_path):
    pipeline = pytest.importorskip("corpus_pipeline")
    table(spark, SMALL, "documents").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    for name in ("labels", "benchmark"):
        table(spark, SMALL, name).write.parquet(f"{tmp_path}/{name}.parquet")
    assert pipeline.run(spark, str(tmp_path)).count() == 0
