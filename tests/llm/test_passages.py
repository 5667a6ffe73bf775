"""Passages inside longer lines against plain loops, and the cases that must not crash."""

from __future__ import annotations

import random

from tests.llm.frames import documents, nothing
from tidalbook.llm import line_dedup, passages

SMALL = "/root/testdata/sf0.01"


def prose(rng, n):
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.choice([2, 4, 6, 7, 9])))
    return [word() + rng.choice(["", "", "", "", "", ".", ","]) for _ in range(n)]


def repeated(rows, n=51):
    """Per document, how many words of its lines stand in runs of n words that a document of smaller id has in a line."""
    first, out = {}, {}
    for doc, text in sorted(rows):
        count, own = 0, []
        for line in (text or "").split("\n"):
            words = line.split(" ")
            hit = bytearray(len(words))
            for i in range(len(words) - n + 1):
                run = tuple(words[i : i + n])
                own.append(run)
                if first.get(run, doc) != doc:
                    hit[i : i + n] = b"\1" * n
            count += sum(hit)
        for run in own:
            first.setdefault(run, doc)
        out[doc] = count
    return out


def planted(seed):
    rng = random.Random(seed)
    passage = [prose(rng, rng.choice([51, 60, 120])) for _ in range(6)]
    rows, own = [], {}
    for doc in range(60):
        head, tail = prose(rng, rng.randint(3, 80)), prose(rng, rng.randint(3, 80))
        k = rng.randrange(8)
        inside = passage[k] if k < 6 else prose(rng, 40)
        rows.append((doc, " ".join(head + inside + tail) + "\nshort end"))
        own[doc] = (head, tail, k if k < 6 else None, inside)
    return rows, own


def test_planted_passages_stay_once(spark):
    rows, own = planted(3)
    got = {r.doc_id: r.text for r in passages.drop_repeated_passages(documents(spark, rows)).collect()}
    seen = set()
    for doc, text in rows:
        head, tail, k, inside = own[doc]
        words = head + tail if k in seen else head + inside + tail
        seen.add(k) if k is not None else None
        assert got[doc] == " ".join(words) + "\nshort end"
    assert sum(repeated(rows).values()) > 1000 and not any(repeated(got.items()).values())


def test_fifty_words_are_no_passage(spark):
    rng = random.Random(5)
    same = prose(rng, 49) + ["end."]
    rows = [(k, " ".join(["."] + prose(rng, 30) + [f"own{k}."] + same + [f"other{k}"] + prose(rng, 30))) for k in range(3)]
    assert {r.doc_id: r.text for r in passages.drop_repeated_passages(documents(spark, rows)).collect()} == dict(rows)


def test_cases(spark):
    rng = random.Random(7)
    passage = " ".join(prose(rng, 90))
    line = lambda k: " ".join(prose(random.Random(k), 20)) + f" {passage} " + " ".join(prose(random.Random(-k - 1), 9))
    rows = [(5, line(1)), (5, line(1)), (5, line(2)), (2, line(3)), (9, line(4)), (9, line(4)), (None, line(5)), (None, None), (6, None), (7, ""), (8, " \n\n")]
    docs = documents(spark, rows)
    got = passages.drop_repeated_passages(docs)
    assert got.schema == docs.schema
    out = sorted(map(str, ((r.doc_id, r.text) for r in got.collect())))
    cut = lambda k: line(k).replace(passage + " ", "")
    want = [(5, cut(1)), (5, cut(1)), (5, cut(2)), (2, line(3)), (9, cut(4)), (9, cut(4)), *rows[6:]]
    assert out == sorted(map(str, want))
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in got.collect())
    assert passages.drop_repeated_passages(nothing(docs)).count() == 0


def test_a_periodic_line_takes_linear_time():
    line = " ".join(["abcdefghijklmnopqrstuvwxyz01234567."] * 60_000)
    anchors = [(k, 0) for k in range(60_000)]
    assert passages.shared_runs(line, line, anchors) == [(0, 60_000)]
    assert passages.without_runs("a b c d\nx y", [(0, 1, 3), (0, 2, 3), (1, 0, 2)]) == "a d\n"


def test_few_repeated_words_are_left(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    lines = line_dedup.drop_recurring_lines(docs).select("doc_id", "text").collect()
    got = line_dedup.drop_recurring(docs).select("doc_id", "text").collect()
    before, after = (sum(repeated([(r.doc_id, r.text) for r in x]).values()) for x in (lines, got))
    assert len(got) == len(lines) and after <= before / 10
