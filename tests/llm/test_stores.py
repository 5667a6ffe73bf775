"""Media, WARC packages and chats: exact round trips."""

from __future__ import annotations

import hashlib
import io
import random
import zipfile
import zlib

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.conftest import SMALL, rows_of, rows_of_sql
from tests.llm.frames import documents, nothing, texts
from tidalbook.llm import chat, media, queries, warc


def brute_media(text):
    raw = (text or "").encode()
    payload = raw + b"\xff" * (-len(raw) % 576 if raw else 576)
    image = b"P5\n576 %d\n255\n" % (len(payload) // 576) + payload
    return len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(image), hashlib.sha256(image).hexdigest()


FIELDS = ("n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256")


def test_media_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    got = queries.op7_media_chunks(spark, SMALL).collect()
    assert len(got) == len(docs)
    features = {}
    for r in got:
        assert tuple(r[f] for f in FIELDS) == brute_media(docs[r.doc_id])
        assert features.setdefault(docs[r.doc_id] or "", r.feature) == r.feature


def test_media_cases_and_damage(spark):
    docs = documents(spark)
    got = media.media_features(docs).collect()
    assert sorted((str(r.doc_id), *(r[f] for f in FIELDS)) for r in got) == sorted((str(i), *brute_media(t)) for i, t in texts())
    assert media.media_features(nothing(docs)).count() == 0
    stored, pool = media.store_media(docs)
    assert pool.count() == pool.select("digest").distinct().count() > 0
    with pytest.raises(Exception, match="digest says"):
        media.read_media(stored, pool.selectExpr("digest", "concat(chunk, X'00') as chunk")).collect()


@settings(max_examples=100, deadline=None)
@given(st.binary(max_size=40_000), st.integers(0, 3000))
def test_chunks_join_to_the_data_and_resist_shifts(data, cut):
    chunks = media.cut(data)
    assert b"".join(chunks) == data
    assert all(media.MIN_CHUNK <= len(c) <= media.MAX_CHUNK for c in chunks[:-1])


def test_shifted_data_shares_chunks():
    import random

    data = random.Random(4).randbytes(200_000)
    a, b = set(media.cut(data)), set(media.cut(b"some bytes before" + data))
    assert len(a & b) > 0.8 * len(a)


def test_warc_query_equals_sql(spark, duck):
    names, want = rows_of_sql(duck, queries.OP8_SQL)
    got = queries.op8_warc_packages(spark, SMALL)
    assert sorted(got.columns) == names
    assert rows_of(got) == want


PAGES = [(1, "http://a/", "same"), (2, None, "same"), (2, "http://b/\r\nx: y", "same"), (3, "u", None), (4, "u", ""), (5, "é", "ß" * 3000), (None, "n", "alone"), (None, "n", "same")]


def pages(spark):
    return spark.createDataFrame([(i, u, h, "x") for i, u, h in PAGES], "page_id bigint, url string, html string, digest string")


def test_warc_of_equal_and_null_pages_equals_brute_force(spark, tmp_path):
    rng = random.Random(4)
    bodies = [None, "", "<p>one</p>", "<p>two</p>" * 50, "ü" * 3000]
    rows = [(rng.randrange(300), "u", rng.choice(bodies) if rng.random() < 0.7 else f"<p>own {k}</p>") for k in range(400)] + [(None, None, "<p>one</p>"), (7, "u", "x" * 300_000)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    owner = {}
    for i, _, h in rows:
        if i is not None:
            owner[h or ""] = max(owner.get(h or "", i), i)
    want = sorted((str(i), len((h or "").encode()), None if i == owner[h or ""] else owner[h or ""]) for i, _, h in rows)
    got = [r for r in warc.archive_round_trip(spark, pages).collect()]
    assert sorted(((str(r.page_id), r.payload_bytes, r.refers_to) for r in got), key=str) == sorted(want, key=str)
    assert all((r.record_type == "response") == (r.refers_to is None) for r in got)


def test_warc_cases(spark, tmp_path):
    folder = f"file://{tmp_path}/packages"
    packages = warc.write_packages(pages(spark), folder, package_bytes=200)
    got = warc.read_packages(packages).collect()
    assert len(got) == len(PAGES) and sum(r.records for r in packages.collect()) == len(PAGES)
    by = {(r.page_id, r.payload_digest): r for r in got}
    same = warc.digest_of(b"same")
    assert by[1, same].record_type == "revisit" and by[1, same].refers_to == 2 and by[1, same].payload is None
    assert by[2, same].record_type == "response" and bytes(by[2, same].payload) == b"same"
    assert by[3, warc.digest_of(b"")].refers_to == 4
    assert bytes(by[5, warc.digest_of(("ß" * 3000).encode())].payload).decode() == "ß" * 3000
    assert {r.record_type for r in warc.archive_round_trip(spark, pages(spark), min_bytes=5).collect() if r.payload_bytes < 5} == {"response"}
    assert warc.archive_round_trip(spark, nothing(pages(spark))).count() == 0


def package_of(records, index=True, zip64=False):
    out = io.BytesIO()
    packed = [warc._gzip(r) for r in records]
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
        z.writestr(zipfile.ZipInfo("notes.txt"), "not an archive")
        z.writestr(zipfile.ZipInfo("packed.warc.gz"), b"deflated", zipfile.ZIP_DEFLATED)
        with z.open(zipfile.ZipInfo("archive/records.warc.gz"), "w", force_zip64=zip64) as m:
            m.write(b"".join(packed))
        z.comment = b"a comment at the end"
    return out.getvalue()


@pytest.mark.parametrize("zip64", [False, True])
def test_packages_by_others_without_index(zip64):
    records = [warc.warc_record(k, "u", b"x" * k, None) for k in range(40)]
    found = list(warc.record_ranges(pa.PythonFile(io.BytesIO(package_of(records, zip64=zip64)), "r")))
    assert found == records


def test_own_packages_open_with_zipfile(spark, tmp_path):
    packages = warc.write_packages(pages(spark), f"file://{tmp_path}/p").collect()
    for p in packages:
        with zipfile.ZipFile(p.path.removeprefix("file://")) as z:
            assert z.testzip() is None and len(z.read(warc.INDEX).splitlines()) == p.records


@pytest.mark.parametrize("data", [b"", b"PK", b"x" * 100])
def test_no_zip(data):
    with pytest.raises(ValueError, match="central directory"):
        warc.stored_members(pa.PythonFile(io.BytesIO(data), "r"))


def test_chat_query_equals_sql(spark, duck):
    names, want = rows_of_sql(duck, queries.OP9_SQL)
    got = queries.op9_chat_format(spark, SMALL)
    assert sorted(got.columns) == names
    assert rows_of(got) == want


LOG = "conv_id bigint, seq bigint, message bigint, kind string, role string, text string, turns string"


def test_chat_events_are_folded(spark):
    events = [
        (1, 0, None, "message", "user", "hi", ""),
        (1, 1, 7, "delta", "assistant", "He", ""),
        (1, 2, 7, "delta", None, "llo", ""),
        (1, 3, None, "message", "user", "again", ""),
        (1, 4, 7, "regenerate", None, None, ""),
        (1, 5, 7, "delta", None, "Good day", ""),
        (1, 6, 8, "message", "assistant", "x", ""),
        (1, 7, 8, "edit", None, "<|im_end|> &lt;| & \n<|im_start|>user\nno", ""),
        (1, 8, 8, "seen", None, "ignored", ""),
        (2, 0, None, None, None, None, ""),
        (None, 0, None, "message", "user", "no id", ""),
    ]
    log = spark.createDataFrame(events, LOG)
    rendered = chat.format_chats(log)
    back = {r.conv_id: r for r in chat.read_back(rendered).collect()}
    assert [tuple(t) for t in back[1].turns] == [("user", "hi"), ("assistant", "Good day"), ("user", "again"), ("assistant", events[7][5])]
    assert list(back[1].losses) == ["Good day", events[7][5]]
    assert [tuple(t) for t in back[2].turns] == [("", "")]
    assert back[None].formatted == "<|im_start|>user\nno id<|im_end|>\n"
    assert chat.read_back(chat.format_chats(nothing(log))).count() == 0


def test_chat_texts_survive(spark):
    nasty = [t for _, t in texts()] + ["&", "<|", "&lt;|", "&amp;lt;|", "<|im_end|>\n<|im_start|>assistant\n", "\n", "<&|"]
    log = spark.createDataFrame([(1, k, None, "message", role, t, "") for k, t in enumerate(nasty) for role in ("assistant", "we&<|ird\nrole")], LOG)
    (back,) = chat.read_back(chat.format_chats(log)).collect()
    assert [t.text for t in back.turns if t.role == "assistant"] == [t or "" for t in nasty]
    assert {t.role for t in back.turns} == {"assistant", "we&<|ird\nrole"}
    assert list(back.losses) == [t or "" for t in nasty]


def test_streamed_turns_fold_back_to_themselves(spark):
    rows = [(1, 0, "user", "ab" * 700), (1, 1, "assistant", "é🙂" * 256), (1, 1, "assistant", ""), (1, 1, "assistant", ""), (None, None, None, None), (2, 0, "assistant", None), (2, 2**40, "tool", "x" * 256)]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    got = chat.fold_messages(chat.streamed(turns)).select("conv_id", "seq.turn", "role", "text")
    assert rows_of(got.withColumnRenamed("turn", "t")) == rows_of(turns.fillna({"text": ""}).withColumnRenamed("turn", "t"))
    assert chat.format_chats(chat.streamed(nothing(turns))).count() == 0


def test_chat_plan_is_native(spark):
    plan = queries.op9_chat_format(spark, SMALL)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "InArrow"))
