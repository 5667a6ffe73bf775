"""HTML extraction, decontamination, PII, tokens: against brute force, SQL and a second implementation."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.conftest import SMALL, rows_of, rows_of_sql
from tests.llm.frames import documents, nothing, texts
from tidalbook.llm import bpe, decontam, html_extract, pii, queries

PAGE = """<!DOCTYPE html><html><head><title>no &amp; no</title><style>p{}</style><script>var a = "<p>not this</p>";</script></head>
<body class="single-post"><header class="site-header"><a href="/">Site</a></header><nav><ul><li><a href="/a">Menu one</a><li><a href="/b">Menu two</a></ul></nav>
<div class="cookie-notice">We use cookies. Accept them all, please.</div>
<div class="sidebar"><p>Related: read these other long stories about other things.</p></div>
<article><h1>A &lt;title&gt;</h1><p>First   para&shy;graph with <b>bold</b> and <a href="/x">a link</a>,
over lines.<p>Second &eacute;&#x1F642; paragraph.<!-- <p>hidden</p> --><ul><li>item one<li>item two</ul>
<div class="ad">Buy now, it is really very cheap today.</div><form><input><label>Your name</label></form>
<section id="comments"><p>Reader: I do not agree with any of this, sorry.</p></section></article>
<footer>&copy; somebody, all rights reserved.</footer></body></html>"""


def test_html_article_only():
    assert html_extract.main_text(PAGE) == "A <title> First para­graph with bold and a link, over lines. Second é🙂 paragraph. item one item two"


@pytest.mark.parametrize("page", [None, "", "<", "<p", "</p></p>", "<!--", "<script>", "&#xFFFFFFF;", "<a href='", "<div " * 500, "<div>" * 2000 + "deep"])
def test_html_broken_pages(page):
    assert isinstance(html_extract.main_text(page), str)


PARAGRAPHS = ["The harbour was quiet that morning, and nobody on the pier expected the old ferry to return before noon.", "When it did, its captain told a long story about fog, a broken compass and two very patient whales."]
LAYOUTS = [
    '<div class="page-with-sidebar"><article>{}</article></div>',
    '<div class="layout-sidebar-right">{}</div>',
    '<form id="aspnetForm"><article>{}</article></form>',
    '<form id="aspnetForm" method="post"><div>{}</div></form>',
    '<div id="main-content" class="has-header">{}</div>',
    '<div class="entry-content share-enabled">{}</div>',
    '<div class="story related-topic">{}</div>',
    '<main class="no-sidebar"><div class="story-share-wrap">{}</div></main>',
    '<div role="main">{}</div>',
    '<table class="layout"><tr><td>{}</td></tr></table>',
]
AROUND = (
    '<nav><ul><li><a href="/">Home</a></li><li><a href="/b">Other things to read</a></li></ul></nav>{}<div class="share-buttons">Send this to all of your friends now.</div>'
    '<div class="related-posts"><a href="/c">Seven other stories that you may like</a></div><div class="comment-list"><p>I was there too, and it was not like that at all.</p></div>'
    '<aside class="widget">Subscribe today, it costs you nothing.</aside><form class="newsletter"><label>Your mail</label><input></form><footer>All rights reserved by the harbour office.</footer>'
)


@pytest.mark.parametrize("layout", LAYOUTS)
def test_html_layouts(layout):
    page = "<html><body class='has-sidebar'>" + AROUND.format(layout.format("".join(f"<p>{p}</p>" for p in PARAGRAPHS))) + "</body></html>"
    assert html_extract.main_text(page) == " ".join(PARAGRAPHS)


BUILT = ["elementor-widget", "panel-widget", "form-text", "notice-text", "ad-free", "so-widget-sow-editor"]


@pytest.mark.parametrize("name", BUILT)
@pytest.mark.parametrize("around", ["{}", "<main>{}</main>", "<article>{}</article>", "<div><div>{}</div></div>", "<section id='page'>{}</section>"])
def test_html_names_that_a_page_is_built_of(name, around):
    for layout in ("".join(f'<div class="{name}"><p>{p}</p></div>' for p in PARAGRAPHS), f'<div class="{name}">' + "".join(f"<p>{p}</p>" for p in PARAGRAPHS) + "</div>"):
        bare = f"<html><body>{around.format(layout)}</body></html>"
        assert html_extract.main_text(bare) == " ".join(PARAGRAPHS)
        assert html_extract.main_text(f"<html><body>{AROUND.format(around.format(layout))}</body></html>") == " ".join(PARAGRAPHS)


@pytest.mark.parametrize("around", ["<article>{}</article>", "<div class='entry-content'>{}</div>", "<main>{}</main>"])
def test_html_boxes_inside_and_after_an_article_go(around):
    boxes = '<div class="author-bio"><p>Ann has written about harbours for years, and she lives by one.</p></div><div class="{}"><p>Subscribe to our letter, and you will never miss a ferry again.</p></div><div class="recommended"><p>Nine ferries that you should have seen by now, and why.</p></div>'
    for name in ("callout", "call-out", "side-bar"):
        page = around.format("".join(f"<p>{p}</p>" for p in PARAGRAPHS) + boxes.format(name)) + '<section id="discussion"><p>I do not believe a word of what this captain said about whales.</p></section>'
        assert html_extract.main_text(page) == " ".join(PARAGRAPHS)


def test_html_many_comments_are_no_article():
    comments = "".join(f'<li class="comment-item"><p>Reader number {k} thinks that the captain made all of this up, and says so at length.</p></li>' for k in range(12))
    page = f"<div class='text'>{''.join(f'<p>{p}</p>' for p in PARAGRAPHS)}</div><ol class='comment-list'>{comments}</ol>"
    assert html_extract.main_text(page) == " ".join(PARAGRAPHS)


def test_the_cut_decides_where_costs_alone_would_not():
    page = f"<div><p>{PARAGRAPHS[0]}</p><p>So</p><p>{PARAGRAPHS[1]}</p></div><div class='menu'><a href='/'>So</a></div>"
    found = html_extract.blocks(page)
    assert [html_extract.evidence(b) > 0 for b in found] == [True, False, True, False]
    assert html_extract.label(found) == [True, True, True, False]
    assert html_extract.label(found, smooth=0.0) == [True, False, True, False]


def test_html_long_and_deep_pages():
    import time

    long = "<article>" + f"<p>{PARAGRAPHS[0]}</p>" * 20_000 + "</article>"
    assert html_extract.main_text(long) == " ".join([PARAGRAPHS[0]] * 20_000)
    took = []
    for depth in (2_000, 16_000):
        began = time.perf_counter()
        html_extract.main_text("<article>" + "<b>word<br>" * depth)
        took.append(time.perf_counter() - began)
    assert took[1] < 40 * took[0]


def brute_cut(source, sink, edges):
    n, best = len(source), None
    for mask in range(1 << n):
        kept = [bool(mask >> k & 1) for k in range(n)]
        cost = sum(sink[k] if kept[k] else source[k] for k in range(n)) + sum(w for a, b, w in edges if kept[a] != kept[b])
        best = cost if best is None else min(best, cost)
    return best


def test_min_cut_is_least():
    rng = random.Random(7)
    for _ in range(60):
        n = rng.randint(1, 8)
        source, sink = ([rng.choice([0.0, 0.5, 1.0, 2.0]) for _ in range(n)] for _ in range(2))
        edges = [(a, b, rng.choice([0.25, 1.0])) for a in range(n) for b in range(a + 1, n) if rng.random() < 0.4]
        kept = html_extract.min_cut(source, sink, edges)
        cost = sum(sink[k] if kept[k] else source[k] for k in range(n)) + sum(w for a, b, w in edges if kept[a] != kept[b])
        assert cost == pytest.approx(brute_cut(source, sink, edges))


def test_html_equals_articles_of_the_pages(spark):
    import html

    for r in spark.read.parquet(f"{SMALL}/pages.parquet").join(queries.op1_html_extraction(spark, SMALL).drop("url"), "page_id").collect():
        article = re.search(r"<article>(.*?)</article>", r.html or "", re.DOTALL)
        blocks = re.sub(r"</?(?:b|i|a)(?: [^>]*)?>", "", article[1] if article else "")
        assert r.text == " ".join(html.unescape(re.sub(r"<[^>]*>", " ", blocks)).split())
        assert r.n_chars == len(r.text)


def test_html_null_repeated_and_empty(spark):
    pages = spark.createDataFrame([(1, "u", PAGE, "x"), (1, "u", PAGE, "y"), (None, None, None, "z")], "page_id bigint, url string, html string, text string")
    got = html_extract.extract_text(pages).collect()
    assert sorted(len(r.text) for r in got) == [0, len(html_extract.main_text(PAGE)), len(html_extract.main_text(PAGE))]
    assert html_extract.extract_text(nothing(pages)).count() == 0


def test_decontamination_equals_sql(spark, duck):
    names, want = rows_of_sql(duck, queries.OP2_SQL)
    got = queries.op2_decontamination(spark, SMALL)
    assert sorted(got.columns) == names
    assert rows_of(got) == want


def brute_hits(text, items, window):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    lower = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    words = word.findall(lower(text))
    hit, found = set(), set()
    for item, body in items:
        own = word.findall(lower(body))
        size = min(window, len(own))
        for s in range(len(own) - size + 1) if own else ():
            for p in range(len(words) - size + 1):
                if words[p : p + size] == own[s : s + size]:
                    hit.update(range(p, p + size))
                    found.add(item or "")
    return len(words), len(hit), sorted(found)


@pytest.mark.parametrize("block_words", [3, 10**6])
def test_decontamination_equals_brute_force(spark, block_words):
    rng = random.Random(3)
    items = [(f"i{k}", " ".join(rng.choice("abAB1é") for _ in range(rng.randint(0, 8)))) for k in range(12)] + [("i1", "a b"), (None, "é é"), ("x", None)]
    rows = [(k, " ".join(rng.choice(["a", "b", "1", "É", "é", "A-b"]) for _ in range(rng.randint(0, 40)))) for k in range(30)] + texts()[4:8] + [(3, None), (3, "a b")]
    benchmark = spark.createDataFrame(items, "item_id string, text string")
    got = decontam.find_contamination(documents(spark, rows), benchmark, window=4, block_words=block_words).collect()
    want = [(i, *brute_hits(t, items, 4)) for i, t in rows]
    assert sorted(((r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in got), key=str) == sorted(want, key=str)
    assert all(r.contaminated == (r.n_hit > 0 and 20 * r.n_hit >= r.n_words) for r in got)


def test_equal_windows_cost_one_look_and_name_all_their_items(spark):
    import time

    stock = "it was a dark and stormy night and the rain fell in torrents over all of the town".split()
    took = []
    for n in (1, 2_000):
        items = [(f"i{k}", [w.encode() for w in [f"q{k}", *stock, f"z{k}"]]) for k in range(n)]
        text = [w.encode() for w in stock] * 60
        table = decontam.prefixes(items, Counter(text), 13)
        began = time.perf_counter()
        spans, found = decontam.occurrences(text, items, table, 13)
        took.append(time.perf_counter() - began)
        assert spans == [(0, len(text))] and found == set(range(n))
    assert took[1] < 100 * took[0] + 0.5


def test_planted_passages_are_dropped_and_clean_documents_stay(spark):
    item = " ".join(f"answer{k}" for k in range(30))
    docs = documents(spark, [(1, f"before it {item} after it"), (2, "word " * 700 + " ".join(item.split()[:13])), (3, "nothing of it"), (4, " ".join(item.split()[:12])), (5, None)])
    bench = spark.createDataFrame([("b", item), ("c", "tiny item"), ("d", None)], "item_id string, text string")
    assert {r.doc_id for r in decontam.drop_contaminated(docs, bench).collect()} == {2, 3, 4, 5}


def test_decontamination_empty_tables(spark):
    docs, benchmark = documents(spark), spark.createDataFrame([], "item_id string, text string")
    assert {r.n_hit for r in decontam.find_contamination(docs, benchmark).collect()} == {0}
    assert decontam.drop_contaminated(docs, benchmark).columns == docs.columns
    assert decontam.find_contamination(nothing(docs), benchmark).count() == 0


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_luhn(digits):
    double = [d * 2 - 9 if d * 2 > 9 else d * 2 for d in map(int, digits[-2::-2])]
    return (sum(map(int, digits[-1::-2])) + sum(double)) % 10 == 0


def brute_spans(text):
    found = []
    for rank, (kind, pattern) in enumerate((("email", EMAIL), ("ip", IP), ("card", CARD), ("phone", PHONE))):
        for m in pattern.finditer(text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")), "card": 12 <= len(digits) <= 19 and plain_luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
            if good:
                found.append((m.start(), rank, f"{kind}:{m.start()}:{m.end()}"))
    return [f for _, _, f in sorted(found)]


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="0123456789.@+-ab %()é,", max_size=60))
def test_pii_base_spans(text):
    assert [str(s) for s in pii.find_spans(text) if s.rank < 4] == brute_spans(text)


def test_pii_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    got = queries.op4_pii(spark, SMALL).collect()
    assert len(got) == len(docs)
    for r in got:
        want = brute_spans(docs[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert [len(r.scores), r.n_iban + r.n_secret] == [len(r.spans.split(",")) if r.spans else 0, len(r.scores) - len(want)]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(w.startswith(k) for w in want) for k in ("email", "ip", "card", "phone")]


def test_pii_context_iban_and_cases(spark):
    text = "iban GB82 WEST 1234 5698 7654 32 and GB82 WEST 1234 5698 7654 33"
    assert [str(s) for s in pii.find_spans(text) if s.rank == 4] == ["iban:5:32"]
    assert [str(s) for s in pii.find_spans("IBAN DE89 3704 0044 0532 0130 00 BIC COBADEFF")] == ["iban:5:32"]
    assert [s.rank for s in pii.find_spans("pay to DE89 3704 0044 0532 0130 00 please")] == [4]
    assert pii.find_spans("serial part DE89 3704 0044 0532 0130 00 of the motor") == []
    run = "9233a8ecf7c5b09fe594"
    assert [str(s) for s in pii.find_spans(f'token = "{run}"')] == ["secret:9:29"]
    assert pii.find_spans(f"commit {run} fixes it") == pii.find_spans(run) == pii.find_spans("the password is " + "a1" * 20) == []
    near, far = (pii.find_spans(t + "+44 20 7946 0958")[0].score for t in ("call me: ", "xyz: "))
    assert near > far
    assert pii.find_pii(documents(spark)).count() == len(texts())
    assert pii.find_pii(nothing(documents(spark))).count() == 0
    assert len(pii.find_spans("1" * 200_000 + "a@" * 50_000)) == 0


@pytest.fixture(scope="module")
def coder():
    ranks, pattern = queries.vocabulary()
    return bpe.ByteBPE(ranks, pattern), tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=80))
def test_tokens_of_any_text(coder, text):
    own, other = coder
    text = text.encode("utf-8", "replace").decode()
    (ids,) = own.encode_texts([text])
    assert [int.from_bytes(ids[k : k + 4], "little") for k in range(0, len(ids), 4)] == other.encode_ordinary(text)
    assert own.decode(ids) == text.encode()


def test_long_pieces(coder):
    own, other = coder
    rng = random.Random(1)
    for text in ("a" * 5000, "".join(rng.choice("abcde") for _ in range(3000)), "!" * 700 + "x" * 600, "é" * 400):
        (ids,) = own.encode_texts([text])
        assert [int.from_bytes(ids[k : k + 4], "little") for k in range(0, len(ids), 4)] == other.encode_ordinary(text)


def test_encode_query(spark, coder):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    for r in queries.op6_byte_bpe(spark, SMALL).collect():
        want = b"".join(i.to_bytes(4, "little") for i in coder[1].encode_ordinary(docs[r.doc_id]))
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(want) // 4, hashlib.sha256(want).hexdigest(), hashlib.sha256(docs[r.doc_id].encode()).hexdigest())


def test_encode_cases(spark, coder):
    got = bpe.encode(documents(spark), *queries.vocabulary(), ids_column=True).collect()
    want = sorted((str(i), coder[1].encode_ordinary(t or "")) for i, t in texts())
    assert sorted((str(r.doc_id), list(r.ids)) for r in got) == want
    assert bpe.encode(nothing(documents(spark)), *queries.vocabulary()).count() == 0


def test_chat_query_folds_every_turn_as_a_message(spark, monkeypatch):
    logs, whole = [], queries.chat.format_chats
    monkeypatch.setattr(queries.chat, "format_chats", lambda log: logs.append(log) or whole(log))
    queries.op9_chat_format(spark, SMALL)
    (log,) = logs
    assert log.where("message is null").count() == 0
    turns = spark.read.parquet(f"{SMALL}/conversations.parquet").count() + 2
    assert log.select("conv_id", "message").distinct().count() == turns < log.count()
    assert {r.kind for r in log.select("kind").distinct().collect()} == {"message", "delta", "edit", "regenerate"}
    plan = whole(log)._jdf.queryExecution().optimizedPlan().toString()
    assert "regenerate" in plan and "aggregate(" in plan
