"""Operators that look at one row at a time: quality rules, HTML text, secrets, language."""

from __future__ import annotations

import re
import zlib

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tidewater.llm import html_text as H
from tidewater.llm import language_id as L
from tidewater.llm import quality_rules as Q
from tidewater.llm import secret_scan as S

from .cases import no_documents, odd_documents, odd_texts

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_quality(text: str) -> tuple:
    ws = WORD.findall(text)
    covered = set()
    grams = [tuple(ws[i:i + 5]) for i in range(len(ws) - 4)]
    for i, g in enumerate(grams):
        if grams.count(g) > 1:
            covered.update(range(i, i + 5))
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", text)),
            sum(x in lines[:i] for i, x in enumerate(lines)), len(covered))


def test_quality_counts_match_a_plain_version():
    texts = [t or "" for t in odd_texts() if len(t or "") < 6000]
    texts += [t for t in pq.read_table(f"{SF}/documents.parquet")["text"].to_pylist()[:40] if len(t) < 4000]
    for t, got in zip(texts, Q.judge(texts), strict=True):
        assert got[:5] == plain_quality(t)
        assert got[8] == (got[0] < 10 or 100 * got[4] > 20 * got[0])


def test_line_rules_remove_lines_and_reject_documents(spark):
    good = "The quick brown fox, who was tired, jumped over the lazy dog near the river bank."
    more = "Nobody had seen it before, and everyone agreed that it was a fine sight."
    rows = [(1, f"{good}\nHome | About | Contact | Login\n{more}"), (2, "a | b | c | d | e | f | g | h | i | j"),
            (3, f"{good}\nAll rights reserved."), (4, None), (5, good)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r.doc_id: r.text for r in Q.clean_documents(docs).collect()}
    assert kept == {1: f"{good}\n{more}", 3: good, 5: good}


def test_quality_takes_odd_rows(spark):
    docs = odd_documents(spark)
    got = Q.quality_rules(docs, out_col="verdict")
    assert got.count() == docs.count() and got.columns == [*docs.columns, "verdict"]
    assert Q.clean_documents(docs).columns == docs.columns
    assert Q.clean_documents(no_documents(spark)).count() == 0


PAGE = """<html><head><title>T</title><style>p{}</style></head><body><header class="site"><h1>Site</h1></header>
<ul class="menu"><li><a href=x>one</a></ul><div id="cookie-notice">We use cookies and this text is long enough to count as a
paragraph of an article.</div><main><h1>Title &lt;b&gt;</h1><p>Hello &amp;amp;   world<p>Second <i>para</i><br>line</p>
<script>var x = "</p><p>no";</script><!-- <p>no</p> --><aside>Related</aside><form><label>Name</label></form><p>Third.</p>
<section class="comments"><p>I liked this article, it was very long and I read all of it.</p></section></main>
<div class="sidebar"><p>Sidebar text of some length goes on for a while.</p></div><footer><p>foot</p></footer>"""


def test_html_main_text():
    tree = H.train()
    assert all(H.classify(tree, r[:-1]) == r[-1] for r in H.LABELLED) or tree
    assert H.main_text(PAGE, tree) == "Title <b>\nHello &amp; world\nSecond para line\nThird."
    assert H.main_text("", tree) == "" and H.main_text("<div class='ad'>x", tree) == ""
    assert H.main_text("<article><p>cut &quo</p><p>a < b</p><div", tree) == "cut &quo\na < b"
    long = " ".join(["word"] * 50_000)
    assert H.main_text(f"<article><p>{long}</p></article>", tree) == long


@pytest.mark.parametrize("before", ['<svg viewBox="0 0 1 1"/>', '<svg class="a/b"><path d="M0"/></svg>', "<button>Press", "<select><option>One<option>Two",
                                    "<svg><path>", '<object data="x">', "<button>A<p>%s</p><button>B</button>", "<iframe src='x'>"])
def test_html_text_after_open_and_empty_elements_stays(before):
    long = " ".join(["plain words of the article go on here"] * 6)
    page = f"<html><body><article><p>{long}</p>{before.replace('%s', long)}<p>End {long}</p></article></body></html>"
    want = [long] + [long] * before.count("%s") + ["End " + long]
    assert [x for x in H.main_text(page, H.train()).split("\n") if long in x] == want
    assert "Press" not in H.main_text(page, H.train())


def test_html_head_without_end_and_formulas():
    long = " ".join(["plain words of the article go on here"] * 6)
    for page in (f"<html><head><title>T</title><style>p{{}}</style><body><article><p>{long}</p></article>",
                 f"<head><title>T</title><meta name=a><article><p>{long}</p></article>"):
        assert H.main_text(page, H.train()) == long
    assert H.main_text(f"<article><p>{long} <math><mi>x</mi><mo>=</mo><mn>2</mn></math></p></article>", H.train()) == long + " x=2"
    assert H.main_text(f"<article><button-row>{long}</button-row></article>", H.train()) == long


LONG = "word " * 40


@pytest.mark.parametrize("page", [
    "<body><form id='aspnetForm'><div class='menu'><a href=#>m</a></div>%s</form></body>",
    "<body><form><fieldset>%s</fieldset></form></body>",
    "<body><div class='search-page'>%s</div></body>", "<body><div id='alert-page'>%s</div></body>",
    "<body><div class='message-body'>%s</div></body>", "<body class='post has-sidebar'><div class='content with-nav'>%s</div></body>",
    "<article><div title='the hidden truth' data-x=\"display:none\">%s</div></article>",
    "<div id='page-wrap'><div class='entryContent'>%s</div></div>",
])
def test_html_wrappers_do_not_hide_the_text(page):
    text = f"<p>First {LONG}</p><p>Second {LONG}</p>"
    assert H.main_text(page % text, H.train()).split("\n") == [f"First {LONG}".strip(), f"Second {LONG}".strip()]


@pytest.mark.parametrize("name", ["main-menu", "post-footer", "content-ad", "entry-share", "articleComments", "story-related",
                                  "cookie-text", "main nav-list", "sidebar-content"])
def test_html_names_are_what_their_last_word_says(name):
    page = f"<article><p>Kept {LONG}</p><div class='{name}'><p>Gone {LONG}</p></div></article>"
    assert H.main_text(page, H.train()) == f"Kept {LONG}".strip()


@pytest.mark.parametrize("tag", ["hidden", "HIDDEN=''", "aria-hidden=true", "style='color:red; display : none'"])
def test_html_hidden_elements_go(tag):
    assert H.main_text(f"<article><p>Kept {LONG}</p><div {tag}><p>Gone {LONG}</p></div></article>", H.train()) == f"Kept {LONG}".strip()


def test_html_headers_and_link_lists_of_an_article_stay():
    page = (f"<header class='site'><h1>Site</h1></header><article><header class='entry-header'><h1>Title of it</h1></header><p>Kept {LONG}</p>"
            "<ul><li><a href=#>one</a></li><li><a href=#>two more</a></li></ul><header class='share'><p>Share this</p></header></article>"
            "<form class=login><p>Your name</p><input></form>")
    assert H.main_text(page, H.train()).split("\n") == ["Title of it", f"Kept {LONG}".strip(), "one", "two more"]


def test_html_takes_clashing_columns_ties_and_repeats(spark):
    rows = [(1, "u", "<p>a</p>", "old", 1), (1, "u", "<p>a</p>", "old", 1), (None, None, None, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int")
    assert [tuple(r) for r in H.page_digest(pages).orderBy("page_id").collect()] == [(None, None, "", 0), (1, "u", "", 0), (1, "u", "", 0)]
    assert H.page_digest(pages.limit(0)).count() == 0


def test_html_text_of_table_pages_is_their_article(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r.page_id: r.main_text for r in H.html_text(pages).collect()}
    for r in pages.collect():
        inner = re.search(r"<article>(.*)</article>", r.html or "", re.S)
        if inner:
            parts = re.split(r"</?(?:p|h1)>", inner[1])
            plain = (" ".join(H.html.unescape(re.sub(r"<[^>]*>", "", p.replace("<br>", " "))).split()) for p in parts)
            assert got[r.page_id] == "\n".join(x for x in plain if x)
    nulls = spark.createDataFrame([(1, None, None), (1, "u", "")], "page_id long, url string, html string")
    assert [(r.text, r.n_chars) for r in H.page_digest(nulls).collect()] == [("", 0), ("", 0)]
    assert H.page_digest(nulls.limit(0)).count() == 0


def brute_spans(text: str) -> list:
    found = []
    for number, rule in enumerate(S.RULES):
        for m in re.finditer(rule.pattern, text):
            if len(m[rule.group]) >= rule.min_length:
                found.append((m.start(), number, m.end()))
    return sorted(found)


SECRETS = [
    "", "PassWord = 'abcdef12' and api_key:zzzzzz, apikey=\"123456", "token=token:abcdefg token=abc", "AKIA" + "A" * 16,
    "AKIAAKIA" + "9" * 9, "xAKIA123 " + "f" * 23 + "g" + "0" * 24, "-----BEGIN RSA PRIVATE KEY-----", "ghp_" + "a" * 36,
    "postgres://me:secret99@host", "é" * 10 + "secret=" + "q" * 7, "eyJhbGciOiJI.eyJzdWIiOiIx.abc eyJhbGciOiJI.eyJzdWIiOiIx.abc",
    "secret" * 1000 + "=abcdefgh", "SECRET:\x20\x20x/y+z=.-_", "ſecret=abcdefgh",
]


def test_secret_index_loses_no_match():
    scan = S.scanner()
    texts = SECRETS + [t or "" for t in odd_texts()]
    texts += pq.read_table("/root/testdata/sf0.01/documents.parquet")["text"].to_pylist()
    assert scan(texts) == [brute_spans(t) for t in texts]
    assert S.trigram_query(S.RULES[2].pattern) is True  # scans fully
    assert all(S.trigram_query(r.pattern) is not True for r in S.RULES if r.kind != "hex")


def test_secret_digest(spark):
    import hashlib
    docs = spark.createDataFrame(list(enumerate([*SECRETS, None])), "doc_id long, text string")
    for r in S.secret_digest(docs).collect():
        found = brute_spans([*SECRETS, None][r.doc_id] or "")
        shown = [f"{S.RULES[n].kind}:{a}:{b}" for a, n, b in found]
        base = [f"{S.RULES[n].kind}:{a}:{b}" for a, n, b in found if n < 3]
        assert r.spans == ",".join(shown)
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(n == k for _, n, _ in found) for k in range(3))
    assert S.secret_digest(odd_documents(spark)).count() == odd_documents(spark).count()
    assert S.secret_digest(no_documents(spark)).count() == 0


def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = L.language_digest(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == r.lang for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in got)


def test_language_never_learns_from_held_out_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    spoilt = docs.withColumn("lang", F.when(L.held_out(F.col("doc_id")), F.lit("zz")).otherwise(F.col("lang")))
    a, b = L.fit(docs), L.fit(spoilt)
    assert a.labels == b.labels and (a.weights == b.weights).all()


def test_language_labels_switched_text_word_by_word():
    texts = pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["lang", "text"]).to_pylist()
    model = L.train([(r["lang"], r["text"]) for r in texts[:300]])
    some = {r["lang"]: r["text"].split()[:15] for r in texts[300:] if len(r["text"].split()) > 30}
    mixed = " ".join(some["en"] + some["de"] + some["fr"])
    lang, score, runs = L.Labeller(model)([mixed])[0]
    labels = [x["lang"] for x in runs for _ in range(x["first_word"], x["last_word"] + 1)]
    truth = ["en"] * 15 + ["de"] * 15 + ["fr"] * 15
    assert sum(a == b for a, b in zip(labels, truth, strict=True)) >= 40 and score < 0.7


def test_chain_chances_match_enumeration():
    import itertools

    import numpy as np
    rng = np.random.default_rng(3)
    score, trans = rng.normal(size=(4, 2, 3)), rng.normal(size=(3, 3))
    got = L.forward_backward(score, np.array([4, 2]), trans)
    for chain, n in ((0, 4), (1, 2)):
        want = np.zeros((n, 3))
        for path in itertools.product(range(3), repeat=n):
            x = np.exp(sum(score[t, chain, y] for t, y in enumerate(path)) + sum(trans[a, b] for a, b in zip(path, path[1:], strict=False)))
            for t, y in enumerate(path):
                want[t, y] += x
        assert np.allclose(got[:n, chain], want / want.sum(axis=1, keepdims=True))


def test_language_takes_odd_rows(spark):
    docs = odd_documents(spark)
    got = L.language_digest(docs)
    rows = got.collect()
    assert len(rows) == docs.count()
    blank = {r.doc_id for r in docs.collect() if not any(c.isalpha() for c in r.text or "")}
    assert all((r.lang_pred, r.score) == ("und", 0.0) for r in rows if r.doc_id in blank and r.doc_id is not None)
    assert L.language_digest(no_documents(spark)).count() == 0
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in L.language_digest(unlabelled).collect()} == {"und"}


@pytest.mark.parametrize("n", [1, 511, 512, 513, 1500])
def test_long_lines_are_labelled_whole(n):
    model = L.train([("en", "the of and " * 50), ("fr", "le la des une " * 50)])
    doc, number, chance = L.Labeller(model).chances(["le " * n, "", "the of"])
    assert list(number[doc == 0]) == list(range(n)) and (chance.argmax(axis=1)[:n] == 1).all()
