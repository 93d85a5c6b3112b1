"""Main text of pages of several makes."""

from __future__ import annotations

import re
import time

import pyarrow.parquet as pq

from opslog.llm import tag_paths

BODY = "<h2>A title</h2><p>First part, with some words; and a few more of them here.<p>Second &amp; last part,\n with   commas, too.<br>Really.<ul><li>one<li>two</ul><p>End.</p>"
WANT = "A title\nFirst part, with some words; and a few more of them here.\nSecond & last part, with commas, too. Really.\none\ntwo\nEnd."
AROUND = (
    '<header><h1>Site name, of course</h1></header><nav><ul><li><a href="/a">A</a></ul></nav><div id="cookie-notice"><p>We keep '
    'cookies, as all do, so there. Agree, please.</p></div>{}<aside><p>More, elsewhere, today.</p></aside><div class="ads top"><p>Buy, '
    'now, this.</p></div><section id=comments><p>Nice, really nice, I say.</p></section><form><p>Your mail, please.</p></form>'
    '<footer><p>All of it, ours.</p></footer><script>var a = "</p><p>no, no, no</p>";</script><style>p { x: y }</style>'
)


def test_layouts():
    for open_, close in (("<article>", "</article>"), ("<main>", "</main>"), ('<div class="post"><div>', "</div></div>"), ("<td>", "</td>")):
        page = f"<!DOCTYPE html><html><head><title>T</title></head><body>{AROUND.replace("{}", open_ + BODY + close)}</body></html>"
        assert tag_paths.main_text(page) == WANT, open_


def test_given_pages(data):
    for row in pq.read_table(f"{data}/pages.parquet").to_pylist():
        inner = re.search(r"<article>(.*?)</article>", row["html"], re.S)[1]
        import html

        parts = [" ".join(html.unescape(re.sub(r"<[^>]+>", " " if "br" in p else "", p)).split()) for p in re.split(r"</?(?:p|h1)>", inner)]
        assert tag_paths.main_text(row["html"]) == "\n".join(p for p in parts if p)


def test_odd_pages():
    assert tag_paths.main_text(None) == tag_paths.main_text("") == tag_paths.main_text("<p></p>") == ""
    assert tag_paths.main_text("only text") == "only text"
    assert tag_paths.main_text("<p>a &lt;b&gt; &#233;&nbsp;c") == "a <b> é c"
    assert tag_paths.main_text("<script>x") == ""
    start = time.time()
    tag_paths.main_text("<div>" * 20_000 + "deep, text.")
    tag_paths.main_text("<" * 50_000)
    tag_paths.main_text('<a href="' * 2_000)
    assert time.time() - start < 20


def test_rows(spark):
    rows = [(1, "u", f"<article>{BODY}</article>"), (1, "u", None), (None, None, ""), (2, "v", "x" * 300_000)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "'t' AS text", "1 AS n_chars")
    got = tag_paths.extract(df).collect()
    assert sorted((r["page_id"] or 0, r["n_chars"]) for r in got) == [(0, 0), (1, 0), (1, len(WANT)), (2, 300_000)]
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    assert tag_paths.extract(df.limit(0)).count() == 0


def test_uneven_paragraphs_and_headings_outside():
    long = "Many words, more of them, and so on; indeed. " * 25
    page = "<html><body>{}</body></html>"
    post = f"<div class=post><p>A short lead, here.</p><p>{long}</p><p>A short end, too.</p></div>"
    want = f"A short lead, here.\n{long.strip()}\nA short end, too."
    assert tag_paths.main_text(page.format(post)) == want
    inner = f"<div class=post><h1>Title</h1><p>A lead, of some words.</p><div class=body><p>{long}</p><p>{long}</p></div></div>"
    assert tag_paths.main_text(page.format(inner)) == f"Title\nA lead, of some words.\n{long.strip()}\n{long.strip()}"
    half = f"<main><article><p>{long}{long}</p></article><div><p>{long}</p></div></main>"
    assert tag_paths.main_text(page.format(half)) == f"{(long + long).strip()}\n{long.strip()}"


def test_names_and_forms_do_not_hide_the_article():
    for open_, close in (
        ("<div class='content has-sidebar'>", "</div>"), ("<div class='no-sidebar with-header'>", "</div>"), ("<form><div>", "</div></form>"),
        ("<div class=widget>", "</div>"), ("<div class='promo'><article>", "</article></div>"),
    ):
        page = f"<html><body>{AROUND.replace('{}', open_ + BODY + BODY + BODY + close)}</body></html>"
        assert tag_paths.main_text(page) == "\n".join([WANT] * 3), open_
    head = "<article><div class=entry-header><h1>Title</h1></div><h2 class=page-header>Part</h2><p>Some text, and more, as here.</p></article>"
    assert tag_paths.main_text(head) == "Title\nPart\nSome text, and more, as here."
    assert tag_paths.main_text("<div id=comments><p>All there is, here.</p></div>") == "All there is, here."
    assert tag_paths.main_text(f"<article><h1>Title</h1><div class='entry widget'>{BODY}</div></article>") == f"Title\n{WANT}"
    talk = f"<article>{BODY}</article><section id=comments><article><p>{'Nice, really nice, I say. ' * 50}</p></article></section>"
    assert tag_paths.main_text(talk) == WANT
