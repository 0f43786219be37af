import re

import pyarrow.parquet as pq
import pytest

from pathfeat.llm.main_text import main_text, main_texts

LONG = "a sentence of the article that goes on for quite a while, word after word. " * 3


@pytest.mark.parametrize(
    "html, text",
    [
        (None, ""),
        ("", ""),
        ("<html><body></body></html>", ""),
        ("just a text", "just a text"),
        ("<p>a<p>b", "a b"),
        (f"<nav><a>x</a></nav><article><h1>T</h1><p>{LONG}</p><p>short</p></article>", f"T {LONG.strip()} short"),
        (f"<article><p><b>{LONG}<br><p>one</p><p>two</article><footer>{LONG}</footer>", f"{LONG.strip()} one two"),
        (f"<article><p>&eacute;&nbsp;&lt;b&gt; x<i>y</i>z\n\t {LONG}</p></article>", f"é <b> xyz {LONG.strip()}"),
        (f"<article><p>{LONG}</p><aside>no</aside><script>var t='</p>';</script><style>p{{}}</style></article>", LONG.strip()),
        (f"<main><p>{LONG}</p><div class='comments-area'><p>{LONG}</p></div></main>", LONG.strip()),
        (f"<div class='page sidebar-left'><article><p>{LONG}</p></article></div>", LONG.strip()),
        (f"<ul><li><a>x</a><li><a>y</a></ul><div><p>{LONG}</p><p>mid</p><p>{LONG}</p></div><div class=cookie-notice>{LONG}</div>", f"{LONG.strip()} mid {LONG.strip()}"),
        (f"<article><p>teaser</p></article><article><p>{LONG}</p></article>", LONG.strip()),
        ("</div></p><article>only</b></article>", "only"),
        (f"<body><div class='has-sidebar'><p>{LONG}</p></div></body>", LONG.strip()),
        (f"<div><p>{LONG}</p><p>No.</p><p>So.</p></div>", f"{LONG.strip()} No. So."),
        (f"<article><p>{LONG * 3}</p></article><article><p>{LONG}</p></article>", f"{(LONG * 3).strip()} {LONG.strip()}"),
        (f"<main><h1>T</h1><p>by x</p><article><p>{LONG}</p></article></main>", f"T by x {LONG.strip()}"),
        (f"<div><div><a>one</a><a>two</a></div><p>{LONG}</p><p>end</p><div><a>more</a></div></div>", f"{LONG.strip()} end"),
        (f"<div><h2>T</h2><div><p>{LONG}</p><p>a</p></div><div><p>{LONG}</p></div></div>", f"T {LONG.strip()} a {LONG.strip()}"),
        (f"<div><table><tr><td>{LONG}</td><td>cell</td></tr></table><p>{LONG}</p><ul><li>x</li></ul><p>{LONG}</p></div>", f"{LONG.strip()} cell {LONG.strip()} x {LONG.strip()}"),
        ("<article><!-- no --><p>a</p><form>no<input></form><p hidden>no</p><p>b</p></article>", "a b"),
    ],
)
def test_main_text(html, text):
    assert main_text(html) == text


def test_without_tags_and_classes_that_tell():
    """Ratios find the article where nothing names it."""
    whole = kept = more = 0
    for html in pq.read_table("/root/testdata/sf0.01/pages.parquet").column("html").to_pylist():
        plain = re.sub(r"<(/?)(?:article|nav|footer|main|header|aside)\b", r"<\1div", html or "")
        text, found = main_text(html), main_text(re.sub(r' (?:class|id|role)="[^"]*"', "", plain))
        whole += len(text)
        kept += len(text) * (text in found)
        more += max(0, len(found) - len(text))
    assert kept >= 0.99 * whole and more <= 0.02 * whole


def test_ratios_decide(monkeypatch):
    """Without a threshold between weak and strong lines, lists and links come back."""
    plain = f"<div><div><a>one</a><a>two</a></div><div>short</div><p>{LONG}</p><p>end</p></div>"
    told = f"<article><p>short</p></article><article><p>{LONG}</p></article>"
    right = [main_text(plain), main_text(told)]
    assert right == [f"{LONG.strip()} end", LONG.strip()]
    monkeypatch.setattr("pathfeat.llm.main_text._threshold", lambda values: 0.0)
    assert main_text(plain) != right[0] and main_text(told) != right[1]


def test_pages(spark):
    long = "<article>" + "<p>word " * 20_000
    rows = [(1, "u", "<article>x</article>", 3), (None, None, None, None), (1, "u", "<article>x</article>", 3), (2, "v", long, 0)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string, n_chars int")
    got = sorted([(r.page_id, r.url, r.n_chars) for r in main_texts(df).collect()], key=str)
    assert got == sorted([(1, "u", 1), (1, "u", 1), (None, None, 0), (2, "v", 99_999)], key=str)
    assert main_texts(df.where("page_id > 9")).collect() == []
