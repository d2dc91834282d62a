"""Lines by hand-made pages; alignment against the quadratic table."""

import random
import re
import time

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from replicheck.llm import html_diff


def page(body, article=True):
    inner = f"<article>{body}</article>" if article else f"<div>{body}</div>"
    return (
        '<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body><nav><ul><li>'
        f'<a href="/a">Home</a></li></ul></nav><!-- ad --><div class="ad">Buy</div>{inner}<footer>&copy; us'
    )


@pytest.mark.parametrize(
    "html, text",
    [
        (None, ""),
        ("", ""),
        ("just text", "just text"),
        (page("<h1>A &amp; B</h1><p>one\n <b>two</b><br>three<p>fo&eacute;<span>ur</span>"), "A & B\none two\nthree\nfoéur"),
        (page("<p>x</p><div class='user-comments'><p>no</p></div><form>f</form><p>y"), "x\ny"),
        (page("<p>x</p><aside>no</aside><section id=notice>no</section><div role=navigation>no</div><p>adsorb"), "x\nadsorb"),
        (page("<p>a &lt;p&gt; &#233; &notanentity; &amp"), "a <p> é ¬anentity; &"),
        (page("<p>a<script>if (a<b) x()</script>b</p><!-- <p>c</p> -->"), "ab"),
        ("<p>" + "word " * 50_000, ("word " * 50_000).strip()),
    ],
)
def test_lines(html, text):
    assert html_diff.Page(1, "u", "h", html).text([]) == text


def longest(a, b):
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
    return t[-1][-1]


def test_alignment():
    rnd = random.Random(1)
    for _ in range(1_500):
        a, b = ([rnd.randint(0, 5) for _ in range(rnd.randint(0, 14))] for _ in range(2))
        found = sorted(html_diff.shared_lines(a, b))
        assert len(found) == longest(a, b)
        it = iter(b)
        assert all(a[k] in it for k in found)  # a common subsequence indeed
        cut = html_diff._best_cut(a[: len(a) // 2], a[len(a) // 2 :], b)
        assert longest(a[: len(a) // 2], b[:cut]) + longest(a[len(a) // 2 :], b[cut:]) == longest(a, b)


def test_template_is_deleted_by_difference(spark):
    rows = []
    for i in range(8):
        own = f"<p>story {i} tells</p><p>more of {i}</p>"
        body = f"<div>Welcome to the site</div>{own}<div>All rights reserved</div>"
        rows.append((i, f"http://a.org/en/{i}.html", body, "clash"))
    rows += [(20, "http://a.org/en/3.html?copy", rows[3][2], "clash"), (21, None, None, "clash"), (22, "http://lone.org/x", "<p>alone</p>", "clash"),
             (22, "http://lone.org/x", "<p>alone</p>", "clash")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, host string").coalesce(1)
    got = [tuple(r) for r in html_diff.extract(df).collect()]
    assert len(got) == len(rows)
    for i, url, _, _ in rows:
        want = {21: "", 22: "alone"}.get(i, f"story {i % 17} tells\nmore of {i % 17}")
        assert (i, url, want, len(want)) in got
    assert html_diff.extract(df.limit(0)).count() == 0


def test_template_inside_articles(spark):
    """A notice in every article goes by difference; a passage of two pages and copies stay."""
    rows, want = [], {}
    for i in range(8):
        own = [f"story {i} tells", f"more of {i}", f"end of {i}"] + ["a quoted passage"] * (i in (3, 4))
        want[i] = "\n".join(own)
        rows.append((i, f"http://a.org/en/{i}.html", page("<p>Read our terms of use</p>" + "".join(f"<p>{t}</p>" for t in own))))
    rows.append((20, "http://a.org/en/5.html?copy", rows[5][2]))
    # the first and last page have a neighbour on one side only
    want |= {20: want[5], 0: "Read our terms of use\n" + want[0], 7: "Read our terms of use\n" + want[7]}
    df = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    assert {r.page_id: r.text for r in html_diff.extract(df).collect()} == want


def plain(rows):
    """Texts by page, each page with its nearest neighbours however far away."""
    placed = []
    for page_id, url, html in sorted(rows, key=lambda r: (r[1], r[0])):
        p = html_diff.Page(page_id, url, "", html)
        host = url.split("/")[2]
        placed.append((p, html_diff.Entry(host, page_id, 0, p.hashes().tolist(), p.kinds, p.framed)))
    entries, out = [e for _, e in placed], {}
    for k, (p, e) in enumerate(placed):
        neighbours = [e.nearest(entries[:k][::-1])[0], e.nearest(entries[k + 1 :])[0]]
        out[p.page_id] = p.text(html_diff.lines_gone(e.hashes, e.kinds, e.framed, neighbours))
    return out


@pytest.mark.parametrize("coalesced", [True, False])
def test_neighbours_beyond_copies_and_ranges(spark, coalesced):
    """Copies between a page and its neighbour, and the edges of ranges, hide no template."""
    rnd, rows = random.Random(4), []
    for h, article in ((0, True), (1, False), (2, False)):
        for i in range(60):
            n = i // 20 if h < 2 else 3 * (i // 3)  # versions of one text, some with a line more or less
            story = [f"story {n} of {h}, line {k}" for k in range(12)]
            story = [t for t in story if rnd.random() < 0.95] + [f"only in {i}"] * (i % 2)
            lines = ["Read our terms of use", *story, "All rights reserved"]
            rows.append((len(rows), f"http://h{h}.org/{i:03}.html", page("".join(f"<p>{t}</p>" for t in lines), article)))
    want = plain(rows)
    assert sum("terms of use" in t for t in want.values()) == 40  # both ends of the host with articles
    df = spark.createDataFrame(rows + rows[7:8], "page_id long, url string, html string").repartition(3)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesced)
    try:
        got = html_diff.extract(df).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(got) == len(rows) + 1
    for r in got:
        assert (r.text, r.n_chars) == (want[r.page_id], len(want[r.page_id]))


def test_holders_count_by_those_that_lack_a_line():
    rnd = random.Random(2)
    pages = [[k for k in range(12) if rnd.random() < (0.9 if k < 6 else 0.3)] * 2 for _ in range(70)]
    holders = html_diff.Holders(pa.array(pages, pa.list_(pa.int64())))
    for mine in [*map(set, pages), set(range(12)), {99, 3}]:
        want = [k for k, p in enumerate(pages) if len(mine & set(p)) < html_diff.COPY * len(mine)]
        assert holders.lacking(np.array(sorted(mine), np.int64)).tolist() == want


TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*)(?:>|\Z)",
    re.S,
)
PIECES = ["<a ", "<div", "</p>", ">", '"', "'", "x y", " ", "class=", "<!--", "-->", "<script>", "/>", "<a\"b", "=", "<", "</", "<!x", "&amp;"]


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=25).map("".join))
def test_tags_are_those_of_the_plain_pattern(html):
    plain = [(m.start(), m.end(), bool(m[1]), (m[2] or "").lower(), m[3] or "") for m in TOKEN.finditer(html)]
    assert list(html_diff.Tags(html)) == plain


MB = 1_000_000


@pytest.mark.parametrize(
    "html",
    ["<a " * (MB // 3) + '"', "<div>" * (MB // 5), "<i>" * (MB // 6) + "</b>" * (MB // 8), "<script>" + "</script" * (MB // 8),
     "<a'" * (MB // 3) + ' "', "<a '\" " * (MB // 6), "<p><b>" * (MB // 6), "<" * MB, "<a<" * (MB // 3) + ' "'],
    ids=["quote", "nested", "closing", "raw", "names", "quotes", "paragraphs", "signs", "no space"],
)
def test_long_pages_take_linear_time(html):
    start = time.perf_counter()
    html_diff.page_lines(html)
    assert time.perf_counter() - start < 5
