from __future__ import annotations

import html
import json
import re

from tablewarden.llm.common import table
from tablewarden.llm.queries import QUERIES
from tablewarden.llm.wrappers import blocks, expression, extract, merge

SF = "/root/testdata/sf0.01"


def article(page):
    """What stands between the article's tags in the given pages, by plain cutting."""
    if "<article>" not in page:
        return ""
    inside = page[page.index("<article>") + 9 :].partition("</article>")[0]
    parts = [" ".join(html.unescape(p).split()) for p in re.split(r"</?(?:p|h1|br|b)>", inside)]
    return "\n".join(p for p in parts if p)


def test_whole_table(spark):
    want = {r.page_id: (r.url, article(r.html)) for r in table(spark, SF, "pages").collect()}
    got = QUERIES["op8_html_extraction"](spark, SF).collect()
    assert {r.page_id: (r.url, r.text) for r in got} == want
    assert all(r.n_chars == len(r.text) for r in got)


def test_blocks_of_broken_markup():
    page = "<div class='A 12'>x &amp; <b>y</i><br>z<p>one<p>two<!-- no --><script>'</p>'</script><ul><li>l1<li>l2</ul>end<section>s</div>after &am"
    assert [t for _, t in blocks(page)] == ["x & y z", "one", "two", "l1", "l2", "end", "s", "after &am"]
    assert blocks("") == [] and blocks("<") == [("", "<")] and blocks("a < b <3") == [("", "a < b <3")]


def shape(page):
    return json.dumps(expression([p for p, _ in blocks(page)]).write())


def written(node):
    label, often, parts = node
    inside = " ".join(map(written, parts))
    return (f"{label}({inside})" if parts else label) + often


def test_expressions_align_to_optional_and_repeated_parts():
    a = shape("<article><h1>t</h1><p>a</p></article>")
    b = shape("<article><h1>t</h1><div class=ad>x</div><p>a</p><p>b</p></article><footer>f</footer>")
    assert written(json.loads(merge([a, b, a]))) == "(article(h1(#) div.ad(#)? p(#)+) footer(#)?)"
    assert merge([a, b]) == merge([b, a])


def test_pages_without_article_elements_and_odd_rows(rows):
    def page(i, extra=""):
        menu = "<div id='menu'><a href=/>Home</a> <a href=/x>About us</a></div><div class='cookie-notice'>We use cookies</div>"
        body = f"<div class=story><h2>Title {i}</h2><p>Text &eacute; number {i} goes on for a while with many words.</p><p>And {i * 7} more words of it here.</p></div>"
        return f"<html><body>{menu}{body}{extra}<div class='comments'><p>First!! {i} {'so long a comment ' * 9}</p></div><footer>&copy; x</footer></body></html>"

    data = rows(
        "page_id BIGINT, url STRING, html STRING, text INT, _host STRING",
        *[(i, "http://h.example/p", page(i, "<aside>more</aside>" if i % 2 else ""), 1, "x") for i in range(4)],
        (9, None, None, 1, "x"), (None, "http://other.example", "", 1, "x"), (8, "nonsense", "plain   text", 1, "x"), (8, "nonsense", "plain   text", 1, "x"),
    )
    got = {}
    for r in extract(data).collect():
        got.setdefault(r.page_id, []).append((r.text, r.n_chars))
    for i in range(4):
        want = f"Title {i}\nText é number {i} goes on for a while with many words.\nAnd {i * 7} more words of it here."
        assert got[i] == [(want, len(want))]
    assert got[9] == [("", 0)] and got[None] == [("", 0)] and got[8] == [("plain text", 10)] * 2
    assert extract(data.limit(0)).count() == 0


def test_layouts_of_one_host_and_class_parts(rows):
    long = "Some words of the story that go on for a while"
    pages = [
        "<body><article><p>A0</p></article></body>",
        f"<body><main><p>{long}</p></main></body>",
        f"<body><div><p>{long} 2</p></div></body>",
        "<body class='no-sidebar'><p>A3</p></body>",
        "<body><main class='has-sidebar'><p>A4</p></main><div class=sidebar>x</div></body>",
        "<body><div class='content-sidebar-wrap'><article class='category-legal'><p>A5</p></article></div><p>stray</p></body>",
        f"<body><main><p>{long} 6</p><article class=card>teaser</article></main></body>",
        f"<body><div class=lead><p>Lead 7</p></div><div class=more><p>{long} 7</p></div><div class=comments>c</div></body>",
        f"<body><div class=lead><p>Lead 8</p></div><div class=more><p>{long} 8</p></div><div class=comments>c</div></body>",
    ]
    want = ["A0", long, f"{long} 2", "A3", "A4", "A5", f"{long} 6\nteaser", f"Lead 7\n{long} 7", f"Lead 8\n{long} 8"]
    for url in ("http://h.example/p", None):
        data = rows("page_id BIGINT, url STRING, html STRING", *[(i, url, p) for i, p in enumerate(pages)])
        assert {r.page_id: r.text for r in extract(data).collect()} == dict(enumerate(want))


def test_repeated_rows_of_a_page_are_one_page(rows):
    page = "<body><div class=top>Menu</div><div class=story>Story {}</div><div class=end>{}</div></body>"
    data = rows("page_id BIGINT, url STRING, html STRING", *[(i, "http://a.example/", page.format(1, 1)) for i in range(3)], *[(9 + i, "http://b.example/", page.format(i, i)) for i in range(2)])
    got = {r.page_id: r.text for r in extract(data).collect()}
    assert got == {**dict.fromkeys(range(3), "Menu\nStory 1\n1"), 9: "Story 0\n0", 10: "Story 1\n1"}


def test_constant_tokens_that_share_a_slot_with_the_article(rows):
    page = "<body><div>All about us, on every page of ours</div><div>Story {0} begins</div><div>and {0} ends</div>{1}</body>"
    pages = [page.format(i, "<div>Read our app's terms</div>" if i != 2 else "") for i in range(4)]
    data = rows("page_id BIGINT, url STRING, html STRING", *[(i, "http://h.example/p", p) for i, p in enumerate(pages)])
    assert {r.page_id: r.text for r in extract(data).collect()} == {i: f"Story {i} begins\nand {i} ends" for i in range(4)}
