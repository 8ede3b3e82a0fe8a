"""Main text of pages: block trees, tree matching, the given pages against a plain reader, and sites with planted templates."""

import random
import time
from functools import lru_cache
from html.parser import HTMLParser

import duckdb
import pytest

from strataflow.llm import queries, wrappers
from strataflow.llm.dom import Page, Tree, absorb, align

SF = "/root/testdata/sf0.001"


def blocks(source):
    page = Page(source)
    return [(t, z) for t, z in zip(page.texts, page.zones(), strict=True)]


class Article(HTMLParser):
    """The blocks of <article>, by the standard library's parser."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.depth, self.found = 0, [[]]

    def handle_starttag(self, tag, attrs):
        self.depth += tag == "article"
        if tag in ("p", "h1"):
            self.found.append([])
        elif tag == "br":
            self.found[-1].append(" ")

    def handle_endtag(self, tag):
        self.depth -= tag == "article"
        if tag in ("p", "h1", "article"):
            self.found.append([])

    def handle_data(self, data):
        if self.depth:
            self.found[-1].append(data)


def plain(source):
    reader = Article()
    reader.feed(source or "")
    reader.close()
    return "\n".join(filter(None, (" ".join("".join(b).split()) for b in reader.found)))


def test_given_pages(spark):
    rows = duckdb.sql(f"select page_id, url, html from '{SF}/pages.parquet'").fetchall()
    got = {r["page_id"]: r for r in queries.QUERIES["op11_main_text"](spark, SF).collect()}
    assert len(got) == len(rows)
    for page_id, url, source in rows:
        text = plain(source)
        assert (got[page_id]["url"], got[page_id]["text"], got[page_id]["n_chars"]) == (url, text, len(text))


@pytest.mark.parametrize("source,wanted", [
    ("", []), ("plain &amp; simple", [("plain & simple", 2)]), ("<p>a<p>b", [("a", 2), ("b", 2)]),
    ("<p>a <b>b<br>c</p>d", [("a b c", 2), ("d", 2)]), ("a<!-- x > <p> -->b", [("ab", 2)]), ("a<!-- open <p>b", [("a", 2)]),
    ("<p>a<script>if (1 < 2) '</p>'</script>b", [("ab", 2)]), ("<p>a<script>open", [("a", 2)]), ("x < y and y > z", [("x < y and y > z", 2)]),
    ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", [("a", 2), ("b", 2), ("c", 2), ("d", 2)]),
    ("<table><tr><td>a<td>b<tr><td>c</table>", [("a b", 2), ("c", 2)]), ("<p title='a>b'>t</p></div></p>", [("t", 2)]),
    ('<p class="x>t</p><p>u</p>', [("t", 2), ("u", 2)]), ("<nav>n</nav><article>a<nav>m</nav></article>f", [("n", 0), ("a", 1), ("m", 0), ("f", 0)]),
    ("<p>&nbsp;&eacute;&#x41;&unknown; \n\t b</p>", [("éA&unknown; b", 2)]),
    ('<div class="comments"><p>c</p></div><p>t</p>', [("c", 0), ("t", 2)]),
    ('<div class="with-sidebar"><h1>T</h1><p>t</p><div class="sidebar">s</div></div>', [("T", 2), ("t", 2), ("s", 0)]),
    ('<main><article><h1>T</h1><p>t</p></article><article class="comment">c</article></main>', [("T", 1), ("t", 1), ("c", 0)]),
    ('<form><main>m<button>go</button></main></form>', [("m", 1), ]), ('<p>a <span class="ad">buy</span> b</p>', [("a b", 2)]),
    ('<body><header><p>site</p></header><article><header><h1>T</h1></header>t</article></body>', [("site", 0), ("T", 1), ("t", 1)]),
    ("<p hidden>x</p><p style='display: none'>y</p><p>z</p>", [("x", 0), ("y", 0), ("z", 2)]), ("<TITLE>x</TITLE><P>y</P>", [("y", 2)]),
    ("<p>a<br/>b<hr>c", [("a b", 2), ("c", 2)]), ("<p>a<svg/>b<svg><text>no</text></svg>c", [("abc", 2)]),
    ("<p>a<select><option>x</select>b", [("ab", 2)]), ("<p>done</p><p>half <a href='", [("done", 2), ("half", 2)]),
])
def test_blocks(source, wanted):
    assert blocks(source) == wanted


def test_deep_and_long_pages():
    deep = "<div>" * 5000 + "x" + "</div>" * 5000 + "<p>after</p>"
    assert [t for t, _ in blocks(deep)] == ["x", "after"]
    assert Page(deep).skeleton()
    long = "<article>" + "".join(f"<h2>h{i}</h2><p>{i}</p><p>b</p>" for i in range(30_000)) + "</article>"
    page = Page(long)
    assert len(page.texts) == 90_000 and len(str(page.skeleton()[0])) < 200
    for piece in ("<a href='x", "<a ", "<!-", "<!--", "<script", "<svg ", "</", '<p title="', "<p a='b\"", "&", "<svg><p>"):
        began = time.perf_counter()
        Page(piece * 50_000)
        assert time.perf_counter() - began < 20, piece


def as_tuple(tree):
    return tree.label, tuple(as_tuple(c) for c in tree.children)


@lru_cache(None)
def most(a, b):
    """The largest matching of two trees: labels equal, order and parents kept."""
    if a[0] != b[0]:
        return 0

    @lru_cache(None)
    def rows(i, j):
        if i == len(a[1]) or j == len(b[1]):
            return 0
        return max(rows(i + 1, j), rows(i, j + 1), rows(i + 1, j + 1) + most(a[1][i], b[1][j]))

    return 1 + rows(0, 0)


def test_simple_tree_matching():
    rng = random.Random(3)

    def tree(depth):
        return Tree(rng.choice("ab"), 1, [tree(depth - 1) for _ in range(rng.randint(0, 3) if depth else 0)])

    for _ in range(300):
        a, b = tree(3), tree(3)
        pairs = []
        align(a, b, pairs)
        assert len(pairs) == most(as_tuple(a), as_tuple(b))
        assert len({id(x) for x, _ in pairs}) == len({id(y) for _, y in pairs}) == len(pairs)
        parent = {id(c): n for t in (a, b) for n in t.walk() for c in n.children}
        assert all(x.label == y.label for x, y in pairs)
        assert all((x, y) == (a, b) or any(parent[id(x)] is p and parent[id(y)] is q for p, q in pairs) for x, y in pairs)
        total = sum(1 for _ in a.walk()) + sum(1 for _ in b.walk()) - len(pairs)
        if pairs:
            absorb(a, b)
            assert sum(1 for _ in a.walk()) == total


def words(rng, n):
    return " ".join("".join(rng.choices("abcdefgh", k=rng.randint(2, 8))) for _ in range(n))


def site(rng, host, n):
    """Pages without marked articles: link lists, a constant line, content of varying shape, and a constant foot."""
    out = []
    for i in range(n):
        content = [words(rng, rng.randint(3, 40)) for _ in range(rng.randint(1, 9))]
        menu = "".join(f"<li><a href='/{rng.random()}'>{words(rng, 1)}</a></li>" for _ in range(rng.randint(2, 5)))
        tags = [rng.choice(["p", "p", "h2", "blockquote"]) for _ in content]
        body = "".join(f"<{t}>{c}</{t}>" for t, c in zip(tags, content, strict=True))
        extra = "<div>Try our new reader today</div>" if i % 4 else ""
        html = (
            f"<html><body><div><ul>{menu}</ul></div>{extra}<div class=x><div><h1>{words(rng, 4)}</h1></div>{body}</div>"
            f"<div><p>All rights reserved by {host}</p></div></body></html>"
        )
        title = html.split("<h1>")[1].split("</h1>")[0]
        out.append((f"https://user@{host.upper()}:80/{i}", html, "\n".join([title, *content])))
    return out


def test_sites(spark, monkeypatch):
    monkeypatch.setattr(wrappers, "CELL_TREES", 7)
    monkeypatch.setattr(wrappers, "FAN_IN", 2)
    rng = random.Random(5)
    rows = site(rng, "big.example", 120) + site(rng, "small.example", 12)
    # Copies of one article do not make it constant; a host of few pages is judged page by page.
    copies = site(rng, "copies.example", 1)[0]
    rows += [(f"https://copies.example/{i}", copies[1], copies[2] + "\nAll rights reserved by copies.example") for i in range(30)]
    rows = [(u, h, t if "copies" not in u else "Try our new reader today\n" * ("Try our" in h) + t) for u, h, t in rows]
    article = "<article><h1>{}</h1><p>{}</p><p>Share this story</p></article>"
    for i in range(10):
        title, text = words(rng, 3), words(rng, 30)
        rows.append((f"http://marked.example/{i}", article.format(title, text), f"{title}\n{text}"))
    # Near copies of one marked article beside a few other pages: what they share stays.
    shared = [words(rng, 12) for _ in range(3)]
    for i in range(20):
        paragraphs = [*shared, words(rng, 5)] if i < 14 else [words(rng, 12) for _ in range(4)]
        body = "".join(f"<p>{p}</p>" for p in paragraphs)
        rows.append((f"http://near.example/{i}", f"<article>{body}</article>", "\n".join(paragraphs)))
    rows += [(None, "<p>no host</p>", "no host"), ("nonsense", None, ""), ("http://big.example/empty", "", ""), (rows[0])]
    df = spark.createDataFrame(
        [(i, u, h, "t", 5, "h", "s", "b") for i, (u, h, _) in enumerate(rows)],
        "page_id long, url string, html string, TEXT string, n_chars int, host string, shape string, blocks string",
    ).repartition(5)
    got = {r["page_id"]: r for r in wrappers.extract(df).collect()}
    assert len(got) == len(rows)
    for i, (_, _, wanted) in enumerate(rows):
        assert (got[i]["text"], got[i]["n_chars"]) == (wanted, len(wanted)), i
        assert (got[i]["host"], got[i]["shape"], got[i]["blocks"]) == ("h", "s", "b")
    monkeypatch.setattr(wrappers, "BROADCAST_BYTES", -1)
    again = {r["page_id"]: r["text"] for r in wrappers.extract(df).collect()}
    assert again == {i: r["text"] for i, r in got.items()}


def test_empty_table(spark):
    assert wrappers.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
