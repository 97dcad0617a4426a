"""Main text by wrappers: pages whose main text is known, and expressions of small pages."""

import json
import random

import pytest
from pyspark.sql import functions as F

from segqa.llm import wrappers
from segqa.llm.markup import parse
from segqa.llm.queries import op11_html_extraction


def sentence(rng, n=12):
    return " ".join(rng.choice(["alpha", "beta", "gamma", "délta", "x"]) + str(rng.randrange(99)) for _ in range(n))


def escaped(text):
    return text.replace("é", "&eacute;").replace("x1", "x&#49;")


def semantic(rng, blocks):
    """Named elements, loose nesting and unclosed ones."""
    body = "".join(rng.choice(["<p>{}</p>", "<p><b>{}<br></b>", "<p>\n {}"]).format(escaped(b)) for b in blocks[1:])
    aside = f"<aside><p>{sentence(rng)}</p></aside>" if rng.random() < 0.5 else ""
    talk = "".join(f"<article class='comment'><p>{sentence(rng)}</p></article>" for _ in range(rng.randrange(3)))
    return (
        f"<!DOCTYPE html><html><head><title>{blocks[0]}</title><style>p{{}}</style><script>var t='</p>'</script>"
        f"<body><header><h1>Site</h1></header><nav><ul><li><a href=/>{sentence(rng, 2)}</a><li>x</ul></nav>"
        f"<div class='cookie-notice'>We use cookies</div><!-- <p>no</p> --><article><h1>{escaped(blocks[0])}</h1>"
        f"{body}{aside}<form><label>Mail</label><input></form><div id=comments>{talk}</div></article>"
        f"<footer>&copy; {sentence(rng, 3)}</footer>" + rng.choice(["</body></html>", ""])
    )


def plain(rng, blocks):
    """Nothing has a telling name: texts that all pages share, and lists of links, are not the main text."""
    links = "".join(f"<li><a href=/{k}>{sentence(rng, 2)}</a></li>" for k in range(rng.randrange(2, 7)))
    body = "".join(f"<div>{escaped(b)}</div>" if k % 3 == 2 else f"<p>{escaped(b)}</p>" for k, b in enumerate(blocks))
    return (
        f"<body><div class=top>Welcome to the one and only page</div><div class=l><ul>{links}</ul></div>"
        f"<div class=c><div class=t>{body}</div></div><table><tr><td>All rights reserved by us</table></body>"
    )


@pytest.fixture(scope="module")
def known():
    rng = random.Random(3)
    rows = []
    for k in range(60):
        blocks = [sentence(rng) for _ in range(rng.randrange(2, 9))]
        make = (semantic, plain)[k % 2]
        host = ("http://A.example.org/x", "https://u@b.example.org:80/?q")[k % 2]
        rows.append((k, host, make(rng, blocks), "\n".join(blocks)))
    return rows


def test_known_pages(spark, known, tmp_path):
    lone = (900, "http://lone.example/", semantic(random.Random(1), ["Title", "One text.", "Two"]), "Title\nOne text.\nTwo")
    rows = [*known, lone]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    pages.repartition(5).write.parquet(f"{tmp_path}/pages.parquet")
    found = op11_html_extraction(spark, str(tmp_path)).collect()
    assert len(found) == len(rows)
    expected = {r[0]: r[3] for r in rows}
    for r in found:
        assert r.text == expected[r.page_id], r.page_id
        assert r.n_chars == len(r.text)


def test_expression():
    def page(html):
        return wrappers.collapse(parse(html)[0])

    held = page("<ul><li>a<li>b</ul><p>one")
    held = wrappers._tell(held, page("<ul><li>a<li>b</ul><h2>x</h2><p>two"), True)
    held = wrappers._tell(held, page("<ul><li>a</ul><p>three"), True)
    stored = json.dumps(wrappers._dump(held))
    assert wrappers.expression(stored) == "<ul>(<li>#</li>)+</ul>(<h2>#</h2>)?<p>#</p>"
    pairs = page("<dl>" + "<dt>a<dd>b" * 4 + "</dl>")
    assert wrappers.expression(json.dumps(wrappers._dump(pairs))) == "<dl>(<dt>#</dt><dd>#</dd>)+</dl>"


def test_expressions_stay_bounded():
    rng = random.Random(8)
    held = None
    for _ in range(60):
        tags = rng.choices(["p", "h2", "ul", "pre", "h3", "div class=ad", "dl", "h4"], k=400)
        html = "<article>" + "".join(f"<{t}>{rng.random()}</{t.split()[0]}>" for t in tags) + "</article>"
        page = wrappers.collapse(parse(html)[0])
        held = page if held is None else wrappers._tell(held, page, True)
    assert len(json.dumps(wrappers._dump(held))) < 3000
    wrappers.mark(held)
    assert wrappers.main_text("<article><p>a<div class=ad>b</div><h2>c</h2></article>", held) == "a\nc"


def test_awkward_pages(spark):
    rows = [
        (1, None, None, "own"), (2, None, "", "own"), (None, "http://a/", "<p>x", None),
        (3, "http://a/", "<p>x</p>", "own"), (3, "http://a/", "<p>x</p>", "own"),
        (4, "no url", "a &amp; b &lt;c&gt; < d", "own"), (5, "http://a/", "<script>unclosed <p>x", "own"),
        (6, "http://a/", "<div>" * 3000 + "deep" + "</div>" * 3000, "own"),
        (7, "http://big/", "<article>" + "<p>word word</p>" * 30000 + "</article>", "own"),
        (8, "http://a/", "<nav>menu</nav><form>field</form><!-- x", "own"),
        (9, "http://a/", "<article></article><p>aside of nothing</p><a href=x>link</a>", "own"),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    pages = pages.withColumns({"host": F.lit("own"), "wrapper": F.lit("own")}).repartition(3)
    found = wrappers.extract_main(pages)
    assert found.columns == ["page_id", "url", "html", "host", "wrapper", "text"]
    by = {}
    for r in found.collect():
        assert (r.host, r.wrapper) == ("own", "own")
        by.setdefault(r.page_id, []).append(r.text)
    assert by[1] == by[2] == [""] and by[None] == ["x"] and by[3] == ["x", "x"]
    assert by[4] == ["a & b <c> < d"] and by[5] == [""] and by[6] == ["deep"] and by[8] == [""]
    assert by[7] == ["\n".join(["word word"] * 30000)]
    none = wrappers.extract_main(pages.filter("page_id < 0"))
    assert none.count() == 0
