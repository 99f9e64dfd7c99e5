"""Block reading, minimum cuts, and whole pages."""

import itertools
import random
import re
from collections import Counter

from cohortline.llm.html_extract import blocks, class_says, extract, max_flow_labels
from tests.conftest import SF_SMALL

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body class="with-sidebar">
<header><h1>Site</h1></header><nav><ul><li><a href="/a">Menu one</a><li><a href="/b">Menu two</a></ul></nav>
<div class="cookie-notice"><p>We use cookies to make this site work better for you.</p></div>
{open}<h1>{title}</h1><p>{a}<br>{b}<p><b>{c}</b>
<div class="advert">Buy now, it is cheap and good, really.</div>
<form><label>Mail</label><input name=x><button>Send</button></form><script>var t="</p>";</script><p>{d}</p>{close}
<aside><h3>Related</h3><a href=1>Other story here</a></aside>
<section id="comments"><h2>Comments</h2><div class="comment"><p>I liked this very much, thank you for it all.</p></div></section>
<footer>&copy; 2020 Site</footer></body></html>"""


def prose(rng, n):
    return " ".join("".join(rng.choice("aeionrst") for _ in range(rng.randint(2, 8))) for _ in range(n)).capitalize() + "."


def pages(n=40):
    rng = random.Random(2)
    for k in range(n):
        parts = {"title": prose(rng, 5), **{x: prose(rng, rng.randint(12, 40)) for x in "abcd"}}
        article = k % 5 != 0
        html = PAGE.format(open="<article>" if article else '<div class="post-body">', close="</article>" if article else "</div>", **parts)
        yield html, "\n".join([parts["title"], parts["a"] + " " + parts["b"], parts["c"], parts["d"]])


def cut_cost(source, sink, edges, side):
    return (sum(t if s else c for c, t, s in zip(source, sink, side))
            + sum(w for a, b, w in edges if side[a] != side[b]))


def test_minimum_cut_against_brute_force():
    rng = random.Random(0)
    for _ in range(200):
        n = rng.randint(1, 8)
        source, sink = ([rng.random() * 3 for _ in range(n)] for _ in "st")
        edges = [(a, b, rng.random()) for a, b in itertools.combinations(range(n), 2) if rng.random() < .5]
        best = min(cut_cost(source, sink, edges, side) for side in itertools.product([True, False], repeat=n))
        assert abs(cut_cost(source, sink, edges, max_flow_labels(source, sink, edges)) - best) < 1e-6


def test_blocks():
    got = [b.text for b in blocks("a&amp;b&nbsp; c<p>x<br>y <i>z</i></p>1 < 2<!-- no --><td>q</td><td>r<script>s</script></td> e <a hre")]
    assert got == ["a&b c", "x y z", "1 < 2 q r e"]
    assert blocks("") == [] and blocks("<p> </p><script>x") == []
    assert [b.text for b in blocks("<ul><li>a<li>b</ul>tail <a title='>'>link</a>")] == ["a", "b", "tail link"]


def test_class_names():
    for name in ("ad", "main-nav", "commentList", "site-header", "article-footer", "related_posts", "navigation", "content-ad"):
        assert class_says(name) == "boiler", name
    for name in ("post-content", "entry", "main", "articleBody", "story"):
        assert class_says(name) == "content", name
    for name in ("with-sidebar", "has-ads", "article-header", "row", "x1", "reader", "shadow", ""):
        assert class_says(name) == "", name


def test_pages(spark):
    made = list(pages())
    rows = [(i, f"http://x/{i}", h, "keep") for i, (h, _) in enumerate(made)]
    rows += [(900, None, None, "n"), (901, "u", "", "e"), (902, "u", "<p", "t"), (902, "u", "<p", "t"),
             (903, "v", "<article><p>" + "long words here, again. " * 40000, "long")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, main_text string").repartition(3)
    out = extract(df)
    assert out.columns == [*df.columns, "main_text_"]
    got = out.collect()
    assert len(got) == len(rows)
    text = {r.page_id: r.main_text_ for r in got}
    assert [text[i] for i in range(len(made))] == [t for _, t in made]
    assert text[900] == text[901] == text[902] == ""
    assert text[903] == ("long words here, again. " * 40000).strip()
    assert extract(df.limit(0)).collect() == []


def test_copies_and_null_addresses_bring_one_page(spark, monkeypatch):
    from cohortline.llm import html_extract

    seen = []
    monkeypatch.setattr(html_extract, "train", lambda x: seen.append(len(x)))
    rows = [(i, None if i % 3 else f"u{i}", f"<nav>menu {i}</nav>") for i in range(900)] + [(i, "u", "<nav>hot</nav>") for i in range(900, 1800)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    html_extract.fit(df, sample=100)
    html_extract.fit(df, sample=5000)
    assert 50 < seen[0] < 160 and seen[1] == 901


def test_whole_blocks_and_whole_pages_count(spark, monkeypatch):
    from cohortline.llm import html_extract

    at = html_extract.FEATURES.index("ends")
    long = "word " * 600 + "end. " * 600
    assert abs(html_extract.features(blocks(f"<p>{long}</p>"))[0, at] - .5) < .01
    seen = []
    monkeypatch.setattr(html_extract, "train", lambda x: seen.append(x))
    page = "<article>" + "<p>text</p>" * 450 + "</article>" + "<footer><p>foot</p></footer>" * 50
    html_extract.fit(spark.createDataFrame([(1, "u", page)], "page_id long, url string, html string"))
    assert len(seen[0]) == 500 and seen[0][:, 1].sum() == 50 and seen[0][:, html_extract.FEATURES.index("last")].sum() == 1


def test_elements_that_end_by_nesting():
    text = lambda page: [b.text for b in blocks(page)]
    assert text('<p>a <svg class=i /> b</p><p>c</p>') == ["a b", "c"]
    assert text('<p>a <svg><title>Icon</title><g><svg/><text>t</text></g></svg>b</p>') == ["a b"]
    assert text('<p>a <svg><path d=1></p><p>b</p>') == ["a", "b"]
    assert text('<p>a <svg><text>t<div>b</div>') == ["a", "b"]
    assert text('<svg><foreignObject><p>x</p></foreignObject></svg><p>b</p>') == ["b"]
    assert text('<p>if <math><mi>x</mi><mo>=</mo><mn>1</mn></math> and <math/> so</p>') == ["if x=1 and so"]
    assert text('<p>a</p><object data=f><p>shown instead</p></object><p>b</p>') == ["a", "shown instead", "b"]
    for name in ("object", "canvas", "template", "svg", "math"):
        assert text(f"<div>a<{name}></div><p>b</p><p>c</p>") == ["a", "b", "c"], name
    assert text("<canvas><p>x</p><canvas>y</canvas>z</canvas><template><p>t</p></template><p>b</p>") == ["b"]
    assert text("<canvas><p>b</p>") == ["b"]
    assert text("<p>a</p><textarea><p>x</p>") == ["a"]


def without_names(html):
    """The page with classes, ids, roles and telling elements taken out."""
    html = re.sub(r"\s(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", "", html, flags=re.I)
    return re.sub(r"<(/?)(article|nav|footer|header|aside|main|section|form|menu|figure|figcaption|button|label|fieldset|dialog)(?=[\s>/])",
                  r"<\1div", html, flags=re.I)


def test_table_without_any_markup_names(spark):
    """Nothing in the table names a kind of block: main text is told by length, sentence ends and links."""
    pages = [r.html or "" for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").select("html").collect()]
    named = spark.createDataFrame([(k, p) for k, p in enumerate(pages)], "page_id long, html string")
    bare = spark.createDataFrame([(k, without_names(p)) for k, p in enumerate(pages)], "page_id long, html string")
    truth = {r.page_id: r.main_text.split("\n") for r in extract(named).collect()}
    got = {r.page_id: r.main_text.split("\n") for r in extract(bare).collect()}
    assert all(t != [""] for k, t in got.items() if truth[k] != [""])
    right = sum(sum((Counter(got[k]) & Counter(truth[k])).values()) for k in truth)
    assert right >= .98 * sum(map(len, truth.values())) and right >= .7 * sum(map(len, got.values()))


def test_one_plain_page(spark):
    first, second = "This is a long paragraph about something, with ends. " * 6, "Another one follows here, and it says more. " * 5
    page = f"<html><body><div><a href=x>Home</a></div><h1>A plain title</h1><p>{first}</p><p>{second}</p><div>Copyright 2024</div></body></html>"
    df = spark.createDataFrame([(1, page)], "page_id long, html string")
    assert extract(df).first().main_text == f"A plain title\n{first.strip()}\n{second.strip()}"
