from __future__ import annotations

import random

import pytest

from statewatt.llm import extract

PAGES = "page_id long, url string, html string"
ARTICLE = "<article><h1>Title &amp; more</h1><p><b>First\n\t para&nbsp;graph<br>goes on</b><p>Second &lt;one&gt; &#233;&#x41;</article>"


def page(i, body, host="h.example.org"):
    return i, f"http://{host}/p/{i:04d}?x=1", f"<!DOCTYPE html><html><head><title>T{i}</title><style>p{{}}</style><script>var t='</p>';</script></head><body>{body}</body></html>"


@pytest.mark.parametrize(
    "body,text",
    [
        (f"<nav><ul><li>Menu</li></ul></nav><div class='ad'>Buy</div>{ARTICLE}<footer>&copy; x</footer>", "Title & more\n\nFirst para graph goes on\n\nSecond <one> éA"),
        ("<header><h1>Site</h1></header><main><header><h1>Kept</h1></header><p>Text</p><aside>Side</aside><form><p>Ask</p></form><section id=comments><p>Nice!</p></section></main>", "Kept\n\nText"),
        ("<div class='cookie-notice'>We use</div><article>Bare <i>in</i>line<div>block</div>tail</article>", "Bare inline\n\nblock\n\ntail"),
        ("<!-- ad <p>no</p> --><article><p>a<!-- x -->b</p><script>document.write('<p>no</p>')</script><table><tr><td>c</td><td>d</td></tr></table></article>", "ab\n\nc\n\nd"),
        ("<article><p>cut &am", "cut &am"),
        ("<article><p>5 < 6 and 7 > 6</p><p attr='a>b'>x</p>", "5 < 6 and 7 > 6\n\nx"),
        ("<article><h2 id='related-work'>Related work</h2><div class='entry-header'>Kept</div><section id='social-science'><p>Kept too</p></section></article>", "Related work\n\nKept\n\nKept too"),
        ("<article><h2 id='comments'>On comments</h2><p>x</p><div class='ad-slot'>Buy</div><div class='box user-comments'>Nice</div><div id='cookie-notice'>C</div></article>", "On comments\n\nx"),
        ("<article><p>a <math><mi>x</mi></math> <object data=f>b</object><svg><text>s</text></svg></p><svg><p>rest</p><noscript>c</article>", "a x b\n\nrest\n\nc"),
        ("<div role=banner>B</div><div hidden>H</div><p>Only text</p>", "Only text"),
        ("<article></article><nav>n</nav>", ""),
        ("", ""),
    ],
)
def test_pages(spark, body, text):
    found = extract.extract(spark.createDataFrame([page(1, body)], PAGES)).collect()
    assert [tuple(r) for r in found] == [(1, page(1, body)[1], text)]


def test_differencing_finds_template_lines_without_mark_up(spark):
    rng = random.Random(1)
    rows, want = [], {}
    for i in range(200):
        own = [f"para {rng.random()}" for _ in range(rng.randrange(1, 6))]
        host = "big.example.org" if i % 3 == 0 else f"h{i % 9}.example.org"
        template = ["Welcome", "Section", "Section", "Contact us", "Imprint"]
        lines = template[:2] + own + template[2:]
        rows.append(page(i, "".join(f"<div>{x}</div>" for x in lines), host))
        want[i] = "\n\n".join(own)
    rows += [page(500, "<div>Welcome</div><div>alone</div>", "alone.example.org")]
    want[500] = "Welcome\n\nalone"
    for parts in (1, 7):
        found = extract.extract(spark.createDataFrame(rows, PAGES).repartition(parts)).collect()
        assert {r["page_id"]: r["text"] for r in found} == want and len(found) == len(rows)


def test_a_copied_article_next_door_stays(spark):
    rows = [page(i, f"<nav>m</nav>{ARTICLE}") for i in range(5)]
    assert {r["text"] for r in extract.extract(spark.createDataFrame(rows, PAGES)).collect()} == {"Title & more\n\nFirst para graph goes on\n\nSecond <one> éA"}


def hosts(rng):
    """Pages as (host, path, [(where, line)]): a frame, of which some lines reach into
    the article, a line that all articles quote, own lines, some pages twice."""
    pages = []
    for h in range(12):
        head, tail = [f"h{h} top {k}" for k in range(3)], [f"h{h} end {k}" for k in range(4)]
        for n in range(rng.randrange(1, 14)):
            body = [f"h{h} p{n} own {k}" for k in range(rng.randrange(1, 7))]
            if h % 2:
                lines = [("out", x) for x in head] + [("out", x) for x in body] + [("out", x) for x in tail]
            else:
                quote = [("in", f"h{h} quoted")] if rng.random() < 0.7 else []
                middle = [("in", body[0])] + quote + [("in", x) for x in body[1:] + [f"h{h} p{n} last"]]
                blurb = rng.random() < 0.8
                lines = [("out", head[0]), ("furniture", head[1]), ("in", head[2])] + middle + [("in", tail[0])] * blurb + [("out", tail[1]), ("furniture", f"h{h} p{n} menu"), ("out", tail[2])]
            pages.append((h, n, lines))
            if rng.random() < 0.2:
                pages.append((h, n + 0.5, lines))
    return pages


def restated(pages):
    out = []
    for i, (h, n, lines) in enumerate(pages):
        near = [{x for _, x in pages[j][2]} for j in (i - 1, i + 1) if 0 <= j < len(pages) and pages[j][0] == h]
        inside = [x for w, x in lines if w == "in"]
        if inside:
            near = [o for o in near if len(o.intersection(inside)) * 2 < len(inside)]
        template = [bool(near) and all(x in o for o in near) for _, x in lines]
        kept = []
        for k, (w, x) in enumerate(lines):
            a = b = k
            while a > 0 and template[a - 1]:
                a -= 1
            while b + 1 < len(lines) and template[b + 1]:
                b += 1
            framed = template[k] and (not inside or any(lines[j][0] != "in" for j in range(a, b + 1)))
            if w == ("in" if inside else "out") and not framed:
                kept.append(x)
        out.append("\n\n".join(kept or inside or [x for w, x in lines if w == "out"]))
    return out


def test_is_the_plain_rule_on_random_hosts(spark):
    pages = hosts(random.Random(23))
    rows, want = [], restated(pages)
    for i, (h, n, lines) in enumerate(pages):
        body, was = "", "out"
        for w, x in lines:
            body += "</article>" if was == "in" != w else "<article>" if w == "in" != was else ""
            body += {"in": f"<p>{x}</p>", "out": f"<div>{x}</div>", "furniture": f"<nav>{x}</nav>"}[w]
            was = w
        rows.append((i, f"http://h{h:02d}.example.org/{n:06.1f}", body))
    for parts in (1, 5):
        found = {r["page_id"]: r["text"] for r in extract.extract(spark.createDataFrame(rows, PAGES).repartition(parts)).collect()}
        assert found == dict(enumerate(want))
    articles = [i for i, p in enumerate(pages) if p[0] % 2 == 0]
    assert any("quoted" in want[i] for i in articles) and sum(" top 2" not in want[i] for i in articles) > 10 and any(" top 2" in want[i] for i in articles)


def test_an_article_changes_with_its_neighbours(spark):
    def one(n, blurb):
        return n, f"http://h/{n}", f"<div>Site</div><article><p>{blurb}</p><p>own {n}</p><p>more {n}</p><p>rest {n}</p></article>"

    alike = {r["page_id"]: r["text"] for r in extract.extract(spark.createDataFrame([one(n, "Share this") for n in range(3)], PAGES)).collect()}
    apart = {r["page_id"]: r["text"] for r in extract.extract(spark.createDataFrame([one(n, f"Share this {n}") for n in range(3)], PAGES)).collect()}
    assert alike[1] == "own 1\n\nmore 1\n\nrest 1" and apart[1] == "Share this 1\n\n" + alike[1]


def test_many_rows_alike_in_everything(spark):
    rows = [(1, "http://h/a", "<p>A</p><p>B</p>")] + [(2, "http://h/b", "<p>A</p><p>C</p>")] * 300 + [(3, "http://h/c", "<p>A</p><p>D</p>")]
    found = [(r["page_id"], r["text"]) for r in extract.extract(spark.createDataFrame(rows, PAGES).repartition(4)).collect()]
    assert len(found) == 302 and set(found) <= {(1, "B"), (2, "A\n\nC"), (2, "C"), (3, "D")}
    assert (1, "B") in found and (3, "D") in found


def test_awkward_rows(spark):
    rows = [(1, None, None), (2, "", ""), (None, "no url", "<p>x</p>"), (None, "no url", "<p>x</p>"), (4, "http://[odd", "plain text"), (5, "http://a/", "<p>" + "long " * 50_000 + "</p>"), (5, "http://a/", "<p>" * 3000 + "deep")]
    df = spark.createDataFrame(rows, PAGES).selectExpr("*", "1 as host", "2 as text", "'x' as URL", "3 as block")
    found = extract.extract(df).collect()
    assert sorted(len(r["text"]) for r in found) == sorted([0, 0, 1, 1, 10, 50_000 * 5 - 1, 4])
    assert extract.extract(spark.createDataFrame([], PAGES)).count() == 0


def lcs(a, b):
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a)):
        for j in range(len(b)):
            t[i + 1][j + 1] = t[i][j] + 1 if a[i] == b[j] else max(t[i][j + 1], t[i + 1][j])
    return t[-1][-1]


@pytest.mark.parametrize("bits", [1 << 28, 60])
def test_alignment_is_a_longest_common_subsequence(bits):
    rng = random.Random(7)
    for _ in range(300):
        a, b = ([rng.choice("abcde") for _ in range(rng.randrange(0, 40))] for _ in range(2))
        hit = extract.shared_lines(a, b, bits)
        assert hit.sum() == lcs(a, b)
        rest = iter(b)
        assert all(any(x == y for y in rest) for x, h in zip(a, hit) if h)
