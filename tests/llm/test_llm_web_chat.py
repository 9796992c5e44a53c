"""Quotations, HTML, URL reputation and WARC on small pages worked out by hand."""

import math

import pytest
from pyspark.sql import functions as F

from tidepool.llm import html_layout, quotes, urls, warc

MESSAGES = "conv_id long, turn long, role string, text string, body string"


def test_quotations(spark):
    rows = [(1, 0, "Hello there\nHow are you?\nok"), (1, 1, "On Monday Jo wrote:\n> Hello there\n> how  ARE you?\nFine.\nThanks"),
            (1, 2, "> > Hello there\n> Fine.\n>  \nGood\nok"), (1, 3, "no quote"), (1, 4, ">ok\n>Good\nyes"), (2, 0, None), (2, 1, ""),
            (None, 1, "> x"), (2, None, "> x\ny"), (2, 3, "> unseen line\n>> y"), (3, 0, "a"), (3, 1, "> a\nb"), (3, 2, "> b\nc"), (3, 3, "> c\nd"),
            (3, 4, "> d\ne"), (3, 5, "> e\nf"), (3, 5, "> e\nf")]
    df = spark.createDataFrame([(c, t, "r", x, "clash") for c, t, x in rows], MESSAGES)
    got = [((r.conv_id, r.turn), (r.parent_turn, r.thread_root, r.reply_depth, r.n_quoted, r.max_depth, r.n_linked, r.body)) for r in quotes.link(df).collect()]
    assert len(got) == len(rows)
    by = dict(got)
    assert by[1, 1] == (0, 0, 1, 2, 1, 2, "Fine.\nThanks")
    assert by[1, 2] == (1, 0, 2, 3, 2, 2, "Good\nok")  # nested quotations say nothing of the message answered
    assert by[1, 4] == (2, 0, 3, 2, 1, 2, "yes")  # "ok" is of turn 0, "Good" of turn 2 and longer
    assert by[1, 3] == (None, 3, 0, 0, 0, 0, "no quote")
    assert by[2, 0] == (None, 0, 0, 0, 0, 0, None) and by[2, 1][-1] == ""
    assert by[2, 3] == (None, 3, 0, 2, 2, 0, "")
    assert by[None, 1][:2] == (None, 1) and by[2, None][:2] == (None, None)
    assert by[3, 5] == (4, 0, 5, 1, 1, 2, "f")  # two rows of one key are one message
    order = [(r.conv_id, r.turn) for r in quotes.reply_ordered(quotes.link(df.where("conv_id = 1"))).collect()]
    assert order == [(1, 0), (1, 1), (1, 2), (1, 4), (1, 3)]
    assert quotes.link(df.limit(0)).collect() == []


def test_quotations_wrapped_anew_and_in_part(spark):
    """Wrapped or partial quotations are linked as whole lines are."""
    long = "The quick brown fox jumps over the lazy dog while seven wizards box with a jolly zebra near the old stone bridge"
    rows = [(1, 0, long + "\nSecond line"), (1, 1, "Unrelated words only, nothing else to see here at all"),
            (1, 2, "> The quick brown fox jumps over\n> the lazy dog while seven wizards\n> box with a jolly zebra near the\n> old stone bridge\nI agree."),
            (1, 3, "first part of it\nthat goes on\nuntil the end"), (1, 4, "> first part of it that goes on until the end\nyes"),
            (1, 5, "> seven wizards box with\nwhich ones?"), (1, 6, "> lazy   DOG\nwhose?"), (1, 7, "> nobody ever wrote such a line of words\nhm"),
            (1, 8, ">> jolly zebra near the old\n>> stone bridge Second\nnested"), (1, 9, "> dog while\n> seven\n> dog while\nrepeats"),
            (2, 0, "nothing"), (2, 1, "> the quick brown fox jumps\nother conversation"), (3, 0, "x " * 40 + "alpha beta gamma"), (3, 1, "> alpha\n> beta gamma\nok"),
            (4, 0, "one two three four five six"), (4, 1, "middle\n> one two three\nmore"), (4, 2, "> four five\n> middle more\nend")]
    df = spark.createDataFrame([(c, t, "r", x, "clash") for c, t, x in rows], MESSAGES)
    by = {(r.conv_id, r.turn): (r.parent_turn, r.n_quoted, r.n_linked) for r in quotes.link(df).collect()}
    assert len(by) == len(rows)
    assert by[1, 2] == (0, 4, 4) and by[1, 4] == (3, 1, 1)
    assert by[1, 5] == (0, 1, 1) and by[1, 6] == (0, 1, 1)
    assert by[1, 7] == (None, 1, 0) and by[1, 8] == (None, 2, 2) and by[1, 9] == (0, 3, 3)
    assert by[2, 1] == (None, 1, 0) and by[3, 1] == (0, 2, 2)
    assert by[4, 1] == (0, 1, 1) and by[4, 2] == (0, 2, 1)  # what stands on both sides of a quotation is no passage
    twice = quotes.link(df.where("conv_id = 1 and turn in (0, 2)").union(df.where("conv_id = 1 and turn = 2"))).where("turn = 2").collect()
    assert [(r.parent_turn, r.n_quoted, r.n_linked) for r in twice] == [(0, 4, 8)] * 2


PAGE = """<html><head><title>T</title><style>.x{display:none} #gone, i.y {visibility: hidden} #gone{visibility:hidden}</style></head><body>
<h1>Head &amp; line</h1><p>One<p>Two <b>bold</b><br>three
<ul><li>a<li>b<ol start=3><li>x<li>y</ol><li>c</ul>after<table><caption>Cap</caption><tr><th>Name<th>Qty<tr><td>apple pie<td>3<tr><td colspan=2>wide cell here
<tr><td rowspan=2>r<td>1<tr><td>2</table><div hidden>no</div><div class="y x">no</div><span style="display: none">no</span>tail
<script>var a="</p>";</script>end<pre>  a
   b

 c</pre><details><summary>sum</summary>no</details><p style="visibility:hidden">no <i style="visibility:visible">yes</i></p><b id=gone>no</b>
<dl><dt>k<dd>v</dl>1 < 2 & 3 <!-- no --> x<unclosed"""

SHOWN = """Head & line

One

Two bold
three

- a
- b
  3. x
  4. y
- c

after

Cap
Name       Qty
apple pie  3
wide cell here
r          1
           2

tail end

  a
   b

 c

sum

yes

k
v

1 < 2 & 3 x<unclosed"""


def test_layout():
    assert html_layout.render(PAGE) == SHOWN


@pytest.mark.parametrize("page,text", [
    (None, ""), ("", ""), ("<p></p><script>x", ""), ("a<br><br>b", "a\n\nb"), ("<div>a<div>b</div>c</div>", "a\nb\nc"), ("<li>a<li>b", "- a\n- b"),
    ("<td>a<td>b", "a\nb"), ("<table><td>a<td>b<table><td>in</table></table>", "a  b\n\n   in".replace("\n\n", "\n\n")), ("<p>a</div>b</p>", "ab"),
    ("x<textarea>a  b</textarea>", "xa  b"), ("&lt;p&gt; &nbsp;&eacute;", "<p> \xa0é"), ("<details open><summary>s</summary>t</details>", "s\nt"),
])
def test_layout_of_small_pages(page, text):
    assert html_layout.render(page) == text


@pytest.mark.parametrize("css,seen", [
    ("@media print { p, .ad { display:none } }", True), ("@media (max-width: 9em) {p{display:none}} .y{display:none}", True), ("@media screen {p{display:none}}", False),
    ("@supports (display:grid) {@media all {p{visibility:hidden}}}", True), (".ad{display:none} .ad{display:block}", True), (".ad{visibility:hidden}.ad{visibility:visible}", True),
    (".ad{display:none!important} .ad{display:block}", False), ("@import 'x'; .ad{color:red;display:none}", False), ("/* } */ @media print{.ad{display:none}} .ad{display:none}", False),
    ("@media print{.x{color:red}} .ad{display:none}", False),
])
def test_styles_under_conditions_and_replaced(css, seen):
    assert html_layout.render(f"<style>{css}</style><p class=ad>shown</p>end") == ("shown\n\nend" if seen else "end")
    assert html_layout.render("<style media=print>p{display:none}</style><p>shown") == "shown"


@pytest.mark.parametrize("page,text", [
    ("so <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>x=2</annotation></math> holds", "so x=2 holds"),
    ("a<svg><title>t</title><defs><text>no</text></defs>no<path d='M0'/><g><text>Label <tspan>one</tspan></text><text>two</text></g><desc>no</desc></svg>b", "a Label one two b"),
    ("<svg><g style='display:none'><text>no</text></g><desc/><text>yes</text></svg>", "yes"),
    ("Size <select><option>S<option selected>M<option>L</select> now", "Size M now"), ("<select><optgroup label=g><option>S</option></optgroup><option>L</select>", "S"),
    ("<select multiple><option>S<option>L</select>", "S\nL"), ("<select></select>x", "x"),
])
def test_formulas_drawings_and_choices(page, text):
    assert html_layout.render(page) == text


@pytest.mark.parametrize("page", ["<div>" * 60000, "<" * 90000, '<a <a "' * 30000 + ">", "<table><tr><td>" * 3000 + "x", "<li>" * 30000, "<!--" * 30000,
                                  "<script>" * 20000, "<p>" * 30000 + "</x>" * 30000, "<table>" + "<tr><td rowspan=100 colspan=100>a" * 600])
def test_layout_of_hostile_pages(page):
    assert isinstance(html_layout.render(page), str)


@pytest.mark.parametrize("page,text", [
    ('<style>.x{display:none}</style><p class="x" style="display:block">hi</p>', "hi"), ("<style>.x{display:none} #y{display:block}</style><p class=x id=y>hi", "hi"),
    ("<style>#y{display:block} .x{display:none}</style><p class=x id=y>hi", "hi"), ("<style>.x{display:none !important} #y{display:block}</style><p class=x id=y>hi", ""),
    ('<style>.x{display:none!important}</style><p class=x style="display:block">hi', ""), ("<style>div.ad{display:none}</style><div class=ad>no</div><p class=ad>yes", "yes"),
    ("<style>.a.b{display:none}</style><p class='b a'>no<p class=a>yes", "yes"), ("<style>*{visibility:hidden} b{visibility:visible}</style><p>no <b>yes</b>", "yes"),
    ("<style>nav .ad{display:none}</style><p class=ad>yes", "yes"), ("<style>.x{.y{display:none}}</style><p class=y>yes", "yes"),
    ("<style>p{color:red;display:none}</style><p>no<div>yes", "yes"), ("<p hidden style='display:block'>yes", "yes"), ("<style>p{display:block}</style><p hidden>yes", "yes"),
    ("a<!-->b<!-- c -->d", "abd"), ("a<!--->b<!-- c -->d", "abd"), ("a<!-- x --!>b", "ab"), ("a<!-- x", "a"), ("a<!--x--->b", "ab"),
    ("<ol reversed><li>c<li>b<li>a</ol>", "3. c\n2. b\n1. a"), ("<ol><li value=5>x<li>y<li value=-2>z<li>w</ol>", "5. x\n6. y\n-2. z\n-1. w"),
    ("<ol start=" + "9" * 5000 + "><li>x</ol>", "1000000000. x"), ("<ul><li>a<ul><li>b</ul></ul>", "- a\n  - b"),
])
def test_probed_pages(page, text):
    assert html_layout.render(page) == text


def test_columns_line_up():
    """Long cells are wrapped, so that the next column begins at one place; no word is lost; wide spans keep later cells in place."""
    long = " ".join(["lorem"] * 9)
    lines = html_layout.render(f"<table><tr><td>{long}<td>b<tr><td>s<td>c</table>").split("\n")
    assert lines[0].index("b") == lines[-1].index("c") and " ".join(" ".join(lines).replace("b", "").replace("c", "").split()) == f"{long} s"
    one = "x" * 60
    assert html_layout.render(f"<table><tr><td>{one}<td>b<tr><td>s<td>c</table>") == f"{one}  b\n" + "s".ljust(42) + "c"
    assert html_layout.render(f"<table><tr><td>{long}</table>") == long  # the only column is left as it is
    rows = html_layout.render("<table><tr>" + "<td>a" * 120 + "<tr><td colspan=119>w<td>z</table>").split("\n")
    assert rows[0].rindex("a") == rows[1].index("z")


def test_open_braces_take_linear_time():
    import time
    start = time.process_time()
    for css in ("a{" * 100_000, "a{;" * 100_000 + "}" * 100_000, "@media screen{" * 50_000, "{}" * 100_000):
        html_layout.render(f"<style>{css}</style><p>x")
    assert time.process_time() - start < 20


def test_extract_rows(spark):
    df = spark.createDataFrame([(1, "u", "<p>a"), (None, None, None), (1, "u", "<p>a")], "page_id long, text string, html string")
    assert sorted(map(str, html_layout.extract(df).collect())) == sorted(map(str, [
        *spark.createDataFrame([(1, "a", 1), (1, "a", 1), (None, "", 0)], "page_id long, text string, n_chars long").collect()]))
    assert html_layout.extract(df.limit(0)).collect() == []


def test_url_rules_and_reputation(spark):
    sets = [("http://Bad.example.com/x", 40, 38), ("http://sub.bad.example.com/x", 0, 0), ("https://good.example.com/fr/x", 40, 1), ("ftp://good.example.com", 30, 0),
            ("http://a.org/x", 1, 0), ("http://n.example.org/es/1", 0, 0), ("http://example.org/en/12", 0, 0), ("http://x.com/de/?q", 1, 0), ("http://a.org", 0, 0),
            ("no scheme", 2, 0), (None, 1, 0), ("http://h#f/en", 0, 0)]
    pages, labels, n = [], [], 0
    for url, many, bad in sets:
        for i in range(max(many, 1)):
            pages.append((n, url, "clash"))
            if i < many:
                labels.append((n, i < bad))
            n += 1
    labels += [(None, True), (0, None), (1, True), (1, False)]
    df = spark.createDataFrame(pages, "page_id long, url string, host string")
    rules = [("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block")]
    rows = urls.judge(df, spark.createDataFrame(labels, "page_id long, bad boolean"), rules).collect()
    assert len(rows) == len(pages)
    by = {(r.host, r.path): (r.rule, r.verdict) for r in rows}
    assert by["bad.example.com", "/x"] == (None, "block")
    assert by["good.example.com", "/fr/x"] == ("com/fr/", "allow") and by["good.example.com", ""] == (None, "allow")
    assert by["a.org", "/x"] == ("org/", "allow") and by["a.org", ""] == (None, "allow")  # the rule's path is "/"
    assert by["n.example.org", "/es/1"] == ("example.org/es/", "block") and by["example.org", "/en/12"] == ("example.org/en/1", "block")
    assert by["x.com", "/de/"] == ("com/de/", "block") and by["", ""] == (None, "allow") and by["h", ""] == (None, "allow")
    p = {r.host: (r.p_bad, r.bound) for r in rows}
    whole = sum(1 for i, b in labels if i is not None and b) / len({i for i, b in labels if i is not None})
    assert whole < p["sub.bad.example.com"][0] < p["bad.example.com"][0] < 38 / 40  # shrunk to the domain, and that to the suffix
    assert p["bad.example.com"][1] == pytest.approx(p["bad.example.com"][0] - 1.645 * math.sqrt(
        p["bad.example.com"][0] * (1 - p["bad.example.com"][0]) / (40 + strength(p, 40) + 1)), abs=0.02)
    none = urls.judge(df, spark.createDataFrame([], "page_id long, bad boolean"), rules)
    assert {r.p_bad for r in none.collect()} == {0.5}
    assert urls.judge(df.limit(0), spark.createDataFrame(labels, "page_id long, bad boolean"), rules).collect() == []


@pytest.mark.parametrize("host,domain,suffix", [
    ("a.b.co.uk", "b.co.uk", "co.uk"), ("co.uk", "co.uk", "co.uk"), ("b.uk", "b.uk", "uk"), ("xco.uk", "xco.uk", "uk"),
    ("a.b.c.ck", "b.c.ck", "c.ck"), ("c.ck", "c.ck", "c.ck"), ("ck", "ck", "ck"), ("www.ck", "www.ck", "ck"), ("a.www.ck", "www.ck", "ck"),
    ("x.city.kobe.jp", "city.kobe.jp", "kobe.jp"), ("x.y.z.kobe.jp", "y.z.kobe.jp", "z.kobe.jp"), ("a.b.leeds.sch.uk", "b.leeds.sch.uk", "leeds.sch.uk"),
    ("sch.uk", "sch.uk", "uk"), ("n.example.org", "n.example.org", "example.org"), ("localhost", "localhost", "localhost"), ("", "", ""),
    ("a..co.uk", ".co.uk", "co.uk"), ("a." * 50_000 + "com", "a.com", "com")])
def test_registered_domains(spark, host, domain, suffix):
    row = spark.createDataFrame([(host,)], "host string").select(*urls.domain_suffix(urls.SUFFIXES)).first()
    assert (row.domain, row.suffix) == (domain, suffix)


def test_registered_domains_without_rules(spark):
    row = spark.createDataFrame([("a.co.uk",)], "host string").select(*urls.domain_suffix(())).first()
    assert (row.domain, row.suffix) == ("co.uk", "uk")


def strength(p, n):
    """The prior's strength, read back from how far the host's mean was drawn to its domain's (sub.bad has the prior's mean)."""
    mean, prior = p["bad.example.com"][0], p["sub.bad.example.com"][0]
    return n * (38 / 40 - mean) / (mean - prior)


def test_warc_derivatives(spark, tmp_path):
    pages = [(1, "http://a.org/x", "<title>My  page</title><p>Hi <a href='/b c'>there</a><a href=#z>!</a>"), (2, None, None), (3, "http://b.org/\r\nX: y", "é"),
             (3, "http://b.org/\r\nX: y", "é")]
    df = spark.createDataFrame([(*p, "clash") for p in pages], "page_id long, url string, html string, record_id string")
    made = warc.responses(df, "2024-01-01T00:00:00Z")
    derived = warc.derivatives(made)
    assert sorted(map(str, derived.collect())) == sorted(map(str, warc.build(df, "2024-01-01T00:00:00Z").collect()))
    by = {(r.page_id, r.record_type): r for r in derived.collect()}
    source = {r.page_id: r for r in made.collect()}
    assert derived.count() == 2 * len(pages)
    for (page, kind), r in by.items():
        assert r.refers_to == source[page].record_id and r.payload_digest == source[page].payload_digest
        assert r.block_digest == warc.digest(r.block.encode()) and r.content_length == len(r.block.encode())
        assert r.concurrent_to == by[page, "metadata" if kind == "conversion" else "conversion"].record_id
    assert by[1, "conversion"].block == "Hi there!" and by[2, "conversion"].block == ""
    data = by[1, "metadata"].block.split("\r\n")
    assert "title: My page" in data and "outlink: /b c" in data and "outlink: #z" in data and "http-status: HTTP/1.1 200 OK" in data
    assert "http-header: Content-Type: text/html; charset=utf-8" in data and f"source-payload-digest: {source[1].payload_digest}" in data
    assert source[3].target_uri == "http://b.org/ X: y" and by[2, "metadata"].target_uri is None
    whole = made.unionByName(derived)
    warc.write(whole, str(tmp_path / "warc"))
    back = warc.read(spark, str(tmp_path / "warc"))
    assert back.where("not whole").count() == 0
    assert sorted(map(str, back.drop("whole", "page_id").collect())) == sorted(map(str, whole.drop("page_id").collect()))
    odd = made.withColumn("block", F.lit(None).cast("string"))
    assert {r.block for r in warc.derivatives(odd).where("record_type = 'conversion'").collect()} == {""}
    assert warc.build(df.limit(0), "x").collect() == []
