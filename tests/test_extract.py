"""Extraction from texts, answers and pages."""

import time

import pytest
from pyspark.sql import functions as F

from catalith.functions import extract, html, markup

C = F.col

GLANCE = (
    "At a glance Price new £15,065 - £19,900 Used prices £1,295 - £9,995 Road tax cost £20 - £190 "
    "Insurance group 26 - 27 Fuel economy Not tested to latest standards Range 380 - 400 miles "
    "Number of doors 3 View full specs Available fuel types Petrol View"
)


def test_glance(spark):
    row = spark.createDataFrame([(GLANCE,), ("",)], "g string").select(*[
        c.alias(n) for n, c in extract.glance_fields(C("g")).items()]).collect()
    assert row[0].asDict() == {
        "new_price_min": "15065", "new_price_max": "19900", "used_price_min": "1295",
        "used_price_max": "9995", "road_tax_min": "20", "road_tax_max": "190",
        "insurance_group": "26", "fuel_economy": "Not tested to latest standards",
        "range_min": "380", "range_max": "400", "doors": "3", "fuel_types": "Petrol",
    }
    assert set(row[1]) == {None}


def pros_cons(one, **cells):
    given = {n: cells.get(n) for n in ("both", "pros", "cons", "page")}
    parts = extract.pros_cons(C("both"), C("pros"), C("cons"), C("page"))
    return tuple(one(p, **given) for p in parts)


def test_pros_cons_cascade(one):
    # the heading's own words match first and say nothing
    assert pros_cons(one, both="Pros & cons PROS fun CONS firm") == (None, None)
    assert pros_cons(one, both="PROS fun  to\ndrive CONS firm ride") == ("fun to drive", "firm ride")
    assert pros_cons(one, both="PROS & CONS firm", pros="roomy") == ("roomy", "firm")
    assert pros_cons(one, page="Good points: lots of space. Bad points: dull looks") == (
        "lots of space.", "dull looks")
    assert pros_cons(one, page="Pros: abc") == (None, None)  # too short
    assert pros_cons(one, page="Pros: " + "a" * 1000) == (None, None)  # too long


def test_author(one):
    author, date = extract.author_date(C("s"))
    text = "Written by Ivo Marsh Published: 6 June 2019 Updated: x"
    assert one(author, s=text) == "Ivo Marsh"
    assert one(date, s=text) == "6 June 2019 Updated: x"
    assert one(author, s="Written by Ann Lee, editor") == "Ann Lee"
    assert one(date, s="Written by Ann Lee, editor") is None


def rivals(one, text, **how):
    return [tuple(r) for r in one(extract.parse_rivals(C("s"), **how), s=text)]


def test_rivals_ratings_and_context(one):
    text = "MINI Cooper S: 4.5/5 (x): small and fun | mini cooper s: 3/5 | Fiat: 4/5"
    got = rivals(one, text)
    assert [r[:2] for r in got] == [("MINI Cooper S", "4.5/5"), ("Fiat", "4/5")]
    assert got[0][2] == "small and fun"
    assert len(rivals(one, text, dedupe=False)) == 3


def test_rivals_web_tail_gives_no_context(one):
    assert rivals(one, "Fiat: 4/5 | https://www.example.com/fiat/") == [("Fiat", "4/5", "")]


def test_rivals_from_addresses(one):
    got = rivals(one, "See Ford Fiesta https://a.example.com/x and VW Polo https://b.example.com")
    assert got == [
        ("See Ford Fiesta", "", "similar size and price"),
        ("x and VW Polo", "", "similar size and price"),
    ]


def test_rivals_limit_and_empty(one):
    many = " | ".join(f"Car number {i}: {i}/5" for i in range(9))
    assert len(rivals(one, many)) == 5
    assert rivals(one, "") == [] and rivals(one, None) == []


def test_out_of_five(one):
    assert one(extract.out_of_five(C("s")), s="Fiat 4.5 out of 5 Smart 3 out of 5") == (
        "Fiat: 4.5/5 | Smart: 3/5")


def test_rival_links(one):
    page = '<a class="c" href="/rivals/1">One</a><a href="/x">No</a><a href="/COMPETITOR">Two </a>'
    assert one(extract.rival_links(C("s")), s=page) == "One: /rivals/1 | Two: /COMPETITOR"


def test_prices(one):
    marked = (
        '<div class="vehicle-price" x><b>£12,500</b> or £11</div><p>£9</p>'
        '<span class="vehicle-price">£12,500</span><i data-testid="advert-price">£7,000</i>'
    )
    assert one(extract.html_prices(C("s")), s=marked) == [7000.0, 12500.0]
    assert one(extract.html_prices(C("s")), s="<p>£1,000 £2</p><p>x</p><p>£ 3</p>") == [1000.0, 3.0]
    assert one(extract.html_prices(C("s")), s=None) == []


@pytest.mark.parametrize("answer, low", [
    ('Sure: {"min_used_price_gbp": 5, "max_used_price_gbp": 6} ok', 5.0), ("{broken", None),
    ("none", None), (None, None), ('{"min_used_price_gbp": null}', None),
])
def test_answer_json(one, answer, low):
    got = one(extract.answer_json(C("s")), s=answer)
    assert (got["min_used_price_gbp"] if got else None) == low
    assert (got is None) == (answer is None or "}" not in answer)


def test_boilerplate(one):
    flag = extract.boilerplate(C("s"))
    assert one(flag, s="FOLLOW three simple  steps to get to your desired version")
    assert not one(flag, s="Step 1 of 3 - select trim level")
    assert one(flag, s="Step 1 of 3 - select trim level. Brief specification overview")
    assert not one(flag, s=None)


PAGE = """<html><head><title>T &amp; t</title><style>p{}</style>
<script>var a="</p><h2>No</h2>";</script></head><body><!-- <h2>no</h2> -->
<article><h1>The <b>Car</h1><p>Intro<br><p>more &lt;3</p><h2>Overview</h2><p>Fine</p>
<ul><li>one</li><li> two </li></ul><h3>Detail</h3><p>deep</p><h2></h2><p>lost</p>
<h2>Empty</h2></article><footer>x</footer></body></html>"""


def test_elements_are_whole(one):
    page = ('<div class="header">NAV</div><div class="x ad">A <div>inner</div> tail</div>'
            "<DIV class=ad>b</div><div class='an-ad'>no</div><div class=\"ad\"/><div class='ad y'>open <p>end")
    ads = lambda mark: markup.has_class(mark, "ad")
    whole = ["A <div>inner</div> tail", "b", "open <p>end"]
    assert one(markup.elements(C("s"), "div", ads), s=page) == whole
    assert one(markup.elements(C("s"), None, ads), s=page) == whole
    assert one(markup.elements(C("s"), "div", ads, first=True), s=page) == whole[:1]
    assert one(markup.elements(C("s"), "div"), s="a<div>b<div>c</div>d</div>e") == ["b<div>c</div>d", "c"]
    assert one(markup.elements(C("s"), "div", outer=True), s="<div>b<div>c</div></div><div>d</div>") == [
        "b<div>c</div>", "d"]
    assert one(markup.elements(C("s"), "div"), s="") == [] and one(markup.elements(C("s"), "div"), s=None) is None


def test_field_rules_take_whole_classes(one):
    page = ('<ul class="prospects"><li>wrong</li></ul><ul class="pros"><li>right one</li>'
            "<li>more<ul><li>deep</li></ul></li><li>last</li></ul>")
    got = {f["field"]: f["value"] for f in one(html.fields(C("s")), s=page)}
    assert got == {"pros": "right one | more | deep | last"}


def test_references(one):
    assert one(markup.decode(C("s")), s="x &#8211; &#163;5 &eacute;&#xE9; &amp;lt; &no; &#150;&nbsp;y&#160;&#x1F600;") == (
        "x – £5 éé &lt; &no; – y 😀")
    assert one(markup.decode(C("s")), s="&#0;&#55296;&#9999999; & x;") == "\ufffd\ufffd\ufffd & x;"
    assert one(markup.decode(C("s")), s=None) is None and one(markup.decode(C("s")), s="") == ""


def test_all_articles(one):
    page = "<article><h1>A</h1>x</article><nav>n</nav><article>y<article>z</article></article>"
    assert one(html.markdown(C("s")), s=page).startswith("x\n\ny")
    assert "n" not in one(html.sections(C("s")), s=page)[0]["text"]
    assert one(html.title(C("s")), s=page) == "A"


def test_prices_in_nested_elements(one):
    page = '<div class="vehicle-price"><div>From</div>&pound;<b>9,000</b></div>'
    assert one(extract.html_prices(C("s")), s=page) == [9000.0]
    assert one(extract.html_prices(C("s")), s="<p>&#163;1,500</p>") == [1500.0]


def test_sections(one):
    got = [tuple(s) for s in one(html.sections(C("s")), s=PAGE)]
    assert got[0][0] == "full_text" and "No" not in got[0][1] and "more <3" in got[0][1]
    assert got[1:] == [("Overview", "Fine\n- one\n- two\nDetail\ndeep")]


def test_markdown(one):
    assert one(html.markdown(C("s")), s=PAGE) == (
        "Intro\n\nmore <3\n\n## Overview\n\nFine\n\n- one\n\n- two\n\n### Detail\n\ndeep\n\n##"
        "\n\nlost\n\n## Empty")


def test_page_fields(one):
    page = PAGE.replace("<ul>", '<ul class="x pros y">')
    got = {f["field"]: f["value"] for f in one(html.fields(C("s")), s=page)}
    assert got["title"] == "The Car" and got["pros"] == "one | two"
    assert "cons" not in got and "rivals" not in got
    untitled = {f["field"]: f["value"] for f in one(html.fields(C("s")), s="<title>A</title>")}
    assert untitled == {"title": "A"}


def test_nested_elements_of_several_names(one):
    page = '<a class="m">1<div class="m">2<a>3</a></div>4</a><div class="m"/><div class="m">5<a class="m">6</div>7'
    marked = lambda mark: markup.has_class(mark, "m")
    assert one(markup.elements(C("s"), None, marked), s=page) == [
        '1<div class="m">2<a>3</a></div>4', "2<a>3</a>", '5<a class="m">6', "6</div>7"]


def test_one_pass_over_many_tags(one):
    """20,000 tags, half of them opening accepted elements, in nested groups of five."""
    group = '<div class="ad">x' * 5 + "</div>" * 5
    start = time.time()
    found = one(markup.elements(C("s"), "div", lambda mark: markup.has_class(mark, "ad")), s=group * 2000)
    assert len(found) == 10_000 and found[0] == group[len('<div class="ad">'):-len("</div>")] and found[-1] == "x"
    assert time.time() - start < 20  # a walk per element took minutes
