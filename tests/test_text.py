"""Normalisers, keys and projections on edge cases."""

import pytest
from pyspark.sql import functions as F

from catalith.functions import compose, text, urls

C = F.col


@pytest.mark.parametrize("given, expected", [
    (" A  b\tC ", "a b c"), (None, ""), ("  ", ""), ("Über", "über"), ("a\n\nb", "a b"),
])
def test_norm(one, given, expected):
    assert one(text.norm(C("s")), s=given) == expected


@pytest.mark.parametrize("given, expected", [
    ("2001 – 2009", "2001-2009"), ("2001 to 2009", "2001-2009"), ("A  b —c", "a b-c"),
    ("2001 ‑2003−2004", "2001-2003-2004"), (None, ""),
])
def test_norm_years(one, given, expected):
    assert one(text.norm_years(C("s")), s=given) == expected


@pytest.mark.parametrize("given", ["", " ", "nan", "NaN", "none", "NULL", None])
def test_blank_to_null(one, given):
    assert one(text.blank_to_null(C("s")), s=given) is None
    assert one(text.or_placeholder(C("s")), s=given) == "placeholder"


def test_keys_never_hold_a_null(one):
    key = text.family_key(C("a"), C("b"), C("c"))
    assert one(key, a=" BMW ", b=None, c="2001 x") == "bmw||2001 x"


def test_variant_key(one):
    key = text.variant_key(F.lit("fam"), C("e"), C("i"))
    assert one(key, e=" 2.0 TDI (x) ", i=7) == "fam__2-0-tdi-x"
    assert one(key, e="--", i=7) == "fam__row7"
    assert one(key, e=None, i=7) == "fam__row7"


@pytest.mark.parametrize("given, expected", [
    ("1.5", 1.5), ("1.5d", None), ("nan", None), ("inf", None), (" 7 ", 7.0), (".5", 0.5),
    ("12,000", None), ("1e3", 1000.0), ("", None), (None, None), ("-2", -2.0),
])
def test_number(one, given, expected):
    assert one(text.number(C("s")), s=given) == expected


def test_number_thousands(one):
    assert one(text.number(C("s"), thousands=True), s="12,000.5") == 12000.5


@pytest.mark.parametrize("given, expected", [("2.5", "2"), ("3.5", "4"), ("x", ""), (None, "")])
def test_integer_text_is_half_even(one, given, expected):
    assert one(text.integer_text(C("s")), s=given) == expected


def test_one_decimal(one):
    assert one(text.one_decimal(C("n")), n=8.5) == "8.5"
    assert one(text.one_decimal(C("n")), n=10.0) == "10.0"
    assert one(text.one_decimal(C("n")), n=0.25) == "0.2"


@pytest.mark.parametrize("years, expected", [
    ("2005 to 2010 (2011)", "2005–2010"), ("from 2005", "2005–present"), ("Golf Mk2", "Mk2"),
    ("Golf", "Golf"), ("", ""),
])
def test_clean_years(one, years, expected):
    assert one(text.clean_years(C("m"), C("y")), m="Golf", y=years) == expected


def test_clean_text_cuts_tails(one):
    given = "Good  car.\n© 1999-2024 Someone and more"
    assert one(text.clean_text(C("s")), s=given) == "Good car."
    assert one(text.clean_text(C("s"), ()), s="a  © 1999-2024") == "a © 1999-2024"


@pytest.mark.parametrize("count", [0, 1, 4, 5, 6, 40])
def test_word_limit(one, count):
    given = "  " + " \n ".join(f"w{i}" for i in range(count))
    words = given.split()
    expected = given if len(words) <= 5 else " ".join(words[:5])
    assert one(text.word_limit(C("s"), 5), s=given) == expected


def test_word_limit_reads_long_texts(one):
    given = " ".join(["word"] * 20000)
    assert one(text.word_limit(C("s"), 150), s=given) == " ".join(["word"] * 150)


def test_bounded_pairs_stops_at_first_overflow(one):
    pairs = [("a", C("a")), ("b", C("b")), ("c", C("c"))]
    # a costs 6, b would overflow, c would fit but comes after
    assert one(text.bounded_pairs(pairs, 12), a="1", b="123456789", c="2") == "a: 1"


def test_value_range(one):
    col = text.value_range(C("a"), C("b"))
    assert one(col, a="1", b="2") == "1-2"
    assert one(col, a="1", b="1") == "1"
    assert one(col, a=None, b="2") == "2"


def test_column_patterns():
    names = ["Power (bhp)", "0-60 mph (secs)", "0 – 60 MPH max"]
    assert text.matching_columns(names, [r"0\s*[-–]\s*60\s*mph"]) == names[1:]
    assert text.matching_columns(names, []) == []


def test_missing_columns_give_null(one):
    assert one(text.first_numeric(["a"], ["zzz"]), a="1") is None
    assert one(text.min_numeric(["a"], ["zzz"]), a="1") is None


def test_display_name(one):
    col = compose.display_name(C("s"), F.lit("BMW"), F.lit("X1"))
    assert one(col, s="\"BMW 'X1'\" ") == "BMW X1"
    assert one(col, s=None) == "BMW X1"


def test_rivals_text_forms(one):
    col = compose.rivals_text(C("s"))
    assert one(col, s="[{'name': 'Mini', 'context': 'fun'}, {'name': ''}]") == "Mini: fun"
    assert one(col, s='[{"name": "A"}, {"name": "B", "context": " x "}]') == "A | B: x"
    assert one(col, s="no list") == ""
    assert one(col, s=None) == ""


def test_template_needs_known_fields():
    with pytest.raises(KeyError):
        text.fill_template("{nope}", {})


@pytest.mark.parametrize("given, expected", [
    ("HTTP://Shop.example.org//A//B/?q=1#x", "http://Shop.example.org/a/b"),
    ("/Bmw/X1/", "https://www.example.com/bmw/x1"), ("bmw", "https://www.example.com/bmw"),
    ("https://h.example.org", "https://h.example.org"),
])
def test_url_normalize(one, given, expected):
    assert one(urls.normalize(C("s")), s=given) == expected


def test_url_candidates(one):
    got = one(urls.candidates(C("s")), s="https://h.example.org/bmw/x1/suv-2015/specs?x#y")
    base = "https://www.example.com/bmw/x1/"
    assert got[:2] == [base + "suv-2015/review/", base + "suv-2015/review"]
    assert base + "suv/used-review" in got and len(got) == 12
    assert one(urls.candidates(C("s")), s="x/specs") == []
    assert one(urls.candidates(C("s")), s="https://a.example.org/review") == [
        "https://a.example.org/review"]


def test_slug(one):
    assert one(urls.slug(C("s")), s=" Å 3-Series (New)! ") == "å-3-series-new"
    assert one(urls.slug(C("s")), s="!!") == "row"
    assert len(one(urls.slug(C("s")), s="x" * 200)) == 80
