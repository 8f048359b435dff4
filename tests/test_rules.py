"""Rule packs at their thresholds."""

import pytest
from pyspark.sql import functions as F

from catalith import values
from catalith.functions import vehicle
from catalith.functions.rules import Rule, classify

C = F.col


@pytest.mark.parametrize("body, length, bucket, descriptor, coarse", [
    ("Hatchback", None, "small hatchback", "medium hatchback", "small hatchback"),
    ("Hatchback", 4300.0, "medium hatchback", "medium hatchback", "small hatchback"),
    ("Hatchback", 4299.9, "small hatchback", "small hatchback", "small hatchback"),
    ("SUV", 4600.0, "large SUV", "crossover SUV", "large SUV"),
    ("SUV", 4599.0, "crossover SUV", "crossover SUV", "crossover SUV"),
    ("Saloon", None, "small saloon", "executive saloon", "small saloon"),
    ("Saloon", 4700.0, "executive saloon", "executive saloon", "large"),
    ("Saloon", 4900.0, "executive saloon", "executive saloon", "exec saloon"),
    ("Gran Coupe", 4850.0, "gran coupe", "large executive hatchback (gran coupe style)", "large"),
    ("MPV", None, "MPV", "MPV", "mpv"),
    ("Van", 4850.0, "Van", "large executive car", "large"),
    (None, None, "car", "car", None),
    ("Premium Estate", None, "estate", "premium estate", "estate"),
])
def test_sizes(one, body, length, bucket, descriptor, coarse):
    length_col = C("n").cast("double")
    cells = {"b": body, "n": length}
    assert one(vehicle.size_bucket(C("b"), length_col), **cells) == bucket
    assert one(vehicle.size_descriptor(C("b"), length_col), **cells) == descriptor
    assert one(vehicle.coarse_size(C("b"), length_col), **cells) == coarse


@pytest.mark.parametrize("body, length, label", [
    ("suv", 4800.0, "full-size"), ("saloon", 4800.0, "large"), ("saloon", 4900.0, "executive"),
    ("mpv", 4400.0, "mid-size"), ("mpv", 4399.0, "compact"), ("crossover", None, "compact"),
    ("wagon", None, "executive"), ("mpv", None, None),
])
def test_size_class(one, body, length, label):
    assert one(vehicle.size_class(C("b"), C("n").cast("double")), b=body, n=length) == label


@pytest.mark.parametrize("seconds, label", [
    (3.4, "supercar"), (3.5, "very fast"), (5.0, "decent performance"), (7.0, "average slow"),
    (10.0, "very slow"), (None, "unknown"),
])
def test_performance(one, seconds, label):
    assert one(vehicle.performance(C("n").cast("double")), n=seconds) == label


@pytest.mark.parametrize("answer, label", [
    ("Hatch Back", "medium hatchback"), ("crossover suv", "crossover SUV"), ("mpv", "MPV"),
    ("EXECUTIVE HATCHBACK (gran coupe style)", "executive hatchback (gran coupe style)"),
    ("executive gran tourer", "executive hatchback (gran coupe style)"), ("van", None),
    ("pickup", "pickup"), (None, None),
])
def test_canonical_label(one, answer, label):
    assert one(vehicle.canonical_label(C("s")), s=answer) == label


def test_fuel_answers(one):
    col = vehicle.fuel_type(C("e"), C("a"))
    assert one(col, e="2.0 TDI", a="It is Diesel.") == "diesel"
    assert one(col, e="2.0 TDI", a="no idea") == "petrol"
    assert one(col, e="1.4 plug-in hybrid", a=None) == "plug in hybrid"
    assert one(col, e="Chevy", a=None) == "electric"  # 'ev' matches inside words, as it must


def test_mileage_order(one):
    col = vehicle.mileage_band(C("f"), C("m"))
    assert one(col, f="Hybrid", m="BMW") == "0–80k miles"
    assert one(col, f="Diesel", m="Toyota") == "0–100k miles"
    assert one(col, f="Diesel", m="Ford") == "40k–100k miles"


def test_variant_sentence(one):
    col = vehicle.variant_sentence(C("e"), C("f"), C("g"), C("d"))
    assert one(col, e=None, f=None, g=None, d=None) == "A sensible choice for typical daily driving."
    assert one(col, e="3.0 AMG", f="", g="Manual", d="xDrive") == (
        "This variant is genuinely quick and more enthusiast-leaning, with more engaging feel if "
        "you like to be involved, added all-weather confidence.")


def test_variant_notes_keep_two(one):
    col = vehicle.variant_notes(C("e"), C("f"), C("g"), C("d"))
    got = one(col, e="2.0 TDI", f="Diesel", g="Automatic", d="AWD")
    assert got == " ".join([values.NOTE_TEXTS["diesel"], values.NOTE_TEXTS["mid"]])
    assert one(col, e=None, f=None, g=None, d=None) == values.NOTE_TEXTS["none"]


def test_buyer_fit(one):
    col = vehicle.buyer_fit(C("e"), C("b"), C("m"))
    assert one(col, e="2.0 TDI", b="Estate", m="strong economy") == (
        "high-mileage professionals, practical families")
    assert one(col, e="1.0", b="Coupe", m="") == "city and suburban commuters"


def test_rule_without_condition_is_refused(spark):
    with pytest.raises(ValueError):
        classify((Rule("x"),), F.lit("a"))
