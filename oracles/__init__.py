"""Hand-written SQL that gives the same results as the registered queries."""

from oracles import (
    classifying, combining, enriching, extracting, loading, normalising, searching,
)

ORACLES: dict[str, str] = {}
for _part in (normalising, classifying, extracting, combining, searching, loading, enriching):
    ORACLES.update(_part.SQL)
