"""SQL fragments for the oracles (DuckDB dialect)."""

from __future__ import annotations

from catalith.plans.views import view_sql

SPACES = "concat(' ', chr(9), chr(10), chr(13), chr(160))"


def views(*names: str) -> str:
    """WITH clause for derived views, left open for more CTEs after a comma."""
    return "WITH " + ", ".join(f"{n} AS ({view_sql(n)})" for n in names) + " "


def strip(x: str) -> str:
    return f"trim({x}, {SPACES})"


def squeeze(x: str) -> str:
    return rf"{strip(rf'''regexp_replace(coalesce({x}, ''), '[\s\x{{A0}}]+', ' ', 'g')''')}"


def norm(x: str) -> str:
    return f"lower({squeeze(x)})"


def number(x: str) -> str:
    return (
        rf"CASE WHEN regexp_matches({strip(x)}, '^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$') "
        rf"THEN try_cast({strip(x)} AS DOUBLE) END"
    )


def blank_null(x: str) -> str:
    return (
        f"CASE WHEN lower({strip(x)}) NOT IN ('', 'nan', 'none', 'null') THEN {strip(x)} END"
    )


def norm_years(x: str) -> str:
    dashes = x
    dashes = f"lower({strip(f'''coalesce({dashes}, '')''')})"
    for dash in ("‐", "‑", "‒", "–", "—", "―", "−", "to"):
        dashes = f"replace({dashes}, '{dash}', '-')"
    return f"regexp_replace(regexp_replace({dashes}, ' ?- ?', '-', 'g'), ' +', ' ', 'g')"


def whole(x: str) -> str:
    """Half-even rounding to bigint."""
    return f"cast(round_even({x}, 0) AS bigint)"
