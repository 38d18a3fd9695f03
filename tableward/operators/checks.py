"""Consistency checks: built-in ones per type class, and a way to add more.

A check counts offending values inside the one counting pass.  When its
trigger fires, the column loses ``penalty`` points and gains an issue text.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from tableward.config import DEFAULTS, QualityConfig
from tableward.functions.columns import NUMERIC, TEMPORAL, TEXT, number, text
from tableward.functions.scalars import WHITESPACE


@dataclass(frozen=True)
class Context:
    """What a check may use besides the column: the clock, fences and settings."""

    now: str
    fences: Mapping[str, tuple[float, float]] = field(default_factory=dict)
    cfg: QualityConfig = DEFAULTS


@dataclass(frozen=True)
class Check:
    """A rule for the columns of one type class, in SQL.

    ``offends(column name, column as SQL, context)`` is the condition counted.
    ``fires`` compares the count ``{found}`` with the column's non-null values
    ``{present}`` or the table's rows ``{total}``, and may use settings.
    ``message`` is the issue text; ``%d`` in it shows the count.
    """

    name: str
    applies_to: str
    penalty: int
    offends: Callable[[str, str, Context], str]
    message: str
    fires: str = "{found} > 0"


def _extreme(name: str, c: str, ctx: Context) -> str:
    if name not in ctx.fences:
        return "false"
    lo, hi = ctx.fences[name]
    return f"{c} < {number(lo)} OR {c} > {number(hi)}"


# Penalties and issue texts of the built-in checks.
TEXT_CASING = Check(
    "casing", TEXT, 20,
    lambda name, c, ctx: f"NOT ({c} = lower({c}) AND {c} <> upper({c})) AND NOT ({c} = upper({c}) AND {c} <> lower({c}))",
    "Inconsistent text casing",
    "{found} > {present} * {cfg.mixed_case_share}D",
)
TEXT_BLANKS = Check(
    "outer_blanks", TEXT, 10, lambda name, c, ctx: f"{c} <> btrim({c}, {text(WHITESPACE)})",
    "%d values with leading/trailing whitespace",
)
TEXT_EMPTY = Check("empty", TEXT, 15, lambda name, c, ctx: f"{c} = ''", "%d empty strings")
NUMERIC_EXTREMES = Check(
    "extremes", NUMERIC, 25, _extreme, "%d extreme outliers detected", "{found} > {total} * {cfg.extreme_share}D"
)
FUTURE_DATES = Check(
    "future", TEMPORAL, 20, lambda name, c, ctx: f"CAST({c} AS TIMESTAMP_NTZ) > {ctx.now}", "%d future dates detected"
)
OLD_DATES = Check(
    "old", TEMPORAL, 15, lambda name, c, ctx: f"CAST({c} AS TIMESTAMP_NTZ) < TIMESTAMP_NTZ '1900-01-01'",
    "%d dates before 1900",
)

BUILT_IN = (TEXT_CASING, TEXT_BLANKS, TEXT_EMPTY, NUMERIC_EXTREMES, FUTURE_DATES, OLD_DATES)


def negative_amounts(columns: tuple[str, ...], penalty: int = 10) -> Check:
    """Domain check for money: amounts that should not be below zero."""
    return Check(
        "negative", NUMERIC, penalty, lambda name, c, ctx: f"{c} < 0" if name in columns else "false",
        "%d negative amounts",
    )
