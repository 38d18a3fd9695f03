"""Exact, linearly interpolated quantiles that do not depend on one task.

``percentile`` keeps a value -> count map of everything it has seen in a single
reducer.  That map grows with the data, so it is not used here.

* Few rows (a configured bound): counts per distinct value, which map-side
  aggregation keeps to one row however hot a value is, ranked by a window per
  column or group.
* More rows: a sketch per column gives a bracket around each wanted rank.  The
  sketches are merged in two levels, so that no reducer receives one per map
  task.  One pass counts the values below and inside each bracket; another
  takes out the values inside, a fixed small share of the rows, as counts per
  distinct value.  These are ranked by a window while they are few; beyond that
  they are range-partitioned and staged, sums per partition locate the one that
  holds the rank, and only that partition is ranked.

The sketch decides only where to look.  Counts decide the answer, and a bracket
that misses its rank is widened, in the end to the whole range.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tableward.config import DEFAULTS, QualityConfig
from tableward.functions.columns import col, ident, number, text
from tableward.session import stage

_SKETCH_K = 2000
_MERGE_SALTS = 64
# Width of a bracket to either side of the rank, as a share of the rows.
_MARGINS = (0.004, 0.04, 1.0)


def _long(df: DataFrame, columns: Sequence[str], by: Sequence[str]) -> DataFrame:
    """``by..., slot, value``: one row per value, the column as a small number."""
    cells = ", ".join(f"named_struct('slot', {i}, 'value', CAST({ident(c)} AS DOUBLE))" for i, c in enumerate(columns))
    long = df.selectExpr(*[ident(b) for b in by], f"inline(array({cells}))")
    return long.where("value IS NOT NULL AND NOT isnan(value)")


def _interpolated(position: str, low: str, high: str) -> str:
    mixed = f"(floor({position}) + 1 - {position}) * {low} + ({position} - floor({position})) * {high}"
    return f"CASE WHEN {low} = {high} THEN {low} ELSE {mixed} END"


def _ranked(long: DataFrame, keys: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """Quantiles from a window over each key's distinct values."""
    named = ", ".join(ident(k) for k in keys)
    counts = long.groupBy(*keys, "value").agg(F.count("*").alias("c"))
    upto = counts.selectExpr(
        "*",
        f"sum(c) OVER (PARTITION BY {named} ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS end",
        f"sum(c) OVER (PARTITION BY {named}) AS n",
    )
    aggs = []
    for j, p in enumerate(probs):
        for name, rounding in (("l", "floor"), ("h", "ceil")):
            rank = f"{rounding}({number(p)} * (n - 1))"
            aggs.append(F.expr(f"max(CASE WHEN {rank} >= end - c AND {rank} < end THEN value END) AS {name}{j}"))
    found = upto.groupBy(*keys).agg(F.max("n").alias("n"), *aggs)
    cells = ", ".join(
        f"named_struct('prob', {number(p)}, 'value', {_interpolated(f'({number(p)} * (n - 1))', f'l{j}', f'h{j}')})"
        for j, p in enumerate(probs)
    )
    return found.selectExpr(*[ident(k) for k in keys], f"inline(array({cells}))")


def _brackets(long: DataFrame, keys: Sequence[str], probs: Sequence[float], margin: float) -> DataFrame:
    """Per key: number of values, and ``lo``/``hi`` around each wanted rank."""
    salted = (
        long.withColumn("salt", F.spark_partition_id() % _MERGE_SALTS)
        .groupBy(*keys, "salt")
        .agg(
            F.kll_sketch_agg_double("value", F.lit(_SKETCH_K)).alias("sketch"),
            F.count("*").alias("n"),
            F.min("value").alias("least"),
            F.max("value").alias("most"),
        )
    )
    merged = salted.groupBy(*keys).agg(
        F.kll_merge_agg_double("sketch", F.lit(_SKETCH_K)).alias("sketch"),
        F.sum("n").alias("n"),
        F.min("least").alias("least"),
        F.max("most").alias("most"),
    )
    bounds = [
        F.expr(f"{e} AS {n}{j}") for j, p in enumerate(probs) for n, e in zip(("lo", "hi"), _bounds("", p, margin))
    ]
    return merged.select(*keys, "n", *bounds)


def _bounds(suffix: str, p: float, margin: float) -> tuple[str, str]:
    """SQL for the ends of a bracket, from a sketch and the extremes."""
    at = "kll_sketch_get_quantile_double(sketch{}, {})".format
    lo = at(suffix, number(p - margin)) if p - margin > 0 else f"least{suffix}"
    hi = at(suffix, number(p + margin)) if p + margin < 1 else f"most{suffix}"
    return lo, hi


def _search(long: DataFrame, keys: Sequence[str], probs: Sequence[float], margin: float) -> DataFrame:
    """``keys..., prob, value`` per group; a value is NULL when its bracket missed the rank."""
    brackets = stage(_brackets(long, keys, probs, margin), "brackets")
    # Below a bracket only the count matters (v NULL); inside it, each value.
    seen = ", ".join(
        f"named_struct('which', {j}, 'v', CASE WHEN value >= lo{j} THEN value END, 'keep', value <= hi{j})"
        for j in range(len(probs))
    )
    counted = (
        long.join(brackets, list(keys))
        .selectExpr(*keys, f"inline(array({seen}))")
        .where("keep")
        .groupBy(*keys, "which", "v")
        .agg(F.count("*").alias("c"))
    )
    prob = f"element_at(array({', '.join(map(number, probs))}), which + 1)"
    wanted = brackets.select(*keys, "n", F.explode(F.sequence(F.lit(0), F.lit(len(probs) - 1))).alias("which")).selectExpr(
        *keys, "which", f"{prob} * (n - 1) AS position"
    )
    found = _locate(counted, wanted, [*keys, "which"])
    return wanted.join(found, [*keys, "which"], "left").selectExpr(*keys, f"{prob} AS prob", "value")


_HIT = "max(CASE WHEN v IS NOT NULL AND {0}(position) >= end - c AND {0}(position) < end THEN v END) AS {1}"


def _pick(ranked: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The value at each position, from counts with their running total ``end``."""
    hits = [F.expr(_HIT.format("floor", "low")), F.expr(_HIT.format("ceil", "high"))]
    return ranked.groupBy(*keys).agg(F.first("position").alias("position"), *hits).selectExpr(
        *keys, f"{_interpolated('position', 'low', 'high')} AS value"
    )


def _locate(counted: DataFrame, wanted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``keys..., value`` at the wanted positions, from counts of any number of values."""
    ranged = stage(
        counted.repartitionByRange(*keys, F.asc_nulls_first("v")).withColumn("part", F.spark_partition_id()), "ranks"
    )
    # at most one row per key and partition
    totals = (
        ranged.groupBy(*keys, "part")
        .agg(F.sum("c").alias("held"))
        .withColumn("upto", F.sum("held").over(W.partitionBy(*keys).orderBy("part")))
        .withColumn("before", F.col("upto") - F.col("held"))
    )
    holding = totals.join(wanted, list(keys)).where("ceil(position) >= before AND floor(position) < upto")
    inside = W.partitionBy(*keys, "part").orderBy(F.asc_nulls_first("v"))
    ranked = ranged.join(holding, [*keys, "part"]).withColumn("end", F.col("before") + F.sum("c").over(inside))
    return _pick(ranked, keys)


def _search_columns(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], cfg: QualityConfig, margin: float
) -> dict[tuple[str, float], float | None]:
    """Quantiles of whole columns; those whose bracket missed the rank are left out."""
    narrow = df.selectExpr(
        *[f"nanvl(CAST({ident(c)} AS DOUBLE), NULL) AS v{i}" for i, c in enumerate(columns)],
    )
    spots = range(len(columns))
    sketches = (
        narrow.selectExpr("*", f"spark_partition_id() % {_MERGE_SALTS} AS salt")
        .groupBy("salt")
        .agg(
            *[
                F.expr(e.format(i=i))
                for i in spots
                for e in (
                    f"kll_sketch_agg_double(v{{i}}, {_SKETCH_K}) AS sketch{{i}}", "count(v{i}) AS n{i}",
                    "min(v{i}) AS least{i}", "max(v{i}) AS most{i}",
                )
            ]
        )
        .selectExpr(
            *[
                e.format(i=i)
                for i in spots
                for e in (
                    f"kll_merge_agg_double(sketch{{i}}, {_SKETCH_K}) AS sketch{{i}}", "sum(n{i}) AS n{i}",
                    "min(least{i}) AS least{i}", "max(most{i}) AS most{i}",
                )
            ]
        )
    )
    ends = [
        f"CASE WHEN n{i} > 0 THEN {e} END AS {n}{i}_{j}"
        for i in spots
        for j, p in enumerate(probs)
        for n, e in zip(("lo", "hi"), _bounds(str(i), p, margin))
    ]
    row = sketches.selectExpr(*[f"n{i}" for i in spots], *ends).first()
    out: dict[tuple[str, float], float | None] = {}
    brackets = []  # column position, probability, position in order, ends
    for i in spots:
        for j, p in enumerate(probs):
            if not row[f"n{i}"]:
                out[columns[i], p] = None
            else:
                brackets.append((i, p, float(p) * (row[f"n{i}"] - 1), row[f"lo{i}_{j}"], row[f"hi{i}_{j}"]))
    if not brackets:
        return out
    tests = [f"v{i} BETWEEN {number(lo)} AND {number(hi)}" for i, _, _, lo, hi in brackets]
    sizes = narrow.selectExpr(
        *[f"count_if(v{i} < {number(lo)}) AS below{w}" for w, (i, _, _, lo, _) in enumerate(brackets)],
        *[f"count_if({t}) AS inside{w}" for w, t in enumerate(tests)],
    ).first()
    good = [
        w for w, (_, _, at, _, _) in enumerate(brackets)
        if sizes[f"below{w}"] <= math.floor(at) and math.ceil(at) < sizes[f"below{w}"] + sizes[f"inside{w}"]
    ]
    # a bracket of a single value that holds the rank is the answer already
    for w in good:
        i, p, _, lo, hi = brackets[w]
        if lo == hi:
            out[columns[i], p] = lo
    good = [w for w in good if brackets[w][3] != brackets[w][4]]
    if not good:
        return out
    cells = ", ".join(f"named_struct('which', {w}, 'v', CASE WHEN {tests[w]} THEN v{brackets[w][0]} END)" for w in good)
    counted = (
        narrow.where(" OR ".join(f"({tests[w]})" for w in good))
        .selectExpr(f"inline(array({cells}))")
        .where("v IS NOT NULL")
        .groupBy("which", "v")
        .agg(F.count("*").alias("c"))
    )
    # positions within the bracket: the values below it are known by number only
    at = ", ".join(f"{w}, {number(brackets[w][2] - sizes[f'below{w}'])}" for w in good)
    if max(sizes[f"inside{w}"] for w in good) <= cfg.quantile_inline_rows:
        order = W.partitionBy("which").orderBy("v").rowsBetween(W.unboundedPreceding, W.currentRow)
        found = _pick(counted.selectExpr("*", f"map({at})[which] AS position").withColumn("end", F.sum("c").over(order)), ["which"])
    else:
        wanted = df.sparkSession.range(len(brackets)).selectExpr("CAST(id AS INT) AS which", f"map({at})[CAST(id AS INT)] AS position")
        found = _locate(counted, wanted.where("position IS NOT NULL"), ["which"])
    for r in found.collect():  # one row per column and probability
        i, p = brackets[r["which"]][:2]
        out[columns[i], p] = r["value"]
    return out


def quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    by: Sequence[str] = (),
    cfg: QualityConfig = DEFAULTS,
    rows: int | None = None,
) -> DataFrame:
    """Long table ``by..., column, prob, value``; ``rows`` saves a count when known."""
    if not columns:
        raise ValueError("no numeric columns given")
    if rows is None:
        rows = df.count()
    names = ", ".join(text(c) for c in columns)
    if rows <= cfg.quantile_inline_rows:
        found = _ranked(_long(df, columns, by), [*by, "slot"], probs)
    elif by:
        # one struct for the group: structs also match on missing fields when joined
        packed = _long(df, columns, by).select(F.struct(*[col(b) for b in by]).alias("_by"), "slot", "value")
        for margin in _MARGINS:
            found = stage(_search(packed, ["_by", "slot"], probs, margin), "quantiles")
            if found.where(F.col("value").isNull()).isEmpty():
                break
        found = found.select("_by.*", "slot", "prob", "value")
    else:
        cells = ", ".join(
            f"named_struct('column', {text(c)}, 'prob', {number(p)}, 'value', {number(v)})"
            for (c, p), v in _whole_columns(df, columns, probs, cfg).items()
            if v is not None
        )
        if cells:
            return df.sparkSession.range(1).selectExpr(f"inline(array({cells}))")
        return df.sparkSession.createDataFrame([], "column string, prob double, value double")
    return found.selectExpr(*[ident(b) for b in by], f"element_at(array({names}), slot + 1) AS column", "prob", "value")


def _whole_columns(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], cfg: QualityConfig
) -> dict[tuple[str, float], float | None]:
    """The column search, a few columns per job, widening brackets that missed."""
    out: dict[tuple[str, float], float | None] = {}
    width = max(1, cfg.max_aggs_per_job // (4 * len(probs)))
    for start in range(0, len(columns), width):
        left = list(columns[start : start + width])
        for margin in _MARGINS:
            out |= _search_columns(df, left, probs, cfg, margin)
            left = [c for c in left if any((c, p) not in out for p in probs)]
            if not left:
                break
    return out


def quantile_values(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    cfg: QualityConfig = DEFAULTS,
    rows: int | None = None,
) -> dict[str, list[float | None]]:
    """The same for whole-table decisions: one short list per column on the driver."""
    if not columns:
        return {}
    if rows is None:
        rows = df.count()
    if rows > cfg.quantile_inline_rows:
        found = _whole_columns(df, columns, probs, cfg)
    else:
        found = {(r["column"], r["prob"]): r["value"] for r in quantiles(df, columns, probs, (), cfg, rows).collect()}
    return {c: [found.get((c, float(p))) for p in probs] for c in columns}
