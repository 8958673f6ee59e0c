"""Owner ranking per branch key, attachment and the territory waterfall.

``rank_owner`` is ROW_NUMBER over a partition by branch key, ordered by
the aggregated measures (W-01, W-02).  The scripts' order is not total;
a final ascending territory makes the winner deterministic (Q-10).

Positions get their owner from the rank-1 rows only (``argmax_owner``, then
``plans.lookup.attach``).  The scripts join the ranked table to the right of
the positions and keep ``rn = 1 OR rn IS NULL``; every non-NULL key has exactly
one rank-1 row, so both keep each position once, and the winners alone come from
an aggregate with map-side partials.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.keys import col, same_text


def rank_owner(cands: DataFrame, key: str, measures: list[str], tiebreak: str,
               rank_col: str = "rn") -> DataFrame:
    order = [F.col(m).desc_nulls_last() for m in measures] + [F.col(tiebreak).asc_nulls_first()]
    w = Window.partitionBy(key).orderBy(*order)
    return cands.withColumn(rank_col, F.row_number().over(w))


def top_owner(cands: DataFrame, key: str, measures: list[str], tiebreak: str) -> DataFrame:
    """Only the rn = 1 row of every key."""
    return rank_owner(cands, key, measures, tiebreak, "__rn").where(F.col("__rn") == 1).drop("__rn")


def argmax_owner(cands: DataFrame, key: str, measures: list[str], tiebreak: str) -> DataFrame:
    """The rows of :func:`top_owner` by an aggregate: each task sends one row per
    key, winners of parts can be merged again, and a key with very many
    candidates needs no sorted window.

    The least of (measure is NULL, negated measure, ...; tiebreak) comes first in
    the order of :func:`rank_owner`."""
    order = [x for m in measures for x in (F.col(m).isNull(), -F.col(m))] + [F.col(tiebreak)]
    names = [f"o{i}" for i in range(len(order))]
    rest = [c for c in cands.columns if c not in (key, tiebreak)]
    least = F.min(F.struct(*(x.alias(n) for x, n in zip(order, names)), F.struct(*rest).alias("rest")))
    top = cands.groupBy(key).agg(least.alias("__top"))
    kept = {c: F.col(f"__top.rest.{c}") for c in rest} | {tiebreak: F.col(f"__top.{names[-1]}"), key: F.col(key)}
    return top.select(*(kept[c].alias(c) for c in cands.columns))


def _waterfall_steps(override, ranked, house_code, house_codes, house_label) -> list[tuple[str, Column, Column]]:
    """(name, condition, territory) in order of precedence."""
    steps = [("override", col(override).isNotNull(), col(override))]
    if house_codes:
        steps.append(("house", same_text(house_code).isin(*house_codes), F.lit(house_label)))
    return [*steps, ("ranked", col(ranked).isNotNull(), col(ranked))]


def waterfall(override, ranked, house_code=None, house_codes: tuple = (), house_label: str | None = None) -> Column:
    """Territory waterfall: override, else house account label, else the
    ranked owner (P-11); without house codes it is COALESCE (P-12)."""
    return F.coalesce(*(F.when(test, value) for _, test, value in _waterfall_steps(
        override, ranked, house_code, house_codes, house_label)))


def waterfall_step(override, ranked, house_code=None, house_codes: tuple = (), house_label: str | None = None) -> Column:
    """Which step of :func:`waterfall` decides; ``none`` if none does."""
    return F.coalesce(*(F.when(test, F.lit(name)) for name, test, _ in _waterfall_steps(
        override, ranked, house_code, house_codes, house_label)), F.lit("none"))


def sum_per_key(rows: DataFrame, keys: list[str], sums: list[str]) -> DataFrame:
    """A fact reduced to its join keys (partial sums before the shuffle), so it
    meets a dimension chain once per key: SUM is linear in join fan-out (R-2)."""
    return rows.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums])
