"""Attachments that repeat a position very often, and the steps of their size (round 3)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from creditmap import catalog
from creditmap.config import testdata_config as analog
from creditmap.operators import output as O
from creditmap.operators.intervals import disjoint_intervals
from creditmap.operators.skew import heavy_hitter_join
from creditmap.plans import lookup as L
from creditmap.plans import market_share as MS
from creditmap.plans import sales_assets as SA
from creditmap.plans import vendor as V
from creditmap.plans.inhouse import direct_source, in_house_daily, in_house_monthly
from creditmap.schemas import MARKET_SHARE_COLUMNS, SALES_ASSETS_COLUMNS
from creditmap.sources.layouts import buckets_for

SF = "/root/testdata/sf0.001"
LOOKUP = "__kind string, __key string, __territory string, __selling_code string, __start date, __end date"
DAY = dt.date(2020, 1, 1)


@pytest.fixture(scope="module")
def src(spark):
    return catalog.sources_for(spark, SF)


def same(a, b):
    assert a.columns == b.columns and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def tasks_of(df) -> int:
    return df.select(F.spark_partition_id().alias("p")).distinct().count()


def bridge(spark, keys, codes):
    return spark.createDataFrame([("rep", f"k{k}", "T", f"SC{c}", DAY, DAY) for k in range(keys) for c in range(codes)], LOOKUP)


# ---- F1, F2: the DISTINCT before the fan-out

def test_only_rows_with_a_shared_face_meet_the_later_distinct(spark):
    """Equal rows from two keys, from two positions and from a stage collapse; the others never reach the DISTINCT."""
    stage = spark.createDataFrame([("f1", "a"), ("f1", "a"), ("f5", "z")], "face string, code string")
    rows = spark.createDataFrame([("f1", 1), ("f2", 1), ("f2", 2), ("f3", 1), ("f4", 2), ("f4", 2), (None, 2)], "face string, k int")
    codes = spark.createDataFrame([(1, "a"), (1, "b"), (2, "b"), (2, "c")], "k int, code string")
    seen = []

    def fan_out(part):
        seen.append({r.face for r in part.collect()})
        return part.join(codes, "k", "left").select("face", "code")

    got = O.accumulate_fanned([stage], [stage.select("face")], rows, ["face"], fan_out)
    same(got, stage.unionByName(fan_out(rows)).distinct())
    assert seen[:2] == [{"f1", "f2", "f4"}, {"f3", None}]


def test_disjoint_intervals(spark):
    d = lambda n: DAY + dt.timedelta(n)
    x = spark.createDataFrame([("a", d(0), d(9)), ("a", d(1), d(2)), ("a", d(5), d(12)), ("a", d(20), d(21)), ("a", d(21), d(22)),
                               ("a", d(31), d(30)), ("b", d(0), d(1)), (None, d(0), d(1)), ("b", None, d(1))], "k string, s date, e date")
    got = {tuple(r) for r in disjoint_intervals(x, ["k"], "s", "e").collect()}
    assert got == {("a", d(0), d(12)), ("a", d(20), d(22)), ("b", d(0), d(1)), (None, d(0), d(1))}


def test_market_share_equals_the_plain_distinct(spark, src):
    cfg = analog(as_of=None)
    plain = (MS.vendor_stages(src, cfg), in_house_daily(src, cfg, MS.peers_of(src)))
    same(MS.market_share(src, cfg), O.accumulate(*(O.conform(s, MARKET_SHARE_COLUMNS) for s in plain)))


def test_sales_assets_equals_the_plain_distinct(spark, src):
    cfg = analog()
    plain = (SA.vendor_stages(src, cfg), in_house_monthly(src, cfg), direct_source(src, cfg))
    same(SA.sales_assets(src, cfg), O.accumulate(*(O.conform(s, SALES_ASSETS_COLUMNS) for s in plain)))


# ---- F3, F4, F5: few bytes that join to many rows are dealt to all tasks

@pytest.mark.parametrize("keys", [40, 1])
def test_attached_positions_are_not_put_together_by_bytes(spark, keys):
    rows = spark.range(400).select("id", F.concat(F.lit("k"), F.col("id") % keys).alias("k"), F.lit(DAY).alias("d"))
    x = L.attach(rows, [bridge(spark, keys, 5)], F.lit("rep"), F.col("k"), F.col("d"), "rep", fans_out=True)
    assert x.count() == 2000 and x.select("id", L.SELLING_CODE).distinct().count() == 2000
    assert tasks_of(x) >= 4


def test_heavy_hitter_join_is_not_put_together_by_bytes(spark):
    rows = spark.range(400).select("id", F.concat(F.lit("k"), F.col("id") % 400).alias("k"))
    x = heavy_hitter_join(rows, bridge(spark, 400, 5).select(F.col("__key").alias("k"), "__selling_code"), "k")
    assert x.count() == 2000 and tasks_of(x) >= 4


# ---- F6, F9: owners do not move positions; the accumulator's stages are worked out once

def test_owners_do_not_move_positions(spark, src):
    x = MS.attached_positions(src, analog(as_of=None), (MS.ADVISOR, MS.CLIENT))
    plan = x._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(__lk" not in plan and "hashpartitioning(__rk" not in plan


def test_accumulator_days_read_stored_rows(spark, src, monkeypatch):
    parts, append = [], catalog.append_days

    def noted(df, path, **how):
        parts.append(df.inputFiles())
        append(df, path, **how)

    monkeypatch.setattr(catalog, "append_days", noted)
    got = catalog._accumulated(src)
    assert len(parts) == 3 and all("accumulate-distinct" in f for p in parts for f in p)
    same(got, catalog._q_accumulate(src, analog()))


# ---- F7: buckets grow with the tables

def test_buckets_grow_with_the_tables(spark, src):
    tables = [src[name] for name in ("ETF_ASSET_POSITION_FACT", "ETF_HOLDINGS_DIM")]
    assert buckets_for(tables) == 8
    few, many = buckets_for(tables, 4096), buckets_for(tables, 1024)
    assert 8 < few < many and many == 4 * few


# ---- F8, F10: only the holdings of the wanted stage

@pytest.mark.parametrize("route", V.SA_ROUTES)
def test_positions_of_one_stage(spark, src, route):
    one = V.sales_positions(src, analog(), (route,))
    same(one, V.sales_positions(src, analog()).where(F.col(V.ROUTE) == route))


def test_holdings_meet_their_branch_before_accounts(spark, src):
    plan = V.holdings_dims(src, analog(), (V.SA_REP,))._jdf.queryExecution().optimizedPlan().toString().splitlines()
    depth = lambda name: next(x.index("Relation") for x in plan if "Relation" in x and name in x)
    assert depth("Office_Postal_CD") > depth("Account_Postal_CD")
