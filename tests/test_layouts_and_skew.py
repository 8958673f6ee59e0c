"""Stored layouts, runtime filters, skewed joins and the incremental accumulator."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from creditmap import catalog
from creditmap.config import testdata_config as analog
from creditmap.operators.distinct_counts import counted, distinct_state, merged
from creditmap.operators.intervals import effective_dated_left, interval_index, overlap_join
from creditmap.operators.output import append_days, read_days
from creditmap.operators.owners import argmax_owner, top_owner
from creditmap.operators.runtime_filter import keep_possible
from creditmap.operators.skew import heavy_hitter_join, heavy_keys
from creditmap.operators.snapshot import snapshot
from creditmap.plans import inhouse as IH
from creditmap.plans import lookup as L
from creditmap.plans import market_share as MS
from creditmap.plans import vendor as V
from creditmap.sources import registry as R
from creditmap.sources.testdata import scratch_path, stored_bucketed, stored_by_day
from helpers import frame, rows

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def src(spark):
    return catalog.sources_for(spark, SF)


@pytest.fixture
def conf(spark):
    """Sets options for one test."""
    old = {}

    def put(**options):
        for k, v in options.items():
            k = k.replace("__", ".")
            old.setdefault(k, spark.conf.get(k, None))
            spark.conf.set(k, v)
    yield put
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def no_broadcast(conf):
    conf(**{"spark__sql__autoBroadcastJoinThreshold": "-1", "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1"})


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def run(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return plan_of(df)


# ---- runtime filter

def test_runtime_filter_keeps_all_keys_and_few_others(spark):
    fact = spark.range(20_000).select(F.when(F.col("id") % 50 != 0, F.col("id")).alias("k"))
    keys = spark.range(0, 20_000, 100).select(F.when(F.col("id") > 0, F.col("id") + 1).alias("k"))
    kept = keep_possible(fact, "k", keys, "k")
    assert kept.join(keys, "k").count() == fact.join(keys, "k").count() == 199
    assert kept.count() < 400 and keep_possible(fact, "k", keys, "k", bits=64).join(keys, "k").count() == 199
    assert keep_possible(fact, "k", keys.where("false"), "k").count() == 0


@pytest.mark.parametrize("name, column", [("in_house_holdings", "Asset_Value_Amt"), ("union_distinct_txn_hold", "Txn_Amt")])
def test_fact_is_filtered_before_its_shuffle(spark, src, conf, name, column):
    no_broadcast(conf)
    plan = plan_of(catalog.build(name, spark, SF))
    # the bit set is tested in the fact's scan, which no exchange precedes
    assert re.search(rf"FileScan parquet \[[^\]]*\b{column}#[^\]]*\] Batched: \w+, DataFilters: \[.*Subquery subquery#", plan)


# ---- stored layouts

def test_latest_day_reads_one_folder(spark, src):
    by_day = stored_by_day(src)
    one = snapshot(by_day[R.MARKET_SHARE], "Reporting_Date", "latest")
    plan = run(one)
    assert re.search(r"PartitionFilters: \[isnotnull\(Reporting_Day#\d+\), \(Reporting_Day#\d+ = Subquery", plan)
    days = by_day[R.MARKET_SHARE].select("Reporting_Day").distinct().count()
    one.collect()
    scan = [n for n in _nodes(one._jdf.queryExecution().executedPlan()) if "Scan parquet" in n.nodeName()][0]
    assert days > 100 and scan.metrics().apply("numPartitions").value() == 1
    # the day itself comes from folder names: no data column is read for it
    assert re.search(r"ReadSchema: struct<>", plan)
    plain = snapshot(src[R.MARKET_SHARE], "Reporting_Date", "latest")
    assert rows(one.drop("Reporting_Day")) == rows(plain)
    as_of = dt.date(1997, 6, 30)
    assert rows(snapshot(by_day[R.MARKET_SHARE], "Reporting_Date", as_of).drop("Reporting_Day")) == rows(snapshot(src[R.MARKET_SHARE], "Reporting_Date", as_of))


def _nodes(plan):
    if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        plan = plan.executedPlan()
    out = [plan]
    if hasattr(plan, "plan") and plan.getClass().getSimpleName().endswith("QueryStageExec"):
        out += _nodes(plan.plan())
    for i in range(plan.children().size()):
        out += _nodes(plan.children().apply(i))
    return out


def test_bucketed_sides_join_without_an_exchange(spark, src, conf):
    no_broadcast(conf)
    both = stored_bucketed(src)
    fact = both[R.ASSET_POSITION].select(F.col("Asset_Position_Holding_ID").alias("Holdings_ID"), "Asset_Position_Balance")
    joined = fact.join(both[R.HOLDINGS], "Holdings_ID")
    plan = plan_of(joined)
    assert "Exchange" not in plan and "SortMergeJoin" in plan and "Bucketed: true" in plan
    plain = src[R.ASSET_POSITION].select(F.col("Asset_Position_Holding_ID").alias("Holdings_ID"), "Asset_Position_Balance").join(src[R.HOLDINGS], "Holdings_ID")
    assert joined.count() == plain.count()


def test_bucketed_positions_move_no_fact_row_before_their_aggregate(spark, src):
    plan = run(V.sales_positions(stored_bucketed(src), analog()))
    lines = plan.splitlines()
    scan = next(i for i, x in enumerate(lines) if "FileScan parquet" in x and "Asset_Position_Holding_ID" in x)
    above = lines[:scan][::-1]
    first = next(i for i, x in enumerate(above) if re.search(r"[^t]Exchange hash", x))
    assert any("HashAggregate" in x and "partial_sum" in x for x in above[:first])


# ---- intervals

def test_interval_index_spreads_a_hot_key_and_bounds_open_ends(spark):
    n = 2000
    ref = spark.range(n).select(F.lit("hot").alias("code"), F.expr("timestamp_ntz'1995-01-01' + make_dt_interval(CAST(id AS INT))").alias("lo"),
                                F.expr("timestamp_ntz'1995-01-01' + make_dt_interval(CAST(id AS INT) + 40)").alias("hi"), F.col("id").cast("string").alias("v"))
    index = interval_index(ref, "code", "lo", "hi", {"v": "v"})
    largest = index.groupBy("__rk", "__month").count().agg(F.max("count")).first()[0]
    assert index.count() < 3 * n and largest < 100  # of 2000 intervals of one key
    open_ = frame(spark, "code string, lo timestamp_ntz, hi timestamp_ntz, v string",
                  [("x", dt.datetime(1900, 1, 1), dt.datetime(9999, 12, 31), "o"), ("x", dt.datetime(2020, 1, 1), dt.datetime(2019, 1, 1), "empty"), ("x", None, dt.datetime(2020, 1, 1), "null"), (None, dt.datetime(1900, 1, 1), dt.datetime(9999, 12, 31), "nokey")])
    assert interval_index(open_, "code", "lo", "hi", {"v": "v"}).where("__rk IS NOT NULL").count() == 601
    at = frame(spark, "id int, k string, at timestamp_ntz", [(1, "x", dt.datetime(1850, 1, 1)), (2, "x", dt.datetime(1900, 1, 1)), (3, "x", dt.datetime(2500, 7, 7)), (4, None, dt.datetime(2000, 1, 1)), (5, "x", None), (6, "x ", dt.datetime(2019, 6, 1))])
    out = effective_dated_left(at, open_, "k", "at", "code", "lo", "hi", {"v": "o"})
    assert rows(out, "id", "o") == [(1, None), (2, "o"), (3, "o"), (4, None), (5, None), (6, "o")]


@pytest.mark.parametrize("skew", [False, True])
def test_overlap_join_equals_the_plain_join(spark, skew):
    rng = random.Random(3)

    def some(n, names):
        out = []
        for i in range(n):
            a = dt.date(1980, 1, 1) + dt.timedelta(days=rng.randint(0, 25_000))
            b = dt.date(9999, 12, 31) if rng.random() < 0.2 else a + dt.timedelta(days=rng.randint(-30, 900))
            key = rng.choice(["A", "B ", "B", None]) if skew else f"k{rng.randint(0, 60)}"
            out.append((i, key, None if rng.random() < 0.05 else a, None if rng.random() < 0.05 else b))
        return frame(spark, f"{names[0]} int, k string, {names[1]} date, {names[2]} date", out)
    left, right = some(400, ("a", "a0", "a1")), some(400, ("p", "p0", "p1"))
    got = overlap_join(left, right, "k", "a0", "a1", "p0", "p1")
    plain = left.join(right.withColumnRenamed("k", "k2"), F.expr("rtrim(k) = rtrim(k2) AND p0 <= a1 AND a0 <= p1"))
    assert rows(got, "a", "p") == rows(plain, "a", "p") and got.columns == ["a", "k", "a0", "a1", "p", "p0", "p1"]


def test_hot_code_of_the_overlap_join_is_split(spark, conf):
    no_broadcast(conf)
    n = 3000
    day = "date'1991-01-01' + CAST(id * 6 AS INT)"
    left = spark.range(n).select(F.lit("hot").alias("k"), F.expr(day).alias("a0"), F.expr(f"{day} + 20").alias("a1"))
    right = left.withColumnsRenamed({"a0": "p0", "a1": "p1"})
    x = overlap_join(left, right, "k", "a0", "a1", "p0", "p1")
    keys = re.findall(r"hashpartitioning\(([^)]*)\)", plan_of(x)) or re.findall(r"hashpartitioning\((.*?), \d+\)", plan_of(x))
    assert len(keys) == 4 and all("__at" in k or "__in" in k for k in keys)  # one key, fifty buckets
    assert x.count() == 2 * (3 * n - 6) + n


# ---- heavy hitters and NULL keys

def test_heavy_hitter_join_equals_the_plain_join(spark, conf):
    no_broadcast(conf)
    left = spark.range(6000).select("id", F.expr("CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 3 = 1 THEN NULL ELSE concat('k', id % 700) END").alias("k"), (F.col("id") % 5).alias("at"))
    right = spark.range(400).select(F.concat(F.lit("k"), "id").alias("k"), F.lit(0).alias("lo"), F.lit(3).alias("hi"), F.col("id").alias("v"))
    right = right.unionByName(spark.createDataFrame([("hot", 0, 2, -1), ("hot", 2, 4, -2), (None, 0, 9, -3)], "k string, lo int, hi int, v long"))
    assert [r.k for r in heavy_keys(left, "k").collect()] == ["hot"]
    inside = F.expr("lo <= at AND at <= hi")
    for how in ("left", "inner"):
        got = heavy_hitter_join(left, right, "k", inside, how, ways=16)
        plain = left.join(right.withColumnRenamed("k", "k2"), F.expr("k = k2 AND lo <= at AND at <= hi"), how).drop("k2")
        assert rows(got) == rows(plain)
    salted = heavy_hitter_join(left, right, "k", inside, ways=16)
    assert "hashpartitioning(__lk#" in plan_of(salted)
    with pytest.raises(ValueError):
        heavy_hitter_join(left, right, "k", how="full")


def test_null_keys_are_spread_by_the_exchange_itself(spark, src, conf):
    """The one key column of the attachment join holds the spread, also with a single lookup."""
    no_broadcast(conf)
    x = MS.attached_positions(src, analog(as_of=None), (MS.ADVISOR,))
    plan = plan_of(x)
    assert "hashpartitioning(__lk#" in plan and "hashpartitioning(__jk#" not in plan
    some = spark.range(4000).select("id", F.lit(None).cast("string").alias("k"))
    lookup = frame(spark, "__kind string, __key string, __territory string, __selling_code string, __start date, __end date", [("x", "a", "T", None, None, None), ("x", None, "N", None, None, None)])
    joined = L.attach(some, [lookup], F.lit("x"), F.col("k"), F.current_date(), "none")
    assert joined.count() == 4000 and joined.where(F.col(L.TERRITORY).isNotNull()).count() == 0


# ---- owners, union, accumulator

def test_argmax_equals_the_ranked_owner(spark, src):
    rng = random.Random(8)
    data = [(rng.choice(["A", "B", None]), rng.choice(["T1", "T2", "T3", None]), rng.choice([None, 1, 2, 2]), rng.choice([None, 5, 6])) for _ in range(80)]
    cands = frame(spark, "Territory string, BR string, Assets decimal(18,2), Parties long", [(t, f"{b}{i % 20}" if b else None, a and __import__("decimal").Decimal(a), p) for i, (b, t, a, p) in enumerate(data)])
    got = argmax_owner(cands, "BR", ["Assets", "Parties"], "Territory")
    assert rows(got) == rows(top_owner(cands, "BR", ["Assets", "Parties"], "Territory")) and got.columns == cands.columns
    plan = plan_of(catalog.build("preserve_left_attach", spark, SF))
    assert "Window" not in plan and "partial_min" in plan


def test_union_and_sums_share_one_exchange(spark, src):
    """DISTINCT and the sums per key run on one clustering of the month-end facts."""
    pre = IH.etf_flows_and_holdings(src, analog()).groupBy(*IH.FLOW_KEY).agg(F.sum("Units").alias("u"))
    top = plan_of(pre).split("Union")[0]
    assert len(re.findall(r"Exchange hashpartitioning", top)) == 1


def test_days_run_again_or_late_give_the_whole_build(spark, src):
    day = lambda d: dt.datetime(2024, 1, d, 5)
    whole = frame(spark, "Reporting_Date timestamp_ntz, x int", [(day(1), 1), (day(1), 1), (day(1), 2), (day(2), 3), (day(3), 4), (None, 9)])
    path = scratch_path(src, "days")
    append_days(whole.where("dayofmonth(Reporting_Date) <> 2 OR Reporting_Date IS NULL"), path)
    append_days(whole.where("dayofmonth(Reporting_Date) = 2"), path)  # late
    append_days(whole.where("dayofmonth(Reporting_Date) = 1"), path)  # again
    assert rows(read_days(spark, path, whole)) == rows(whole.distinct())
    append_days(frame(spark, "Reporting_Date timestamp_ntz, x int", [(day(1), 7)]), path)  # corrected
    assert rows(read_days(spark, path, whole), "x") == [(3,), (4,), (7,), (9,)]


def test_merged_states_count_like_count_distinct(spark, src):
    rng = random.Random(4)
    data = [(rng.choice(["a", "b", None]), rng.choice([None, rng.randint(-5, 40), rng.randint(0, 200_000)]), k) for k in range(3000)]
    x = frame(spark, "g string, party long, day int", data)
    days = [distinct_state(x.where(f"day % 4 = {k}"), ["g"], "party") for k in (0, 1, 2, 3, 3)]  # one day comes twice
    path = scratch_path(src, "states")
    for k, state in enumerate(days):
        state.write.parquet(f"{path}/{k}")
    stored = spark.read.option("recursiveFileLookup", "true").parquet(path)
    got = counted(merged(merged(stored, ["g"]), ["g"]), ["g"], "n")
    assert rows(got, "g", "n") == rows(x.groupBy("g").agg(F.countDistinct("party").alias("n")), "g", "n")
    assert "Expand" not in plan_of(got)
