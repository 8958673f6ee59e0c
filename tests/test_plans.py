"""Physical-plan assertions on the analog tables."""

import datetime as dt
import re

import pytest

from creditmap import catalog
from creditmap.config import testdata_config as analog
from creditmap.plans import market_share as MS
from creditmap.plans import sales_assets as SA
from creditmap.plans import vendor as V

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def src(spark):
    return catalog.sources_for(spark, SF)


def executed(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def scans_reading(plan: str, column: str) -> int:
    """Number of parquet scans whose output includes ``column``."""
    return len(re.findall(rf"FileScan parquet \[[^\]]*\b{column}#", plan))


@pytest.mark.parametrize("build", [MS.market_share, SA.sales_assets])
def test_no_cartesian_or_nested_loop(spark, src, build):
    plan = executed(build(src, analog()))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_sales_vendor_fact_scanned_once(spark, src):
    plan = executed(SA.vendor_stages(src, analog()))
    assert scans_reading(plan, "Asset_Position_Holding_ID") == 1


def test_market_share_vendor_fact_scanned_once_plus_latest_subquery(spark, src):
    plan = executed(MS.vendor_stages(src, analog()))
    # the rows once; the latest-day scalar subquery reads the date column only
    assert scans_reading(plan, "Industry_Asset_Amount") == 1


def test_literal_as_of_is_pushed_to_the_scan(spark, src):
    cfg = analog(as_of=dt.date(1998, 6, 1))
    df = V.market_share_positions(src, cfg, cfg.as_of)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(Reporting_Date", plan)
    assert re.search(r"PushedFilters: \[[^\]]*LessThan\(Reporting_Date", plan)


def test_small_dimensions_are_broadcast_by_file_size(spark, src):
    plan = executed(V.market_share_positions(src, analog(), None))
    assert "BroadcastHashJoin" in plan


def test_daily_fact_is_shuffled_once_and_reduced(spark, src):
    """The raw rows meet their small dimensions and a partial aggregate before the only exchange of the fact."""
    plan = executed(V.market_share_positions(src, analog(), None))
    lines = plan[: plan.index("Initial Plan")].splitlines() if "Initial Plan" in plan else plan.splitlines()
    scan = next(i for i, x in enumerate(lines) if re.search(r"FileScan parquet \[[^\]]*Industry_Asset_Amount#", x))
    depth = re.search(r"[A-Z]", lines[scan]).start()
    above = []  # the scan's ancestors, nearest first
    for x in lines[:scan][::-1]:
        found = re.search(r"[A-Z]", x)
        if found and found.start() < depth:
            above.append(x[found.start() :])
            depth = found.start()
    exchanges = [i for i, x in enumerate(above) if x.startswith("Exchange")]
    assert len(exchanges) == 1
    assert any("partial_sum" in x for x in above[: exchanges[0]]) and any(x.startswith("BroadcastHashJoin") for x in above[: exchanges[0]])


def test_owner_fact_is_pre_aggregated_per_key(spark, src):
    from creditmap.plans import owners as OW

    plan = OW.advisor_candidates(src, analog(), False, False)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"HashAggregate\(keys=\[Associated_Codes_ID#\w+\], functions=\[partial_sum", plan)


def test_null_keys_spread_over_all_partitions(spark):
    from creditmap.plans import lookup as L
    from pyspark.sql import functions as F

    rows = spark.range(5000).select(F.col("id"), F.when(F.col("id") % 10 == 0, "a").alias("k"), F.lit("x").alias("kind"), F.current_date().alias("d"))
    lookup = spark.createDataFrame([("x", "a", "T", None, None, None)],
                                   "__kind string, __key string, __territory string, __selling_code string, __start date, __end date")
    x = L.attach(rows, [lookup], F.col("kind"), F.col("k"), F.col("d"), "none")
    assert x.count() == 5000 and x.where("__territory = 'T'").count() == 500
    assert "pmod(xxhash64(id#" in x._jdf.queryExecution().optimizedPlan().toString()
