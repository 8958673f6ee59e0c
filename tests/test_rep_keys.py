"""Runtime broadcasts, rows dropped in the scan and shuffle files of stored tables (round 4: F3 to F7)."""

import pytest
from pyspark.sql import functions as F

from creditmap import catalog
from creditmap.config import testdata_config as analog
from creditmap.operators.versions import collapse_versions
from creditmap.plans import bridge as B
from creditmap.plans import vendor as V
from creditmap.plans.territory import party_current_territories
from creditmap.session import FREE_SHUFFLES, freed_shuffles
from creditmap.sources import registry as R
from creditmap.sources.testdata import testdata_sources as adapter

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def src(spark):
    return catalog.sources_for(spark, SF)


def same(a, b):
    assert a.columns == b.columns and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def shuffle_files(spark) -> set[str]:
    blocks = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllBlocks()
    return {x for x in blocks.mkString(" ").split() if x.startswith("shuffle_")}


# ---- F3: what the driver builds at run time

@pytest.mark.parametrize("rows, how", [(1000, "BroadcastHashJoin"), (400_000, "SortMergeJoin")])
def test_only_small_sides_are_broadcast_at_run_time(spark, rows, how):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    try:
        text = F.sha1(F.col("id").cast("string"))
        x = spark.range(400_000).select("id", text.alias("a")).join(spark.range(rows).select("id", text.alias("b")), "id")
        x = x.where("a = b").groupBy().count()
        assert x.collect()[0][0] == rows
        plan = x._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert how in plan
    finally:
        spark.conf.set(name, before)


# ---- F4 to F6: only the keys and rows of the stage's dealers

@pytest.mark.parametrize("keys", [V.rep_keys_daily, V.rep_keys_monthly])
@pytest.mark.parametrize("relation", [B.dealer_rep_bridge, B.bridge_territories])
def test_the_bridge_of_a_stage_has_the_rows_of_its_keys(src, relation, keys):
    every, some, own = relation(src, analog()), relation(src, analog(), keys), keys(src, analog())
    same(some.join(own, "DlrRep", "left_semi"), every.join(own, "DlrRep", "left_semi"))
    assert 0 < some.count() < every.count() / 2


@pytest.mark.parametrize("rep, keys", [
    (lambda s, c: V.market_share_positions(s, c, None, (V.MS_REP,)), V.rep_keys_daily),
    (lambda s, c: V.sales_positions(s, c, (V.SA_REP,)), V.rep_keys_monthly)])
def test_keys_cover_all_positions(src, rep, keys):
    rows = rep(src, analog())
    assert rows.where("aBR IS NOT NULL").count() > 0
    assert rows.where("aBR IS NOT NULL").join(keys(src, analog()), F.col("aBR") == F.col("DlrRep"), "left_anti").count() == 0


def test_rows_of_other_dealers_are_gone_in_the_scan(src):
    one = V.market_share_positions(src, analog(), None, (V.MS_REP,))
    same(one, V.market_share_positions(src, analog(), None).where(F.col(V.ROUTE) == V.MS_REP))
    assert "scalar-subquery" in one._jdf.queryExecution().optimizedPlan().toString()


def test_versions_collapse_before_the_joins(spark, src):
    sell = src[R.SELLING_CODE]
    odd = sell.limit(20)
    for c in ("Selling_Code", "Distributor_ID", "Rec_Created_Date", "Rec_Term_Date"):
        odd = odd.unionByName(sell.limit(20).withColumn(c, F.lit(None).cast(sell.schema[c].dataType)))
    src = src.with_table(R.SELLING_CODE, sell.unionByName(odd).unionByName(sell.withColumn("Distributor_ID", F.col("Distributor_ID") + 2).limit(50)))
    rows = (src[R.SELLING_CODE].join(src[R.DISTRIBUTOR].select("Distributor_ID", "src_Party_ID"), "Distributor_ID")
            .join(party_current_territories(src, analog()).select("src_Party_ID", "Territory_External_ID"), "src_Party_ID"))
    got = B.selling_code_parties(src, analog())
    same(got, collapse_versions(rows, ["Selling_Code", "src_Party_ID", "Territory_External_ID"]))
    plan = got._jdf.queryExecution().optimizedPlan().toString().splitlines()
    assert [x for x in plan if "Aggregate" in x and "Selling_Code" in x and "Distributor_ID" in x]


# ---- F7: tables that are stored leave no shuffle files

def test_adapter_tables_leave_no_shuffle_files(spark):
    stored = adapter(spark, SF)
    before = shuffle_files(spark)
    stored[R.SELLING_CODE]
    assert shuffle_files(spark) <= before


def test_freed_shuffles_restores_the_setting(spark):
    was = spark.conf.get(FREE_SHUFFLES, None)
    with pytest.raises(ZeroDivisionError), freed_shuffles(spark):
        assert spark.conf.get(FREE_SHUFFLES) == "true"
        1 / 0
    assert spark.conf.get(FREE_SHUFFLES, None) == was
