"""Registered queries: one per operator key of the survey (section 2.14).

Each builder takes ``(spark, sf_dir)``, reads the driver tables through the
logical adapter and returns a lazy DataFrame over the whole tables.  The
matching DuckDB SQL is in ``creditmap.oracle``; column names and types
agree (sums are cast to DECIMAL(38, s), counts are BIGINT).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .config import AttributionConfig, testdata_config
from .functions import predicates as P
from .functions.keys import (
    branch_key, client_key, dealer_rep_key, dealer_type, master_dealer_rep_key, month_end, same_text, vendor_key,
)
from .operators.distinct_counts import counted, distinct_state, merged
from .operators.output import accumulate, append_days, conform, read_days
from .operators.owners import rank_owner, waterfall_step
from .operators.runtime_filter import keep_possible
from .operators.skew import heavy_hitter_join
from .operators.snapshot import snapshot
from .operators.versions import hop_as_of, hop_to_current
from .plans import lookup as L
from .plans import market_share as MS
from .plans import owners as OW
from .plans import sales_assets as SA
from .plans import vendor as V
from .plans.bridge import dealer_rep_bridge, dealer_rep_codes
from .plans.inhouse import (
    direct_source, etf_flows_and_holdings, etf_products, in_house_daily, in_house_monthly, peer_products, source_territories,
)
from .plans.territory import distributor_territories
from .schemas import MARKET_SHARE_COLUMNS, SALES_ASSETS_COLUMNS
from .session import freed_shuffles
from .sources import registry as R
from .sources.peers import peer_list
from .sources.registry import Sources
from .sources.testdata import scratch_path, stored_bucketed, stored_by_day, testdata_sources

Builder = Callable[[Sources, AttributionConfig], DataFrame]
_REGISTRY: dict[str, Builder] = {}


def register(name: str):
    def deco(fn: Builder) -> Builder:
        _REGISTRY[name] = fn
        return fn
    return deco


def d2(c) -> F.Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(38,2)")


def d6(c) -> F.Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(38,6)")


def _branch_firm_dealer(src: Sources) -> DataFrame:
    return V._branch_dims(src, "left")


# ---- scalar keys ------------------------------------------------------------

@register("branch_key_concat")
def _q_branch_key(src, cfg):
    return _branch_firm_dealer(src).select(
        "Dealer_Branch_ID",
        vendor_key("MLI_Dealer_Code", "Firm_ID", "Office_Postal_CD").alias("aBR"),
        branch_key("MLI_Dealer_Code", "Office_Postal_CD").alias("dealer_postal_key"),
    )


@register("postal_key_replace")
def _q_postal_key(src, cfg):
    return src["part"].select(
        "p_partkey",
        branch_key("p_brand", "p_name").alias("key_raw"),
        branch_key("p_brand", "p_name", replace_blanks=True).alias("key_dash"),
    )


@register("client_key_left4")
def _q_client_key(src, cfg):
    owners = src[R.POLICY_CUSTOMER].select("Customer_ID", "Policy_ID").join(
        src[R.POLICY].select("Policy_ID", "Host_Distributor_Num"), "Policy_ID")
    return src[R.CUSTOMER_ADDRESS].join(owners, "Customer_ID").select(
        "Customer_ID",
        client_key("Host_Distributor_Num", "Postal_Code").alias("cBranch_raw"),
        client_key("Host_Distributor_Num", "Postal_Code", replace_blanks=True).alias("cBranch_dash"),
    )


@register("dealer_rep_key_drop4")
def _q_dealer_rep_key(src, cfg):
    return _branch_firm_dealer(src).select(
        "Dealer_Branch_ID", dealer_rep_key("MLI_Dealer_Code", "Dealer_Branch_CD", cfg.strict_right).alias("DlrRep")
    )


@register("dealer_type_case")
def _q_dealer_type(src, cfg):
    dealer = src[R.REF_DEALER].select(F.col("ETF_Dealer_Code").alias("Firm_ID"), "MLI_Dealer_Code")
    return src[R.FIRM].join(dealer, "Firm_ID", "left").select(
        "Firm_ID", "MLI_Dealer_Code", dealer_type("MLI_Dealer_Code").alias("Dealer_Type")
    )


@register("month_end_bucket")
def _q_month_end(src, cfg):
    return src[R.ASSET_POSITION].groupBy(month_end("Asset_Position_Reporting_Date").alias("Month_End")).agg(
        F.count(F.lit(1)).alias("n"),
        d6(F.sum("Asset_Position_Shares")).alias("shares"),
        d2(F.sum("Asset_Position_Net_New_Assets")).alias("net_new"),
        d2(F.sum("Asset_Position_Balance")).alias("balance"),
    )


@register("latest_snapshot")
def _q_latest(src, cfg):
    return snapshot(src[R.MARKET_SHARE], "Reporting_Date", "latest").groupBy("Dealer_Branch_ID", "Rank_Group").agg(
        F.count(F.lit(1)).alias("n"),
        d2(F.sum("Industry_Shares_Amount")).alias("shares"),
        d2(F.sum("Industry_Asset_Amount")).alias("assets"),
    )


@register("latest_snapshot_by_day")
def _q_latest_by_day(src, cfg):
    """The fact stored by day: one folder is read."""
    return _q_latest(stored_by_day(src), cfg)


# ---- filters ------------------------------------------------------------------

@register("firm_exclusion_3vl")
def _q_firm_exclusion(src, cfg):
    firm = src[R.FIRM].select(F.col("Firm_ID").alias("Office_ID"), "Firm_Name")
    return (
        src[R.DEALER_BRANCH].join(firm, "Office_ID")
        .where(P.firm_kept("Firm_Name", "Dealer_Branch_CD", cfg))
        .select("Dealer_Branch_ID", "Firm_Name", "Dealer_Branch_CD")
    )


@register("branch_class_filter")
def _q_branch_class(src, cfg):
    rows = _branch_firm_dealer(src).select(
        "Dealer_Branch_ID",
        F.explode_outer(V._routes([
            (V.SA_ACTUAL, P.actual_branches("Office_Type", "Dealer_Branch_CD", "MLI_Dealer_Code", cfg)),
            (V.SA_CORRELATED, P.correlated_branches("Office_Type", "Dealer_Branch_CD", "MLI_Dealer_Code", cfg)),
            (V.SA_REP, P.rep_level_monthly("Dealer_Branch_CD", "MLI_Dealer_Code", cfg)),
        ])).alias("route"),
    )
    return rows.select("Dealer_Branch_ID", F.coalesce("route", F.lit("dropped")).alias("route"))


@register("default_branch_or_null")
def _q_default_branch(src, cfg):
    return src[R.DISTRIBUTOR].where(P.default_branch_or_null("Branch_Code")).select(
        "Distributor_ID", "src_Party_ID", "Branch_Code"
    )


# ---- versioned hops -------------------------------------------------------------

def _by(df, key, *sums):
    """Rows per key with their number and sums, before a dimension hop."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("__n"), *[F.sum(c).alias(c) for c in sums])


@register("hop_current")
def _q_hop_current(src, cfg):
    rows = hop_to_current(
        _by(src[R.ASSET_DAILY], ["Original_Selling_Code_ID"], "Asset_Value_Amt"), src[R.SELLING_CODE],
        "Original_Selling_Code_ID", "Selling_Code_ID", "Selling_Code",
        {"Selling_Code_ID": "Current_Selling_Code_ID", "Distributor_ID": "Current_Distributor_ID"},
        active_flag=cfg.active_flag,
    )
    return rows.groupBy("Current_Selling_Code_ID", "Current_Distributor_ID").agg(
        F.sum("__n").alias("n"), d2(F.sum("Asset_Value_Amt")).alias("assets")
    )


@register("hop_as_of")
def _q_hop_as_of(src, cfg):
    dates = src[R.DATE_DIM].select(F.col("Date_ID").alias("Reporting_Date_ID"), F.col("Calendar_Date").cast("date").alias("__day"))
    codes = src[R.SELLING_CODE].select(F.col("Selling_Code_ID").alias("Original_Selling_Code_ID"),
                                       F.col("Selling_Code").alias("__code"))
    rows = _by(src[R.ASSET_DAILY], ["Reporting_Date_ID", "Original_Selling_Code_ID"], "Asset_Value_Amt")
    rows = rows.join(dates, "Reporting_Date_ID").join(codes, "Original_Selling_Code_ID")
    rows = hop_as_of(rows, src[R.SELLING_CODE], "__code", "Selling_Code", "__day", {"Selling_Code_ID": "Version_ID"})
    return rows.groupBy("Version_ID").agg(F.sum("__n").alias("n"), d2(F.sum("Asset_Value_Amt")).alias("assets"))


@register("typed_territory_link")
def _q_typed_link(src, cfg):
    return distributor_territories(src, cfg)


@register("effective_dated_override")
def _q_override(src, cfg):
    rows = _by(src[R.MARKET_SHARE], ["Dealer_Branch_ID", "Reporting_Date"], "Industry_Asset_Amount").join(
        src[R.DEALER_BRANCH].select("Dealer_Branch_ID", "Dealer_Branch_CD"), "Dealer_Branch_ID")
    return V.with_overrides(rows, src, "Reporting_Date").groupBy("Dealer_Branch_CD", "MLI_Territory_Name").agg(
        F.sum("__n").alias("n"), d2(F.sum("Industry_Asset_Amount")).alias("assets")
    )


# ---- owners -------------------------------------------------------------------

def _ranked(cands, order):
    ranked = rank_owner(cands, OW.OWNER_KEY, order, OW.OWNER_TERRITORY)
    return ranked.select("BR", "Territory", d2("Assets").alias("Assets"), *order[1:], F.col("rn").cast("bigint").alias("rn"))


@register("rank_owner_advisor")
def _q_rank_advisor(src, cfg):
    return _ranked(OW.advisor_candidates(src, cfg, False, False), OW.ADVISOR_ORDER)


@register("rank_owner_advisor_monthly")
def _q_rank_advisor_monthly(src, cfg):
    return _ranked(OW.advisor_candidates(src, cfg, True, True), OW.ADVISOR_ORDER)


@register("rank_owner_client")
def _q_rank_client(src, cfg):
    return _ranked(OW.client_candidates(src, cfg, False, False), OW.CLIENT_ORDER)


@register("rank_owner_client_policy")
def _q_rank_client_policy(src, cfg):
    return _ranked(OW.client_candidates(src, cfg, True, True), OW.CLIENT_ORDER)


@register("distinct_parties_merged")
def _q_distinct_parties(src, cfg):
    """Parties per branch and territory from the merged states of three parts of the advisor chain."""
    keys = [OW.OWNER_KEY, OW.OWNER_TERRITORY]
    chain = OW.advisor_chain(src, cfg, False, False).withColumnRenamed("Territory_External_ID", OW.OWNER_TERRITORY)
    part = F.pmod("Associated_Codes_ID", F.lit(3))
    states = reduce(DataFrame.unionByName, (distinct_state(chain.where(part == k), keys, "src_Party_ID") for k in range(3)))
    return counted(merged(states, keys), keys, "Parties")


def _daily_positions_all_days(src, cfg):
    return V.branch_positions_daily(V.market_share_positions(src, cfg, None, (V.MS_BRANCH,)))


_POS_COLS = ["Reporting_Date", "Firm_Name", "aBR", "Dealer_Type", "MLI_Dealer_Code", "PeerGroup", "Office_Type",
             "Dealer_Branch_CD", "MLI_Territory_Name"]


def _pos_select(df, *extra):
    return df.select(*_POS_COLS, d2("Asset_Position_Shares").alias("Asset_Position_Shares"),
                     d2("Asset_Position_Balance").alias("Asset_Position_Balance"), *extra)


def _attached(src, cfg):
    return MS.attached_positions(src, cfg.with_(as_of=None), (MS.ADVISOR,))


@register("preserve_left_attach")
def _q_attach(src, cfg):
    return _pos_select(_attached(src, cfg).withColumnRenamed("Rank_Group", "PeerGroup"), F.col(L.TERRITORY).alias("Territory"))


@register("territory_waterfall")
def _q_waterfall(src, cfg):
    return _attached(src, cfg).groupBy(MS.resolve(cfg, waterfall_step).alias("outcome")).agg(
        F.count(F.lit(1)).alias("n"), d2(F.sum("Asset_Position_Balance")).alias("balance")
    )


# ---- vendor rollups ------------------------------------------------------------

@register("vendor_position_rollup")
def _q_vendor_daily(src, cfg):
    return _pos_select(_daily_positions_all_days(src, cfg))


@register("vendor_position_rollup_monthly")
def _q_vendor_monthly(src, cfg):
    return _monthly(src, cfg, V.SA_ACTUAL)


@register("bucketed_position_join")
def _q_bucketed(src, cfg):
    """Positions and holdings stored bucketed by holding id: their join moves no rows."""
    return _monthly(stored_bucketed(src), cfg, V.SA_ACTUAL)


@register("vendor_position_rollup_correlated")
def _q_vendor_correlated(src, cfg):
    return _monthly(src, cfg, V.SA_CORRELATED)


def _monthly(src, cfg, route):
    return V.branch_positions_monthly(V.sales_positions(src, cfg, (route,)), route).select(
        "Asset_Position_Reporting_Date", "Firm_Name", "aBR", "cBR", "Dealer_Type", "CUSIP", "Office_Type",
        "Dealer_Branch_CD", "Account_Type", "MLI_Territory_Name",
        d6("Asset_Position_Shares").alias("Asset_Position_Shares"),
        d2("Asset_Position_Net_New_Assets").alias("Asset_Position_Net_New_Assets"),
        d2("Asset_Position_Balance").alias("Asset_Position_Balance"),
    )


_REP_COLS = ["Firm_Name", "Dealer_Type", "aBR", "Office_Type", "Reporting_Date", "PEER_GROUP"]


def _rep_daily_all_days(src, cfg):
    return V.rep_positions_daily(V.market_share_positions(src, cfg, None, (V.MS_REP,)))


@register("dealer_rep_positions")
def _q_rep_daily(src, cfg):
    return _rep_daily_all_days(src, cfg).select(
        *_REP_COLS, d2("Asset_Position_Shares").alias("Asset_Position_Shares"),
        d2("Asset_Position_Balance").alias("Asset_Position_Balance"),
    )


@register("dealer_rep_positions_monthly")
def _q_rep_monthly(src, cfg):
    return V.rep_positions_monthly(V.sales_positions(src, cfg, (V.SA_REP,))).select(
        "Firm_Name", "Dealer_Type", "aBR", "Office_Type", "Reporting_Date", "cBR", "Account_Type", "CUSIP",
        d6("Asset_Position_Shares").alias("Asset_Position_Shares"),
        d2("Asset_Position_Net_New_Assets").alias("Asset_Position_Net_New_Assets"),
        d2("Asset_Position_Balance").alias("Asset_Position_Balance"),
    )


# ---- dealer-rep bridge -----------------------------------------------------------

@register("collapse_versions")
def _q_collapse(src, cfg):
    return dealer_rep_codes(src)


@register("interval_overlap_bridge")
def _q_bridge(src, cfg):
    return dealer_rep_bridge(src, cfg)


@register("point_in_interval_attach")
def _q_point_in_interval(src, cfg):
    x = MS.attached_positions(src, cfg.with_(as_of=None), (MS.REP,))
    return x.select(
        "Firm_Name", "Dealer_Type", "aBR", "Office_Type", F.col("Reporting_Date").cast("date").alias("Reporting_Date"),
        F.col("Rank_Group").alias("PEER_GROUP"), d2("Asset_Position_Shares").alias("Asset_Position_Shares"),
        d2("Asset_Position_Balance").alias("Asset_Position_Balance"), F.col(L.SELLING_CODE).alias("Selling_Code"),
        F.col(L.TERRITORY).alias("Territory_External_ID"),
    )


@register("heavy_hitter_attach")
def _q_heavy_hitter(src, cfg):
    """The bridge attached with frequent dealer keys split over tasks."""
    reps = _rep_daily_all_days(src, cfg).withColumnRenamed("aBR", "DlrRep")
    bridge = dealer_rep_bridge(src, cfg, V.rep_keys_daily).select("DlrRep", "Selling_Code", "Territory_External_ID", "THE_START", "THE_END")
    inside = (F.col("THE_START") <= F.col("Reporting_Date")) & (F.col("THE_END") >= F.col("Reporting_Date"))
    x = heavy_hitter_join(reps, bridge, "DlrRep", inside).withColumnRenamed("DlrRep", "aBR")
    return x.select(*_REP_COLS, d2("Asset_Position_Shares").alias("Asset_Position_Shares"),
                    d2("Asset_Position_Balance").alias("Asset_Position_Balance"), "Selling_Code", "Territory_External_ID")


@register("fallback_branch_coalesce")
def _q_fallback(src, cfg):
    return conform(MS.vendor_stages(src, cfg.with_(as_of=None), (MS.REP,)), MARKET_SHARE_COLUMNS)


# ---- in-house and dealer files -----------------------------------------------------

def _per_product(src):
    return _by(src[R.ASSET_DAILY], ["inv_Product_ID"], "Asset_Value_Amt", "Number_Of_Units")


@register("peer_values_join")
def _q_peers(src, cfg):
    rows = _per_product(src).join(peer_products(src, cfg, MS.peers_of(src)), "inv_Product_ID")
    return rows.groupBy("PEER_GROUP").agg(
        F.sum("__n").alias("n"), d2(F.sum("Asset_Value_Amt")).alias("assets"), d6(F.sum("Number_Of_Units")).alias("units"),
    )


@register("peer_list_literal")
def _q_peer_list(src, cfg):
    """The script's own list, against products that are given its names in turn."""
    peers = peer_list(src.spark)
    place = Window.orderBy("CUSIP")
    names = peers.select("CUSIP").distinct().select("CUSIP", (F.row_number().over(place) - 1).alias("__at"))  # 91 rows
    prod = src[R.PRODUCT_DIM].select(F.col("Product_ID").alias("inv_Product_ID"), (F.col("Product_ID") % 130).alias("__at"))
    rows = _per_product(src).join(prod.join(names, "__at").join(peers, "CUSIP"), "inv_Product_ID")
    return rows.groupBy("CUSIP", "PEER_GROUP").agg(F.sum("__n").alias("n"), d2(F.sum("Asset_Value_Amt")).alias("assets"))


@register("peer_join_collation")
def _q_peer_collation(src, cfg):
    """Product names with another case, an accent or trailing blanks find their peer (Q-16)."""
    name, at = F.col("Product_Name"), F.col("Product_ID") % 5
    varied = src[R.PRODUCT_DIM].withColumn("Product_Name", F.when(at == 0, F.lower(name)).when(at == 1, F.concat(name, F.lit("  ")))
                                           .when(at == 2, F.replace(name, F.lit("U"), F.lit("\u00dc"))).otherwise(name))
    house = in_house_daily(src.with_table(R.PRODUCT_DIM, varied), cfg, MS.peers_of(src))
    return conform(house, MARKET_SHARE_COLUMNS)


@register("key_varchar30")
def _q_key_varchar30(src, cfg):
    """Keys of long codes and of codes with trailing blanks (CAST AS varchar keeps 30 characters)."""
    long = F.concat(F.repeat(F.lit("D"), 24), F.col("s_suppkey").cast("string"), F.lit("-0123456789"))
    x = src["supplier"].select(
        "s_suppkey", long.alias("code"), F.concat("s_name", F.lit("   ")).alias("branch"), F.concat(F.lit("P "), F.lit("  ")).alias("postal"))
    keys = {"vendor": vendor_key("code", "s_suppkey", "postal"), "rep": dealer_rep_key("code", "branch"),
            "master": master_dealer_rep_key("code", "code"), "advisor": branch_key("code", "postal"), "branch": F.col("branch")}
    return x.select("s_suppkey", *[same_text(k).alias(name) for name, k in keys.items()])


@register("semi_product_filter")
def _q_semi(src, cfg):
    prod = etf_products(src, cfg)
    rows = _by(keep_possible(src[R.NBV_MONTHEND], "Product_ID", prod, "Product_ID"), ["Product_ID"], "Txn_Amt").join(prod, "Product_ID")
    return rows.groupBy("Product_Name").agg(F.sum("__n").alias("n"), d2(F.sum("Txn_Amt")).alias("amount"))


@register("union_distinct_txn_hold")
def _q_union(src, cfg):
    return etf_flows_and_holdings(src, cfg)


@register("conditional_net_new")
def _q_monthly(src, cfg):
    return conform(in_house_monthly(src, cfg), SALES_ASSETS_COLUMNS)


@register("in_house_holdings")
def _q_daily(src, cfg):
    return conform(in_house_daily(src, cfg, MS.peers_of(src)), MARKET_SHARE_COLUMNS)


@register("direct_source_rollup")
def _q_direct(src, cfg):
    return conform(direct_source(src, cfg), SALES_ASSETS_COLUMNS)


@register("duplicate_link_fanout")
def _q_fanout(src, cfg):
    rows = _by(src[R.DIRECT_SOURCE], ["Selling_Code"], "Assets").join(source_territories(src, cfg), "Selling_Code")
    return rows.groupBy("Selling_Code", "Territory_External_ID").agg(
        F.sum(F.col("__n") * F.col("__times")).cast("bigint").alias("n"), d2(F.sum(F.col("Assets") * F.col("__times"))).alias("assets")
    )


# ---- output ------------------------------------------------------------------

@register("conform_numeric")
def _q_conform(src, cfg):
    from pyspark.sql import types as T
    ap = src[R.ASSET_POSITION].select(
        "Asset_Position_Holding_ID", "Asset_Position_Reporting_Date",
        (F.col("Asset_Position_Balance") * F.col("Asset_Position_Net_New_Assets")).alias("amount_2"),
        (F.col("Asset_Position_Shares") * F.col("Asset_Position_Net_New_Assets")).alias("shares_6"),
    )
    cols = (("Asset_Position_Holding_ID", T.LongType(), None),
            ("Asset_Position_Reporting_Date", T.TimestampNTZType(), None),
            ("amount_2", T.DecimalType(15, 2), None), ("shares_6", T.DecimalType(15, 6), None))
    return conform(ap, cols)


@register("accumulate_distinct")
def _q_accumulate(src, cfg):
    cfg = cfg.with_(as_of=None)
    return accumulate(conform(MS.vendor_stages(src, cfg, (MS.ADVISOR, MS.CLIENT)), MARKET_SHARE_COLUMNS))


@register("accumulate_by_day")
def _q_accumulate_by_day(src, cfg):
    """The accumulator filled day by day (see :func:`_accumulated`)."""
    return src[ACCUMULATED]


#: The accumulator of ``accumulate_by_day`` among the adapter's stored tables.
ACCUMULATED = "ACCUMULATOR" + R.BY_DAY


def _accumulated(src: Sources) -> DataFrame:
    """Odd days, even days late, odd days again; the stages are worked out once and their rows stored."""
    rows, stored = _q_accumulate(src, testdata_config()), scratch_path(src, "accumulate-distinct")
    with freed_shuffles(src.spark):
        rows.write.parquet(stored)
    rows = src.spark.read.schema(rows.schema).parquet(stored)
    odd = F.dayofmonth("Reporting_Date") % 2 == 1
    path = scratch_path(src, "accumulator")
    for part in (odd, ~odd, odd):
        append_days(rows.where(part), path, is_distinct=True)
    return read_days(src.spark, path, rows)


@register("market_share_attribution")
def _q_market_share(src, cfg):
    return MS.market_share(src, cfg)


@register("market_share_attribution_all_days")
def _q_market_share_all_days(src, cfg):
    """The full history: the script's one-day filter is marked for removal there."""
    return MS.market_share(src, cfg.with_(as_of=None))


#: A day inside the validity of the analog overrides.
AS_OF = dt.date(1997, 6, 30)


@register("market_share_as_of")
def _q_market_share_as_of(src, cfg):
    return MS.market_share(src, cfg.with_(as_of=AS_OF))


@register("sales_assets_attribution")
def _q_sales_assets(src, cfg):
    return SA.sales_assets(src, cfg)


# ---- driver-facing wrappers --------------------------------------------------------

_SOURCES: dict[tuple, Sources] = {}


def sources_for(spark: SparkSession, sf_dir: str) -> Sources:
    """The adapter registry for ``sf_dir``, one per session.  Its tables are
    written when first read; relations are kept by name and configuration."""
    key = (id(spark), spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _SOURCES:
        src = testdata_sources(spark, sf_dir)
        src.sf_dir = sf_dir.rstrip("/")
        src.add(ACCUMULATED, lambda: _accumulated(src))
        _SOURCES[key] = src
    return _SOURCES[key]


def build(name: str, spark: SparkSession, sf_dir: str, cfg: AttributionConfig | None = None) -> DataFrame:
    cfg = cfg or testdata_config()
    return _REGISTRY[name](sources_for(spark, sf_dir), cfg)


def names() -> list[str]:
    return list(_REGISTRY)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {n: (lambda spark, sf_dir, _n=n: build(_n, spark, sf_dir)) for n in _REGISTRY}
