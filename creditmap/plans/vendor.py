"""Vendor position rollups (C-05).

Each script reads its vendor fact in several stages that differ in their
filters and group keys.  Here every fact row is routed once, on the
dimension side, to the stages that want it (a row may go to several, each
copy carries its route), and ONE aggregation serves all stages: its group
keys are route-dependent expressions that equal, for each route, exactly
the group keys of that stage.  A stage rollup is then a filter and a
projection of the shared aggregate, and the end-to-end plans attach all
routes with one join, so the fact is scanned once per script.

The daily fact meets its few branch dimensions as it is scanned (broadcast
where they are small) and is aggregated once; the position fact meets its
holdings once, and stored bucketed by holding id on both sides
(``sources.layouts``) that join needs no shuffle.  Overrides come from an
interval index by branch code and month.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import AttributionConfig
from ..functions import predicates as P
from ..functions.keys import dealer_rep_key, dealer_type, month_end, same_text, vendor_key
from ..operators.intervals import effective_dated_left
from ..operators.runtime_filter import keep_possible
from ..operators.snapshot import snapshot
from ..sources import registry as R
from ..sources.registry import Sources

ROUTE = "__route"
# Market-share routes
MS_BRANCH = "branch"      # stages 1 and 2 (firm filter F-03)
MS_REP = "rep"            # stage 3 (dealer filter F-08)
# Sales routes
SA_ACTUAL = "actual"      # stage 1
SA_CORRELATED = "correlated"  # stage 2
SA_REP = "rep"            # stage 3


def _routes(pairs: list[tuple[str, Column]]) -> Column:
    """Array of the routes whose predicate is TRUE (NULL counts as false)."""
    arr = F.array(*[F.when(pred, F.lit(name)) for name, pred in pairs])
    return F.filter(arr, lambda r: r.isNotNull())


def _is(route: str) -> Column:
    return F.col(ROUTE) == F.lit(route)


def _with_firm(rows: DataFrame, src: Sources, dealer_how: str) -> DataFrame:
    """``rows`` of branches with their firm and dealer; each join is with a stored table, whose size Spark knows."""
    firm = src[R.FIRM].select(F.col("Firm_ID").alias("Office_ID"), "Firm_ID", "Firm_Name")
    dealer = src[R.REF_DEALER].select(F.col("ETF_Dealer_Code").alias("Firm_ID"), "MLI_Dealer_Code")
    return rows.join(firm, "Office_ID").join(dealer, "Firm_ID", dealer_how)


def _branches(src: Sources) -> DataFrame:
    return src[R.DEALER_BRANCH].select("Dealer_Branch_ID", "Office_ID", "Dealer_Branch_CD", "Office_Type", "Office_Postal_CD")


def _branch_dims(src: Sources, dealer_how: str) -> DataFrame:
    return _with_firm(_branches(src), src, dealer_how)


def rep_keys_daily(src: Sources, cfg: AttributionConfig) -> DataFrame:
    """(DlrRep) of the branches of market-share stage 3."""
    return _rep_keys(_branch_dims(src, "inner").where(P.rep_level_daily("MLI_Dealer_Code", "Dealer_Branch_CD", cfg)))


def rep_keys_monthly(src: Sources, cfg: AttributionConfig) -> DataFrame:
    """(DlrRep) of the branches of sales stage 3."""
    return _rep_keys(_branch_dims(src, "left").where(P.rep_level_monthly("Dealer_Branch_CD", "MLI_Dealer_Code", cfg)))


def _rep_keys(dims: DataFrame) -> DataFrame:
    """Never strict: a short code raises when it has positions."""
    return dims.select(same_text(dealer_rep_key("MLI_Dealer_Code", "Dealer_Branch_CD")).alias("DlrRep"))


def with_overrides(rows: DataFrame, src: Sources, at: str, only_when: Column | None = None) -> DataFrame:
    """``rows`` with the territories that override their branch code at ``at`` (J-08)."""
    return effective_dated_left(rows, src[R.REF_TERRITORY], "Dealer_Branch_CD", at, "ETF_Branch_Name", "Effective_Date", "End_Date",
                                {"MLI_Territory_Name": "MLI_Territory_Name"}, only_when)


# ---------------------------------------------------------------------------
# Script A: market share, daily
# ---------------------------------------------------------------------------

def market_share_positions(src: Sources, cfg: AttributionConfig, as_of, routes: tuple[str, ...] = (MS_BRANCH, MS_REP)) -> DataFrame:
    return src.memo(("market_share_positions", str(as_of), routes, cfg), lambda: _market_share_positions(src, cfg, as_of, routes))


def _market_share_positions(src: Sources, cfg: AttributionConfig, as_of, routes: tuple[str, ...]) -> DataFrame:
    """Market-share fact aggregated once for the stages that want ``routes``.

    Group keys per route (A:135-144 for ``branch``, A:329-337 for ``rep``):
    Reporting_Date (raw), Firm_Name, aBR (office key / dealer-rep key),
    Dealer_Type, MLI_Dealer_Code (``branch`` only), Rank_Group,
    Office_Type, Dealer_Branch_CD, MLI_Territory_Name (``branch`` only).
    """
    wanted = {MS_BRANCH: P.firm_kept("Firm_Name", "Dealer_Branch_CD", cfg),
              MS_REP: P.rep_level_daily("MLI_Dealer_Code", "Dealer_Branch_CD", cfg)}
    dims = _branch_dims(src, "inner").select("*", F.explode(_routes([(r, wanted[r]) for r in routes])).alias(ROUTE))
    fact = snapshot(src[R.MARKET_SHARE], "Reporting_Date", as_of).select(
        "Dealer_Branch_ID", "Reporting_Date", "Rank_Group", "Industry_Shares_Amount", "Industry_Asset_Amount")
    if MS_BRANCH not in routes:  # few dealers: other rows are gone in the scan
        fact = keep_possible(fact, "Dealer_Branch_ID", dims, "Dealer_Branch_ID")
    rows = with_overrides(fact.join(dims, "Dealer_Branch_ID"), src, "Reporting_Date", _is(MS_BRANCH))
    rep = _is(MS_REP)
    return rows.groupBy(
        ROUTE, "Reporting_Date", "Firm_Name",
        same_text(F.when(rep, dealer_rep_key("MLI_Dealer_Code", "Dealer_Branch_CD", cfg.strict_right))
                  .otherwise(vendor_key("MLI_Dealer_Code", "Firm_ID", "Office_Postal_CD"))).alias("aBR"),
        dealer_type("MLI_Dealer_Code").alias("Dealer_Type"),
        F.when(~rep, F.col("MLI_Dealer_Code")).alias("MLI_Dealer_Code"),
        "Rank_Group", "Office_Type", "Dealer_Branch_CD", "MLI_Territory_Name",
    ).agg(
        F.sum("Industry_Shares_Amount").alias("Asset_Position_Shares"),
        F.sum("Industry_Asset_Amount").alias("Asset_Position_Balance"),
    )


def branch_positions_daily(positions: DataFrame) -> DataFrame:
    """Stages 1-2 vendor rollup (G-03), keyed by the office branch key aBR."""
    return positions.where(_is(MS_BRANCH)).select(
        "Reporting_Date", "Firm_Name", "aBR", "Dealer_Type", "MLI_Dealer_Code",
        F.col("Rank_Group").alias("PeerGroup"), "Office_Type", "Dealer_Branch_CD", "MLI_Territory_Name",
        "Asset_Position_Shares", "Asset_Position_Balance",
    )


def rep_positions_daily(positions: DataFrame) -> DataFrame:
    """Stage 3 rollup (G-05): grouped by raw timestamp and branch code,
    shown as a day (Q-18)."""
    return positions.where(_is(MS_REP)).select(
        "Firm_Name", "Dealer_Type", "aBR", "Office_Type",
        F.col("Reporting_Date").cast("date").alias("Reporting_Date"),
        F.col("Rank_Group").alias("PEER_GROUP"), "Asset_Position_Shares", "Asset_Position_Balance",
    )


# ---------------------------------------------------------------------------
# Script B: sales and assets, month end
# ---------------------------------------------------------------------------

SA_ROUTES = (SA_ACTUAL, SA_CORRELATED, SA_REP)


def holdings_dims(src: Sources, cfg: AttributionConfig, routes: tuple[str, ...] = SA_ROUTES) -> DataFrame:
    """Holding id -> account, branch, firm, dealer, product and stage routes.

    Holdings meet their branch first: those that no stage of ``routes`` wants are gone before any shuffle."""
    wanted = {
        SA_ACTUAL: P.actual_branches("Office_Type", "Dealer_Branch_CD", "MLI_Dealer_Code", cfg),
        SA_CORRELATED: P.correlated_branches("Office_Type", "Dealer_Branch_CD", "MLI_Dealer_Code", cfg),
        SA_REP: P.rep_level_monthly("Dealer_Branch_CD", "MLI_Dealer_Code", cfg),
    }
    hold = src[R.HOLDINGS].select("Holdings_ID", "Account_ID", "Dealer_Branch_ID", "Product_ID")
    acct = src[R.ACCOUNT].select("Account_ID", "Account_Postal_CD", "Account_Type_TA_CD")
    prod = src[R.ETF_PRODUCT].select("Product_ID", "Product_CUSIP")
    held = _with_firm(hold.join(_branches(src), "Dealer_Branch_ID"), src, "left").withColumn("__routes", _routes([(r, wanted[r]) for r in routes]))
    dims = held.where(F.size("__routes") > 0).join(acct, "Account_ID").join(prod, "Product_ID")
    return dims.select(
        "Holdings_ID", "Firm_ID", "Firm_Name", "MLI_Dealer_Code", "Office_Postal_CD", "Account_Postal_CD",
        "Office_Type", "Dealer_Branch_CD", "Account_Type_TA_CD", "Product_CUSIP",
        F.explode("__routes").alias(ROUTE),
    )


def sales_positions(src: Sources, cfg: AttributionConfig, routes: tuple[str, ...] = SA_ROUTES) -> DataFrame:
    return src.memo(("sales_positions", routes, cfg), lambda: _sales_positions(src, cfg, routes))


def _sales_positions(src: Sources, cfg: AttributionConfig, routes: tuple[str, ...]) -> DataFrame:
    """Asset positions aggregated once for the stages that want ``routes``, at month end.

    Group keys per route (B:134-144 for ``actual``/``correlated``, B:329-337
    for ``rep``): month end, Firm_Name, aBR (office key / dealer-rep key),
    cBR, Dealer_Type, CUSIP, Office_Type, Dealer_Branch_CD (not ``rep``),
    Account_Type, MLI_Territory_Name (not ``rep``).
    """
    fact = src[R.ASSET_POSITION].select(
        F.col("Asset_Position_Holding_ID").alias("Holdings_ID"), "Asset_Position_Reporting_Date",
        "Asset_Position_Shares", "Asset_Position_Net_New_Assets", "Asset_Position_Balance",
    )
    rep = _is(SA_REP)
    rows = with_overrides(fact.join(holdings_dims(src, cfg, routes), "Holdings_ID"), src, "Asset_Position_Reporting_Date", ~rep)
    return rows.groupBy(
        ROUTE, month_end("Asset_Position_Reporting_Date").alias("Reporting_Date"), "Firm_Name",
        same_text(F.when(rep, dealer_rep_key("MLI_Dealer_Code", "Dealer_Branch_CD", cfg.strict_right))
                  .otherwise(vendor_key("MLI_Dealer_Code", "Firm_ID", "Office_Postal_CD"))).alias("aBR"),
        same_text(vendor_key("MLI_Dealer_Code", "Firm_ID", "Account_Postal_CD")).alias("cBR"),
        dealer_type("MLI_Dealer_Code").alias("Dealer_Type"),
        F.col("Product_CUSIP").alias("CUSIP"), "Office_Type",
        F.when(~rep, F.col("Dealer_Branch_CD")).alias("Dealer_Branch_CD"),
        F.col("Account_Type_TA_CD").alias("Account_Type"), "MLI_Territory_Name",
    ).agg(
        F.sum("Asset_Position_Shares").alias("Asset_Position_Shares"),
        F.sum("Asset_Position_Net_New_Assets").alias("Asset_Position_Net_New_Assets"),
        F.sum("Asset_Position_Balance").alias("Asset_Position_Balance"),
    )


_SALES_SUMS = ("Asset_Position_Shares", "Asset_Position_Net_New_Assets", "Asset_Position_Balance")


def branch_positions_monthly(positions: DataFrame, route: str) -> DataFrame:
    """Stage 1 or 2 rollup (G-04)."""
    return positions.where(_is(route)).select(
        F.col("Reporting_Date").alias("Asset_Position_Reporting_Date"), "Firm_Name", "aBR", "cBR",
        "Dealer_Type", "CUSIP", "Office_Type", "Dealer_Branch_CD", "Account_Type", "MLI_Territory_Name",
        *_SALES_SUMS,
    )


def rep_positions_monthly(positions: DataFrame) -> DataFrame:
    """Stage 3 rollup (G-06)."""
    return positions.where(_is(SA_REP)).select(
        "Firm_Name", "Dealer_Type", "aBR", "Office_Type", "Reporting_Date", "cBR", "Account_Type", "CUSIP",
        *_SALES_SUMS,
    )
