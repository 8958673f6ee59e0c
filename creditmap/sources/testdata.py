"""Logical source tables derived from the driver's TPC-H-like tables.

The reference ships no data; this adapter (FIXTURES section 3) maps the
driver tables onto every column the scripts read.  All derivations are
plain DataFrame expressions, so each logical table scales with the
driver tables.  The DuckDB oracle builds the same tables in SQL
(``creditmap.oracle``) independently of this module.
"""

from __future__ import annotations

import tempfile
import uuid
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.keys import date_id
from ..session import freed_shuffles
from . import registry as R
from .layouts import buckets_for, read_by_day, write_bucketed, write_by_day
from .registry import Sources

DRIVER_TABLES = ("nation", "customer", "supplier", "part", "orders", "lineitem", "events")

# Fixed analog dates (FIXTURES section 3).
OVERRIDE_FROM = "1996-01-01 00:00:00"
OVERRIDE_TO = "1998-12-31 00:00:00"
DISTRIBUTOR_SPLIT_END = "1998-06-30 00:00:00"
DISTRIBUTOR_SPLIT_START = "1998-07-01 00:00:00"
DISTRIBUTOR_FIRST_START = "1990-01-01 00:00:00"
OPEN_END = "9999-12-31 00:00:00"


def _ts(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def _amount(c) -> Column:
    return F.col(c).cast("decimal(18,2)") if isinstance(c, str) else c.cast("decimal(18,2)")


def _units(c) -> Column:
    return F.col(c).cast("decimal(18,6)") if isinstance(c, str) else c.cast("decimal(18,6)")


def _txt(c: Column) -> Column:
    return c.cast("string")


def _master_postal(k: Column) -> Column:
    """pc(k): 'P'||k for k<4, else 'P '||k."""
    return F.when(k < 4, F.concat(F.lit("P"), _txt(k))).otherwise(F.concat(F.lit("P "), _txt(k)))


def _vendor_postal(k: Column) -> Column:
    """pv(k): 'P'||k for k<4, 'P-'||k for k<6, else 'P '||k."""
    return (
        F.when(k < 4, F.concat(F.lit("P"), _txt(k)))
        .when(k < 6, F.concat(F.lit("P-"), _txt(k)))
        .otherwise(F.concat(F.lit("P "), _txt(k)))
    )


def _holding_id(cust: Column, supp: Column, part: Column) -> Column:
    return (cust * 100_000 + supp) * 10_000_000 + part


def build(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    t = {n: spark.read.parquet(f"{sf_dir.rstrip('/')}/{n}.parquet") for n in DRIVER_TABLES}
    nation, customer, supplier, part = t["nation"], t["customer"], t["supplier"], t["part"]
    orders, lineitem, events = t["orders"], t["lineitem"], t["events"]
    n, c, s, p = F.col("n_nationkey"), F.col("c_custkey"), F.col("s_suppkey"), F.col("p_partkey")

    out: dict[str, DataFrame] = {}

    # ---- vendor side -----------------------------------------------------
    out[R.FIRM] = nation.select(n.cast("long").alias("Firm_ID"), F.col("n_name").alias("Firm_Name"))
    out[R.REF_DEALER] = nation.where(n % 12 != 11).select(
        n.cast("long").alias("ETF_Dealer_Code"),
        F.when(n % 6 == 0, F.lit(None).cast("string")).otherwise(_txt(n + 9000)).alias("MLI_Dealer_Code"),
    )
    suffix = (
        F.when(s % 10 == 0, F.lit("DEFAULT"))
        .when(s % 10 == 1, F.lit("000"))
        .otherwise(F.lpad(_txt(s % 100), 3, "0"))
    )
    branch = supplier.select(
        s.alias("Dealer_Branch_ID"),
        F.col("s_nationkey").cast("long").alias("Office_ID"),
        F.concat(F.lit("C"), F.lpad(_txt(F.col("s_nationkey")), 2, "0"), F.lit(":"), suffix).alias(
            "Dealer_Branch_CD"
        ),
        F.when(s % 13 == 7, F.lit(None).cast("string"))
        .when(s % 3 == 0, F.lit("Correlated"))
        .otherwise(F.lit("Actual"))
        .alias("Office_Type"),
        F.when(s % 29 == 5, F.lit(None).cast("string")).otherwise(_vendor_postal(s % 7)).alias("Office_Postal_CD"),
    )
    out[R.DEALER_BRANCH] = branch
    out[R.REF_TERRITORY] = (
        branch.where(F.col("Dealer_Branch_ID") % 9 == 0)
        .select(
            F.col("Dealer_Branch_CD").alias("ETF_Branch_Name"),
            _ts(OVERRIDE_FROM).alias("Effective_Date"),
            _ts(OVERRIDE_TO).alias("End_Date"),
            F.concat(F.lit("OVR_"), _txt(F.col("Office_ID"))).alias("MLI_Territory_Name"),
        )
        .distinct()
    )
    out[R.MARKET_SHARE] = lineitem.join(part, F.col("l_partkey") == p).select(
        F.col("l_suppkey").alias("Dealer_Branch_ID"),
        F.col("l_shipdate").alias("Reporting_Date"),
        F.col("p_type").alias("Rank_Group"),
        _amount("l_quantity").alias("Industry_Shares_Amount"),
        _amount("l_extendedprice").alias("Industry_Asset_Amount"),
    )
    out[R.ACCOUNT] = customer.select(
        c.alias("Account_ID"),
        _vendor_postal(c % 7).alias("Account_Postal_CD"),
        F.col("c_mktsegment").alias("Account_Type_TA_CD"),
    )
    li_ord = lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    hid = _holding_id(F.col("o_custkey"), F.col("l_suppkey"), F.col("l_partkey"))
    out[R.HOLDINGS] = (
        li_ord.select("o_custkey", "l_suppkey", "l_partkey")
        .distinct()
        .select(
            hid.alias("Holdings_ID"),
            F.col("o_custkey").alias("Account_ID"),
            F.col("l_suppkey").alias("Dealer_Branch_ID"),
            F.col("l_partkey").alias("Product_ID"),
        )
    )
    out[R.ASSET_POSITION] = li_ord.select(
        hid.alias("Asset_Position_Holding_ID"),
        F.col("l_shipdate").alias("Asset_Position_Reporting_Date"),
        _units("l_quantity").alias("Asset_Position_Shares"),
        _amount("l_tax").alias("Asset_Position_Net_New_Assets"),
        _amount("l_extendedprice").alias("Asset_Position_Balance"),
    )
    out[R.ETF_PRODUCT] = part.select(
        p.alias("Product_ID"),
        F.concat(F.lit("CU"), _txt(p)).alias("Product_CUSIP"),
        F.when(p % 2 == 0, F.lit("ETF")).otherwise(F.lit("MF")).alias("Product_Type"),
    )
    out[R.DIRECT_SOURCE] = events.select(
        F.concat(F.lit("SC"), _txt(F.col("user_id"))).alias("Selling_Code"),
        F.col("ts").alias("Reporting_Date"),
        F.col("event_type").alias("CUSIP"),
        _units("value").alias("Units"),
        _amount(F.col("value") * 10).alias("Assets"),
        _amount("value").alias("Net_Sales"),
    )

    # ---- advisor / customer master -------------------------------------
    by_cust = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    nxt = F.lead("o_orderdate").over(by_cust)
    out[R.SELLING_CODE] = orders.select(
        F.col("o_orderkey").alias("Selling_Code_ID"),
        F.concat(F.lit("SC"), _txt(F.col("o_custkey"))).alias("Selling_Code"),
        (F.col("o_custkey") * 2 + F.when(F.col("o_orderdate") >= _ts(DISTRIBUTOR_SPLIT_START), 1).otherwise(0)).alias(
            "Distributor_ID"
        ),
        F.col("o_orderdate").alias("Rec_Created_Date"),
        F.coalesce(nxt - F.make_dt_interval(F.lit(1)), _ts(OPEN_END)).alias("Rec_Term_Date"),
        F.when(nxt.isNull(), F.lit("Y")).otherwise(F.lit("N")).alias("Active_Record_Ind"),
    )
    v = F.col("v")
    cust_v = customer.select("c_custkey", "c_nationkey", F.explode(F.array(F.lit(0), F.lit(1))).alias("v"))
    out[R.DISTRIBUTOR] = cust_v.select(
        (c * 2 + v).alias("Distributor_ID"),
        c.alias("src_Party_ID"),
        F.when(c % 4 == 0, F.lit(None).cast("int"))
        .when(c % 4 == 3, F.lit(2))
        .otherwise(F.lit(1))
        .alias("Branch_Code"),
        F.when(v == 0, _ts(DISTRIBUTOR_FIRST_START)).otherwise(_ts(DISTRIBUTOR_SPLIT_START)).alias("Rec_Created_Date"),
        F.when(v == 0, _ts(DISTRIBUTOR_SPLIT_END)).otherwise(_ts(OPEN_END)).alias("Rec_Term_Date"),
        F.when(v == 1, F.lit("Y")).otherwise(F.lit("N")).alias("Active_Record_Ind"),
    )

    def link(cond, target: Column, type_id: int) -> DataFrame:
        return customer.where(cond).select(
            (c * 2 + 1).alias("Distributor_ID"),
            target.cast("long").alias("Sales_Territory_ID"),
            F.lit(type_id).alias("Territory_Type_ID"),
            F.lit("Y").alias("Active_Record_Ind"),
        )

    nk = F.col("c_nationkey")
    out[R.DIST_TERRITORY] = (
        link(F.lit(True), ((nk + c % 3) % 25) * 2, 4)
        .unionByName(link(F.lit(True), F.lit(0), 2))
        .unionByName(link(c % 50 == 0, ((nk + 5) % 25) * 2, 4))
    )
    nat_v = nation.select("n_nationkey", "n_name", F.explode(F.array(F.lit(0), F.lit(1))).alias("v"))
    out[R.SALES_TERRITORY] = nat_v.select(
        (n * 2 + v).cast("long").alias("Sales_Territory_ID"),
        n.cast("long").alias("src_ID"),
        F.col("n_name").alias("Territory_External_ID"),
        F.when(n == 24, F.lit("TERM")).otherwise(F.col("n_name")).alias("Territory_Name"),
        F.when(v == 1, F.lit("Y")).otherwise(F.lit("N")).alias("Active_Record_Ind"),
    )
    out[R.ASSOCIATED_CODES] = orders.join(customer, F.col("o_custkey") == c).select(
        F.col("o_orderkey").alias("Associated_Codes_ID"),
        F.col("o_orderkey").alias("Selling_Code_ID"),
        _txt(nk + 9000).alias("Dealer_Code"),
        F.lpad(_txt(F.col("o_custkey") % 100), 3, "0").alias("Rep_Code"),
    )
    out[R.DIST_ADDRESS] = customer.select(
        c.alias("src_Party_ID"), _master_postal(c % 7).alias("Postal_Code"), F.lit("Y").alias("Active_Record_Ind")
    )
    out[R.CUSTOMER_ADDRESS] = customer.select(c.alias("Customer_ID"), _master_postal(c % 7).alias("Postal_Code"))
    out[R.POLICY_CUSTOMER] = customer.select(
        c.alias("Policy_ID"),
        c.alias("Customer_ID"),
        F.when(c % 11 == 0, F.lit("insured")).otherwise(F.lit("owner")).alias("Customer_Role"),
    )
    out[R.POLICY] = customer.select(
        c.alias("Policy_ID"),
        F.when(c % 5 == 0, F.lit("Other")).otherwise(F.lit("Core Funds")).alias("Product_Name"),
        F.concat(_txt(nk + 9000), F.lit("XX")).alias("Host_Distributor_Num"),
    )
    out[R.SELLING_CODE_POLICY] = orders.select(
        F.col("o_custkey").alias("Policy_ID"),
        F.col("o_orderkey").alias("Selling_Code_ID"),
        F.when(F.col("o_orderkey") % 10 == 0, F.lit("N")).otherwise(F.lit("Y")).alias("Active_Record_Ind"),
    )
    out[R.ASSET_DAILY] = li_ord.select(
        F.col("l_orderkey").alias("Original_Associated_Codes_ID"),
        F.col("l_orderkey").alias("Reporting_Selling_Code_ID"),
        F.col("l_orderkey").alias("Original_Selling_Code_ID"),
        F.col("o_custkey").alias("Policy_ID"),
        F.col("l_partkey").alias("inv_Product_ID"),
        date_id("l_shipdate").alias("Reporting_Date_ID"),
        _amount("l_extendedprice").alias("Asset_Value_Amt"),
        _units("l_quantity").alias("Number_Of_Units"),
    )
    out[R.ASSET_MONTHEND] = lineitem.where(F.col("l_linestatus") == "O").select(
        date_id("l_shipdate").alias("Reporting_Date_ID"),
        F.col("l_partkey").alias("inv_Product_ID"),
        F.col("l_orderkey").alias("Original_Selling_Code_ID"),
        _amount("l_extendedprice").alias("Asset_Value_Amt"),
        _units("l_quantity").alias("Number_Of_Units"),
    )
    flag = F.col("l_returnflag")
    qty = _amount("l_quantity")
    out[R.NBV_MONTHEND] = lineitem.select(
        date_id("l_shipdate").alias("Reporting_Date_ID"),
        F.when(flag == "A", F.lit("G")).when(flag == "R", F.lit("R")).otherwise(F.lit("X")).alias(
            "Gross_Redemption_Type"
        ),
        F.col("l_partkey").alias("Product_ID"),
        F.col("l_orderkey").alias("Original_Selling_Code_ID"),
        F.when(flag == "R", -qty).otherwise(qty).alias("Txn_Amt"),
    )
    out[R.DATE_DIM] = (
        lineitem.select("l_shipdate")
        .distinct()
        .select(date_id("l_shipdate").alias("Date_ID"), F.col("l_shipdate").alias("Calendar_Date"))
    )
    out[R.PRODUCT_DIM] = part.select(
        p.alias("Product_ID"),
        F.concat(F.lit("CU"), _txt(p)).alias("Product_Name"),
        F.when(p % 17 == 0, F.lit("N")).otherwise(F.lit("Y")).alias("Active_Record_Ind"),
    )
    peer = part.select(F.concat(F.lit("CU"), _txt(p)).alias("CUSIP"), F.col("p_type").alias("PEER_GROUP"), p)
    out[R.PEERS] = (
        peer.where(p % 20 == 0).drop("p_partkey").unionByName(peer.where(p % 200 == 0).drop("p_partkey"))
    )
    return out


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the session names in ``spark.checkpoint.dir``.

    A local session that names none (tests) gets a temporary one; on a cluster
    no folder of one machine would do, and this raises."""
    sc = spark.sparkContext
    root = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="creditmap-checkpoint-"))
        root = sc.getCheckpointDir()
    return root.rstrip("/")


def testdata_sources(spark: SparkSession, sf_dir: str, stored: bool = True) -> Sources:
    """The logical tables over the driver tables at ``sf_dir``.

    ``stored=True`` writes a table under the checkpoint folder when a query
    first asks for it and reads it from there: production reads stored tables,
    and this gives the plans the same shape (one scan per source, with pushdown
    and pruning).  ``stored=False`` keeps them as lazy derivations.
    """
    tables = build(spark, sf_dir)
    if not stored:
        return Sources(spark, tables)
    tag = "-".join(p for p in sf_dir.rstrip("/").split("/")[-2:] if p)
    root = f"{scratch_root(spark)}/creditmap-sources/{tag}-{uuid.uuid4().hex[:8]}"

    def opened(name: str) -> DataFrame:
        with freed_shuffles(spark):
            tables[name].write.mode("overwrite").parquet(f"{root}/{name}")
        return spark.read.schema(tables[name].schema).parquet(f"{root}/{name}")

    given = {name: spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet") for name in ("part", "supplier")}
    src = Sources(spark, given | {name: partial(opened, name) for name in tables})
    src.add(R.MARKET_SHARE + R.BY_DAY, partial(_by_day, src))
    for name, key in BUCKETS.items():
        src.add(name + R.BUCKETED, partial(_bucketed, src, name, key))
    return src


#: Tables that are also stored bucketed, and by which key.
BUCKETS = {R.ASSET_POSITION: "Asset_Position_Holding_ID", R.HOLDINGS: "Holdings_ID"}


def _by_day(src: Sources) -> DataFrame:
    fact, path = src[R.MARKET_SHARE], scratch_path(src, "by-day")
    with freed_shuffles(src.spark):
        write_by_day(fact, path, "Reporting_Date")
    return read_by_day(src.spark, path, fact)


def _bucketed(src: Sources, name: str, key: str) -> DataFrame:
    path = scratch_path(src, f"bucketed-{name}")
    buckets = buckets_for(src[n] for n in BUCKETS)
    with freed_shuffles(src.spark):
        return write_bucketed(src[name], path.rsplit("/", 1)[1].replace("-", "_"), path, key, buckets)


def scratch_path(src: Sources, name: str) -> str:
    """A new folder under :func:`scratch_root` for a stored layout."""
    return f"{scratch_root(src.spark)}/creditmap-layouts/{name}-{uuid.uuid4().hex[:8]}"


def stored_by_day(src: Sources) -> Sources:
    """``src`` with the daily fact stored by reporting day."""
    return src.with_table(R.MARKET_SHARE, src[R.MARKET_SHARE + R.BY_DAY])


def stored_bucketed(src: Sources) -> Sources:
    """``src`` with positions and holdings stored bucketed by holding id."""
    for name in BUCKETS:
        src = src.with_table(name, src[name + R.BUCKETED])
    return src
