"""Source registry: the logical tables of both scripts as DataFrames.

Production reads parquet or catalog tables by the reference's table
names; tests read the analog built from the driver tables
(``creditmap.sources.testdata``).  Every consumer asks for a table by
name, so plans never hard-code a location.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

# Vendor (ETF intelligence) tables
MARKET_SHARE = "ETF_MARKET_SHARE_FACT"
DEALER_BRANCH = "ETF_DEALER_BRANCH_FACT"
FIRM = "ETF_FIRM_FACT"
REF_DEALER = "ETF_ref_DEALER_FACT"
REF_TERRITORY = "ETF_ref_TERRITORY_FACT"
ACCOUNT = "ETF_ACCOUNT_FACT"
HOLDINGS = "ETF_HOLDINGS_DIM"
ASSET_POSITION = "ETF_ASSET_POSITION_FACT"
ETF_PRODUCT = "ETF_PRODUCT_FACT"
DIRECT_SOURCE = "ETF_DIRECT_SOURCE"
# Advisor / customer master tables
ASSOCIATED_CODES = "ASSOCIATED_CODES_DIM"
SELLING_CODE = "SELLING_CODE_DIM"
ASSET_DAILY = "ASSET_DAILY_FACT"
DISTRIBUTOR = "DISTRIBUTOR_DIM"
DIST_TERRITORY = "DISTRIBUTOR_SALES_TERRITORY_FACT"
SALES_TERRITORY = "SALES_TERRITORY_DIM"
DIST_ADDRESS = "DISTRIBUTOR_ADDRESS_DIM"
CUSTOMER_ADDRESS = "CUSTOMER_ADDRESS_DIM"
POLICY_CUSTOMER = "POLICY_CUSTOMER_FACT"
POLICY = "POLICY_DIM"
SELLING_CODE_POLICY = "SELLING_CODE_POLICY_FACT"
DATE_DIM = "DATE_DIM"
PRODUCT_DIM = "PRODUCT_DIM"
NBV_MONTHEND = "NBV_MONTHEND_FACT"
ASSET_MONTHEND = "ASSET_MONTHEND_FACT"
# The peer list the market-share script declares inline.
PEERS = "PEER_LIST"
# Other stored layouts of the same tables (sources.layouts).
BY_DAY = "/by-day"
BUCKETED = "/bucketed"

ALL_TABLES = (
    MARKET_SHARE, DEALER_BRANCH, FIRM, REF_DEALER, REF_TERRITORY, ACCOUNT, HOLDINGS,
    ASSET_POSITION, ETF_PRODUCT, DIRECT_SOURCE, ASSOCIATED_CODES, SELLING_CODE, ASSET_DAILY,
    DISTRIBUTOR, DIST_TERRITORY, SALES_TERRITORY, DIST_ADDRESS, CUSTOMER_ADDRESS,
    POLICY_CUSTOMER, POLICY, SELLING_CODE_POLICY, DATE_DIM, PRODUCT_DIM, NBV_MONTHEND,
    ASSET_MONTHEND,
)


class Sources:
    """Named logical tables and the relations built over them.

    Nothing here runs a Spark job or looks at sizes: every plan is the same at
    every size, and Spark picks broadcast or shuffle joins from file sizes and,
    at run time, from measured shuffle sizes (AQE)."""

    def __init__(self, spark: SparkSession, tables: Mapping[str, DataFrame | Callable[[], DataFrame]]):
        self.spark = spark
        self._tables = dict(tables)
        self._memo: dict = {}
        self.sf_dir: str | None = None

    def __getitem__(self, name: str) -> DataFrame:
        try:
            table = self._tables[name]
        except KeyError:
            raise KeyError(f"source table {name!r} is not registered") from None
        if not isinstance(table, DataFrame):  # opened at first use
            table = self._tables[name] = table()
        return table

    def __contains__(self, name: str) -> bool:
        return name in self._tables

    def add(self, name: str, open_: Callable[[], DataFrame]) -> None:
        """Register a table that ``open_`` opens at first use."""
        self._tables[name] = open_

    def names(self) -> list[str]:
        return list(self._tables)

    def memo(self, key, build):
        """The DataFrame ``build()`` returns, built once per ``key``.

        Plans are immutable, so a relation used by several stages (a
        territory chain, the owner tables, the bridge) is one plan instance:
        fewer round-trips while building, and Spark can reuse its exchange
        or broadcast wherever it appears in one query.  The key names the
        relation and the configuration it depends on."""
        if key not in self._memo:
            self._memo[key] = build()
        return self._memo[key]

    def with_table(self, name: str, df: DataFrame) -> "Sources":
        out = Sources(self.spark, {**self._tables, name: df})
        out.sf_dir = self.sf_dir
        return out

    @classmethod
    def from_parquet(cls, spark: SparkSession, root: str, names=ALL_TABLES) -> "Sources":
        """One parquet dataset per logical table under ``root``."""
        return cls(spark, {n: spark.read.parquet(f"{root.rstrip('/')}/{n}") for n in names})

    @classmethod
    def from_catalog(cls, spark: SparkSession, database: str, names=ALL_TABLES) -> "Sources":
        return cls(spark, {n: spark.table(f"{database}.{n}") for n in names})
