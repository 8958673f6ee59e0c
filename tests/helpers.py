"""Small builders for hand-made test tables."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from creditmap.sources.registry import Sources


def D(x) -> Decimal:
    return Decimal(str(x))


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


def day(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


def frame(spark, schema: str, rows):
    return spark.createDataFrame(list(rows), schema)


def sources(spark, tables: dict) -> Sources:
    return Sources(spark, tables)


def rows(df, *cols):
    """Sorted list of tuples (None sorts first)."""
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()), key=lambda t: tuple((v is not None, v) for v in t))


# Logical schemas (FIXTURES section 1) used by hand-made fixtures.
SELLING_CODE = ("Selling_Code_ID long, Selling_Code string, Distributor_ID long, Rec_Created_Date timestamp_ntz, "
                "Rec_Term_Date timestamp_ntz, Active_Record_Ind string")
DISTRIBUTOR = ("Distributor_ID long, src_Party_ID long, Branch_Code int, Rec_Created_Date timestamp_ntz, "
               "Rec_Term_Date timestamp_ntz, Active_Record_Ind string")
DIST_TERRITORY = "Distributor_ID long, Sales_Territory_ID long, Territory_Type_ID int, Active_Record_Ind string"
SALES_TERRITORY = ("Sales_Territory_ID long, src_ID long, Territory_External_ID string, Territory_Name string, "
                   "Active_Record_Ind string")
