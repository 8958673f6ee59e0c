"""Advisor-master chains to the current sales territory (C-03, R-4).

The same chain is spelled out four times in each script.  Here it is
built once, on the dimension side, and joined to facts after they are
aggregated, so the large facts never travel through the chain.  Every hop
from a version to its current version goes through ``current_versions``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import AttributionConfig
from ..functions.predicates import active
from ..operators.versions import current_versions
from ..sources import registry as R
from ..sources.registry import Sources


def distributor_territories(src: Sources, cfg: AttributionConfig, dist_col: str = "Distributor_ID") -> DataFrame:
    return src.memo(("distributor_territories", dist_col, cfg), lambda: _distributor_territories(src, cfg, dist_col))


def _distributor_territories(src: Sources, cfg: AttributionConfig, dist_col: str) -> DataFrame:
    """Distributor id -> current territory through its active typed links.

    ``link(type, active) -> SALES_TERRITORY(version) -> SALES_TERRITORY(current,
    same src_ID)``.  Columns: ``dist_col, Territory_External_ID, Territory_Name``.
    """
    link = src[R.DIST_TERRITORY].where(
        (F.col("Territory_Type_ID") == F.lit(cfg.territory_type_id)) & active("Active_Record_Ind", cfg)
    ).select(F.col("Distributor_ID").alias(dist_col), "Sales_Territory_ID")
    current = current_versions(src[R.SALES_TERRITORY], "Sales_Territory_ID", "src_ID",
                               {"Territory_External_ID": "Territory_External_ID", "Territory_Name": "Territory_Name"},
                               active_flag=cfg.active_flag)
    return link.join(current, "Sales_Territory_ID").drop("Sales_Territory_ID")


def party_current_territories(src: Sources, cfg: AttributionConfig) -> DataFrame:
    return src.memo(("party_current_territories", cfg), lambda: _party_current_territories(src, cfg))


def _party_current_territories(src: Sources, cfg: AttributionConfig) -> DataFrame:
    """Party -> its current distributor versions -> their current territories.

    Columns: ``src_Party_ID, Territory_External_ID, Territory_Name``.
    """
    cur = src[R.DISTRIBUTOR].where(active("Active_Record_Ind", cfg)).select(
        "src_Party_ID", F.col("Distributor_ID").alias("__cur")
    )
    return cur.join(distributor_territories(src, cfg, "__cur"), "__cur").drop("__cur")


def selling_code_territories(src: Sources, cfg: AttributionConfig) -> DataFrame:
    return src.memo(("selling_code_territories", cfg), lambda: _selling_code_territories(src, cfg))


def _selling_code_territories(src: Sources, cfg: AttributionConfig) -> DataFrame:
    """Selling code id (any version) -> current selling-code versions ->
    their distributor (any version) -> current distributor versions of the
    same party -> current territories.

    Columns: ``Selling_Code_ID, src_Party_ID, Territory_External_ID, Territory_Name``.
    """
    current = current_versions(src[R.SELLING_CODE], "Selling_Code_ID", "Selling_Code", {"Distributor_ID": "__dist"},
                               active_flag=cfg.active_flag)
    party = src[R.DISTRIBUTOR].select(F.col("Distributor_ID").alias("__dist"), "src_Party_ID")
    return (current.join(party, "__dist").join(party_current_territories(src, cfg), "src_Party_ID")
            .drop("__dist"))
