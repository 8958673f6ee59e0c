"""Row filters of the vendor stages.

Written exactly as the scripts' boolean expressions so that SQL
three-valued logic carries over (trailing blanks never count): a NULL firm name, dealer code or office
type makes ``<>``/``NOT IN`` unknown and the row is dropped.  Never
rewrite these with null-safe equality.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import AttributionConfig
from .keys import col, same_text, tsql_right


def _is_default_branch(code, cfg: AttributionConfig) -> Column:
    suffix = cfg.default_branch_suffix
    return same_text(tsql_right(code, len(suffix))) == F.lit(suffix)


def firm_kept(firm_name, branch_code, cfg: AttributionConfig) -> Column:
    """Market-share stages 1-2: drop the firms handled elsewhere; keep the
    partial firm only on its exception branches (F-03)."""
    f = same_text(firm_name)
    keep = F.lit(True)
    for name in cfg.excluded_firms:
        keep = keep & (f != F.lit(name))
    partial = (f == F.lit(cfg.partial_firm)) & ~same_text(branch_code).isin(
        *cfg.market_share_exception_branches
    )
    return keep & ~partial


def rep_level_daily(dealer_code, branch_code, cfg: AttributionConfig) -> Column:
    """Market-share stage 3: rep-level dealers, and the partial dealer off
    its exception branches (F-08)."""
    d = same_text(dealer_code)
    return d.isin(*cfg.rep_level_dealers) | (
        (d == F.lit(cfg.partial_dealer))
        & ~same_text(branch_code).isin(*cfg.market_share_exception_branches)
    )


def correlated_class(office_type, branch_code, cfg: AttributionConfig) -> Column:
    """Correlated office, exception branch, or a *DEFAULT branch (F-05)."""
    return (
        (same_text(office_type) == F.lit(cfg.correlated_office_type))
        | same_text(branch_code).isin(*cfg.sales_exception_branches)
        | _is_default_branch(branch_code, cfg)
    )


def actual_branches(office_type, branch_code, dealer_code, cfg: AttributionConfig) -> Column:
    """Sales stage 1 (F-04 and F-06)."""
    rep = (*cfg.rep_level_dealers, cfg.partial_dealer)
    return ~correlated_class(office_type, branch_code, cfg) & ~same_text(dealer_code).isin(*rep)


def correlated_branches(office_type, branch_code, dealer_code, cfg: AttributionConfig) -> Column:
    """Sales stage 2 (F-05, F-06 and F-07)."""
    d = same_text(dealer_code)
    excluded = (*cfg.source_dealers, *cfg.rep_level_dealers)
    partial_off_exception = (d == F.lit(cfg.partial_dealer)) & ~same_text(branch_code).isin(
        *cfg.sales_exception_branches
    )
    return correlated_class(office_type, branch_code, cfg) & ~d.isin(*excluded) & ~partial_off_exception


def rep_level_monthly(branch_code, dealer_code, cfg: AttributionConfig) -> Column:
    """Sales stage 3 (F-09)."""
    rep = (*cfg.rep_level_dealers, cfg.partial_dealer)
    return (
        same_text(dealer_code).isin(*rep)
        & ~same_text(branch_code).isin(*cfg.sales_exception_branches)
        & ~_is_default_branch(branch_code, cfg)
    )


def default_branch_or_null(branch_code) -> Column:
    """``ISNULL(Branch_Code, 1) = 1`` (F-15)."""
    return F.coalesce(col(branch_code), F.lit(1)) == F.lit(1)


def active(flag_col, cfg: AttributionConfig) -> Column:
    """``Active_Record_Ind = 'Y'`` (F-01)."""
    return same_text(flag_col) == F.lit(cfg.active_flag)
