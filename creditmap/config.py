"""Business parameters of the attribution.

Everything the scripts hard-code (firm names, dealer codes, branch codes,
product line, territory blacklist, territory type) is data here, so the
same plans run on production tables and on the test-table analog.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, replace

# ---------------------------------------------------------------------------
# These must equal the reference's literals for right results.
# ---------------------------------------------------------------------------
ACTIVE_FLAG = "Y"
TERRITORY_TYPE_ID = 4
OWNER_ROLE = "owner"
PRODUCT_LINE = "Manulife Mutual Funds"
TERRITORY_BLACKLIST = ("TERM", "TBQ", "Non Wealth")
HOUSE_ACCOUNTS = ("C72:DEFAULT", "C57:DEFAULT", "C58:DEFAULT", "CAA:DEFAULT", "C18:DEFAULT")
INSTITUTIONAL_TERRITORY = "Institutional"
EXCLUDED_FIRMS = ("MANULIFE SECURITIES", "CIBC WORLD MARKETS CORP.", "RBC DOMINION SECURITIES.")
PARTIAL_FIRM = "SCOTIACAPITAL INC."
MARKET_SHARE_EXCEPTION_BRANCHES = ("C36:000",)
SALES_EXCEPTION_BRANCHES = ("C36:000", "C36:013")
REP_LEVEL_DEALERS = ("9190", "9280")
PARTIAL_DEALER = "9155"
SOURCE_DEALERS = ("9834", "7585")
CORRELATED_OFFICE_TYPE = "Correlated"
DEFAULT_BRANCH_SUFFIX = "DEFAULT"
IN_HOUSE_FIRM = "MANULIFE SECURITIES"
DIRECT_SOURCE_FIRM = "TD WATERHOUSE"
ETF_PRODUCT_TYPE = "ETF"
FLOW_TYPES = ("G", "R")
GROSS_TYPE = "G"
REDEMPTION_TYPE = "R"
HOLDING_TYPE = "H"
SOURCE_ACCOUNT_TYPE = "1"
DEALER_TYPE_RETAIL = "RETAIL"
DEALER_TYPE_INSTITUTIONAL = "INSTITUTIONAL"
OFFICE_ACTUAL = "ACTUAL"
OFFICE_CORRELATED = "CORRELATED"
OFFICE_SOURCE = "SOURCE"


@dataclass(frozen=True)
class AttributionConfig:
    """Parameters of both attribution scripts.

    ``as_of`` selects the vendor snapshot of the market-share stages 1-3:
    ``"latest"`` (the reference's max-date filter), ``None`` (no filter)
    or a ``datetime.date``.
    """

    active_flag: str = ACTIVE_FLAG
    territory_type_id: int = TERRITORY_TYPE_ID
    owner_role: str = OWNER_ROLE
    product_line: str = PRODUCT_LINE
    territory_blacklist: tuple[str, ...] = TERRITORY_BLACKLIST
    house_accounts: tuple[str, ...] = HOUSE_ACCOUNTS
    institutional_territory: str = INSTITUTIONAL_TERRITORY
    excluded_firms: tuple[str, ...] = EXCLUDED_FIRMS
    partial_firm: str = PARTIAL_FIRM
    market_share_exception_branches: tuple[str, ...] = MARKET_SHARE_EXCEPTION_BRANCHES
    sales_exception_branches: tuple[str, ...] = SALES_EXCEPTION_BRANCHES
    rep_level_dealers: tuple[str, ...] = REP_LEVEL_DEALERS
    partial_dealer: str = PARTIAL_DEALER
    source_dealers: tuple[str, ...] = SOURCE_DEALERS
    correlated_office_type: str = CORRELATED_OFFICE_TYPE
    default_branch_suffix: str = DEFAULT_BRANCH_SUFFIX
    in_house_firm: str = IN_HOUSE_FIRM
    direct_source_firm: str = DIRECT_SOURCE_FIRM
    etf_product_type: str = ETF_PRODUCT_TYPE
    as_of: str | _dt.date | None = "latest"
    # How product names and the peer list's CUSIPs compare: the list declares a
    # collation without case, accents and trailing blanks.
    peer_collation: str = "UNICODE_CI_AI_RTRIM"
    # Raise (as T-SQL does) when RIGHT(code, LEN(code)-4) gets a code shorter
    # than 4; otherwise yield '' like Spark's right().
    strict_right: bool = False

    def with_(self, **kw) -> "AttributionConfig":
        return replace(self, **kw)


def testdata_config(**overrides) -> AttributionConfig:
    """Analog parameters for the driver tables (FIXTURES section 3).

    Dealers 9007 / 9015 stand for the two rep-level dealers, 9009 for the
    partial one, 9003 / 9021 for the two source dealers; the firms of the
    matching nations stand for the excluded firm names.
    """
    exception = tuple(f"C{n:02d}:000" for n in range(25))
    house = tuple(f"C{n:02d}:DEFAULT" for n in range(1, 25, 2))
    cfg = AttributionConfig(
        product_line="Core Funds",
        territory_blacklist=("TERM",),
        house_accounts=house,
        excluded_firms=("NATION_21", "NATION_7", "NATION_15"),
        partial_firm="NATION_9",
        market_share_exception_branches=exception,
        sales_exception_branches=exception,
        rep_level_dealers=("9007", "9015"),
        partial_dealer="9009",
        source_dealers=("9003", "9021"),
    )
    return cfg.with_(**overrides) if overrides else cfg
