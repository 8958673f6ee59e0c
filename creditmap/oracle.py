"""DuckDB SQL for every registered query.

Written from the survey's operator list, independently of the Spark code.  The
logical tables are rebuilt from the driver tables (``ADAPTER``); over them stand
a few shared views: the current territory of a distributor, a party and a
selling code; offices and holdings with everything known about them; the
dealer-rep bridge; owners as the winner of each branch key.  A query selects
from these views only.  Strings compare without trailing blanks, rank ties go
to the smaller territory.
"""

from __future__ import annotations

import datetime as dt

from .config import AttributionConfig, testdata_config
from .sources.peers import PEER_LIST


def _lit(v) -> str:
    return "'" + str(v).replace("'", "''") + "'"


def _list(values) -> str:
    return "(" + ", ".join(_lit(v) for v in values) + ")"


def _vendor_postal(k: str) -> str:
    return (f"CASE WHEN {k} < 4 THEN 'P' || CAST({k} AS STRING) WHEN {k} < 6 THEN 'P-' || CAST({k} AS STRING) "
            f"ELSE 'P ' || CAST({k} AS STRING) END")


def _master_postal(k: str) -> str:
    return f"CASE WHEN {k} < 4 THEN 'P' || CAST({k} AS STRING) ELSE 'P ' || CAST({k} AS STRING) END"


def _date_id(d: str) -> str:
    return f"CAST(year({d}) * 10000 + month({d}) * 100 + day({d}) AS INTEGER)"


def _hid() -> str:
    return "(o_custkey * 100000 + l_suppkey) * 10000000 + l_partkey"


ADAPTER = [
    ("ETF_FIRM_FACT", "SELECT CAST(n_nationkey AS BIGINT) AS Firm_ID, n_name AS Firm_Name FROM nation"),
    ("ETF_ref_DEALER_FACT", """SELECT CAST(n_nationkey AS BIGINT) AS ETF_Dealer_Code,
        CASE WHEN n_nationkey % 6 = 0 THEN NULL ELSE CAST(n_nationkey + 9000 AS STRING) END AS MLI_Dealer_Code
        FROM nation WHERE n_nationkey % 12 <> 11"""),
    ("ETF_DEALER_BRANCH_FACT", f"""SELECT s_suppkey AS Dealer_Branch_ID, CAST(s_nationkey AS BIGINT) AS Office_ID,
        'C' || lpad(CAST(s_nationkey AS STRING), 2, '0') || ':' ||
          CASE WHEN s_suppkey % 10 = 0 THEN 'DEFAULT' WHEN s_suppkey % 10 = 1 THEN '000'
               ELSE lpad(CAST(s_suppkey % 100 AS STRING), 3, '0') END AS Dealer_Branch_CD,
        CASE WHEN s_suppkey % 13 = 7 THEN NULL WHEN s_suppkey % 3 = 0 THEN 'Correlated' ELSE 'Actual' END AS Office_Type,
        CASE WHEN s_suppkey % 29 = 5 THEN NULL ELSE {_vendor_postal('s_suppkey % 7')} END AS Office_Postal_CD
        FROM supplier"""),
    ("ETF_ref_TERRITORY_FACT", """SELECT DISTINCT Dealer_Branch_CD AS ETF_Branch_Name,
        TIMESTAMP '1996-01-01 00:00:00' AS Effective_Date, TIMESTAMP '1998-12-31 00:00:00' AS End_Date,
        'OVR_' || CAST(Office_ID AS STRING) AS MLI_Territory_Name
        FROM ETF_DEALER_BRANCH_FACT WHERE Dealer_Branch_ID % 9 = 0"""),
    ("ETF_MARKET_SHARE_FACT", """SELECT l_suppkey AS Dealer_Branch_ID, l_shipdate AS Reporting_Date,
        p_type AS Rank_Group, CAST(l_quantity AS DECIMAL(18,2)) AS Industry_Shares_Amount,
        CAST(l_extendedprice AS DECIMAL(18,2)) AS Industry_Asset_Amount
        FROM lineitem JOIN part ON l_partkey = p_partkey"""),
    ("ETF_ACCOUNT_FACT", f"""SELECT c_custkey AS Account_ID, {_vendor_postal('c_custkey % 7')} AS Account_Postal_CD,
        c_mktsegment AS Account_Type_TA_CD FROM customer"""),
    ("ETF_HOLDINGS_DIM", f"""SELECT DISTINCT {_hid()} AS Holdings_ID, o_custkey AS Account_ID,
        l_suppkey AS Dealer_Branch_ID, l_partkey AS Product_ID
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""),
    ("ETF_ASSET_POSITION_FACT", f"""SELECT {_hid()} AS Asset_Position_Holding_ID,
        l_shipdate AS Asset_Position_Reporting_Date, CAST(l_quantity AS DECIMAL(18,6)) AS Asset_Position_Shares,
        CAST(l_tax AS DECIMAL(18,2)) AS Asset_Position_Net_New_Assets,
        CAST(l_extendedprice AS DECIMAL(18,2)) AS Asset_Position_Balance
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""),
    ("ETF_PRODUCT_FACT", """SELECT p_partkey AS Product_ID, 'CU' || CAST(p_partkey AS STRING) AS Product_CUSIP,
        CASE WHEN p_partkey % 2 = 0 THEN 'ETF' ELSE 'MF' END AS Product_Type FROM part"""),
    ("ETF_DIRECT_SOURCE", """SELECT 'SC' || CAST(user_id AS STRING) AS Selling_Code, ts AS Reporting_Date,
        event_type AS CUSIP, CAST(value AS DECIMAL(18,6)) AS Units, CAST(value * 10 AS DECIMAL(18,2)) AS Assets,
        CAST(value AS DECIMAL(18,2)) AS Net_Sales FROM events"""),
    ("SELLING_CODE_DIM", """SELECT o_orderkey AS Selling_Code_ID, 'SC' || CAST(o_custkey AS STRING) AS Selling_Code,
        o_custkey * 2 + CASE WHEN o_orderdate >= TIMESTAMP '1998-07-01 00:00:00' THEN 1 ELSE 0 END AS Distributor_ID,
        o_orderdate AS Rec_Created_Date,
        COALESCE(lead(o_orderdate) OVER w - INTERVAL 1 DAY, TIMESTAMP '9999-12-31 00:00:00') AS Rec_Term_Date,
        CASE WHEN lead(o_orderdate) OVER w IS NULL THEN 'Y' ELSE 'N' END AS Active_Record_Ind
        FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)"""),
    ("DISTRIBUTOR_DIM", """SELECT c_custkey * 2 AS Distributor_ID, c_custkey AS src_Party_ID,
          CASE WHEN c_custkey % 4 = 0 THEN NULL WHEN c_custkey % 4 = 3 THEN 2 ELSE 1 END AS Branch_Code,
          TIMESTAMP '1990-01-01 00:00:00' AS Rec_Created_Date, TIMESTAMP '1998-06-30 00:00:00' AS Rec_Term_Date,
          'N' AS Active_Record_Ind FROM customer
        UNION ALL
        SELECT c_custkey * 2 + 1, c_custkey,
          CASE WHEN c_custkey % 4 = 0 THEN NULL WHEN c_custkey % 4 = 3 THEN 2 ELSE 1 END,
          TIMESTAMP '1998-07-01 00:00:00', TIMESTAMP '9999-12-31 00:00:00', 'Y' FROM customer"""),
    ("DISTRIBUTOR_SALES_TERRITORY_FACT", """SELECT c_custkey * 2 + 1 AS Distributor_ID,
          CAST(((c_nationkey + c_custkey % 3) % 25) * 2 AS BIGINT) AS Sales_Territory_ID,
          4 AS Territory_Type_ID, 'Y' AS Active_Record_Ind FROM customer
        UNION ALL SELECT c_custkey * 2 + 1, CAST(0 AS BIGINT), 2, 'Y' FROM customer
        UNION ALL SELECT c_custkey * 2 + 1, CAST(((c_nationkey + 5) % 25) * 2 AS BIGINT), 4, 'Y'
          FROM customer WHERE c_custkey % 50 = 0"""),
    ("SALES_TERRITORY_DIM", """SELECT CAST(n_nationkey * 2 AS BIGINT) AS Sales_Territory_ID,
          CAST(n_nationkey AS BIGINT) AS src_ID, n_name AS Territory_External_ID,
          CASE WHEN n_nationkey = 24 THEN 'TERM' ELSE n_name END AS Territory_Name, 'N' AS Active_Record_Ind
          FROM nation
        UNION ALL SELECT CAST(n_nationkey * 2 + 1 AS BIGINT), CAST(n_nationkey AS BIGINT), n_name,
          CASE WHEN n_nationkey = 24 THEN 'TERM' ELSE n_name END, 'Y' FROM nation"""),
    ("ASSOCIATED_CODES_DIM", """SELECT o_orderkey AS Associated_Codes_ID, o_orderkey AS Selling_Code_ID,
        CAST(c_nationkey + 9000 AS STRING) AS Dealer_Code, lpad(CAST(o_custkey % 100 AS STRING), 3, '0') AS Rep_Code
        FROM orders JOIN customer ON o_custkey = c_custkey"""),
    ("DISTRIBUTOR_ADDRESS_DIM", f"""SELECT c_custkey AS src_Party_ID, {_master_postal('c_custkey % 7')} AS Postal_Code,
        'Y' AS Active_Record_Ind FROM customer"""),
    ("CUSTOMER_ADDRESS_DIM", f"""SELECT c_custkey AS Customer_ID, {_master_postal('c_custkey % 7')} AS Postal_Code
        FROM customer"""),
    ("POLICY_CUSTOMER_FACT", """SELECT c_custkey AS Policy_ID, c_custkey AS Customer_ID,
        CASE WHEN c_custkey % 11 = 0 THEN 'insured' ELSE 'owner' END AS Customer_Role FROM customer"""),
    ("POLICY_DIM", """SELECT c_custkey AS Policy_ID, CASE WHEN c_custkey % 5 = 0 THEN 'Other' ELSE 'Core Funds' END
        AS Product_Name, CAST(c_nationkey + 9000 AS STRING) || 'XX' AS Host_Distributor_Num FROM customer"""),
    ("SELLING_CODE_POLICY_FACT", """SELECT o_custkey AS Policy_ID, o_orderkey AS Selling_Code_ID,
        CASE WHEN o_orderkey % 10 = 0 THEN 'N' ELSE 'Y' END AS Active_Record_Ind FROM orders"""),
    ("ASSET_DAILY_FACT", f"""SELECT l_orderkey AS Original_Associated_Codes_ID, l_orderkey AS Reporting_Selling_Code_ID,
        l_orderkey AS Original_Selling_Code_ID, o_custkey AS Policy_ID, l_partkey AS inv_Product_ID,
        {_date_id('l_shipdate')} AS Reporting_Date_ID, CAST(l_extendedprice AS DECIMAL(18,2)) AS Asset_Value_Amt,
        CAST(l_quantity AS DECIMAL(18,6)) AS Number_Of_Units
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""),
    ("ASSET_MONTHEND_FACT", f"""SELECT {_date_id('l_shipdate')} AS Reporting_Date_ID, l_partkey AS inv_Product_ID,
        l_orderkey AS Original_Selling_Code_ID, CAST(l_extendedprice AS DECIMAL(18,2)) AS Asset_Value_Amt,
        CAST(l_quantity AS DECIMAL(18,6)) AS Number_Of_Units FROM lineitem WHERE l_linestatus = 'O'"""),
    ("NBV_MONTHEND_FACT", f"""SELECT {_date_id('l_shipdate')} AS Reporting_Date_ID,
        CASE l_returnflag WHEN 'A' THEN 'G' WHEN 'R' THEN 'R' ELSE 'X' END AS Gross_Redemption_Type,
        l_partkey AS Product_ID, l_orderkey AS Original_Selling_Code_ID,
        CASE WHEN l_returnflag = 'R' THEN -CAST(l_quantity AS DECIMAL(18,2)) ELSE CAST(l_quantity AS DECIMAL(18,2)) END
          AS Txn_Amt FROM lineitem"""),
    ("DATE_DIM", f"""SELECT {_date_id('l_shipdate')} AS Date_ID, l_shipdate AS Calendar_Date
        FROM (SELECT DISTINCT l_shipdate FROM lineitem)"""),
    ("PRODUCT_DIM", """SELECT p_partkey AS Product_ID, 'CU' || CAST(p_partkey AS STRING) AS Product_Name,
        CASE WHEN p_partkey % 17 = 0 THEN 'N' ELSE 'Y' END AS Active_Record_Ind FROM part"""),
    ("PEER_LIST", """SELECT 'CU' || CAST(p_partkey AS STRING) AS CUSIP, p_type AS PEER_GROUP FROM part
          WHERE p_partkey % 20 = 0
        UNION ALL SELECT 'CU' || CAST(p_partkey AS STRING), p_type FROM part WHERE p_partkey % 200 = 0"""),
]


def _ctes(views: dict[str, str]) -> str:
    return ",\n".join(f"{name} AS ({sql})" for name, sql in views.items())


class Views:
    """SQL of the shared views for one configuration."""

    def __init__(self, cfg: AttributionConfig):
        self.cfg = cfg
        self.on = f"= {_lit(cfg.active_flag)}"

    # -- who owns what now ------------------------------------------------------

    def territories(self) -> dict[str, str]:
        """Distributor, party and selling code (any version) with their territories of today."""
        return {
            "now_territory": f"""SELECT old.Sales_Territory_ID, cur.Territory_External_ID AS terr, cur.Territory_Name AS terr_name
                FROM SALES_TERRITORY_DIM cur JOIN SALES_TERRITORY_DIM old USING (src_ID) WHERE cur.Active_Record_Ind {self.on}""",
            "dist_territory": f"""SELECT Distributor_ID, terr, terr_name FROM DISTRIBUTOR_SALES_TERRITORY_FACT
                JOIN now_territory USING (Sales_Territory_ID)
                WHERE Active_Record_Ind {self.on} AND Territory_Type_ID = {self.cfg.territory_type_id}""",
            "party_territory": f"""SELECT src_Party_ID AS party, terr, terr_name FROM DISTRIBUTOR_DIM
                JOIN dist_territory USING (Distributor_ID) WHERE Active_Record_Ind {self.on}""",
            "code_territory": f"""SELECT any_version.Selling_Code_ID, d.src_Party_ID AS party, p.terr, p.terr_name
                FROM party_territory p JOIN DISTRIBUTOR_DIM d ON d.src_Party_ID = p.party
                JOIN SELLING_CODE_DIM today ON today.Distributor_ID = d.Distributor_ID AND today.Active_Record_Ind {self.on}
                JOIN SELLING_CODE_DIM any_version ON any_version.Selling_Code = today.Selling_Code""",
        }

    @staticmethod
    def _dashed(column: str, dashed: bool) -> str:
        return f"replace({column}, ' ', '-')" if dashed else column

    def advisors(self, dashed: bool, listed_only: bool) -> str:
        """Assets and parties of each branch key and territory, by the advisor's own address."""
        keep = f"WHERE terr_name NOT IN {_list(self.cfg.territory_blacklist)}" if listed_only else ""
        return f"""SELECT rtrim(codes.Dealer_Code || '-' || {self._dashed('a.Postal_Code', dashed)}) AS branch, t.terr,
              sum(amount) AS assets, count(DISTINCT t.party) AS parties
            FROM code_territory t JOIN ASSOCIATED_CODES_DIM codes USING (Selling_Code_ID)
            JOIN DISTRIBUTOR_ADDRESS_DIM a ON a.src_Party_ID = t.party AND a.Active_Record_Ind {self.on}
            LEFT JOIN (SELECT Original_Associated_Codes_ID AS id, sum(Asset_Value_Amt) AS amount FROM ASSET_DAILY_FACT
                       GROUP BY Original_Associated_Codes_ID) f ON f.id = codes.Associated_Codes_ID
            {keep} GROUP BY ALL"""

    def clients(self, dashed: bool, by_policy: bool) -> str:
        """Assets of each branch key and territory, by the policy owner's address."""
        column, join, on = (("Policy_ID", "LEFT JOIN", "pol.Policy_ID") if by_policy else
                            ("Reporting_Selling_Code_ID", "JOIN", "link.Selling_Code_ID"))
        return f"""SELECT rtrim(left(pol.Host_Distributor_Num, 4) || '-' || {self._dashed('home.Postal_Code', dashed)}) AS branch,
              t.terr, sum(amount) AS assets
            FROM POLICY_DIM pol JOIN POLICY_CUSTOMER_FACT who ON who.Policy_ID = pol.Policy_ID
            JOIN CUSTOMER_ADDRESS_DIM home ON home.Customer_ID = who.Customer_ID
            JOIN SELLING_CODE_POLICY_FACT link ON link.Policy_ID = pol.Policy_ID AND link.Active_Record_Ind {self.on}
            JOIN code_territory t ON t.Selling_Code_ID = link.Selling_Code_ID
            {join} (SELECT {column} AS id, sum(Asset_Value_Amt) AS amount FROM ASSET_DAILY_FACT GROUP BY {column}) f ON f.id = {on}
            WHERE pol.Product_Name = {_lit(self.cfg.product_line)} AND who.Customer_Role = {_lit(self.cfg.owner_role)}
            GROUP BY ALL"""

    @staticmethod
    def ranked(candidates: str, parties: bool) -> str:
        order = "assets DESC NULLS LAST, " + ("parties DESC, " if parties else "") + "terr NULLS FIRST"
        return f"SELECT *, row_number() OVER (PARTITION BY branch ORDER BY {order}) AS place FROM ({candidates}) c"

    def owners(self, dashed: bool, listed_only: bool, by_policy: bool) -> dict[str, str]:
        """The winner of each branch key."""
        return {
            "advisor_owner": f"SELECT branch, terr FROM ({self.ranked(self.advisors(dashed, listed_only), True)}) r WHERE place = 1",
            "client_owner": f"SELECT branch, terr FROM ({self.ranked(self.clients(dashed, by_policy), False)}) r WHERE place = 1",
        }

    # -- vendor side ----------------------------------------------------------------

    def offices(self) -> dict[str, str]:
        """Every office with its firm, dealer code, keys and the classes that filters ask for."""
        c = self.cfg
        default = f"right(cd, {len(c.default_branch_suffix)}) = {_lit(c.default_branch_suffix)}"
        rep_or_partial = _list((*c.rep_level_dealers, c.partial_dealer))
        excluded = " AND ".join(f"Firm_Name <> {_lit(f)}" for f in c.excluded_firms)
        return {
            "office_of": """SELECT b.Dealer_Branch_ID, b.Dealer_Branch_CD AS cd, b.Office_Type, b.Office_Postal_CD, f.Firm_ID, f.Firm_Name,
                d.MLI_Dealer_Code AS code, d.ETF_Dealer_Code IS NOT NULL AS listed,
                coalesce(left(d.MLI_Dealer_Code, 30), CAST(f.Firm_ID AS STRING)) AS maker,
                CASE WHEN d.MLI_Dealer_Code IS NULL THEN 'INSTITUTIONAL' ELSE 'RETAIL' END AS kind
                FROM ETF_DEALER_BRANCH_FACT b JOIN ETF_FIRM_FACT f ON f.Firm_ID = b.Office_ID
                LEFT JOIN ETF_ref_DEALER_FACT d ON d.ETF_Dealer_Code = b.Office_ID""",
            "office_class": f"""SELECT *, rtrim(maker || '-' || Office_Postal_CD) AS office_key,
                left(code, 30) || CASE WHEN length(rtrim(cd)) > 4 THEN right(cd, length(rtrim(cd)) - 4) ELSE '' END AS rep_key,
                (Office_Type = {_lit(c.correlated_office_type)} OR cd IN {_list(c.sales_exception_branches)} OR {default}) AS correlated,
                {excluded} AND NOT (Firm_Name = {_lit(c.partial_firm)} AND cd NOT IN {_list(c.market_share_exception_branches)}) AS firm_kept,
                code IN {_list(c.rep_level_dealers)} OR (code = {_lit(c.partial_dealer)}
                  AND cd NOT IN {_list(c.market_share_exception_branches)}) AS rep_daily,
                code IN {rep_or_partial} AND cd NOT IN {_list(c.sales_exception_branches)} AND NOT ({default}) AS rep_monthly,
                code NOT IN {rep_or_partial} AS not_rep,
                code NOT IN {_list((*c.source_dealers, *c.rep_level_dealers))} AND NOT (code = {_lit(c.partial_dealer)}
                  AND cd NOT IN {_list(c.sales_exception_branches)}) AS not_source
                FROM office_of""",
            "office": "SELECT *, NOT correlated AND not_rep AS is_actual, correlated AND not_source AS is_correlated FROM office_class",
        }

    def daily(self, as_of: str | dt.date | None) -> dict[str, str]:
        """Vendor lines with their office, and the two daily rollups over them."""
        when = ""
        if as_of == "latest":
            when = "WHERE CAST(Reporting_Date AS DATE) = (SELECT CAST(max(Reporting_Date) AS DATE) FROM ETF_MARKET_SHARE_FACT)"
        elif as_of is not None:
            when = f"WHERE CAST(Reporting_Date AS DATE) = DATE '{as_of}'"
        sums = "sum(Industry_Shares_Amount) AS shares, sum(Industry_Asset_Amount) AS balance"
        return {
            "daily_line": f"SELECT * FROM ETF_MARKET_SHARE_FACT JOIN office USING (Dealer_Branch_ID) {when}",
            "office_day": f"""SELECT Reporting_Date, Firm_Name, office_key, kind, code, Rank_Group, Office_Type, cd,
                MLI_Territory_Name AS override, {sums}
                FROM daily_line LEFT JOIN ETF_ref_TERRITORY_FACT ON ETF_Branch_Name = cd AND Reporting_Date BETWEEN Effective_Date AND End_Date
                WHERE listed AND firm_kept GROUP BY ALL""",
            "rep_time": f"""SELECT Reporting_Date AS moment, Firm_Name, rep_key, kind, Rank_Group, Office_Type, cd, {sums}
                FROM daily_line WHERE rep_daily GROUP BY ALL""",
            "rep_day": "SELECT *, CAST(moment AS DATE) AS day FROM rep_time",
        }

    def monthly(self) -> dict[str, str]:
        """Vendor positions with their holding, and the month-end rollups over them."""
        sums = """sum(Asset_Position_Shares) AS shares, sum(Asset_Position_Net_New_Assets) AS net_new, sum(Asset_Position_Balance) AS balance"""
        return {
            "position_line": """SELECT office.*, rtrim(maker || '-' || Account_Postal_CD) AS account_key, Account_Type_TA_CD AS account_type,
                Product_CUSIP AS cusip, Asset_Position_Reporting_Date AS moment, last_day(Asset_Position_Reporting_Date) AS month,
                Asset_Position_Shares, Asset_Position_Net_New_Assets, Asset_Position_Balance
                FROM ETF_ASSET_POSITION_FACT JOIN ETF_HOLDINGS_DIM h ON h.Holdings_ID = Asset_Position_Holding_ID
                JOIN office ON office.Dealer_Branch_ID = h.Dealer_Branch_ID JOIN ETF_ACCOUNT_FACT acct ON acct.Account_ID = h.Account_ID
                JOIN ETF_PRODUCT_FACT prod ON prod.Product_ID = h.Product_ID""",
            "office_month": f"""SELECT is_actual, month, Firm_Name, office_key, account_key, kind, cusip, Office_Type, cd, account_type,
                MLI_Territory_Name AS override, {sums}
                FROM position_line LEFT JOIN ETF_ref_TERRITORY_FACT ON ETF_Branch_Name = cd AND moment BETWEEN Effective_Date AND End_Date
                WHERE is_actual OR is_correlated GROUP BY ALL""",
            "rep_month": f"""SELECT month, Firm_Name, rep_key, account_key, kind, cusip, Office_Type, account_type, {sums}
                FROM position_line WHERE rep_monthly GROUP BY ALL""",
        }

    # -- dealer reps and in-house books --------------------------------------------------

    def bridge(self) -> dict[str, str]:
        """Which selling code and territory a dealer-rep key had, and when."""
        hull = "CAST(min(Rec_Created_Date) AS DATE) AS since, CAST(max(Rec_Term_Date) AS DATE) AS until"
        return {
            "rep_code": f"""SELECT left(Dealer_Code, 30) || left(Rep_Code, 30) AS rep, Selling_Code, {hull}
                FROM SELLING_CODE_DIM JOIN ASSOCIATED_CODES_DIM USING (Selling_Code_ID) WHERE Dealer_Code IS NOT NULL GROUP BY ALL""",
            "party_code": f"""SELECT Selling_Code, party, terr, {hull} FROM (
                SELECT s.Selling_Code, s.Rec_Created_Date, s.Rec_Term_Date, p.party, p.terr FROM SELLING_CODE_DIM s
                JOIN DISTRIBUTOR_DIM d ON d.Distributor_ID = s.Distributor_ID JOIN party_territory p ON p.party = d.src_Party_ID) v GROUP BY ALL""",
            "rep_bridge": """SELECT r.rep, r.Selling_Code, p.party, p.terr, greatest(r.since, p.since) AS since, least(r.until, p.until) AS until
                FROM rep_code r JOIN party_code p ON p.Selling_Code = r.Selling_Code
                WHERE greatest(r.since, p.since) <= least(r.until, p.until)""",
        }

    def house(self, lines: str) -> str:
        """Rows (id, day, ...) of ``lines`` with the selling code in force that
        day and the territories of its party, where a main distributor was in force."""
        on_day = "BETWEEN CAST({0}.Rec_Created_Date AS DATE) AND CAST({0}.Rec_Term_Date AS DATE)"
        return f"""SELECT l.*, v.Selling_Code AS code_then, p.terr FROM ({lines}) l
            JOIN SELLING_CODE_DIM named ON named.Selling_Code_ID = l.id
            JOIN SELLING_CODE_DIM v ON v.Selling_Code = named.Selling_Code AND l.day {on_day.format('v')}
            JOIN DISTRIBUTOR_DIM seller ON seller.Distributor_ID = v.Distributor_ID
            JOIN DISTRIBUTOR_DIM main ON main.src_Party_ID = seller.src_Party_ID AND l.day {on_day.format('main')}
              AND coalesce(main.Branch_Code, 1) = 1
            JOIN party_territory p ON p.party = main.src_Party_ID"""

    def etf_books(self) -> str:
        """Flows and holdings of ETF products; equal rows count once."""
        etf = f"Product_Name IN (SELECT Product_CUSIP FROM ETF_PRODUCT_FACT WHERE Product_Type = {_lit(self.cfg.etf_product_type)})"
        rest = "JOIN PRODUCT_DIM prod ON prod.Product_ID = x.inv_Product_ID JOIN DATE_DIM cal ON cal.Date_ID = x.Reporting_Date_ID WHERE " + etf
        return f"""SELECT x.* FROM (SELECT Reporting_Date_ID, 'H' AS Gross_Redemption_Type, inv_Product_ID, Original_Selling_Code_ID,
                Asset_Value_Amt AS Txn_Amt, Number_Of_Units AS Units FROM ASSET_MONTHEND_FACT) x {rest}
            UNION SELECT x.* FROM (SELECT Reporting_Date_ID, Gross_Redemption_Type, Product_ID AS inv_Product_ID, Original_Selling_Code_ID,
                Txn_Amt, CAST(NULL AS DECIMAL(18,6)) AS Units FROM NBV_MONTHEND_FACT WHERE Gross_Redemption_Type IN ('R', 'G')) x {rest}"""

    # -- results --------------------------------------------------------------------------

    def share_rows(self, firm, terr, kind, branch, office, date, group, shares, balance, source) -> str:
        return f"""SELECT {firm} AS FirmName, CAST({terr} AS STRING) AS Comp_Territory, {kind} AS Dealer_Type, CAST({branch} AS STRING) AS Branch,
            CAST({office} AS STRING) AS Office_Type, CAST({date} AS TIMESTAMP) AS Reporting_Date, CAST({group} AS STRING) AS PEER_GROUP,
            CAST({shares} AS DECIMAL(15,2)) AS Asset_Position_Shares, CAST({balance} AS DECIMAL(15,2)) AS Asset_Balance FROM {source}"""

    def sales_rows(self, firm, terr, kind, branch, office, account, client, date, cusip, shares, balance, net_new, source) -> str:
        return f"""SELECT {firm} AS FirmName, CAST({terr} AS STRING) AS Comp_Territory, {kind} AS Dealer_Type, CAST({branch} AS STRING) AS Branch,
            CAST({office} AS STRING) AS Office_Type, CAST({account} AS STRING) AS Account_Type, CAST({client} AS STRING) AS C_BR,
            CAST({date} AS TIMESTAMP) AS Reporting_Date, CAST({cusip} AS STRING) AS CUSIP,
            CAST({shares} AS DECIMAL(15,6)) AS Asset_Position_Shares, CAST({balance} AS DECIMAL(15,2)) AS Asset_Balance,
            CAST({net_new} AS DECIMAL(15,2)) AS Net_New_Assets FROM {source}"""

    def decided(self, owner: str) -> str:
        house = f"CASE WHEN cd IN {_list(self.cfg.house_accounts)} THEN {_lit(self.cfg.institutional_territory)} ELSE {owner}.terr END"
        return f"coalesce(override, {house})"

    def share_office(self, owner: str) -> str:
        return self.share_rows("Firm_Name", self.decided(owner), "kind", "office_key", "Office_Type", "Reporting_Date", "Rank_Group",
                               "shares", "balance", f"office_day LEFT JOIN {owner} ON {owner}.branch = office_key")

    def share_reps(self) -> str:
        return self.share_rows("Firm_Name", "b.terr", "kind", "coalesce(b.Selling_Code, rep_key)", "Office_Type", "day", "Rank_Group",
                               "shares", "balance", "rep_day LEFT JOIN rep_bridge b ON b.rep = rep_key AND day BETWEEN b.since AND b.until")

    def share_house(self, names: str = "PRODUCT_DIM", same: str = "prod.Product_Name = peer.CUSIP") -> str:
        lines = f"""SELECT cal.Calendar_Date AS moment, CAST(cal.Calendar_Date AS DATE) AS day, Original_Selling_Code_ID AS id, peer.PEER_GROUP,
              Asset_Value_Amt, Number_Of_Units
            FROM ASSET_DAILY_FACT JOIN DATE_DIM cal ON cal.Date_ID = Reporting_Date_ID JOIN {names} prod ON prod.Product_ID = inv_Product_ID
            JOIN PEER_LIST peer ON {same}"""
        total = f"""(SELECT terr, moment, code_then, PEER_GROUP AS grp, sum(Number_Of_Units) AS units, sum(Asset_Value_Amt) AS assets
            FROM ({self.house(lines)}) h GROUP BY ALL) t"""
        return self.share_rows(_lit(self.cfg.in_house_firm), "terr", "'RETAIL'", "code_then", "'SOURCE'", "moment", "grp", "units", "assets", total)

    def sales_office(self, actual: bool) -> str:
        owner, key, office = ("advisor_owner", "office_key", "'ACTUAL'") if actual else ("client_owner", "account_key", "'CORRELATED'")
        return self.sales_rows("Firm_Name", f"coalesce(override, {owner}.terr)", "kind", "office_key", office, "account_type", "account_key",
                               "month", "cusip", "shares", "balance", "net_new",
                               f"(SELECT * FROM office_month WHERE is_actual = {str(actual).lower()}) o LEFT JOIN {owner} ON {owner}.branch = {key}")

    def sales_reps(self) -> str:
        return self.sales_rows("Firm_Name", "b.terr", "kind", "coalesce(b.Selling_Code, rep_key)", "Office_Type", "account_type", "account_key",
                               "month", "cusip", "shares", "balance", "net_new",
                               "rep_month LEFT JOIN rep_bridge b ON b.rep = rep_key AND month BETWEEN b.since AND b.until")

    def sales_house(self) -> str:
        lines = f"""SELECT cal.Calendar_Date AS moment, CAST(cal.Calendar_Date AS DATE) AS day, book.Original_Selling_Code_ID AS id, prod.Product_Name, book.*
            FROM ({self.etf_books()}) book JOIN DATE_DIM cal ON cal.Date_ID = book.Reporting_Date_ID
            JOIN PRODUCT_DIM prod ON prod.Product_ID = book.inv_Product_ID AND prod.Active_Record_Ind {self.on}"""
        amount = lambda types: f"sum(CASE WHEN Gross_Redemption_Type IN ({types}) THEN Txn_Amt ELSE 0 END)"
        total = f"""(SELECT terr, last_day(moment) AS month, code_then, Product_Name AS name, sum(Units) AS units, {amount("'H'")} AS held,
            {amount("'G', 'R'")} AS moved FROM ({self.house(lines)}) h GROUP BY ALL) t"""
        return self.sales_rows(_lit(self.cfg.in_house_firm), "terr", "'RETAIL'", "code_then", "'SOURCE'", "'1'", "NULL", "month", "name",
                               "units", "held", "moved", total)

    def file_territory(self) -> dict[str, str]:
        """Selling code to territory for dealer files, with how often each of
        its rows repeats: once per typed link of the distributor (Q-07)."""
        return {"file_territory": f"""SELECT today.Selling_Code AS sold_by, t.terr,
            (SELECT count(*) FROM dist_territory again WHERE again.Distributor_ID = main.Distributor_ID) AS times
            FROM SELLING_CODE_DIM today JOIN DISTRIBUTOR_DIM seller ON seller.Distributor_ID = today.Distributor_ID
            JOIN DISTRIBUTOR_DIM main ON main.src_Party_ID = seller.src_Party_ID AND main.Active_Record_Ind {self.on}
              AND coalesce(main.Branch_Code, 1) = 1
            JOIN dist_territory t ON t.Distributor_ID = main.Distributor_ID WHERE today.Active_Record_Ind {self.on}"""}

    def sales_files(self) -> str:
        total = """(SELECT terr, sold_by, last_day(Reporting_Date) AS month, CUSIP AS name, sum(Units * times) AS units,
            sum(Assets * times) AS held, sum(Net_Sales * times) AS moved
            FROM ETF_DIRECT_SOURCE JOIN file_territory ON sold_by = Selling_Code GROUP BY ALL) t"""
        return self.sales_rows(_lit(self.cfg.direct_source_firm), "terr", "'RETAIL'", "sold_by", "'SOURCE'", "'1'", "NULL", "month", "name",
                               "units", "held", "moved", total)

    def market_share(self, as_of) -> tuple[dict[str, str], str]:
        views = self.territories() | self.owners(False, False, False) | self.offices() | self.daily(as_of) | self.bridge()
        parts = [self.share_office("advisor_owner"), self.share_office("client_owner"), self.share_reps(), self.share_house()]
        return views, " UNION ".join(parts)

    def sales_assets(self) -> tuple[dict[str, str], str]:
        views = self.territories() | self.owners(True, True, True) | self.offices() | self.monthly() | self.bridge() | self.file_territory()
        parts = [self.sales_office(True), self.sales_office(False), self.sales_reps(), self.sales_house(), self.sales_files()]
        return views, " UNION ".join(parts)


def _money(column: str, name: str, scale: int = 2) -> str:
    return f"CAST({column} AS DECIMAL(38,{scale})) AS {name}"


def build(cfg: AttributionConfig | None = None) -> dict[str, str]:
    cfg = cfg or testdata_config()
    v = Views(cfg)
    q: dict[str, str] = {}

    def add(name: str, body: str, *views: dict[str, str]) -> None:
        found: dict[str, str] = dict(ADAPTER)
        for x in views:
            found |= x
        q[name] = f"WITH {_ctes(found)}\n{body}"

    office, terr = v.offices(), v.territories()
    owners, bridge, every_day = v.owners(False, False, False), v.bridge(), v.daily(None)
    sums = f"{_money('shares', 'Asset_Position_Shares')}, {_money('balance', 'Asset_Position_Balance')}"
    units = f"{_money('shares', 'Asset_Position_Shares', 6)}, {_money('net_new', 'Asset_Position_Net_New_Assets')}, {_money('balance', 'Asset_Position_Balance')}"

    # keys
    add("branch_key_concat", """SELECT Dealer_Branch_ID, office_key AS "aBR", rtrim(code || '-' || Office_Postal_CD) AS dealer_postal_key FROM office""", office)
    add("postal_key_replace", """SELECT p_partkey, rtrim(p_brand || '-' || p_name) AS key_raw, rtrim(p_brand || '-' || replace(p_name, ' ', '-')) AS key_dash FROM part""")
    add("client_key_left4", """SELECT Customer_ID, left(Host_Distributor_Num, 4) || '-' || Postal_Code AS "cBranch_raw",
        left(Host_Distributor_Num, 4) || '-' || replace(Postal_Code, ' ', '-') AS "cBranch_dash"
        FROM CUSTOMER_ADDRESS_DIM JOIN POLICY_CUSTOMER_FACT USING (Customer_ID) JOIN POLICY_DIM USING (Policy_ID)""")
    add("dealer_rep_key_drop4", 'SELECT Dealer_Branch_ID, rep_key AS "DlrRep" FROM office', office)
    add("dealer_type_case", """SELECT Firm_ID, MLI_Dealer_Code, CASE WHEN MLI_Dealer_Code IS NULL THEN 'INSTITUTIONAL' ELSE 'RETAIL' END AS Dealer_Type
        FROM ETF_FIRM_FACT LEFT JOIN ETF_ref_DEALER_FACT ON ETF_Dealer_Code = Firm_ID""")
    add("key_varchar30", """SELECT s_suppkey, left(code, 30) || '-P' AS vendor, rtrim(left(code, 30) || right(s_name || '   ', length(s_name) - 4)) AS rep,
        left(code, 30) || left(code, 30) AS master, code || '-P' AS advisor, s_name AS branch
        FROM (SELECT *, repeat('D', 24) || s_suppkey || '-0123456789' AS code FROM supplier) x""")
    add("month_end_bucket", f"""SELECT last_day(Asset_Position_Reporting_Date) AS Month_End, count(*) AS n, {_money('sum(Asset_Position_Shares)', 'shares', 6)},
        {_money('sum(Asset_Position_Net_New_Assets)', 'net_new')}, {_money('sum(Asset_Position_Balance)', 'balance')} FROM ETF_ASSET_POSITION_FACT GROUP BY 1""")
    add("latest_snapshot", f"""SELECT Dealer_Branch_ID, Rank_Group, count(*) AS n, {_money('sum(Industry_Shares_Amount)', 'shares')},
        {_money('sum(Industry_Asset_Amount)', 'assets')} FROM daily_line GROUP BY 1, 2""", office, v.daily("latest"))

    # filters
    add("firm_exclusion_3vl", "SELECT Dealer_Branch_ID, Firm_Name, cd AS Dealer_Branch_CD FROM office WHERE firm_kept", office)
    add("branch_class_filter", """SELECT Dealer_Branch_ID, unnest(CASE WHEN len(routes) = 0 THEN ['dropped'] ELSE routes END) AS route FROM (
        SELECT Dealer_Branch_ID, [x FOR x IN [CASE WHEN is_actual THEN 'actual' END, CASE WHEN is_correlated THEN 'correlated' END,
          CASE WHEN rep_monthly THEN 'rep' END] IF x IS NOT NULL] AS routes FROM office) o""", office)
    add("default_branch_or_null", "SELECT Distributor_ID, src_Party_ID, Branch_Code FROM DISTRIBUTOR_DIM WHERE Branch_Code IS NULL OR Branch_Code = 1")

    # versions
    add("hop_current", f"""SELECT today.Selling_Code_ID AS Current_Selling_Code_ID, today.Distributor_ID AS Current_Distributor_ID, count(*) AS n,
        {_money('sum(Asset_Value_Amt)', 'assets')} FROM SELLING_CODE_DIM today JOIN SELLING_CODE_DIM other USING (Selling_Code)
        JOIN ASSET_DAILY_FACT ON Original_Selling_Code_ID = other.Selling_Code_ID WHERE today.Active_Record_Ind {v.on} GROUP BY ALL""")
    add("hop_as_of", f"""SELECT dated.Selling_Code_ID AS Version_ID, count(*) AS n, {_money('sum(Asset_Value_Amt)', 'assets')}
        FROM SELLING_CODE_DIM dated JOIN SELLING_CODE_DIM other USING (Selling_Code) JOIN ASSET_DAILY_FACT ON Original_Selling_Code_ID = other.Selling_Code_ID
        JOIN DATE_DIM ON Date_ID = Reporting_Date_ID
        WHERE CAST(Calendar_Date AS DATE) BETWEEN CAST(dated.Rec_Created_Date AS DATE) AND CAST(dated.Rec_Term_Date AS DATE) GROUP BY ALL""")
    add("typed_territory_link", "SELECT Distributor_ID, terr AS Territory_External_ID, terr_name AS Territory_Name FROM dist_territory", terr)
    add("effective_dated_override", f"""SELECT Dealer_Branch_CD, MLI_Territory_Name, count(*) AS n, {_money('sum(Industry_Asset_Amount)', 'assets')}
        FROM ETF_MARKET_SHARE_FACT JOIN ETF_DEALER_BRANCH_FACT USING (Dealer_Branch_ID)
        LEFT JOIN ETF_ref_TERRITORY_FACT ON ETF_Branch_Name = Dealer_Branch_CD AND Reporting_Date BETWEEN Effective_Date AND End_Date GROUP BY 1, 2""")

    # owners
    for name, dashed in (("rank_owner_advisor", False), ("rank_owner_advisor_monthly", True)):
        add(name, f"""SELECT branch AS "BR", terr AS "Territory", {_money('assets', '"Assets"')}, parties AS "Parties", place AS rn
            FROM ({v.ranked(v.advisors(dashed, dashed), True)}) r""", terr)
    for name, dashed in (("rank_owner_client", False), ("rank_owner_client_policy", True)):
        add(name, f"""SELECT branch AS "BR", terr AS "Territory", {_money('assets', '"Assets"')}, place AS rn
            FROM ({v.ranked(v.clients(dashed, dashed), False)}) r""", terr)
    add("distinct_parties_merged", f"""SELECT branch AS "BR", terr AS "Territory", parties AS "Parties" FROM ({v.ranked(v.advisors(False, False), True)}) r""", terr)
    day = f"""Reporting_Date, Firm_Name, office_key AS "aBR", kind AS Dealer_Type, code AS MLI_Dealer_Code, Rank_Group AS "PeerGroup",
        Office_Type, cd AS Dealer_Branch_CD, override AS MLI_Territory_Name, {sums}"""
    owned = "office_day LEFT JOIN advisor_owner ON branch = office_key"
    add("vendor_position_rollup", f"SELECT {day} FROM office_day", office, every_day)
    add("preserve_left_attach", f"""SELECT {day}, terr AS "Territory" FROM {owned}""", terr, owners, office, every_day)
    add("territory_waterfall", f"""SELECT outcome, count(*) AS n, {_money('sum(balance)', 'balance')} FROM (
        SELECT CASE WHEN override IS NOT NULL THEN 'override' WHEN cd IN {_list(cfg.house_accounts)} THEN 'house'
               WHEN terr IS NOT NULL THEN 'ranked' ELSE 'none' END AS outcome, balance FROM {owned}) o GROUP BY outcome""", terr, owners, office, every_day)

    # rollups
    month = f"""month AS Asset_Position_Reporting_Date, Firm_Name, office_key AS "aBR", account_key AS "cBR", kind AS Dealer_Type, cusip AS "CUSIP",
        Office_Type, cd AS Dealer_Branch_CD, account_type AS Account_Type, override AS MLI_Territory_Name, {units}"""
    add("vendor_position_rollup_monthly", f"SELECT {month} FROM office_month WHERE is_actual", office, v.monthly())
    add("vendor_position_rollup_correlated", f"SELECT {month} FROM office_month WHERE NOT is_actual", office, v.monthly())
    rep = f"""Firm_Name, kind AS Dealer_Type, rep_key AS "aBR", Office_Type, day AS Reporting_Date, Rank_Group AS "PEER_GROUP", {sums}"""
    add("dealer_rep_positions", f"SELECT {rep} FROM rep_day", office, every_day)
    add("dealer_rep_positions_monthly", f"""SELECT Firm_Name, kind AS Dealer_Type, rep_key AS "aBR", Office_Type, month AS Reporting_Date,
        account_key AS "cBR", account_type AS Account_Type, cusip AS "CUSIP", {units} FROM rep_month""", office, v.monthly())

    # bridge
    add("collapse_versions", 'SELECT rep AS "DlrRep", Selling_Code, since AS Start_Date, until AS End_Date FROM rep_code', terr, bridge)
    add("interval_overlap_bridge", """SELECT rep AS "DlrRep", Selling_Code, party AS "src_Party_ID", terr AS Territory_External_ID,
        since AS "THE_START", until AS "THE_END" FROM rep_bridge""", terr, bridge)
    add("point_in_interval_attach", f"""SELECT {rep}, Selling_Code, terr AS Territory_External_ID
        FROM rep_day LEFT JOIN rep_bridge b ON b.rep = rep_key AND day BETWEEN b.since AND b.until""", terr, bridge, office, every_day)
    add("fallback_branch_coalesce", v.share_reps(), terr, bridge, office, every_day)

    # in-house books and files
    add("peer_values_join", f"""SELECT PEER_GROUP, count(*) AS n, {_money('sum(Asset_Value_Amt)', 'assets')}, {_money('sum(Number_Of_Units)', 'units', 6)}
        FROM PEER_LIST JOIN PRODUCT_DIM ON Product_Name = CUSIP JOIN ASSET_DAILY_FACT ON inv_Product_ID = Product_ID GROUP BY 1""")
    literal = ", ".join(f"({_lit(c)}, {_lit(g)})" for c, g in PEER_LIST)
    add("peer_list_literal", f"""SELECT peer.CUSIP, peer.PEER_GROUP, count(*) AS n, {_money('sum(Asset_Value_Amt)', 'assets')}
        FROM (VALUES {literal}) peer(CUSIP, PEER_GROUP)
        JOIN (SELECT cusip, row_number() OVER (ORDER BY cusip) - 1 AS place FROM (SELECT DISTINCT col0 AS cusip FROM (VALUES {literal}) l) d) named
          ON named.cusip = peer.CUSIP
        JOIN PRODUCT_DIM ON Product_ID % 130 = named.place JOIN ASSET_DAILY_FACT ON inv_Product_ID = Product_ID GROUP BY 1, 2""")
    varied = """(SELECT Product_ID, CASE Product_ID % 5 WHEN 0 THEN lower(Product_Name) WHEN 1 THEN Product_Name || '  '
        WHEN 2 THEN replace(Product_Name, 'U', chr(220)) ELSE Product_Name END AS Product_Name FROM PRODUCT_DIM)"""
    add("peer_join_collation", v.share_house(varied, "lower(strip_accents(rtrim(prod.Product_Name))) = lower(strip_accents(rtrim(peer.CUSIP)))"), terr)
    add("semi_product_filter", f"""SELECT Product_Name, count(*) AS n, {_money('sum(Txn_Amt)', 'amount')}
        FROM NBV_MONTHEND_FACT JOIN PRODUCT_DIM USING (Product_ID)
        WHERE EXISTS (SELECT 1 FROM ETF_PRODUCT_FACT e WHERE e.Product_CUSIP = Product_Name AND e.Product_Type = {_lit(cfg.etf_product_type)}) GROUP BY 1""")
    add("union_distinct_txn_hold", v.etf_books())
    add("conditional_net_new", v.sales_house(), terr)
    add("in_house_holdings", v.share_house(), terr)
    add("direct_source_rollup", v.sales_files(), terr, v.file_territory())
    add("duplicate_link_fanout", f"""SELECT Selling_Code, terr AS Territory_External_ID, CAST(sum(times) AS BIGINT) AS n, {_money('sum(Assets * times)', 'assets')}
        FROM ETF_DIRECT_SOURCE JOIN file_territory ON sold_by = Selling_Code GROUP BY 1, 2""", terr, v.file_territory())

    # output
    add("conform_numeric", """SELECT Asset_Position_Holding_ID, Asset_Position_Reporting_Date,
        CAST(Asset_Position_Balance * Asset_Position_Net_New_Assets AS DECIMAL(15,2)) AS amount_2,
        CAST(Asset_Position_Shares * Asset_Position_Net_New_Assets AS DECIMAL(15,6)) AS shares_6 FROM ETF_ASSET_POSITION_FACT""")
    add("accumulate_distinct", f"{v.share_office('advisor_owner')} UNION {v.share_office('client_owner')}", terr, owners, office, every_day)
    for name, as_of in (("market_share_attribution", "latest"), ("market_share_attribution_all_days", None), ("market_share_as_of", "1997-06-30")):
        views, body = v.market_share(as_of)
        add(name, body, views)
    views, body = v.sales_assets()
    add("sales_assets_attribution", body, views)

    # other layouts and joins, same results
    for name, same in (("latest_snapshot_by_day", "latest_snapshot"), ("bucketed_position_join", "vendor_position_rollup_monthly"),
                       ("heavy_hitter_attach", "point_in_interval_attach"), ("accumulate_by_day", "accumulate_distinct")):
        q[name] = q[same]
    return q


def plain_sql(name: str, cfg: AttributionConfig | None = None) -> str:
    """One result as a single SQL statement over views named like the logical
    tables (runs on DuckDB and Spark SQL): the bench's comparison."""
    cfg = cfg or testdata_config()
    v = Views(cfg)
    views, body = v.sales_assets() if name == "sales_assets_attribution" else v.market_share(cfg.as_of)
    return f"WITH {_ctes(views)}\n{body}"
