"""Column builders for the matching keys and derived labels.

All keys are NULL-propagating string concatenations (T-SQL ``+`` on
strings): one NULL part makes the whole key NULL, so it never matches.

Strings compare as in T-SQL without trailing blanks (Q-16): ``same_text``
strips them where a column or a finished key is compared, grouped or joined.
Blanks inside a key stay.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import DEALER_TYPE_INSTITUTIONAL, DEALER_TYPE_RETAIL


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_text(c) -> Column:
    """CAST(x AS varchar): the first 30 characters."""
    return F.left(col(c).cast("string"), F.lit(30))


def same_text(c) -> Column:
    """The string as comparisons see it."""
    return F.rtrim(col(c))


def blanks_to_dash(c) -> Column:
    """REPLACE(x, ' ', '-')."""
    return F.replace(col(c), F.lit(" "), F.lit("-"))


def tsql_len(c) -> Column:
    """LEN(x): character count without trailing blanks."""
    return F.length(F.rtrim(col(c)))


def tsql_right(c, n, strict: bool = False) -> Column:
    """RIGHT(x, n).  A negative n raises in T-SQL; Spark returns ''."""
    n = col(n) if not isinstance(n, int) else F.lit(n)
    out = F.right(col(c), n)
    if strict:
        out = F.when(n < 0, F.raise_error(F.lit("RIGHT: negative length"))).otherwise(out)
    return out


def branch_key(dealer_code, postal, replace_blanks: bool = False) -> Column:
    """Advisor branch key ``Dealer_Code + '-' + Postal_Code`` (P-01, P-02)."""
    p = blanks_to_dash(postal) if replace_blanks else col(postal)
    return F.concat(col(dealer_code), F.lit("-"), p)


def client_key(host_distributor_num, postal, replace_blanks: bool = False) -> Column:
    """Client branch key ``LEFT(Host_Distributor_Num, 4) + '-' + Postal_Code`` (P-03, P-04)."""
    p = blanks_to_dash(postal) if replace_blanks else col(postal)
    return F.concat(F.left(col(host_distributor_num), F.lit(4)), F.lit("-"), p)


def vendor_key(dealer_code, firm_id, postal) -> Column:
    """Vendor branch key: dealer code, else firm id, plus a postal code (P-05, P-06)."""
    return F.concat(F.coalesce(as_text(dealer_code), as_text(firm_id)), F.lit("-"), col(postal))


def dealer_rep_key(dealer_code, branch_code, strict: bool = False) -> Column:
    """Dealer code followed by the branch code without its first 4 characters (P-07)."""
    rest = tsql_right(branch_code, tsql_len(branch_code) - 4, strict)
    return F.concat(as_text(dealer_code), rest)


def master_dealer_rep_key(dealer_code, rep_code) -> Column:
    """``Dealer_Code + Rep_Code`` on the advisor master (P-08)."""
    return F.concat(as_text(dealer_code), as_text(rep_code))


def dealer_type(dealer_code) -> Column:
    """INSTITUTIONAL without a dealer code, RETAIL otherwise (P-10)."""
    return F.when(col(dealer_code).isNull(), F.lit(DEALER_TYPE_INSTITUTIONAL)).otherwise(
        F.lit(DEALER_TYPE_RETAIL)
    )


def month_end(ts) -> Column:
    """EOMONTH(ts) as a DATE (P-17)."""
    return F.last_day(col(ts))


def day_of(ts) -> Column:
    """CAST(ts AS date) (P-18)."""
    return col(ts).cast("date")


def date_id(ts) -> Column:
    """yyyymmdd integer of a date or timestamp."""
    return (F.year(col(ts)) * 10000 + F.month(col(ts)) * 100 + F.dayofmonth(col(ts))).cast("int")
