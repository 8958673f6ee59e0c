
from creditmap.functions import keys as K
from helpers import day, frame, rows, ts


def test_branch_keys_propagate_null_and_replace_blanks(spark):
    df = frame(spark, "code string, postal string", [
        ("9001", "P 1"), (None, "P 1"), ("9001", None), ("9001", "P 1 "), ("9001", "P  2"),
    ])
    out = df.select(
        "code", "postal",
        K.branch_key("code", "postal").alias("raw"),
        K.branch_key("code", "postal", replace_blanks=True).alias("dash"),
    )
    got = {(r.code, r.postal): (r.raw, r.dash) for r in out.collect()}
    assert got[("9001", "P 1")] == ("9001-P 1", "9001-P-1")
    assert got[(None, "P 1")] == (None, None)
    assert got[("9001", None)] == (None, None)
    assert got[("9001", "P 1 ")] == ("9001-P 1 ", "9001-P-1-")
    assert got[("9001", "P  2")] == ("9001-P  2", "9001-P--2")


def test_client_key_left4(spark):
    df = frame(spark, "host string, postal string", [("9012XX", "P 3"), ("90", "P1"), (None, "P1")])
    got = rows(df.select(K.client_key("host", "postal", replace_blanks=True).alias("k")))
    assert got == [(None,), ("90-P1",), ("9012-P-3",)]


def test_vendor_key_falls_back_to_firm_id(spark):
    df = frame(spark, "code string, firm long, postal string", [("9001", 1, "P1"), (None, 7, "P1"), (None, 7, None)])
    got = rows(df.select(K.vendor_key("code", "firm", "postal").alias("k")))
    assert got == [(None,), ("7-P1",), ("9001-P1",)]


def test_dealer_rep_key_drops_first_four_chars_tsql_len(spark):
    # LEN ignores trailing blanks, RIGHT counts them (T-SQL semantics).
    df = frame(spark, "code string, branch string", [
        ("9007", "C07:012"), ("9007", "C07:DEFAULT"), ("9007", "C07"), ("9007", "C07:"),
        ("9007", "C07:12  "), (None, "C07:012"), ("9007", None),
    ])
    out = {(r.code, r.branch): r.k for r in
           df.select("code", "branch", K.dealer_rep_key("code", "branch").alias("k")).collect()}
    assert out[("9007", "C07:012")] == "9007012"
    assert out[("9007", "C07:DEFAULT")] == "9007DEFAULT"
    assert out[("9007", "C07")] == "9007"        # negative length -> '' (T-SQL would raise)
    assert out[("9007", "C07:")] == "9007"
    assert out[("9007", "C07:12  ")] == "9007  "  # RIGHT(s, LEN(s)-4): 2 chars, both blanks
    assert out[(None, "C07:012")] is None
    assert out[("9007", None)] is None


def test_dealer_rep_key_strict_raises(spark):
    import pytest
    df = frame(spark, "code string, branch string", [("9007", "C7")])
    with pytest.raises(Exception):
        df.select(K.dealer_rep_key("code", "branch", strict=True)).collect()


def test_dealer_type_month_end_date_id(spark):
    df = frame(spark, "code string, t timestamp_ntz", [("9001", ts("2001-02-10 05:00:00")), (None, ts("2000-02-01"))])
    got = rows(df.select(K.dealer_type("code"), K.month_end("t"), K.date_id("t")))
    assert got == [("INSTITUTIONAL", day("2000-02-29"), 20000201), ("RETAIL", day("2001-02-28"), 20010210)]
