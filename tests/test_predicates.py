"""Stage filters: the coverage table of SURVEY 5.1 and NULL logic."""


from creditmap.config import AttributionConfig
from creditmap.functions import predicates as P
from creditmap.plans.vendor import SA_ACTUAL, SA_CORRELATED, SA_REP, _routes
from helpers import frame

CFG = AttributionConfig()  # the reference's own codes
ACT = ("Actual", "C10:001")
COR = ("Correlated", "C10:001")
EXC = ("Actual", "C36:000")
DEF = ("Actual", "C10:DEFAULT")
GRID = {
    "1234": {"ACT": SA_ACTUAL, "COR": SA_CORRELATED, "EXC": SA_CORRELATED, "DEF": SA_CORRELATED},
    "9834": {"ACT": SA_ACTUAL, "COR": None, "EXC": None, "DEF": None},
    "7585": {"ACT": SA_ACTUAL, "COR": None, "EXC": None, "DEF": None},
    "9190": {"ACT": SA_REP, "COR": SA_REP, "EXC": None, "DEF": None},
    "9280": {"ACT": SA_REP, "COR": SA_REP, "EXC": None, "DEF": None},
    "9155": {"ACT": SA_REP, "COR": SA_REP, "EXC": SA_CORRELATED, "DEF": None},
    None: {"ACT": None, "COR": None, "EXC": None, "DEF": None},
}


def route_of(spark, data):
    df = frame(spark, "dealer string, office string, branch string", data)
    out = df.select("dealer", "office", "branch", _routes([
        (SA_ACTUAL, P.actual_branches("office", "branch", "dealer", CFG)),
        (SA_CORRELATED, P.correlated_branches("office", "branch", "dealer", CFG)),
        (SA_REP, P.rep_level_monthly("branch", "dealer", CFG)),
    ]).alias("r"))
    return {(r.dealer, r.office, r.branch): r.r for r in out.collect()}


def test_sales_branch_class_grid(spark):
    classes = {"ACT": ACT, "COR": COR, "EXC": EXC, "DEF": DEF}
    data = [(d, *classes[c]) for d in GRID for c in classes]
    got = route_of(spark, data)
    for dealer, expect in GRID.items():
        for c, route in expect.items():
            assert got[(dealer, *classes[c])] == ([route] if route else []), (dealer, c)


def test_sales_null_office_type_and_null_branch(spark):
    got = route_of(spark, [
        ("1234", None, "C10:001"), ("9190", None, "C10:001"),
        ("1234", "Correlated", None), ("9155", "Correlated", None), ("9834", "Correlated", None),
        ("1234", "Actual", None),
    ])
    assert got[("1234", None, "C10:001")] == []
    assert got[("9190", None, "C10:001")] == [SA_REP]
    assert got[("1234", "Correlated", None)] == [SA_CORRELATED]
    assert got[("9155", "Correlated", None)] == []
    assert got[("9834", "Correlated", None)] == []
    assert got[("1234", "Actual", None)] == []


def test_market_share_firm_filter_three_valued(spark):
    partial = CFG.partial_firm
    df = frame(spark, "firm string, branch string", [
        ("SOME FIRM", "C10:001"), ("SOME FIRM", None), (None, "C10:001"),
        *[(f, "C10:001") for f in CFG.excluded_firms],
        (partial, "C36:000"), (partial, "C36:013"), (partial, None),
    ])
    kept = {(r.firm, r.branch) for r in df.where(P.firm_kept("firm", "branch", CFG)).collect()}
    assert kept == {("SOME FIRM", "C10:001"), ("SOME FIRM", None), (partial, "C36:000")}


def test_market_share_rep_level_filter(spark):
    df = frame(spark, "dealer string, branch string", [
        ("9190", "C36:000"), ("9280", None), ("9155", "C36:000"), ("9155", "C36:013"), ("9155", None),
        ("1234", "C10:001"), (None, "C10:001"),
    ])
    kept = {(r.dealer, r.branch) for r in df.where(P.rep_level_daily("dealer", "branch", CFG)).collect()}
    assert kept == {("9190", "C36:000"), ("9280", None), ("9155", "C36:013")}


def test_default_branch_or_null(spark):
    df = frame(spark, "b int", [(None,), (1,), (2,)])
    assert sorted(r.b for r in df.where(P.default_branch_or_null("b")).collect() if r.b) == [1]
    assert df.where(P.default_branch_or_null("b")).count() == 2
