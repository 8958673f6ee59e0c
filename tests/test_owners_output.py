"""Owner ranking and attachment (R-1), conform and accumulate."""

import pytest

from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditmap.operators.output import accumulate, conform
from creditmap.operators.owners import rank_owner, top_owner, waterfall, waterfall_step
from creditmap.plans import lookup as L
from helpers import D, frame, rows

CANDS = "BR string, Territory string, Assets decimal(18,2), Parties long"


def cands(spark):
    return frame(spark, CANDS, [
        ("K1", "T_B", D(10), 1), ("K1", "T_A", D(10), 1),          # tie on both measures -> T_A
        ("K2", "T_A", D(10), 1), ("K2", "T_B", D(10), 3),          # tie on sum, parties decide -> T_B
        ("K3", "T_A", None, 5), ("K3", "T_B", D(1), 1),            # NULL sum ranks last -> T_B
        ("K4", "T_Z", D(7), 1),                                    # single owner
        (None, "T_A", D(99), 1), (None, "T_B", D(1), 1),           # NULL key partition
    ])


def test_rank_owner_ties_and_nulls(spark):
    ranked = rank_owner(cands(spark), "BR", ["Assets", "Parties"], "Territory")
    top = {r.BR: r.Territory for r in ranked.where("rn = 1").collect()}
    assert top == {"K1": "T_A", "K2": "T_B", "K3": "T_B", "K4": "T_Z", None: "T_A"}
    assert ranked.groupBy("BR").agg(F.max("rn").alias("m")).where("m = 0").count() == 0


def test_top_owner_plans_group_limit(spark):
    plan = top_owner(cands(spark), "BR", ["Assets", "Parties"], "Territory")._jdf.queryExecution() \
        .executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_attach_equals_literal_right_join_filter(spark):
    """R-1: positions LEFT JOIN (rn = 1) == owner RIGHT JOIN positions WHERE rn = 1 OR rn IS NULL."""
    positions = frame(spark, "id int, aBR string", [
        (1, "K1"), (2, "K1"), (3, "K2"), (4, "K9"), (5, None), (6, "K3"), (6, "K3"),
    ])
    ranked = rank_owner(cands(spark), "BR", ["Assets", "Parties"], "Territory")
    literal = ranked.join(positions, ranked.BR == positions.aBR, "right") \
        .where((F.col("rn") == 1) | F.col("rn").isNull()).select("id", "aBR", F.col("Territory").alias("owner"))
    owners = L.owner_lookup(top_owner(cands(spark), "BR", ["Assets", "Parties"], "Territory"), "advisor")
    rewritten = L.attach(positions, [owners], F.lit("advisor"), F.col("aBR"), F.current_date(), "rep").select(
        "id", "aBR", F.col(L.TERRITORY).alias("owner"))
    assert literal.exceptAll(rewritten).count() == 0
    assert rewritten.exceptAll(literal).count() == 0
    assert rewritten.count() == positions.count()


def test_waterfall_outcomes(spark):
    df = frame(spark, "ovr string, code string, owner string", [
        ("O", "C01:DEFAULT", "W"), (None, "C01:DEFAULT", "W"), (None, "C02:001", "W"), (None, "C02:001", None),
    ])
    out = df.select(waterfall("ovr", "owner", "code", ("C01:DEFAULT",), "Institutional").alias("t"),
                    waterfall("ovr", "owner").alias("b"))
    assert [tuple(r) for r in out.collect()] == [("O", "O"), ("Institutional", "W"), ("W", "W"), (None, None)]
    steps = df.select(waterfall_step("ovr", "owner", "code", ("C01:DEFAULT",), "Institutional")).collect()
    assert [r[0] for r in steps] == ["override", "house", "ranked", "none"]


COLS = (("name", T.StringType(), 5), ("v", T.DecimalType(15, 2), None), ("u", T.DecimalType(15, 6), None))


def test_conform_rounds_half_away_from_zero(spark):
    df = frame(spark, "name string, v decimal(20,4), u decimal(20,8)", [
        ("a", D("0.0050"), D("0.00000050")), ("b", D("-0.0050"), D("-0.00000050")), ("c", D("1.0049"), D("1")),
    ])
    got = {r.name: (r.v, r.u) for r in conform(df, COLS).collect()}
    assert got == {"a": (D("0.01"), D("0.000001")), "b": (D("-0.01"), D("-0.000001")), "c": (D("1.00"), D("1.000000"))}


def test_conform_overflow_and_width_raise(spark):
    big = frame(spark, "name string, v decimal(20,2), u decimal(20,6)", [("a", D("12345678901234.00"), D(0))])
    with pytest.raises(Exception, match="does not fit"):
        conform(big, COLS).collect()
    long = frame(spark, "name string, v decimal(20,2), u decimal(20,6)", [("abcdef", D(1), D(0))])
    with pytest.raises(Exception, match="longer than 5"):
        conform(long, COLS).collect()


def test_accumulate_is_set_union_after_cast(spark):
    s1 = frame(spark, "name string, v decimal(20,4), u decimal(20,6)", [("a", D("1.0010"), D(1)), ("t1", D(2), D(1))])
    s2 = frame(spark, "name string, v decimal(20,4), u decimal(20,6)", [("a", D("1.0040"), D(1)), ("t2", D(2), D(1))])
    out = accumulate(conform(s1, COLS), conform(s2, COLS))
    # equal only after rounding -> one row; differing names kept (Q-01 / Q-03)
    assert rows(out, "name", "v") == [("a", D("1.00")), ("t1", D("2.00")), ("t2", D("2.00"))]
    again = accumulate(out, out)
    assert again.exceptAll(out).count() == 0 and out.exceptAll(again).count() == 0
