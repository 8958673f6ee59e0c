"""Versioned hops, collapse, effective-dated and interval joins."""

from creditmap.operators.intervals import effective_dated_left, overlap_join
from creditmap.operators.versions import collapse_versions, hop_as_of, hop_to_current
from helpers import SELLING_CODE, day, frame, rows, ts

OPEN = ts("9999-12-31")


def selling_codes(spark):
    return frame(spark, SELLING_CODE, [
        # code A: two versions, the second current
        (1, "A", 10, ts("2000-01-01"), ts("2000-06-30"), "N"),
        (2, "A", 11, ts("2000-07-01"), OPEN, "Y"),
        # code B: two current versions (a data error the scripts keep)
        (3, "B", 20, ts("2000-01-01"), OPEN, "Y"),
        (4, "B", 21, ts("2000-01-01"), OPEN, "Y"),
        # code C: no current version
        (5, "C", 30, ts("2000-01-01"), ts("2000-12-31"), "N"),
        # code D: gap between versions
        (6, "D", 40, ts("2000-01-01"), ts("2000-01-31"), "N"),
        (7, "D", 41, ts("2000-03-01 10:30:00"), ts("2000-03-31 23:00:00"), "Y"),
    ])


def test_hop_to_current_is_a_bag(spark):
    facts = frame(spark, "sc long, amt int", [(1, 1), (2, 2), (3, 3), (5, 5)])
    out = hop_to_current(facts, selling_codes(spark), "sc", "Selling_Code_ID", "Selling_Code",
                         {"Selling_Code_ID": "cur", "Distributor_ID": "dist"})
    assert rows(out, "amt", "cur", "dist") == [(1, 2, 11), (2, 2, 11), (3, 3, 20), (3, 4, 21)]


def test_hop_as_of_closed_day_grain(spark):
    facts = frame(spark, "code string, d date", [
        ("A", day("2000-06-30")),   # term day of version 1
        ("A", day("2000-07-01")),   # created day of version 2
        ("C", day("2001-01-01")),   # day after the last term: no version
        ("D", day("2000-02-15")),   # inside the gap: no version
        ("D", day("2000-03-01")),   # created at 10:30, compared at day grain
        ("D", day("2000-03-31")),   # term at 23:00 on that day
    ])
    out = hop_as_of(facts, selling_codes(spark), "code", "Selling_Code", "d", {"Selling_Code_ID": "v"})
    assert rows(out, "code", "d", "v") == [
        ("A", day("2000-06-30"), 1), ("A", day("2000-07-01"), 2),
        ("D", day("2000-03-01"), 7), ("D", day("2000-03-31"), 7),
    ]


def test_collapse_versions_bridges_gaps(spark):
    out = collapse_versions(selling_codes(spark), ["Selling_Code"])
    got = {r.Selling_Code: (r.Start_Date, r.End_Date) for r in out.collect()}
    assert got["D"] == (day("2000-01-01"), day("2000-03-31"))
    assert got["A"] == (day("2000-01-01"), day("9999-12-31"))


def test_effective_dated_override_timestamp_grain_and_overlaps(spark):
    ref = frame(spark, "name string, eff timestamp_ntz, fin timestamp_ntz, terr string", [
        ("B1", ts("2000-01-01"), ts("2000-12-31"), "T1"),
        ("B2", ts("2000-01-01"), ts("2000-12-31"), "T2"),
        ("B2", ts("2000-06-01"), ts("2001-12-31"), "T3"),   # overlaps with a different name
        ("B3", ts("2000-01-01"), ts("2000-12-31"), "T4"),
        ("B3", ts("2000-01-01"), ts("2000-12-31"), "T4"),   # identical duplicate
    ])
    pos = frame(spark, "id int, branch string, at timestamp_ntz", [
        (1, "B1", ts("2000-12-31 00:00:00")),   # midnight on the end date: in
        (2, "B1", ts("2000-12-31 05:00:00")),   # 05:00 on the end date: out (Q-11)
        (3, "B2", ts("2000-07-01")),            # two intervals, two names: fan-out
        (4, "B3", ts("2000-07-01")),            # duplicate interval: doubled
        (5, "B9", ts("2000-07-01")),            # no interval
    ])
    out = effective_dated_left(pos, ref, "branch", "at", "name", "eff", "fin", {"terr": "ovr"})
    assert rows(out, "id", "ovr") == [(1, "T1"), (2, None), (3, "T2"), (3, "T3"), (4, "T4"), (4, "T4"), (5, None)]


def test_effective_dated_only_when_keeps_row_once(spark):
    from pyspark.sql import functions as F
    ref = frame(spark, "name string, eff timestamp_ntz, fin timestamp_ntz, terr string",
                [("B1", ts("2000-01-01"), ts("2000-12-31"), "T1"), ("B1", ts("2000-01-01"), ts("2000-12-31"), "T2")])
    pos = frame(spark, "id int, branch string, at timestamp_ntz, route string",
                [(1, "B1", ts("2000-07-01"), "rep"), (2, "B1", ts("2000-07-01"), "branch")])
    out = effective_dated_left(pos, ref, "branch", "at", "name", "eff", "fin", {"terr": "ovr"},
                               only_when=F.col("route") != "rep")
    assert rows(out, "id", "ovr") == [(1, None), (2, "T1"), (2, "T2")]


def test_overlap_join_touching_disjoint_nested(spark):
    a = frame(spark, "k string, a0 date, a1 date", [
        ("X", day("2000-01-01"), day("2000-01-31")),
        ("Y", day("2000-01-01"), day("2000-01-31")),
        ("Z", day("2000-01-01"), day("2000-12-31")),
    ])
    p = frame(spark, "k string, p0 date, p1 date", [
        ("X", day("2000-01-31"), day("2000-02-28")),   # touching: overlaps (closed)
        ("Y", day("2000-02-01"), day("2000-02-28")),   # disjoint
        ("Z", day("2000-03-01"), day("2000-03-31")),   # nested
    ])
    out = overlap_join(a, p, "k", "a0", "a1", "p0", "p1")
    assert rows(out, "k") == [("X",), ("Z",)]
