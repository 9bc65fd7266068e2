"""Joins by cells and lists of cells: what they give, and that what they send around doesn't grow with the matches."""

import random

import pytest
from pyspark.sql import functions as F

from hertzmill.operators import lookup as L
from hertzmill.plans import intervals as K

WIDE = 275_000_000_000


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def odd(spark):
    """Edges, empty, turned and repeated intervals, points at and beside edges, null and negative ones, one frequency with most of the points."""
    rnd = random.Random(11)
    rows = [("dup1", 10, 20), ("dup2", 10, 20), ("empty", 7, 7), ("turned", 9, 3), ("all", 0, WIDE), ("below", -50, 5)]
    for i in range(150):
        w = rnd.choice([1, 64, 10**6, 10**9, 10**10, WIDE])
        lo = rnd.randrange(0, max(1, WIDE - w))
        rows.append((f"i{i}", lo, lo + w))
    hz = sorted({x for _, lo, hi in rows for x in (lo - 1, lo, hi - 1, hi)} | {0, WIDE + 5, 2**62}) + [162_550_000] * 900 + [None, -3]
    spans = [(i, x, x + rnd.choice([-5, 0, 1, 10**6, 10**9, 10**11])) for i, x in enumerate(hz[:250])] + [(900, 0, 2**62), (901, None, 5)]
    return (
        rows, list(enumerate(hz)), spans,
        spark.createDataFrame(rows, "id string, lo_hz long, hi_hz long"),
        spark.createDataFrame(list(enumerate(hz)), "sighting_id long, hz long"),
        spark.createDataFrame(spans, "span_id long, p_lo long, p_hi long"),
    )


@pytest.mark.parametrize("cells", [2, 16, 1024])
def test_points_by_cells(odd, monkeypatch, cells):
    rows, points, _, ivs, pts, _ = odd
    monkeypatch.setattr(K, "CELLS", cells)
    want = sorted((p, i) for p, x in points if x is not None for i, lo, hi in rows if lo <= x < hi)
    assert sorted((r["sighting_id"], r["id"]) for r in K.point_join(pts, ivs, how="cells").collect()) == want


def test_copies_are_linear_and_hot_cells_are_dealt(odd):
    _, points, _, ivs, pts, _ = odd
    cells = K.cells_of(pts, "hz", ivs, "lo_hz", "hi_hz", K.COST)
    n = cells.copies(ivs, "lo_hz", "hi_hz").count()
    assert n <= 2 * (len(points) + 160) and max(cells.keys) > 3
    by_key = cells.dealt(pts, "hz").groupBy("_key").count().agg(F.max("count")).first()[0]
    assert by_key < len(points) / 4


@pytest.fixture(scope="module")
def wide(spark):
    """4,000 channels of which each point is in about 400."""
    ivs = spark.range(4000).select(F.concat(F.lit("ch-"), "id").alias("id"), (F.col("id") * 20_000_000).alias("lo_hz")).withColumn("hi_hz", F.col("lo_hz") + 8_000_000_000)
    return ivs, spark.range(3000).select(F.col("id").alias("sighting_id"), (F.col("id") * 27_000_001).alias("hz"))


def test_points_are_not_repeated_where_most_of_what_is_compared_matches(wide):
    """One row is shuffled for each point, not one for each level of width."""
    ivs, pts = wide
    met = L.channels_at(pts, ivs)
    plan = plan_of(met)
    assert "_level" not in plan and "NestedLoop" not in plan
    assert met.count() == L.channels_at(pts, ivs, "broadcast").count()


def test_few_matches_are_still_found_by_bins(spark):
    """Narrow intervals, all beside the points of their cells: comparing would be quadratic."""
    ivs = spark.range(60_000).select(F.col("id"), (F.col("id") * 10).alias("lo_hz"), (F.col("id") * 10 + 1).alias("hi_hz"))
    pts = spark.range(60_000).select(F.col("id").alias("sighting_id"), (F.pmod(F.xxhash64("id"), F.lit(600_000))).alias("hz"))
    assert K.cells_of(pts, "hz", ivs, "lo_hz", "hi_hz", 8) is None


@pytest.mark.parametrize(("cells", "cost"), [(2, 10**9), (64, 10**9), (1024, 10**9), (1024, -(10**9))])
def test_lists_of_spans(odd, monkeypatch, cells, cost):
    """Spans of all widths, by runs of cells and by pairs: what a sort for each span gives, a row for each span."""
    rows, _, spans, ivs, _, sps = odd
    monkeypatch.setattr(K, "CELLS", cells)
    monkeypatch.setattr(K, "LIST_COST", cost)
    twice = sps.unionByName(sps.where("span_id % 9 = 1"))
    got = K.ranked_in(twice, ivs, [F.col("hi_hz") - F.col("lo_hz"), "lo_hz", "id"], ["id"], "m").select("span_id", F.transform("m", lambda x: x["id"]).alias("m")).collect()
    want = [(p, [i for *_, i in sorted((hi - lo, lo, i) for i, lo, hi in rows if lo < hi and lo < b and hi > a)] if a is not None and a < b else []) for p, a, b in spans + [x for x in spans if x[0] % 9 == 1]]
    assert sorted((r["span_id"], r["m"]) for r in got) == sorted(want)


def test_lists_of_points_are_not_made_for_each_segment(wide):
    """One list for each cell."""
    ivs, pts = wide
    met = L.narrowest_first(pts, ivs, "sighting_id", "id")
    assert "_seg" not in plan_of(met) and "_l0" not in plan_of(met)
    want = L.rank(L.channels_at(pts, ivs, "broadcast"), "sighting_id", "id").select("sighting_id", "id", "rank")
    assert met.select("sighting_id", "id", "rank").exceptAll(want).isEmpty() and met.count() == want.count()


def test_rule_parts_are_united(spark):
    rows = [("1", "a", 0, 10), ("1", "a", 5, 20), ("1", "a", 20, 30), ("1", "a", 40, 50), ("1", "a", 42, 45), ("1", "b", 5, 6), ("2", None, 9, 3), ("2", None, 3, 9)]
    df = spark.createDataFrame(rows, "part string, name string, lo_hz long, hi_hz long")
    got = sorted(map(tuple, L.united(df).collect()), key=str)
    assert got == [("1", "a", 0, 30, None), ("1", "a", 40, 50, 30), ("1", "b", 5, 6, None), ("2", None, 3, 9, None)]


def test_rule_parts_meet_a_span_once(spark):
    """No pair for each interval of a part; ids that come twice are one probe."""
    parts = spark.range(2000).select((F.col("id") % 7 + 2).cast("string").alias("part"), F.concat(F.lit("Rules "), F.col("id") % 3).alias("name"), (F.col("id") * 1000).alias("lo_hz")).withColumn("hi_hz", F.col("lo_hz") + 1500)
    spans = spark.range(60).select(F.when(F.col("id") < 50, F.col("id")).otherwise(7).alias("span_id"), (F.col("id") * 31_000).alias("p_lo"), (F.col("id") * 31_000 + F.pmod(F.col("id") * 7919, F.lit(100_000))).alias("p_hi"))
    got, want = L.rule_parts_at(spans, parts, "span_id"), L.rule_parts_at(spans, parts, "span_id", "broadcast")
    assert L.united(parts).count() <= 2000 and got.exceptAll(want).isEmpty() and got.count() == want.count() > 500
    once = plan_of(L.rule_parts_at(spans.where("span_id <> 7"), parts, "span_id"))
    assert "ended" in once


def test_points_of_one_frequency_have_one_answer(spark, sf_dir):
    """L18 at points: the text is made for each frequency, not for each point."""
    from hertzmill import catalog
    from hertzmill.fixtures import Tables

    t = Tables(spark, sf_dir)
    some = t.sightings_low.select("sighting_id", "hz").limit(40)
    probes = some.unionByName(some.withColumn("sighting_id", F.col("sighting_id") + 10**9)).unionByName(spark.createDataFrame([(-1, None)], "sighting_id long, hz long"))
    met = catalog.answers(t, probes, "sighting_id")
    joined = [x for x in plan_of(met).split("\n") if "SortMergeJoin" in x and "[hz" in x]
    assert joined and met.count() == probes.count()
    assert met.where("sighting_id = -1").first()["channels"] == ""


def test_equal_intervals_are_ranked_once(spark):
    """Of intervals with equal edges the least is kept before they are numbered and spread over nodes."""
    ivs = spark.range(300).select(F.format_string("c%03d", "id").alias("id"), F.lit(100).cast("long").alias("lo_hz"), (F.lit(200) + F.col("id") % 2).alias("hi_hz"))
    pts = spark.createDataFrame([(1, 150), (2, 200), (3, 99)], "sighting_id long, hz long")
    value = F.struct((F.col("hi_hz") - F.col("lo_hz")).alias("w"), "id")
    assert sorted(r["m"]["id"] for r in K._least_of_equal(ivs, value, "m").collect()) == ["c000", "c001"]
    assert {r["hz"]: r["m"]["id"] for r in K.least_at(pts, ivs, value, "m").collect()} == {150: "c000", 200: "c001"}


def test_crowded_tiles_have_cells_of_their_own(spark):
    """One far edge doesn't put all tiles below it into a few cells."""
    edges = [*range(0, 400_000, 100), 1 << 55]
    tiles = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(zip(edges, [*edges[1:], K.TOP]))], "seg long, s_lo long, s_hi long")
    cell = K.lookup_cell(tiles, 1 << 55, False)
    assert tiles.groupBy(cell(F.col("s_lo")).alias("c")).count().agg(F.max("count")).first()[0] <= 3
    pts = spark.range(2000).select(F.col("id").alias("sighting_id"), (F.col("id") * 211 - 3).alias("hz"))
    got = {r["sighting_id"]: r["seg"] for r in K.segment_lookup(pts, tiles, 1 << 55, False).collect()}
    assert got == {i: (i * 211 - 3) // 100 if 0 <= i * 211 - 3 < 400_000 else 4000 if i == 0 else 3999 for i in range(2000)}


def test_spans_by_cells(odd):
    """L3: also where an interval begins in the span."""
    rows, _, spans, ivs, _, sps = odd
    want = sorted((p, i) for p, a, b in spans if a is not None and a < b for i, lo, hi in rows if lo < hi and lo < b and hi > a)
    assert sorted((r["span_id"], r["id"]) for r in K.span_join(sps, ivs, "cells").collect()) == want
    assert K.cells_of(sps, "p_lo", ivs, "lo_hz", "hi_hz", 0, must=True).copies(ivs, "lo_hz", "hi_hz").count() <= 2 * (len(spans) + len(rows))
