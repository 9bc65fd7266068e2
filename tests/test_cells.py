"""Literal cells, numbers, grids and prose."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from hertzmill.functions import cells as C
from hertzmill.functions import hertz as H
from hertzmill.operators import allocations as A
from hertzmill.operators import grid as G
from hertzmill.operators import normalize as N
from hertzmill.operators import validate as V


def one(spark, column, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()], F.lit(0).alias("_"))
    return row.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(("text", "hz"), [("162.5375", 162537500), (" 446.00625 ", 446006250), ("0.0000005", 0), ("0.0000015", 2), ("0.07745", 77450), ("x", None)])
def test_mhz_is_decimal_and_half_even(spark, text, hz):
    assert one(spark, H.mhz_to_hz(F.col("t")), t=text) == hz


@pytest.mark.parametrize(("hz", "text"), [(162537500, "162.537 MHz"), (88000000, "88 MHz"), (77500, "77.5 kHz"), (999, "999 Hz"), (5_800_000_000, "5.8 GHz")])
def test_fmt_hz(spark, hz, text):
    assert one(spark, H.fmt_hz(F.col("h")), h=hz) == text


def test_raster(spark):
    rows = H.raster(spark, "pmr", "446.00625", "12.5", 16, "12.5").orderBy("id").collect()
    assert len(rows) == 16 and rows[0]["id"] == "pmr-01" and (rows[0]["lo_hz"] + rows[0]["hi_hz"]) // 2 == 446006250
    assert rows[-1]["hi_hz"] == 446_200_000
    check = V.raster_check(H.raster(spark, "pmr", "446.00625", "12.5", 16, "12.5"), F.lit("pmr"), 12500).first()
    assert (check["channels"], check["first_center"], check["off_raster"]) == (16, 446006250, 0)


@pytest.mark.parametrize(("name", "primary"), [("MOBILE except aeronautical mobile", True), ("Radiolocation", False), ("A b", False), ("(AIS 1) XY", True), ("EARTH EXPLORATION-SATELLITE", True)])
def test_primary(spark, name, primary):
    assert one(spark, C.is_primary(F.col("n")), n=name) is primary


@pytest.mark.parametrize(
    ("line", "unit", "want"),
    [("88-108", "MHz", (88_000_000, 108_000_000)), ("Below 8.3", "kHz", (0, 8300)), ("1 240-1 300", "MHz", (1_240_000_000, 1_300_000_000)), ("300-325 (Not Allocated)", "kHz", (300_000, 325_000)), ("FIXED", "MHz", None)],
)
def test_ranges(spark, line, unit, want):
    got = one(spark, C.parse_range(F.col("t"), F.col("u")), t=line, u=unit)
    assert (got and tuple(got)) == want


def parsed(spark, text, unit="MHz"):
    return one(spark, C.split_bands(F.col("t"), F.col("u")), t=text, u=unit)


def test_cell_quirks(spark):
    cell = parsed(spark, "40-41\nEARTH EXPLORATION-\nSATELLITE\n(Earth-to-space)  5.1\n5.150, 5.151\nMobile\n5.9A\n5.10  US2\nG3")[0]
    assert [s["name"] for s in cell["services"]] == ["EARTH EXPLORATION-SATELLITE (Earth-to-space)", "Mobile"]
    assert [list(s["footnotes"]) for s in cell["services"]] == [["5.1"], []]
    assert list(cell["footnotes"]) == ["5.9A", "5.10", "US2", "G3"]
    interior = parsed(spark, "40-41\n5.7\nFIXED\n5.8\nMOBILE")[0]
    assert list(interior["footnotes"]) == ["5.7"] and list(interior["services"][0]["footnotes"]) == ["5.8"]
    two = parsed(spark, "lost\n17.8-18.1\nFIXED\n18.1-18.3\nMOBILE", "GHz")
    assert [(c["lo_hz"], c["raw_text"]) for c in two] == [(17_800_000_000, "17.8-18.1\nFIXED"), (18_100_000_000, "18.1-18.3\nMOBILE")]
    spill = parsed(spark, "FIXED\n40-41")
    assert len(spill) == 1 and spill[0]["lo_hz"] is None
    assert parsed(spark, "")[0]["lo_hz"] is None


def test_normalize(spark):
    assert one(spark, C.normalize_text(F.col("t")), t=" a  b  c \n\n \t\nd") == "a b c\nd"


def test_spills_fold_once(spark):
    cells = [(1, 0, i, 0, ["us_federal"], t, "MHz") for i, t in enumerate(["LOST\n5.1", "40-41\nFIXED\n5.2  5.2", "FIXED\nMOBILE  5.3\n5.2  5.4", "MOBILE"])]
    df = spark.createDataFrame(cells, "doc_id long, table_index long, row_index long, cell_index int, columns array<string>, text string, unit string")
    band = A.to_bands(A.fold_spills(A.chunks(df))).collect()
    assert len(band) == 1 and band[0]["source"] == "tbl0:row1"
    assert [s["name"] for s in band[0]["services"]] == ["FIXED", "MOBILE"]
    assert list(band[0]["footnotes"]) == ["5.2", "5.2", "5.4", "5.3"]


def test_rule_parts_take_the_latest_range(spark):
    rows = [(["fcc_parts"], "Early (90)"), (["us_federal", "fcc_parts"], "40-41\nFIXED"), (["fcc_parts"], "Private Land\nmobile (90)\nMaritime (80)"), (["us_federal"], "41-42\nFIXED"), (["fcc_parts"], "Amateur (97)")]
    df = spark.createDataFrame([(1, 0, i, 0, c, t, "MHz") for i, (c, t) in enumerate(rows)], "doc_id long, table_index long, row_index long, cell_index int, columns array<string>, text string, unit string")
    parts = A.rule_parts(df)
    assert sorted((r["part"], r["name"], r["lo_hz"]) for r in parts.collect()) == [("80", "Maritime", 40_000_000), ("90", "Private Land mobile", 40_000_000), ("97", "Amateur", 41_000_000)]
    assert sorted(r["row_index"] for r in A.band_cells(df, parts).collect()) == [1, 3]


def test_footnotes(spark):
    said = ["before", "(a) Allocation Table. x", "(9) 5.1 too early", "(b) International footnotes.", "(53)  5.53  first", "more", None, "(54) [Reserved]", "lost", "(260)(i)  5.260A A", "(1) 5.53 again", "(c) United States Footnotes.", "(2) US2 us"]
    df = spark.createDataFrame([(1, i, "p" if t is not None else "tbl", t) for i, t in enumerate(said)], "doc_id long, block_index int, kind string, text string")
    got = {r["id"]: (r["class"], r["text"]) for r in A.parse_footnotes(df).collect()}
    assert got == {"5.53": ("itu", "again"), "5.260A": ("itu", "A"), "US2": ("us", "us")}
    rev = spark.createDataFrame([(1, 3, "p", "Revised on  3 May 2026 "), (2, 0, "p", "x")], "doc_id long, block_index int, kind string, text string")
    assert {r["doc_id"]: r["revision"] for r in A.source_revision(rev).collect()} == {1: "3 May 2026", 2: "unknown"}


def brute(score_of, n):
    """Plain recursion over (cell, column) with strict improvement: unused first, then the smaller end."""
    best = [[-np.inf] * 7 for _ in range(n + 1)]
    step = {}
    for j in range(7):
        best[n][j] = 0.0
    for i, j in itertools.product(range(n - 1, -1, -1), range(5, -1, -1)):
        options = [(best[i][j + 1], None)] + [(score_of(i, j, e) + best[i + 1][e + 1], e) for e in range(j, 6) if best[i + 1][e + 1] > -np.inf]
        for value, e in options:
            if value > best[i][j]:
                best[i][j], step[i, j] = value, e
    out, i, j = [], 0, 0
    while i < n:
        if (i, j) not in step:
            return []
        e = step[i, j]
        if e is None:
            j += 1
        else:
            out.append((j, e))
            i, j = i + 1, e + 1
    return out


def test_column_choice_equals_recursion():
    rnd = random.Random(3)
    for _ in range(300):
        n = rnd.randint(1, 6)
        score = np.array([[rnd.choice([-2.0, -1.0, 0.0, 1.0, 1.0, 3.0]) for _ in G._RUNS] for _ in range(n)])
        got = G._best(score.copy(), np.zeros_like(score), [None] * n, [None] * 6)
        assert got == brute(lambda i, j, e, s=score: s[i, G._RUN_NO[j, e]], n)
    assert G._best(np.zeros((7, 21)), np.zeros((7, 21)), [None] * 7, [None] * 6) == []


def test_assignment_follows_content_and_continuity(spark):
    bounds = list(G.DEFAULT_BOUNDS)
    rows = [(0, 0, "10-20\nA", 0.0, 0.148), (0, 1, "10-20\nB", 0.148, 0.503), (0, 2, "10-20\nC\nG5", 0.503, 0.88), (1, 0, "20-30\nA", 0.0, 0.15), (1, 1, "NG4", 0.6, 0.75)]
    df = spark.createDataFrame([(1, 0, r, c, t, False, a, b, bounds, "MHz") for r, c, t, a, b in rows], "doc_id long, table_index long, row_index long, cell_index int, text string, merged_up boolean, x0 double, x1 double, bounds array<double>, unit string")
    got = {(r["row_index"], r["cell_index"]): list(r["columns"]) for r in G.assign_columns(df).collect()}
    assert got[0, 0] == ["itu_r1"] and got[0, 1] == ["itu_r2", "itu_r3"] and got[0, 2] == ["us_federal", "us_non_federal"]
    # every column whose last band ended at 20 MHz gives more than its missing width takes
    assert got[1, 0] == ["itu_r1", "itu_r2", "itu_r3", "us_federal"] and got[1, 1] == ["us_non_federal"]


def test_merged_and_bounds(spark):
    cells = spark.createDataFrame([(1, 0, 0, 0, 1, False, "top"), (1, 0, 1, 0, 1, True, ""), (1, 0, 2, 0, 1, True, "own"), (1, 0, 3, 0, 2, True, "")], "doc_id long, table_index long, row_index long, cell_index int, span int, merged_up boolean, text string")
    grids = spark.createDataFrame([(1, 0, [10, 30])], "doc_id long, table_index long, widths array<int>")
    placed = G.inherit_merged(G.place_cells(cells, grids)).orderBy("row_index").collect()
    assert [r["text"] for r in placed] == ["top", "top", "own", "top"] and placed[3]["x1"] == 1.0 and placed[0]["x1"] == 0.25
    head = [(1, 0, 0, i, label, i / 6, (i + 1) / 6) for i, label in enumerate(G.LABELS)]
    thin = [(1, 0, 1, i, label, 0.5 + i / 1000, 0.5 + (i + 1) / 1000) for i, label in enumerate(G.LABELS[:5])]
    body = [(1, 0, 2, 0, "x", 0.0, 0.1)]
    df = spark.createDataFrame(head + thin + body, "doc_id long, table_index long, row_index long, cell_index int, text string, x0 double, x1 double")
    out = G.column_bounds(df).collect()
    assert {r["row_index"] for r in out} == {1, 2} and list(out[0]["bounds"]) == [0.0, 0.1667, 0.3333, 0.5, 0.6667, 0.8333, 1.0]


def test_numbers_are_dense_and_strict_errors_raise(spark):
    bands = spark.createDataFrame([(d, i) for d in (3, 1, 2) for i in range(4)], "doc_id long, seq long")
    got = [r["band_id"] for r in N.number_bands(bands, ["doc_id", "seq"]).orderBy("doc_id", "seq").collect()]
    assert got == list(range(1, 13))
    bad = spark.createDataFrame([("a", "us", 5, 5, "s")], "id string, jurisdiction string, lo_hz long, hi_hz long, source string")
    with pytest.raises(V.ChannelError):
        V.channel_errors(bad, strict=True)


def test_collapse_prints_first_and_last_region(spark):
    from hertzmill.operators.lookup import collapse_regions

    rows = [(1, f"itu-r{n}", 0, 10, ["A"]) for n in (3, 1)] + [(1, "itu-r2", 0, 10, ["B"])]
    df = spark.createDataFrame(rows, "p long, jurisdiction string, lo_hz long, hi_hz long, services array<string>")
    assert sorted(r["label"] for r in collapse_regions(df, "p").collect()) == ["ITU Region 2", "ITU Regions 1–3"]


def test_every_title_is_looked_at(spark):
    cases = {
        "Table of Frequency Allocations 1-2 MHz (HF)": ("MHz", "HF"),
        "Table of Frequency Allocations (cont.) Table of Frequency Allocations 1-2 MHz (HF)": ("MHz", "HF"),
        "x\nTable of Frequency Allocations\n 0.5 - 137.25 GHz": ("GHz", ""),
        "Table of Frequency Allocations\u00a01\u00a0-\u00a02kHz (a (b) c)": ("kHz", "a (b"),
        "Table of Frequency Allocations 3-4 kHz Table of Frequency Allocations 5-6 GHz (later)": ("kHz", ""),
        "Table of Frequency Allocations 1 2-3 MHz (HF)": None,
        "Table of Frequency Allocations 12-3 4 MHz": None,
        "Table of Frequency Allocations1-2 MHz": None,
        "Table of Frequency Allocations -2 MHz": None,
        "Table of Frequency Allocations 1-2 Hz": None,
        "Table of Frequency Allocations": None,
        "": None,
    }
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    got = {r["t"]: r["s"] and tuple(r["s"]) for r in df.select("t", G.section_of(F.col("t")).alias("s")).collect()}
    assert got == cases


def test_one_huge_document_spreads_over_tasks(spark):
    """Sections, bounds, spills and entries of a single document of all rows equal those of a plain walk."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        cells = [(1, i // 50, i, 0, f"Table of Frequency Allocations {i}-{i + 1} {'MHz' if i % 2 else 'GHz'} ({i})" if i % 37 == 5 else f"row {i}") for i in range(600)]
        rows = spark.createDataFrame(cells, "doc_id long, table_index long, row_index long, cell_index int, text string")
        unit, label, want = "kHz", "", {}
        for _, _, i, _, text in cells:
            if text.startswith("Table"):
                unit, label = "MHz" if i % 2 else "GHz", str(i)
            else:
                want[i] = unit, label
        assert {r["row_index"]: (r["unit"], r["section_label"]) for r in G.sections(rows).collect()} == want
        blocks = [(1, 0, "p", "(a) Allocation Table. x"), (1, 1, "p", "(b) International footnotes. y")]
        for i in range(2, 500):
            blocks.append((1, i, "p", f"({i}) 5.{i} text" if i % 3 == 0 else f"more {i}"))
        got = {r["id"]: r["text"] for r in A.parse_footnotes(spark.createDataFrame(blocks, "doc_id long, block_index int, kind string, text string")).collect()}
        assert got == {f"5.{i}": "\n".join(["text", *(f"more {k}" for k in (i + 1, i + 2) if k < 500)]) for i in range(3, 500, 3)}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
