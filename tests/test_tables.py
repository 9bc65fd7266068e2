"""Written builds: counts in passing, buckets, partitions, differences by ranges."""

import random

import pytest
from pyspark.sql import functions as F

from hertzmill.fixtures import Tables
from hertzmill.operators import lookup as L
from hertzmill.operators import normalize as N
from hertzmill.operators import validate as V
from hertzmill.sources import tables as S


def test_counts_in_passing_equal_meta(spark, sf_dir, tmp_path):
    t = Tables(spark, sf_dir)
    got = S.write_build({"band": t.bands, "channel": t.channels, "footnote": t.footnote_defs, "rule_part": t.rule_parts}, str(tmp_path), "3 May 2026")
    want = {r["key"]: r["value"] for r in N.meta(t.bands, t.channels, t.footnote_defs, t.rule_parts, "3 May 2026").collect()}
    assert got == want == {r["key"]: r["value"] for r in spark.read.parquet(f"{tmp_path}/meta").collect()}
    assert spark.read.parquet(f"{tmp_path}/band").count() == int(want["band_count"])


def test_joins_by_band_move_nothing(spark, sf_dir, tmp_path):
    t = Tables(spark, sf_dir)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        saved = S.save_tables({"band": t.bands, "service": t.services, "band_footnote": t.band_footnote}, str(tmp_path), "buckets", 4)
        bands = saved["band"].where("jurisdiction = 'us-federal'")
        plans = {}
        for name, df in {"l10": L.band_services(bands, saved["service"]), "labels": bands.join(L.services_label(saved["service"]), "band_id"), "l11": bands.select("band_id").distinct().join(saved["band_footnote"].select("band_id", "footnote_id").distinct(), "band_id")}.items():
            plans[name] = df._jdf.queryExecution().executedPlan().toString()
            assert "Exchange" not in plans[name], name
        assert "PartitionFilters: [isnotnull(jurisdiction" in plans["l10"] and "us-federal" in plans["l10"]
        got = sorted(map(str, L.band_services(bands.select("band_id", "lo_hz"), saved["service"]).collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == sorted(map(str, L.band_services(t.bands.where("jurisdiction = 'us-federal'").select("band_id", "lo_hz"), t.services).collect()))


def build(n):
    rnd = random.Random(6)
    rows = [(k, rnd.randrange(5), rnd.choice(["x", None])) for k in rnd.sample(range(10**9), n)] + [(None, 1, "null key"), (None, 1, "null key")]
    return rows + rows[:20]


@pytest.mark.parametrize("change", ["none", "one", "null", "repeat", "many", "empty"])
def test_diff_by_ranges(spark, change):
    rows = build(3000)
    other = list(rows)
    if change == "one":
        other[1500] = (other[1500][0], 99, "changed")
    elif change == "null":
        other.remove((None, 1, "null key"))
    elif change == "repeat":
        other.append(other[7])
    elif change == "many":
        other = [(k, v, "other" if k and k % 3 else s) for k, v, s in other]
    elif change == "empty":
        other = []
    kind = "k long, v long, s string"
    a, b = spark.createDataFrame(rows, kind), spark.createDataFrame(other, kind).select("s", "v", "k")
    for x, y in ((a, b), (b.select("k", "v", "s"), a)):
        assert sorted(map(str, V.diff_by_ranges(x, y, "k").collect())) == sorted(map(str, V.diff_builds(x, y).collect()))
    parts = V.differing_ranges(a, b, "k")
    if change == "none":
        assert parts == []
    if change in ("one", "repeat", "null"):
        read = a.where(V._within("k", parts)).count()
        assert len(parts) == 1 and read < len(rows) / 1000 + 50


def test_footnotes_of_a_probe_by_bits(spark, monkeypatch):
    rnd = random.Random(2)
    notes = [(b, f"5.{rnd.randrange(700)}", "itu") for b in range(60) for _ in range(rnd.randrange(30))]
    notes = sorted({(b, i, c, None if i.endswith("9") else f"text {i}") for b, i, c in notes}, key=str)
    pairs = [(p, rnd.randrange(70)) for p in range(40) for _ in range(rnd.randrange(6))]
    texts = {i: t for _, i, _, t in notes}
    want = sorted({(p, i, texts[i] or L.NO_TEXT) for p, b in pairs for b2, i, _, _ in notes if b == b2})
    held = spark.createDataFrame(notes, "band_id long, id string, class string, text string")
    matches = spark.createDataFrame(pairs + pairs[:5], "p long, band_id long")
    for wide in (L.WIDE, 0):  # as columns, and a row for each word
        monkeypatch.setattr(L, "WIDE", wide)
        assert sorted(map(tuple, L.footnote_texts(matches, held, "p").collect())) == want
    assert L.footnote_texts(matches, held.where("false"), "p").count() == 0


# What the printed table says at well-known frequencies (FM, two metres, marine
# channel 16, two of ships' beacons, satellite navigation, aircraft beacons), edges in hertz.
KNOWN = [
    (98_500_000, "us-non-federal", 88_000_000, 108_000_000, "BROADCASTING"),
    (146_520_000, "us-non-federal", 146_000_000, 148_000_000, "AMATEUR"),
    (156_800_000, "us-non-federal", 156_787_500, 156_812_500, "MARITIME MOBILE"),
    (161_975_000, "us-non-federal", 161_962_500, 161_987_500, "AIS 1"),
    (162_025_000, "us-non-federal", 162_012_500, 162_037_500, "AIS 2"),
    (1_575_420_000, "us-federal", 1_559_000_000, 1_610_000_000, "RADIONAVIGATION-SATELLITE"),
    (1_090_000_000, "us-federal", 960_000_000, 1_164_000_000, "AERONAUTICAL RADIONAVIGATION"),
]


def test_known_answers(spark):
    """The expectations hold on bands of those edges, and each fails where the band, its services or the rule part differ."""
    kinds = ("hz long, jurisdiction string, want_lo long, want_hi long, contains string", "band_id long, jurisdiction string, lo_hz long, hi_hz long, seq long", "band_id long, ordinal int, name string, is_primary boolean")
    bands = [(i, j, lo, hi, i) for i, (_, j, lo, hi, _) in enumerate(KNOWN)]
    bands += [(10 + i, j, hi, hi + 1000, 10 + i) for i, (_, j, _, hi, _) in enumerate(KNOWN)] + [(20, "us-federal", 88_000_000, 108_000_000, 0)]
    services = [(i, 1, f"{text} (AIS)" if "AIS" in text else text, True) for i, (*_, text) in enumerate(KNOWN)] + [(i, 0, "FIXED", True) for i in range(21)]

    def passed(known, bands=bands, services=services):
        made = [spark.createDataFrame(rows, kind) for rows, kind in zip((known, bands, services), kinds, strict=True)]
        return {r["hz"]: r["passed"] for r in V.expect_at(*made).collect()}

    assert passed(KNOWN) == {hz: True for hz, *_ in KNOWN}
    assert not any(passed([(hi, j, lo, hi, text) for _, j, lo, hi, text in KNOWN]).values())  # an upper edge belongs to the next band
    assert not any(passed(KNOWN, services=[x for x in services if x[1] == 0]).values())
    assert not any(passed([(hz, "itu-r1", *rest) for hz, _, *rest in KNOWN]).values())
    parts = spark.createDataFrame([(462_550_000, 467_725_000, "95", "Personal Radio"), (450_000_000, 470_000_000, "90", "Private Land Mobile"), (470_000_000, 471_000_000, "73", "x")], "lo_hz long, hi_hz long, part string, name string")
    met = L.rule_parts_at(spark.createDataFrame([(1, 462_562_500)], "p long, hz long"), parts, "p")
    assert [r["part"] for r in met.orderBy("position").collect()] == ["90", "95"]
