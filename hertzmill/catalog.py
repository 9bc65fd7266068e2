"""Registered queries of the spectrum operators and the SQL that states the same plainly."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .fixtures import Tables, with_fixtures
from .functions import cells as C
from .functions import hertz as H
from .operators import allocations as A
from .operators import grid as G
from .operators import lookup as L
from .operators import normalize as N
from .operators import validate as V
from .plans import intervals as K
from .plans.storage import shared_path
from .sources import tables as S

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Registers f(tables) as a query of (spark, sf_dir); sql: its oracle over tables and fixtures."""

    def add(f):
        QUERIES[name] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if sql:
            ORACLES[name] = with_fixtures(sql)
        return f

    return add


def spans(t: Tables) -> DataFrame:
    return t.spans.withColumnsRenamed({"lo_hz": "p_lo", "hi_hz": "p_hi"})


def slim(channels: DataFrame) -> DataFrame:
    return channels.select("id", "lo_hz", "hi_hz")


JNAMES = ", ".join(f"('{j[0]}', '{j[1]}', '{j[2]}', {'NULL' if j[3] is None else repr(j[3])}, {j[4]}, {i})" for i, j in enumerate(H.JURISDICTIONS))
JURIS = f"juris AS (SELECT * FROM (VALUES {JNAMES}) v(jid, jname, authority, country, itu_region, code))"
LABELS = "labels AS (SELECT band_id, string_agg(name || CASE WHEN is_primary THEN '' ELSE ' (secondary)' END, ', ' ORDER BY ordinal) AS label FROM services GROUP BY band_id)"
PLAIN = "labels AS (SELECT band_id, string_agg(name, ', ' ORDER BY ordinal) AS label FROM services GROUP BY band_id)"
NOTES = "notes AS (SELECT DISTINCT b.band_id, f.id, f.class, f.text FROM band_footnote b JOIN footnote_defs f ON f.id = b.footnote_id)"


# ------------------------------------------------------------------------------ lookup
@query("l1_channels_at", "SELECT sighting_id, id FROM sightings JOIN channels ON lo_hz <= hz AND hz < hi_hz")
def _(t):
    return L.channels_at(t.sightings, slim(t.channels)).select("sighting_id", "id")


@query("l2_bands_at", f"WITH {JURIS} SELECT sighting_id, band_id, jname FROM sightings JOIN bands ON lo_hz <= hz AND hz < hi_hz JOIN juris ON jid = jurisdiction")
def _(t):
    return L.bands_at(t.sightings, t.bands).select("sighting_id", "band_id", "jname")


@query("l3_channels_in", "SELECT span_id, c.id FROM spans s JOIN channels c ON c.lo_hz < s.hi_hz AND c.hi_hz > s.lo_hz WHERE s.lo_hz < s.hi_hz")
def _(t):
    return L.channels_in(spans(t), slim(t.channels)).select("span_id", "id")


@query("l4_bands_in", f"WITH {JURIS} SELECT span_id, band_id, jname FROM spans s JOIN bands c ON c.lo_hz < s.hi_hz AND c.hi_hz > s.lo_hz JOIN juris ON jid = jurisdiction WHERE s.lo_hz < s.hi_hz")
def _(t):
    return L.bands_in(spans(t), t.bands).select("span_id", "band_id", "jname")


PART_NO = "CASE WHEN regexp_extract(part, '^\\d+', 0) = '' THEN 0 ELSE CAST(regexp_extract(part, '^\\d+', 0) AS INTEGER) END"


@query("l5_rule_parts_at", f"""
SELECT span_id, part, name, CAST(row_number() OVER (PARTITION BY span_id ORDER BY {PART_NO}, part, name) AS INTEGER) AS position
FROM (SELECT DISTINCT span_id, part, name FROM spans s JOIN rule_parts r ON r.lo_hz < s.hi_hz AND r.hi_hz > s.lo_hz WHERE s.lo_hz < s.hi_hz) x""")
def _(t):
    return L.rule_parts_at(spans(t), t.rule_parts, "span_id")


RANKED = "SELECT sighting_id, id, CAST(row_number() OVER (PARTITION BY sighting_id ORDER BY hi_hz - lo_hz, lo_hz, hi_hz, id) AS INTEGER) AS rank FROM sightings JOIN channels ON lo_hz <= hz AND hz < hi_hz"


@query("l6_rank", RANKED)
def _(t):
    return L.narrowest_first(t.sightings, slim(t.channels), "sighting_id", "id").select("sighting_id", "id", "rank")


@query("l7_top_n", f"SELECT * FROM ({RANKED}) x WHERE rank <= 32")
def _(t):
    return L.narrowest_first(t.sightings, slim(t.channels), "sighting_id", "id", 32).select("sighting_id", "id", "rank")


@query("l7_top_1", f"SELECT * FROM ({RANKED}) x WHERE rank <= 1")
def _(t):
    met = L.narrowest_at(t.sightings, slim(t.channels), "id").where("match is not null")
    return met.select("sighting_id", "match.id", F.lit(1).alias("rank"))


@query("l8_count_matches", "SELECT span_id, count(c.id) AS n_matches FROM spans s LEFT JOIN channels c ON c.lo_hz < s.hi_hz AND c.hi_hz > s.lo_hz AND s.lo_hz < s.hi_hz GROUP BY span_id")
def _(t):
    return L.count_matches(spans(t), t.channels, "span_id")


@query("l9_services_label", f"WITH {LABELS}, r AS (SELECT band_id, string_agg(name, ', ' ORDER BY ordinal) AS ranked FROM services GROUP BY band_id) SELECT b.band_id, COALESCE(label, '') AS serving, COALESCE(label, 'no service listed') AS report, COALESCE(ranked, '(no service listed)') AS ranked FROM bands b LEFT JOIN labels l ON l.band_id = b.band_id LEFT JOIN r ON r.band_id = b.band_id")
def _(t):
    out = t.bands.select("band_id")
    for kind, empty in L.EMPTY_LABEL.items():
        out = out.join(L.services_label(t.services, kind).withColumnRenamed("label", kind), "band_id", "left").withColumn(kind, F.coalesce(kind, F.lit(empty)))
    return out


@query("l10_band_services", "SELECT b.band_id, COALESCE(string_agg(ordinal || ':' || name || ':' || CASE WHEN is_primary THEN 'true' ELSE 'false' END, '|' ORDER BY ordinal), '') AS services FROM bands b LEFT JOIN services s ON s.band_id = b.band_id GROUP BY b.band_id")
def _(t):
    shown = F.transform("services", lambda s: F.concat_ws(":", s["ordinal"].cast("string"), s["name"], s["is_primary"].cast("string")))
    return L.band_services(t.bands.select("band_id"), t.services).select("band_id", F.array_join(shown, "|").alias("services"))


@query("l11_band_footnotes", f"WITH {NOTES} SELECT n.band_id, n.id, n.class, n.text FROM notes n JOIN bands b ON b.band_id = n.band_id")
def _(t):
    return L.band_footnotes(t.bands, t.band_footnote, t.footnote_defs)


@query("l12_ranked_layers", f"""
WITH {PLAIN}, layers AS (
  SELECT 'channel' AS layer, name AS what, id AS item, lo_hz, hi_hz FROM channels
  UNION ALL SELECT 'band', COALESCE(label, '(no service listed)'), CAST(b.band_id AS VARCHAR), lo_hz, hi_hz FROM bands b LEFT JOIN labels l ON l.band_id = b.band_id WHERE jurisdiction LIKE 'us%')
SELECT sighting_id, layer, what, lo_hz, hi_hz, CAST(row_number() OVER (PARTITION BY sighting_id ORDER BY hi_hz - lo_hz, lo_hz, hi_hz, layer, what, item) AS INTEGER) AS rank
FROM sightings JOIN layers ON lo_hz <= hz AND hz < hi_hz""")
def _(t):
    return L.ranked_layers(t.sightings, t.channels, t.bands, t.services)


@query("l13_filter_jurisdiction", "SELECT sighting_id, id FROM sightings JOIN channels ON lo_hz <= hz AND hz < hi_hz WHERE jurisdiction = 'eu'")
def _(t):
    return L.channels_at(t.sightings, slim(L.filter_jurisdiction(t.channels, "eu"))).select("sighting_id", "id")


SUMMARY = f"""
WITH {LABELS}, p AS (SELECT DISTINCT hz FROM SIGHTINGS),
c AS (SELECT hz, arg_min(name, (hi_hz - lo_hz, lo_hz, hi_hz, id)) AS name FROM p JOIN channels ON lo_hz <= hz AND hz < hi_hz GROUP BY hz),
u AS (SELECT hz, arg_min(b.band_id, (hi_hz - lo_hz, lo_hz, hi_hz, b.band_id)) AS band_id FROM p JOIN bands b ON lo_hz <= hz AND hz < hi_hz WHERE jurisdiction LIKE 'us%' GROUP BY hz)
SELECT s.sighting_id, COALESCE(c.name, NULLIF(l.label, ''), 'No allocation on record') AS summary
FROM SIGHTINGS s LEFT JOIN c ON c.hz = s.hz LEFT JOIN u ON u.hz = s.hz LEFT JOIN labels l ON l.band_id = u.band_id"""


@query("l14_summary", SUMMARY.replace("SIGHTINGS", "sightings"))
def _(t):
    return L.summary(t.sightings, t.channels, t.bands, t.services)


@query("l14_summary_dyadic", SUMMARY.replace("SIGHTINGS", "sightings"))
def _(t):
    return L.summary(t.sightings, t.channels, t.bands, t.services, how="dyadic")


SAID = "said AS (SELECT b.band_id, jurisdiction, lo_hz, hi_hz, COALESCE(string_agg(ordinal || ':' || name || ':' || CASE WHEN is_primary THEN 'true' ELSE 'false' END, '|' ORDER BY ordinal), '') AS services FROM bands b LEFT JOIN services s ON s.band_id = b.band_id GROUP BY ALL)"


@query("l15_collapse_regions", f"""
WITH {SAID}, m AS (SELECT sighting_id, lo_hz, hi_hz, services, substr(jurisdiction, 6, 1) AS r FROM sightings JOIN said ON lo_hz <= hz AND hz < hi_hz WHERE jurisdiction LIKE 'itu-r%')
SELECT sighting_id, lo_hz, hi_hz, services, CASE WHEN count(DISTINCT r) > 1 THEN 'ITU Regions ' || min(r) || '–' || max(r) ELSE 'ITU Region ' || min(r) END AS label
FROM m GROUP BY sighting_id, lo_hz, hi_hz, services""")
def _(t):
    shown = F.transform("services", lambda s: F.concat_ws(":", s["ordinal"].cast("string"), s["name"], s["is_primary"].cast("string")))
    rich = L.band_services(t.bands.select("band_id", "jurisdiction", "lo_hz", "hi_hz"), t.services)
    return L.collapse_regions(K.point_join(t.sightings, rich), "sighting_id").withColumn("services", F.array_join(shown, "|"))


@query("l16_us_allocation", f"""
WITH {LABELS}, {NOTES}, ids AS (SELECT band_id, string_agg(id, ', ' ORDER BY id) AS footnotes FROM notes GROUP BY band_id)
SELECT span_id, b.band_id, COALESCE(label, 'no service listed') AS label, COALESCE(footnotes, '') AS footnotes
FROM spans s JOIN bands b ON b.lo_hz < s.hi_hz AND b.hi_hz > s.lo_hz AND s.lo_hz < s.hi_hz LEFT JOIN labels l ON l.band_id = b.band_id LEFT JOIN ids i ON i.band_id = b.band_id
WHERE jurisdiction LIKE 'us%'""")
def _(t):
    notes = L.band_footnotes(t.bands, t.band_footnote, t.footnote_defs)
    return L.us_allocation(L.bands_in(spans(t), t.bands), t.services, notes).select("span_id", "band_id", "label", "footnotes")


@query("l17_footnote_texts", f"WITH {NOTES} SELECT DISTINCT span_id, id, COALESCE(text, '{L.NO_TEXT}') AS text FROM spans s JOIN bands b ON b.lo_hz < s.hi_hz AND b.hi_hz > s.lo_hz AND s.lo_hz < s.hi_hz JOIN notes n ON n.band_id = b.band_id")
def _(t):
    notes = L.band_footnotes(t.bands, t.band_footnote, t.footnote_defs)
    return L.footnote_texts(L.bands_in(spans(t), t.bands), notes, "span_id")


ANSWER = f"""
WITH {SAID}, {NOTES}, ids AS (SELECT band_id, string_agg(id || '=' || class || '=' || text, ',' ORDER BY id) AS f FROM notes GROUP BY band_id),
c AS (SELECT span_id, string_agg(id, ';' ORDER BY c.hi_hz - c.lo_hz, c.lo_hz, c.hi_hz, id) AS channels FROM spans s JOIN channels c ON c.lo_hz < s.hi_hz AND c.hi_hz > s.lo_hz AND s.lo_hz < s.hi_hz GROUP BY span_id),
b AS (SELECT span_id, string_agg(b.band_id || '/' || services || '/' || COALESCE(f, ''), ';' ORDER BY b.hi_hz - b.lo_hz, b.lo_hz, b.hi_hz, b.band_id) AS bands
      FROM spans s JOIN said b ON b.lo_hz < s.hi_hz AND b.hi_hz > s.lo_hz AND s.lo_hz < s.hi_hz LEFT JOIN ids i ON i.band_id = b.band_id GROUP BY span_id),
r AS (SELECT span_id, string_agg(part || ' ' || name, ';' ORDER BY {PART_NO}, part, name) AS rule_parts
      FROM (SELECT DISTINCT span_id, part, name FROM spans s JOIN rule_parts r ON r.lo_hz < s.hi_hz AND r.hi_hz > s.lo_hz AND s.lo_hz < s.hi_hz) x GROUP BY span_id)
SELECT s.span_id, COALESCE(channels, '') AS channels, COALESCE(bands, '') AS bands, COALESCE(rule_parts, '') AS rule_parts
FROM spans s LEFT JOIN c ON c.span_id = s.span_id LEFT JOIN b ON b.span_id = s.span_id LEFT JOIN r ON r.span_id = s.span_id"""


def answers(t: Tables, probes: DataFrame, probe_id: str) -> DataFrame:
    """Answers as text; points of one frequency have one, which is made once."""
    if "hz" in probes.columns and probe_id != "hz":
        made = answers(t, probes.select("hz").distinct().where("hz is not null"), "hz")
        texts = ("channels", "bands", "rule_parts")
        return probes.select(probe_id, "hz").join(made.hint("merge"), "hz", "left").select(probe_id, *[F.coalesce(c, F.lit("")).alias(c) for c in texts])
    out = L.answer(probes, t.channels.select("id", "lo_hz", "hi_hz", "name"), t.bands, t.services, t.band_footnote, t.footnote_defs, t.rule_parts, probe_id)
    service = lambda s: F.concat_ws(":", s["ordinal"].cast("string"), s["name"], s["is_primary"].cast("string"))
    band = lambda b: F.concat_ws("/", b["band_id"].cast("string"), F.array_join(F.transform(b["services"], service), "|"), F.array_join(F.transform(b["footnotes"], lambda n: F.concat_ws("=", n["id"], n["class"], n["text"])), ","))
    return out.select(
        probe_id, F.array_join(F.transform("channels", lambda c: c["id"]), ";").alias("channels"), F.array_join(F.transform("bands", band), ";").alias("bands"),
        F.array_join(F.transform("rule_parts", lambda r: F.concat_ws(" ", r["part"], r["name"])), ";").alias("rule_parts"),
    )


@query("l18_answer", ANSWER)
def _(t):
    return answers(t, spans(t), "span_id")


@query("l18_answer_at", re.sub(r"\bspan_id\b", "sighting_id", ANSWER.replace("FROM spans s", "FROM (SELECT sighting_id, hz AS lo_hz, hz + 1 AS hi_hz FROM sightings_low) s")))
def _(t):
    return answers(t, t.sightings_low.select("sighting_id", "hz"), "sighting_id")


@query("l19_fmt_hz", "SELECT sighting_id, hz, CASE WHEN abs(hz) >= 1000000000 THEN printf('%g', hz / 1e9) || ' GHz' WHEN abs(hz) >= 1000000 THEN printf('%g', hz / 1e6) || ' MHz' WHEN abs(hz) >= 1000 THEN printf('%g', hz / 1e3) || ' kHz' ELSE hz || ' Hz' END AS shown FROM sightings")
def _(t):
    return t.sightings.select("sighting_id", "hz", H.fmt_hz("hz").alias("shown"))


@query("l20_center_hz", "SELECT id, lo_hz + (hi_hz - lo_hz) // 2 AS center_hz FROM channels")
def _(t):
    return t.channels.select("id", H.center_hz().alias("center_hz"))


# -------------------------------------------------------------------------- validation
UNIQUE = "u AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY jurisdiction, lo_hz, hi_hz ORDER BY seq) AS k FROM bands_faulty) x WHERE k = 1)"
PREV = UNIQUE + ", p AS (SELECT *, lag(lo_hz) OVER w AS prev_lo, lag(hi_hz) OVER w AS prev_hi FROM u WINDOW w AS (PARTITION BY jurisdiction ORDER BY lo_hz, hi_hz))"


@query("v1_dedupe_restated", f"WITH {UNIQUE} SELECT band_id, jurisdiction, lo_hz, hi_hz, seq FROM u")
def _(t):
    return V.dedupe_restated(t.bands_faulty)


@query("v2_tiling_summary", f"""WITH {PREV} SELECT jurisdiction, count(*) AS bands, CAST(sum(CASE WHEN lo_hz > prev_hi THEN 1 ELSE 0 END) AS BIGINT) AS gaps,
CAST(sum(CASE WHEN lo_hz < prev_hi THEN 1 ELSE 0 END) AS BIGINT) AS overlaps, arg_min(lo_hz, (lo_hz, hi_hz)) AS span_lo, arg_max(hi_hz, (lo_hz, hi_hz)) AS span_hi FROM p GROUP BY jurisdiction""")
def _(t):
    return V.tiling_summary(t.bands_faulty)


@query("v3_tiling_issues", f"WITH {PREV} SELECT jurisdiction, CASE WHEN lo_hz > prev_hi THEN 'GAP' ELSE 'OVERLAP' END AS kind, prev_lo, prev_hi, lo_hz, hi_hz FROM p WHERE lo_hz <> prev_hi")
def _(t):
    return V.tiling_issues(t.bands_faulty)


@query("v4_malformed", "SELECT span_id, lo_hz, hi_hz FROM spans WHERE lo_hz >= hi_hz")
def _(t):
    return V.malformed(t.spans)


@query("v5_coverage", "SELECT jurisdiction, arg_min(lo_hz, (lo_hz, hi_hz)) = 0 AS starts, arg_max(hi_hz, (lo_hz, hi_hz)) = 275000000000 AS ends FROM bands GROUP BY jurisdiction")
def _(t):
    return V.coverage(t.bands)


@query("v6_dangling_footnotes", "SELECT footnote_id, count(*) AS citations FROM band_footnote WHERE footnote_id NOT IN (SELECT id FROM footnote_defs) GROUP BY footnote_id")
def _(t):
    return V.dangling_footnotes(t.band_footnote, t.footnote_defs)


SWAPPED = "SELECT id, CASE WHEN length(id) % 4 = 0 THEN 'us' ELSE class END AS class FROM footnote_defs"


@query("v7_footnote_class_mismatch", f"SELECT id, class FROM ({SWAPPED}) x WHERE class <> CASE substr(id, 1, 1) WHEN '5' THEN 'itu' WHEN 'U' THEN 'us' WHEN 'N' THEN 'ng' ELSE 'g' END")
def _(t):
    return V.footnote_class_mismatch(t.sql(SWAPPED))


BROKEN = """SELECT CASE WHEN CAST(substr(id, 4) AS BIGINT) % 50 = 0 THEN 'ch-1' ELSE id END AS id, CASE WHEN CAST(substr(id, 4) AS BIGINT) % 71 = 0 THEN 'xx' ELSE jurisdiction END AS jurisdiction,
CASE WHEN CAST(substr(id, 4) AS BIGINT) % 43 = 0 THEN NULL ELSE lo_hz END AS lo_hz, CASE WHEN CAST(substr(id, 4) AS BIGINT) % 37 = 0 THEN lo_hz WHEN CAST(substr(id, 4) AS BIGINT) % 47 = 0 THEN NULL ELSE hi_hz END AS hi_hz, CASE WHEN CAST(substr(id, 4) AS BIGINT) % 61 = 0 THEN ' ' ELSE service END AS source FROM channels"""


@query("v8_channel_errors", f"""WITH b AS ({BROKEN}) SELECT id, 'duplicate id' AS reason FROM b GROUP BY id HAVING count(*) > 1
UNION ALL SELECT id, 'unknown jurisdiction' FROM b WHERE jurisdiction NOT IN ('us', 'eu') UNION ALL SELECT id, 'unreadable frequency' FROM b WHERE lo_hz IS NULL OR hi_hz IS NULL UNION ALL SELECT id, 'lo >= hi' FROM b WHERE lo_hz >= hi_hz UNION ALL SELECT id, 'blank source' FROM b WHERE trim(source) = ''""")
def _(t):
    return V.channel_errors(t.sql(BROKEN))


@query("v9_population", f"WITH {JURIS} SELECT jid AS jurisdiction, count(band_id) AS n_rows, count(band_id) >= 40 AS enough FROM juris LEFT JOIN bands ON jurisdiction = jid GROUP BY jid")
def _(t):
    return V.population(t.bands, 40)


@query("v10_raster_check", """
WITH c AS (SELECT 'width ' || CAST(hi_hz - lo_hz AS VARCHAR) AS grid, id, lo_hz, hi_hz, lo_hz + (hi_hz - lo_hz) // 2 AS center FROM channels),
s AS (SELECT *, center - lag(center) OVER (PARTITION BY grid ORDER BY lo_hz, hi_hz, id) AS step FROM c)
SELECT grid, count(*) AS channels, min(center) AS first_center, CAST(sum(CASE WHEN step <> 25000 THEN 1 ELSE 0 END) AS BIGINT) AS off_raster FROM s GROUP BY grid""")
def _(t):
    return V.raster_check(t.channels, F.concat(F.lit("width "), (F.col("hi_hz") - F.col("lo_hz")).cast("string")), 25000)


EXPECTED = """SELECT lo_hz + 500000 AS hz, jurisdiction, CASE WHEN band_id % 11 = 0 THEN lo_hz + 1 ELSE lo_hz END AS want_lo, hi_hz AS want_hi, CASE WHEN band_id % 3 = 0 THEN 'STEEL' ELSE 'a' END AS contains FROM bands"""


@query("v11_expect_at", f"""
WITH e AS ({EXPECTED}), n AS (SELECT band_id, string_agg(name, ' ' ORDER BY ordinal) AS names FROM services GROUP BY band_id),
f AS (SELECT e.hz, e.jurisdiction, want_lo, want_hi, contains, arg_min(b.band_id, seq) AS band_id FROM e JOIN bands b ON b.jurisdiction = e.jurisdiction AND b.lo_hz <= e.hz AND e.hz < b.hi_hz GROUP BY ALL)
SELECT e.hz, e.jurisdiction, e.want_lo, e.want_hi, e.contains, COALESCE(b.lo_hz = e.want_lo AND b.hi_hz = e.want_hi AND COALESCE(contains(names, e.contains), FALSE), FALSE) AS passed
FROM e LEFT JOIN f ON f.hz = e.hz AND f.jurisdiction = e.jurisdiction AND f.want_lo = e.want_lo AND f.want_hi = e.want_hi AND f.contains = e.contains LEFT JOIN bands b ON b.band_id = f.band_id LEFT JOIN n ON n.band_id = f.band_id""")
def _(t):
    return V.expect_at(t.sql(EXPECTED), t.bands, t.services)


@query("v12_diff_builds", """
SELECT *, 'a' AS side FROM (SELECT * FROM bands EXCEPT ALL SELECT * FROM bands_faulty) x UNION ALL SELECT *, 'b' FROM (SELECT * FROM bands_faulty EXCEPT ALL SELECT * FROM bands) y""")
def _(t):
    return V.diff_builds(t.bands, t.bands_faulty)


#: A build with one band changed and one that comes twice.
EDITED = "SELECT band_id, jurisdiction, lo_hz, CASE WHEN band_id = 77 THEN hi_hz + 5 ELSE hi_hz END AS hi_hz, seq FROM bands UNION ALL SELECT band_id, jurisdiction, lo_hz, hi_hz, seq FROM bands WHERE band_id = 150"


@query("v12_diff_by_ranges", f"""WITH edited AS ({EDITED})
SELECT *, 'a' AS side FROM (SELECT * FROM bands EXCEPT ALL SELECT * FROM edited) x UNION ALL SELECT *, 'b' FROM (SELECT * FROM edited EXCEPT ALL SELECT * FROM bands) y""")
def _(t):
    return V.diff_by_ranges(t.bands, t.sql(EDITED), "band_id")


def chunk_rows(t: Tables, source: DataFrame | None = None) -> DataFrame:
    """Chunks of the fixture's cells, which have no table place of their own."""
    cells = (source or t.cells).select(F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("table_index"), F.col("seq").cast("long").alias("row_index"), F.lit(0).alias("cell_index"), F.array(F.lit("us_federal")).alias("columns"), "text", "unit")
    return A.chunks(cells)


# Cells cut as P9 says, in SQL: a chunk for each range line if there are two, else one.
LINES = r"""
lines AS (SELECT seq, unit, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS i, text FROM cells),
spans_ AS (SELECT *, regexp_matches(replace(line, ' (Not Allocated)', ''), '^[\d.]+-[\d.]+$') AS is_range FROM lines),
parts AS (SELECT *, CAST(sum(CASE WHEN is_range THEN 1 ELSE 0 END) OVER (PARTITION BY seq ORDER BY i) - 1 AS INTEGER) AS chunk FROM spans_),
heads AS (SELECT seq, chunk, CAST(round(CAST(split_part(replace(line, ' (Not Allocated)', ''), '-', 1) AS DOUBLE) * 1e6) AS BIGINT) AS lo_hz,
                 CAST(round(CAST(split_part(replace(line, ' (Not Allocated)', ''), '-', 2) AS DOUBLE) * 1e6) AS BIGINT) AS hi_hz, contains(line, 'Not Allocated') AS not_allocated FROM parts WHERE is_range)"""


#: Cells of which some say nothing and others have a range the wrong way round.
SPOILT = "SELECT seq, unit, CASE WHEN seq % 31 = 0 THEN '. ,' WHEN seq % 37 = 0 THEN CONCAT(CAST(seq + 5 AS VARCHAR(20)), '-', CAST(seq AS VARCHAR(20)), CHR(10), 'FIXED') ELSE text END AS text FROM cells"


@query("v13_parse_problems", f"WITH spoilt AS ({SPOILT}), " + LINES.strip().replace("FROM cells)", "FROM spoilt WHERE seq % 31 <> 0)") + """
SELECT 'tbl0:row' || seq AS source, 'non-increasing range ' || lo_hz || '-' || hi_hz AS problem FROM heads WHERE lo_hz >= hi_hz
UNION ALL SELECT 'tbl0:row' || seq, 'unparsed cell ' || text FROM spoilt WHERE seq % 31 = 0""")
def _(t):
    return V.parse_problems(chunk_rows(t, t.sql(SPOILT)))


# ----------------------------------------------------------------------------- parsing
@query("p1_normalize_text", r"""
SELECT doc_id, table_index, row_index, cell_index, list_aggregate(list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(regexp_replace(x, '[ \x{00A0}]+', ' ', 'g'))), lambda x: x <> ''), 'string_agg', chr(10)) AS text
FROM grid_cells""".replace("list_aggregate(", "COALESCE(list_aggregate(").replace("chr(10)) AS text", "chr(10)), '') AS text"))
def _(t):
    return t.grid_cells.select("doc_id", "table_index", "row_index", "cell_index", C.normalize_text(F.col("text")).alias("text"))


GRIDS = "SELECT DISTINCT doc_id, table_index, 100 + doc_id AS w FROM grid_cells"


@query("p2_place_cells", f"""
WITH g AS ({GRIDS}), c AS (SELECT *, CAST(COALESCE(sum(span) OVER (PARTITION BY doc_id, table_index, row_index ORDER BY cell_index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS INTEGER) AS col FROM grid_cells)
SELECT c.doc_id, c.table_index, c.row_index, cell_index, col, CAST(least(col, 4) * w AS DOUBLE) / (4 * w) AS x0, CAST(least(col + span, 4) * w AS DOUBLE) / (4 * w) AS x1
FROM c JOIN g ON g.doc_id = c.doc_id AND g.table_index = c.table_index""")
def _(t):
    grids = t.sql(GRIDS).select("doc_id", "table_index", F.array_repeat(F.col("w").cast("int"), 4).alias("widths"))
    return G.place_cells(t.grid_cells, grids).select("doc_id", "table_index", "row_index", "cell_index", "col", "x0", "x1")


@query("p3_inherit_merged", """
SELECT doc_id, table_index, row_index, cell_index, CASE WHEN merged_up AND text = '' THEN COALESCE(last_value(CASE WHEN NOT merged_up THEN text END IGNORE NULLS)
  OVER (PARTITION BY doc_id, table_index, cell_index = 0, CASE WHEN cell_index = 2 THEN 1 + w ELSE cell_index END ORDER BY row_index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') ELSE text END AS text
FROM (SELECT *, max(CASE WHEN cell_index = 1 THEN span END) OVER (PARTITION BY doc_id, table_index, row_index) AS w FROM grid_cells) x""")
def _(t):
    grids = t.sql(GRIDS).select("doc_id", "table_index", F.array_repeat(F.col("w").cast("int"), 4).alias("widths"))
    return G.inherit_merged(G.place_cells(t.grid_cells, grids)).select("doc_id", "table_index", "row_index", "cell_index", "text")


#: Some rows have the title twice, the first time without a range; in others white space parts a number, which opens nothing.
TITLED = """SELECT doc_id, table_index, row_index, cell_index, CASE WHEN row_index % 21 = 0 THEN REPLACE(text, 'Table of Frequency', 'Table of Frequency Allocations (cont.) Table of Frequency')
WHEN row_index % 35 = 0 THEN REPLACE(text, '-99.5', ' 5-99.5') WHEN row_index % 28 = 0 THEN REPLACE(text, '-99.5', ' - 99.5') ELSE text END AS text FROM grid_cells"""


@query("p4_sections", rf"""
WITH titled AS ({TITLED}), r AS (SELECT doc_id, table_index, row_index, string_agg(text, chr(10) ORDER BY cell_index) AS joined FROM titled GROUP BY ALL),
o AS (SELECT *, regexp_extract(joined, 'Table of Frequency Allocations\s+[\d.]+\s*-\s*[\d.]+\s*(kHz|MHz|GHz)', 1) AS unit FROM r),
f AS (SELECT *, last_value(NULLIF(unit, '') IGNORE NULLS) OVER w AS u FROM o WINDOW w AS (PARTITION BY doc_id ORDER BY table_index, row_index))
SELECT c.doc_id, c.table_index, c.row_index, cell_index, COALESCE(u, 'kHz') AS unit, CASE WHEN u IS NULL THEN '' ELSE 'VHF' END AS section_label
FROM grid_cells c JOIN f ON f.doc_id = c.doc_id AND f.table_index = c.table_index AND f.row_index = c.row_index WHERE f.unit = ''""")
def _(t):
    return G.sections(t.sql(TITLED)).select("doc_id", "table_index", "row_index", "cell_index", "unit", "section_label")


#: Grid cells with pages of seven columns: a heading row for every ninth part, rows of bands below.
PAGES = """
SELECT p_partkey % 20 AS doc_id, CAST(p_size AS BIGINT) AS table_index, p_partkey AS row_index, c AS cell_index, 1 AS span, FALSE AS merged_up,
  CASE WHEN p_partkey % 9 = 0 THEN CASE c WHEN 0 THEN 'Region 1 Table' WHEN 1 THEN 'Region 2 Table' WHEN 2 THEN 'Region 3 Table' WHEN 3 THEN 'Federal Table' WHEN 4 THEN 'Non-Federal Table' ELSE 'FCC Rule Part(s)' END
       WHEN p_partkey % 9 = 1 THEN CASE WHEN c = 0 THEN 'International Table' ELSE '' END
       WHEN c = 5 THEN CASE WHEN p_partkey % 4 = 0 THEN CONCAT('Aviation (87', CASE WHEN p_size % 2 = 0 THEN 'F' ELSE '' END, ')') ELSE '' END
       WHEN p_partkey % 9 = 2 AND c > 2 THEN CONCAT('US', CAST(p_size AS VARCHAR(20)), CASE WHEN c = 4 THEN CONCAT(' NG', CAST(p_size AS VARCHAR(20))) ELSE ' G7' END)
       ELSE CONCAT(CAST(p_partkey AS VARCHAR(20)), '-', CAST(p_partkey + p_size AS VARCHAR(20)), CHR(10), UPPER(p_name), CHR(10), '5.', CAST(p_size AS VARCHAR(20)),
            CASE WHEN c = 3 THEN '  G5' WHEN c = 4 THEN '  NG4' ELSE '' END) END AS text,
  (c * 100 + CASE WHEN p_partkey % 18 = 0 AND c > 0 THEN 20 ELSE 0 END) / 600.0 AS x0, ((c + 1) * 100 + CASE WHEN p_partkey % 18 = 0 AND c < 5 THEN 20 ELSE 0 END) / 600.0 AS x1
FROM part CROSS JOIN (SELECT 0 AS c UNION ALL SELECT 1 UNION ALL SELECT 2 UNION ALL SELECT 3 UNION ALL SELECT 4 UNION ALL SELECT 5) k"""


def pages(t: Tables) -> DataFrame:
    rows = t.sql(PAGES)
    return rows.withColumns({"x0": F.col("x0").cast("double"), "x1": F.col("x1").cast("double"), "cell_index": F.col("cell_index").cast("int")})


BOUNDED = f"""pages AS ({PAGES}),
r AS (SELECT doc_id, table_index, row_index, bool_or(text = 'Region 1 Table') AS head, list(round(CAST(x0 AS DOUBLE), 4) ORDER BY cell_index) || [1.0::DOUBLE] AS b FROM pages GROUP BY ALL),
f AS (SELECT *, last_value(CASE WHEN head THEN b END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY table_index, row_index) AS u FROM r)"""


@query("p5_column_bounds", f"WITH {BOUNDED} SELECT p.doc_id, p.table_index, p.row_index, cell_index, list_aggregate(list_transform(COALESCE(u, [0.0, 0.148, 0.317, 0.503, 0.702, 0.88, 1.0]::DOUBLE[]), lambda x: CAST(CAST(round(x * 10000) AS BIGINT) AS VARCHAR)), 'string_agg', ' ') AS bounds FROM pages p JOIN f ON f.doc_id = p.doc_id AND f.table_index = p.table_index AND f.row_index = p.row_index WHERE NOT head")
def _(t):
    shown = F.array_join(F.transform("bounds", lambda x: F.rint(x * 10000).cast("long").cast("string")), " ")
    return G.column_bounds(pages(t)).select("doc_id", "table_index", "row_index", "cell_index", shown.alias("bounds"))


@query("p6_drop_headers", f"WITH pages AS ({PAGES}), h AS (SELECT DISTINCT doc_id, table_index, row_index FROM pages WHERE contains(text, 'Table') OR contains(text, 'FCC Rule')) SELECT doc_id, table_index, row_index, cell_index, text FROM pages WHERE (doc_id, table_index, row_index) NOT IN (SELECT (doc_id, table_index, row_index) FROM h)")
def _(t):
    return G.drop_headers(pages(t)).select("doc_id", "table_index", "row_index", "cell_index", "text")


def assigned(t: Tables) -> DataFrame:
    return G.assign_columns(G.drop_headers(G.column_bounds(G.sections(pages(t)))))


#: The choice of columns as a recursion over the rows of a document: all placements of a row's cells are scored with the state before it.
CHOICE = rf"""
WITH RECURSIVE {BOUNDED},
h AS (SELECT DISTINCT doc_id, table_index, row_index FROM pages WHERE contains(text, 'Table') OR contains(text, 'FCC Rule')),
c AS (SELECT p.doc_id, p.table_index, p.row_index, cell_index, text, split_part(text, chr(10), 1) AS line, COALESCE(u, [0.0, 0.148, 0.317, 0.503, 0.702, 0.88, 1.0]::DOUBLE[]) AS b, CAST(x0 AS DOUBLE) AS x0, CAST(x1 AS DOUBLE) AS x1
      FROM pages p JOIN f ON f.doc_id = p.doc_id AND f.table_index = p.table_index AND f.row_index = p.row_index
      WHERE text <> '' AND (p.doc_id, p.table_index, p.row_index) NOT IN (SELECT (doc_id, table_index, row_index) FROM h)),
told AS (SELECT *, CASE WHEN regexp_matches(line, '^\d+-\d+$') THEN CAST(split_part(line, '-', 1) AS BIGINT) * 1000 END AS lo, CASE WHEN regexp_matches(line, '^\d+-\d+$') THEN CAST(split_part(line, '-', 2) AS BIGINT) * 1000 END AS hi,
         [2.0 * (greatest(0.0, least(x1, b[k + 1]) - greatest(x0, b[k])) / (b[k + 1] - b[k])) - 1.0 for k in [1, 2, 3, 4, 5, 6]] AS e,
         [regexp_matches(text, '\bG\d+[A-Z]*\b'), regexp_matches(text, '\bNG\d+[A-Z]*\b'), regexp_matches(text, '\bUS\d+[A-Z]*\b'), regexp_matches(text, '^[^\n]+\(\d+[A-Z]?\)$')] AS says FROM c),
page_rows AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY table_index, row_index) AS rn FROM (SELECT doc_id, table_index, row_index, count(*) AS n, list(struct_pack(lo := lo, hi := hi, e := e, says := says, i := cell_index) ORDER BY cell_index) AS cells FROM told GROUP BY doc_id, table_index, row_index) listed),
pl AS (SELECT 0 AS n, CAST([] AS STRUCT(a BIGINT, z BIGINT)[]) AS runs, CAST([] AS BIGINT[]) AS k, 1::BIGINT AS nxt
       UNION ALL SELECT n + 1, list_append(runs, struct_pack(a := x.a, z := y.z)), list_concat(k, [-x.a, y.z]), y.z + 1 FROM pl, range(1, 7) x(a), range(1, 7) y(z) WHERE n < 6 AND x.a >= nxt AND y.z >= x.a),
w AS (SELECT doc_id, 0::BIGINT AS rn, CAST([NULL, NULL, NULL, NULL, NULL, NULL] AS STRUCT(lo BIGINT, hi BIGINT)[]) AS st, CAST(NULL AS STRUCT(a BIGINT, z BIGINT)[]) AS runs FROM page_rows GROUP BY doc_id
      UNION ALL
      SELECT doc_id, rn + 1, list_transform([1, 2, 3, 4, 5, 6], lambda k: COALESCE(list_filter(list_transform(range(1, len(cells) + 1), lambda i: CASE WHEN runs[i].a <= k AND k <= runs[i].z AND cells[i].lo IS NOT NULL THEN struct_pack(lo := cells[i].lo, hi := cells[i].hi) END), lambda x: x IS NOT NULL)[1], st[k])), runs
      FROM (SELECT w.doc_id, w.rn, w.st, q.cells, arg_min(pl.runs, struct_pack(s := -list_reduce(list_concat([0.0::DOUBLE], list_reverse(list_transform(range(1, q.n + 1), lambda i:
              list_reduce(q.cells[i].e[pl.runs[i].a:pl.runs[i].z], lambda x, y: x + y)
              + list_sum(list_transform([1, 2, 3, 4], lambda t: CASE WHEN NOT q.cells[i].says[t] THEN 0.0 WHEN CASE t WHEN 1 THEN pl.runs[i].a <= 4 AND pl.runs[i].z >= 4 WHEN 2 THEN pl.runs[i].a <= 5 AND pl.runs[i].z >= 5
                           WHEN 3 THEN pl.runs[i].a <= 5 AND pl.runs[i].z >= 4 ELSE pl.runs[i].z = 6 END THEN 2.0 ELSE -100.0 END))
              + CASE WHEN q.cells[i].lo IS NULL THEN 0.0 ELSE list_sum(list_transform(w.st[pl.runs[i].a:pl.runs[i].z], lambda s: CASE WHEN s IS NULL THEN 0.0 WHEN q.cells[i].lo = s.hi THEN 3.0 WHEN q.cells[i].lo = s.lo THEN 1.0 ELSE -2.0 END)) END))),
              lambda x, y: y + x), k := pl.k)) AS runs
            FROM w JOIN page_rows q ON q.doc_id = w.doc_id AND q.rn = w.rn + 1 JOIN pl ON pl.n = q.n GROUP BY w.doc_id, w.rn, w.st, q.cells) best)
SELECT q.doc_id, q.table_index, q.row_index, q.cells[g.i].i AS cell_index,
       array_to_string((['itu_r1', 'itu_r2', 'itu_r3', 'us_federal', 'us_non_federal', 'fcc_parts'])[w.runs[g.i].a:w.runs[g.i].z], ',') AS columns
FROM w JOIN page_rows q ON q.doc_id = w.doc_id AND q.rn = w.rn, range(1, 7) g(i) WHERE g.i <= q.n
"""


@query("p7_assign_columns", CHOICE)
def _(t):
    return assigned(t).select("doc_id", "table_index", "row_index", "cell_index", F.array_join("columns", ",").alias("columns"))


@query("p8_parse_range", f"WITH {LINES} SELECT seq, CAST(i AS INTEGER) AS i, CASE WHEN is_range THEN CAST(round(CAST(split_part(replace(line, ' (Not Allocated)', ''), '-', 1) AS DOUBLE) * 1e6) AS BIGINT) END AS lo_hz, CASE WHEN is_range THEN CAST(round(CAST(split_part(replace(line, ' (Not Allocated)', ''), '-', 2) AS DOUBLE) * 1e6) AS BIGINT) END AS hi_hz FROM spans_")
def _(t):
    rows = t.cells.select("seq", "unit", F.posexplode(F.split("text", "\n")).alias("i", "line"))
    return rows.select("seq", "i", C.parse_range(F.col("line"), F.col("unit")).alias("r")).select("seq", "i", "r.lo_hz", "r.hi_hz")


@query("p9_split_bands", f"WITH {LINES} SELECT h.seq, h.chunk, lo_hz, hi_hz, CASE WHEN (SELECT max(chunk) FROM heads k WHERE k.seq = h.seq) = 0 THEN min(p.text) ELSE string_agg(p.line, chr(10) ORDER BY p.i) END AS raw_text FROM heads h JOIN parts p ON p.seq = h.seq AND p.chunk = h.chunk GROUP BY h.seq, h.chunk, lo_hz, hi_hz")
def _(t):
    return chunk_rows(t).select(F.col("row_index").alias("seq"), "chunk", "lo_hz", "hi_hz", "raw_text")


JOINED = LINES + r""",
body AS (SELECT seq, chunk, line, row_number() OVER (PARTITION BY seq, chunk ORDER BY i) AS k FROM parts WHERE NOT is_range),
glue AS (SELECT *, lag(line) OVER (PARTITION BY seq, chunk ORDER BY k) AS before FROM body),
sep AS (SELECT *, CASE WHEN before IS NULL THEN '' WHEN before LIKE '%-' THEN '' WHEN regexp_matches(line, '^(\(|[a-z])') THEN ' ' ELSE chr(10) END || line AS piece FROM glue),
whole AS (SELECT seq, chunk, string_agg(piece, '' ORDER BY k) AS body FROM sep GROUP BY seq, chunk)"""


@query("p10_rejoin_lines", f"WITH {JOINED} SELECT h.seq, h.chunk, COALESCE(w.body, '') AS body FROM heads h LEFT JOIN whole w ON w.seq = h.seq AND w.chunk = h.chunk")
def _(t):
    body = C.lines_of(F.col("raw_text"))
    cut = F.slice(body, F.lit(2), F.greatest(F.size(body) - 1, F.lit(0)))
    return chunk_rows(t).select(F.col("row_index").alias("seq"), "chunk", F.array_join(C.rejoin_lines_once(cut), "\n").alias("body"))


FOOT = r"'(5\.\d+[A-Z]*|US\d+[A-Z]*|NG\d+[A-Z]*|G\d+[A-Z]*)'"


@query("p11_extract_footnotes", rf"WITH {LINES} SELECT seq, CAST(i AS INTEGER) AS i, COALESCE(list_aggregate(regexp_extract_all(line, '\b' || {FOOT} || '\b'), 'string_agg', ' '), '') AS ids FROM lines")
def _(t):
    rows = t.cells.select("seq", F.posexplode(F.split("text", "\n")).alias("i", "line"))
    return rows.select("seq", "i", F.array_join(C.extract_footnotes(F.col("line")), " ").alias("ids"))


TOLD = JOINED + rf""",
says AS (SELECT seq, chunk, unnest(string_split(body, chr(10))) AS line, unnest(range(len(string_split(body, chr(10))))) AS k FROM whole),
marked AS (SELECT *, trim(regexp_replace(line, '\b' || {FOOT} || '\b', '', 'g')) = '' AS only_ids FROM says),
named AS (SELECT seq, chunk, k, trim(regexp_replace(regexp_replace(line, '\b' || {FOOT} || '\b', '', 'g'), '\s{{2,}}', ' ', 'g'), ' .,') AS name,
                 COALESCE(list_aggregate(regexp_extract_all(line, '\b' || {FOOT} || '\b'), 'string_agg', ' '), '') AS ids FROM marked WHERE NOT only_ids),
first_word AS (SELECT *, regexp_extract(name, '(?:^|\s)([A-Za-z]\S*)', 1) AS word FROM named)"""


@query("p12_parse_services", f"""WITH {TOLD}
SELECT h.seq, h.chunk, COALESCE((SELECT string_agg(name || '[' || ids || ']', ';' ORDER BY k) FROM named n WHERE n.seq = h.seq AND n.chunk = h.chunk), '') AS services,
       COALESCE((SELECT string_agg(line, ' ' ORDER BY k) FROM (SELECT k, list_aggregate(regexp_extract_all(line, {FOOT}), 'string_agg', ' ') AS line, seq, chunk FROM marked WHERE only_ids) m WHERE m.seq = h.seq AND m.chunk = h.chunk), '') AS footnotes
FROM heads h""")
def _(t):
    shown = F.transform("services", lambda s: F.concat(s["name"], F.lit("["), F.array_join(s["footnotes"], " "), F.lit("]")))
    return chunk_rows(t).select(F.col("row_index").alias("seq"), "chunk", F.array_join(shown, ";").alias("services"), F.array_join("footnotes", " ").alias("footnotes"))


@query("p13_is_primary", rf"WITH {TOLD} SELECT seq, chunk, name, regexp_matches(regexp_replace(word, '[^A-Za-z]', '', 'g'), '^[A-Z]{{2,}}$') AS is_primary FROM first_word WHERE name <> ''")
def _(t):
    return chunk_rows(t).select(F.col("row_index").alias("seq"), "chunk", F.explode("services").alias("s")).select("seq", "chunk", "s.name", "s.is_primary")


@query("p14_not_allocated", f"WITH {LINES} SELECT seq, chunk, not_allocated FROM heads")
def _(t):
    return chunk_rows(t).select(F.col("row_index").alias("seq"), "chunk", "not_allocated")


POINTING = "SELECT seq, unit, CASE WHEN seq % 13 = 0 THEN CONCAT(text, ' (See Previous Page)') ELSE text END AS text FROM cells"


@query("p15_drop_pointers", f"SELECT seq, text FROM ({POINTING}) x WHERE NOT contains(lower(text), 'see previous page')")
def _(t):
    return A.drop_pointers(t.sql(POINTING)).select("seq", "text")


#: Assigned cells: every fourth a rule part, every seventh a spill without a range.
ASSIGNED = """
SELECT p_partkey % 19 AS doc_id, CAST(p_size AS BIGINT) AS table_index, p_partkey AS row_index, 0 AS cell_index, 'MHz' AS unit,
  CASE WHEN p_partkey % 4 = 0 THEN 'fcc_parts' WHEN p_partkey % 4 = 1 THEN 'us_federal' WHEN p_partkey % 4 = 2 THEN 'us_non_federal' ELSE 'itu_r1' END AS col,
  CASE WHEN p_partkey % 4 = 0 THEN CONCAT('Land', CHR(10), 'mobile (', CAST(p_size AS VARCHAR(20)), CASE WHEN p_size % 3 = 0 THEN 'D' ELSE '' END, ')')
       WHEN p_partkey % 7 = 0 THEN CONCAT(UPPER(p_name), CHR(10), '5.', CAST(p_partkey % 5 AS VARCHAR(20)))
       ELSE CONCAT(CAST(p_partkey AS VARCHAR(20)), '-', CAST(p_partkey + p_size AS VARCHAR(20)), CHR(10), UPPER(p_name), CHR(10), '5.', CAST(p_size % 5 AS VARCHAR(20))) END AS text
FROM part"""


def assigned_rows(t: Tables) -> DataFrame:
    return t.sql(ASSIGNED).withColumn("columns", F.array("col"))


@query("p16_rule_parts", rf"""
WITH a AS ({ASSIGNED}),
k AS (SELECT *, CASE WHEN col <> 'fcc_parts' AND regexp_matches(text, '^\d') THEN row_index END AS own FROM a),
f AS (SELECT *, last_value(own IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY table_index, row_index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS src FROM k)
SELECT f.doc_id, f.row_index, regexp_extract(f.text, '\((\d+[A-Z]?)\)', 1) AS part, 'Land mobile' AS name, CAST(split_part(split_part(s.text, chr(10), 1), '-', 1) AS BIGINT) * 1000000 AS lo_hz, CAST(split_part(split_part(s.text, chr(10), 1), '-', 2) AS BIGINT) * 1000000 AS hi_hz
FROM f JOIN a s ON s.row_index = f.src WHERE f.col = 'fcc_parts'""")
def _(t):
    return A.rule_parts(assigned_rows(t)).select("doc_id", "row_index", "part", "name", "lo_hz", "hi_hz")


def folded(t: Tables) -> DataFrame:
    rows = assigned_rows(t)
    return A.fold_spills(A.chunks(A.band_cells(rows, A.rule_parts(rows))))


FOLDED = rf"""a AS ({ASSIGNED}),
c AS (SELECT *, regexp_matches(text, '^\d') AS ranged FROM a WHERE col <> 'fcc_parts'),
n AS (SELECT *, sum(CASE WHEN ranged THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, col ORDER BY table_index, row_index) AS no FROM c),
i AS (SELECT *, string_split(text, chr(10)) AS l FROM n WHERE no > 0),
s AS (SELECT doc_id, col, no, name, min(ord) AS ord FROM (SELECT doc_id, col, no, (table_index, row_index) AS ord, CASE WHEN ranged THEN l[2] ELSE l[1] END AS name FROM i) x GROUP BY ALL),
f AS (SELECT doc_id, col, no, id, min(ord) AS ord FROM (SELECT doc_id, col, no, (table_index, row_index) AS ord, CASE WHEN ranged THEN l[3] ELSE l[2] END AS id FROM i) x GROUP BY ALL),
sj AS (SELECT doc_id, col, no, string_agg(name, ';' ORDER BY ord) AS services FROM s GROUP BY ALL),
fj AS (SELECT doc_id, col, no, string_agg(id, ';' ORDER BY ord) AS footnotes FROM f GROUP BY ALL),
b AS (SELECT i.doc_id, i.col, row_index, CAST(split_part(l[1], '-', 1) AS BIGINT) * 1000000 AS lo_hz, CAST(split_part(l[1], '-', 2) AS BIGINT) * 1000000 AS hi_hz, table_index, services, footnotes
      FROM i JOIN sj ON sj.doc_id = i.doc_id AND sj.col = i.col AND sj.no = i.no JOIN fj ON fj.doc_id = i.doc_id AND fj.col = i.col AND fj.no = i.no WHERE ranged)"""


@query("p17_fold_spills", f'WITH {FOLDED} SELECT doc_id, col AS "column", row_index, lo_hz, hi_hz, services, footnotes FROM b')
def _(t):
    names = F.array_join(F.transform("services", lambda s: s["name"]), ";")
    return folded(t).select("doc_id", "column", "row_index", "lo_hz", "hi_hz", names.alias("services"), F.array_join("footnotes", ";").alias("footnotes"))


@query("p18_to_bands", f"WITH {FOLDED} SELECT doc_id, replace(replace(col, '_', '-'), 'us-non-', 'us-non-') AS jurisdiction, 'tbl' || table_index || ':row' || row_index AS source, lo_hz, hi_hz FROM b")
def _(t):
    return A.to_bands(folded(t)).select("doc_id", "jurisdiction", "source", "lo_hz", "hi_hz")


NOTES_SQL = r"""
SELECT doc_id, '5.' || (doc_id % 90 + 1) AS id, 'itu' AS class,
  trim(substr(source, 1, 10)) || CASE WHEN doc_id % 3 = 0 THEN chr(10) || '[table omitted -- see source document]' ELSE COALESCE(chr(10) || lang, '') END
  || CASE WHEN doc_id % 4 = 0 THEN '' ELSE chr(10) || '(i) first item' || chr(10) || 'trailing paragraph' END AS text FROM documents
UNION ALL SELECT doc_id, 'US' || (doc_id % 50) || 'A', 'us', CASE WHEN doc_id % 5 = 0 THEN 'later' ELSE lang END FROM documents
UNION ALL SELECT doc_id, 'US' || (doc_id % 50) || 'B', 'us', 'later' FROM documents WHERE doc_id % 5 <> 0"""


@query("p19_parse_footnotes", NOTES_SQL)
def _(t):
    return A.parse_footnotes(t.blocks)


#: Revision lines in the first blocks, in none, and only after the blocks that are looked at.
REVISED = """SELECT doc_id, CASE WHEN doc_id % 4 = 1 AND block_index = 0 THEN 60 ELSE block_index END AS block_index, kind,
CASE WHEN block_index > 0 THEN text WHEN doc_id % 4 = 0 THEN 'no revision' ELSE CONCAT('Revised on ', CAST(doc_id % 28 + 1 AS VARCHAR(20)), ' May 2026 ') END AS text FROM blocks
UNION ALL SELECT doc_id, 10 + i + 6 * j, 'p', 'more' FROM documents CROSS JOIN (SELECT 0 AS i UNION ALL SELECT 1 UNION ALL SELECT 2 UNION ALL SELECT 3 UNION ALL SELECT 4 UNION ALL SELECT 5) a
CROSS JOIN (SELECT 0 AS j UNION ALL SELECT 1 UNION ALL SELECT 2 UNION ALL SELECT 3 UNION ALL SELECT 4 UNION ALL SELECT 5) b"""


@query("p20_source_revision", "SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN 'unknown' WHEN doc_id % 4 = 1 THEN 'unknown' ELSE (doc_id % 28 + 1) || ' May 2026' END AS revision FROM documents")
def _(t):
    return A.source_revision(t.sql(REVISED))


# -------------------------------------------------------------------- normal forms
@query("n1_number_bands", "SELECT seq, jurisdiction, row_number() OVER (ORDER BY jurisdiction, lo_hz, hi_hz, seq) AS band_id FROM bands")
def _(t):
    return N.number_bands(t.bands.drop("band_id"), ["jurisdiction", "lo_hz", "hi_hz", "seq"]).select("seq", "jurisdiction", "band_id")


def nested(t: Tables) -> DataFrame:
    return S.nested_bands(t.bands, t.services, t.band_footnote).withColumn("services", F.transform("services", lambda s: F.struct(s["name"].alias("name"), s["primary"].alias("is_primary"), s["footnotes"].alias("footnotes"))))


@query("n2_service_rows", "SELECT s.band_id, ordinal, name, is_primary FROM services s JOIN bands b ON b.band_id = s.band_id")
def _(t):
    return N.service_rows(nested(t))


@query("n3_band_footnote_rows", "SELECT f.band_id, footnote_id, scope, service_ordinal FROM band_footnote f JOIN bands b ON b.band_id = f.band_id")
def _(t):
    return N.band_footnote_rows(nested(t))


@query("n4_footnote_dim", """
WITH e AS (SELECT footnote_id AS id FROM band_footnote UNION SELECT id FROM footnote_defs)
SELECT e.id, COALESCE(f.class, CASE substr(e.id, 1, 1) WHEN '5' THEN 'itu' WHEN 'U' THEN 'us' WHEN 'N' THEN 'ng' WHEN 'G' THEN 'g' ELSE 'itu' END) AS class, f.text FROM e LEFT JOIN footnote_defs f ON f.id = e.id""")
def _(t):
    return N.footnote_dim(t.band_footnote, t.footnote_defs)


@query("n5_meta", """
SELECT 'band_count' AS key, CAST(count(*) AS VARCHAR) AS value FROM bands UNION ALL SELECT 'channel_count', CAST(count(*) AS VARCHAR) FROM channels
UNION ALL SELECT 'footnote_count', CAST(count(*) AS VARCHAR) FROM footnote_defs UNION ALL SELECT 'rule_part_count', CAST(count(*) AS VARCHAR) FROM rule_parts
UNION ALL SELECT 'source_revision', 'unknown' UNION ALL SELECT 'frequency_unit', 'hertz' UNION ALL SELECT 'interval_convention', 'half-open [lo_hz, hi_hz)'""")
def _(t):
    return N.meta(t.bands, t.channels, t.footnote_defs, t.rule_parts)


@query("n6_jurisdictions", f"WITH {JURIS} SELECT band_id, jname AS name, authority, country, CAST(itu_region AS INTEGER) AS itu_region, CAST(code AS INTEGER) AS code FROM bands JOIN juris ON jid = jurisdiction")
def _(t):
    names = H.jurisdictions(t.spark).withColumnRenamed("id", "jurisdiction")
    return t.bands.join(F.broadcast(names), "jurisdiction").select("band_id", "name", "authority", "country", "itu_region", "code")


@query("n7_mhz_to_hz", "SELECT l_orderkey, l_linenumber, CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * 1000000 AS BIGINT) AS decimal_hz, CAST(round_even(CAST(l_extendedprice AS DOUBLE) * 1e6, 0) AS BIGINT) AS double_hz FROM lineitem")
def _(t):
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    return t.lineitem.select("l_orderkey", "l_linenumber", H.mhz_to_hz(F.concat(F.lit(" "), price.cast("string"), F.lit(" "))).alias("decimal_hz"), H.query_mhz_to_hz(F.col("l_extendedprice")).alias("double_hz"))


@query("n8_channel_from_center", "SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 1000000 AS BIGINT) - 6250 AS lo_hz, CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 1000000 AS BIGINT) + 6250 AS hi_hz FROM orders")
def _(t):
    rows = t.orders.select("o_orderkey", F.col("o_totalprice").cast("decimal(18,2)").alias("center"), F.lit("12.5").alias("bw"))
    return H.channel_from_center(rows, "center", "bw").select("o_orderkey", "lo_hz", "hi_hz")


@query("n9_raster", """
WITH g AS (SELECT 'pmr-' || lpad(CAST(i + 1 AS VARCHAR), 2, '0') AS id, 446006250 + i * 12500 - 6250 AS lo_hz, 446006250 + i * 12500 + 6250 AS hi_hz FROM range(16) t(i))
SELECT g.id, g.lo_hz, g.hi_hz, count(s.hz) AS sightings FROM g LEFT JOIN (SELECT 446000000 + hz % 200000 AS hz FROM sightings) s ON s.hz >= g.lo_hz AND s.hz < g.hi_hz GROUP BY g.id, g.lo_hz, g.hi_hz""")
def _(t):
    grid = H.raster(t.spark, "pmr", "446.00625", "12.5", 16, "12.5")
    near = t.sightings.select((F.lit(446000000) + F.col("hz") % 200000).alias("hz"))
    hits = L.channels_at(near, grid).groupBy("id").agg(F.count("*").alias("n"))
    return grid.join(hits, "id", "left").select("id", "lo_hz", "hi_hz", F.coalesce("n", F.lit(0)).cast("long").alias("sightings"))


# --------------------------------------------------------------------- sources, sinks
def _scratch(t: Tables, name: str) -> str:
    """A folder all executors share, for queries that write and read back."""
    return shared_path(t.spark, name)


@query("s1_read_channels", "SELECT id, jurisdiction, lo_hz, hi_hz, name || ', \"x\"' AS name, service FROM channels")
def _(t):
    path = _scratch(t, "csv")
    mhz = lambda c: F.col(c).cast("decimal(28,6)") / F.lit(1000000).cast("decimal(7,0)")
    rows = t.channels.select("jurisdiction", F.concat(F.lit(" "), "id").alias("id"), mhz("lo_hz").cast("decimal(28,6)").cast("string").alias("lo_mhz"), mhz("hi_hz").cast("decimal(28,6)").cast("string").alias("hi_mhz"), F.concat("name", F.lit(', "x"')).alias("name"), "service", *[F.lit("").alias(c) for c in ("description", "mode", "tags")], F.lit("driver").alias("source"))
    for j in ("us", "eu"):
        rows.where(F.col("jurisdiction") == j).drop("jurisdiction").write.csv(f"{path}/{j}", header=True, escape='"', ignoreLeadingWhiteSpace=False)
    return S.read_channels(t.spark, path).select("id", "jurisdiction", "lo_hz", "hi_hz", "name", "service")


@query("s2_read_grid", "SELECT doc_id, table_index, row_index, cell_index, text FROM grid_cells WHERE table_index < 61")
def _(t):
    path = _scratch(t, "grid")
    t.grid_cells.select(*[F.col(c.split()[0]).cast(c.split()[1]) for c in S.GRID.split(", ")]).write.parquet(path)
    return S.read_grid(t.spark, path).select("doc_id", "table_index", "row_index", "cell_index", "text")


@query("s2_read_blocks", "SELECT doc_id, CAST(block_index AS INTEGER) AS block_index, kind, text FROM blocks")
def _(t):
    path = _scratch(t, "blocks")
    t.blocks.select(*[F.col(c.split()[0]).cast(c.split()[1]) for c in S.BLOCKS.split(", ")]).write.parquet(path)
    return S.read_blocks(t.spark, path)


#: Columns by output, for queries that read back all outputs of a sink as rows of text.
TABLE_COLUMNS = {
    "band": ("bands", "band_id jurisdiction lo_hz hi_hz seq"), "channel": ("channels", "id jurisdiction lo_hz hi_hz name service"), "service": ("services", "band_id ordinal name is_primary"),
    "footnote": ("footnote_defs", "id class text"), "band_footnote": ("band_footnote", "band_id footnote_id scope service_ordinal"), "rule_part": ("rule_parts", "lo_hz hi_hz part name"),
    "jurisdiction": ("jurs", "id name authority country itu_region code"), "meta": ("meta", "key value"),
}
METAS = """meta AS (SELECT 'band_count' AS key, CAST(count(*) AS VARCHAR) AS value FROM bands UNION ALL SELECT 'channel_count', CAST(count(*) AS VARCHAR) FROM channels
UNION ALL SELECT 'footnote_count', CAST(count(*) AS VARCHAR) FROM footnote_defs UNION ALL SELECT 'rule_part_count', CAST(count(*) AS VARCHAR) FROM rule_parts
UNION ALL SELECT 'source_revision', 'unknown' UNION ALL SELECT 'frequency_unit', 'hertz' UNION ALL SELECT 'interval_convention', 'half-open [lo_hz, hi_hz)')"""
OUTPUTS = f"{JURIS}, jurs AS (SELECT jid AS id, jname AS name, authority, country, itu_region, code FROM juris), {METAS}"


def _text_sql(output: str, source: str, columns: str) -> str:
    listed = " || '|' || ".join(f"COALESCE(CAST({c} AS VARCHAR), '')" for c in columns.split())
    return f"SELECT '{output}' AS output, {listed} AS line FROM {source}"


def _text(output: str, df: DataFrame, columns: str) -> DataFrame:
    return df.select(F.lit(output).alias("output"), F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns.split()]).alias("line"))


def _all(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _built(t: Tables) -> dict[str, DataFrame]:
    return {
        "band": t.bands, "channel": t.channels, "service": t.services, "footnote": t.footnote_defs, "band_footnote": t.band_footnote,
        "rule_part": t.rule_parts, "jurisdiction": H.jurisdictions(t.spark), "meta": N.meta(t.bands, t.channels, t.footnote_defs, t.rule_parts),
    }


@query("s3_write_tables", f"WITH {OUTPUTS} " + " UNION ALL ".join(_text_sql(k, *v) for k, v in TABLE_COLUMNS.items()))
def _(t):
    path = _scratch(t, "tables")
    S.write_tables(_built(t), path)
    return _all([_text(k, t.spark.read.parquet(f"{path}/{k}"), columns) for k, (_, columns) in TABLE_COLUMNS.items()])


@query("s3_write_build", f"WITH {METAS} SELECT key, value FROM meta")
def _(t):
    path = _scratch(t, "build")
    S.write_build({k: v for k, v in _built(t).items() if k != "meta"}, path)
    return t.spark.read.parquet(f"{path}/meta")


@query("s3_saved_tables", "SELECT b.band_id, COALESCE(string_agg(ordinal || ':' || name, '|' ORDER BY ordinal), '') AS services FROM bands b LEFT JOIN services s ON s.band_id = b.band_id WHERE jurisdiction = 'us-federal' GROUP BY b.band_id")
def _(t):
    path = _scratch(t, "saved")
    saved = S.save_tables({"band": t.bands, "service": t.services}, path, "t" + path.split("hertzmill-io-")[1].split("/")[0])
    rich = L.band_services(saved["band"].where("jurisdiction = 'us-federal'").select("band_id"), saved["service"])
    return rich.select("band_id", F.array_join(F.transform("services", lambda x: F.concat_ws(":", x["ordinal"].cast("string"), x["name"])), "|").alias("services"))


@query("s4_export_nested", f"""
WITH {OUTPUTS}, w AS (SELECT band_id, string_agg(footnote_id, ' ' ORDER BY footnote_id) AS f FROM band_footnote WHERE scope = 'band' GROUP BY band_id),
o AS (SELECT band_id, service_ordinal AS ordinal, string_agg(footnote_id, ' ' ORDER BY footnote_id) AS f FROM band_footnote WHERE scope = 'service' GROUP BY ALL),
s AS (SELECT s.band_id, string_agg(name || '[' || CAST(is_primary AS VARCHAR) || ' ' || COALESCE(o.f, '') || ']', ';' ORDER BY s.ordinal) AS services FROM services s LEFT JOIN o ON o.band_id = s.band_id AND o.ordinal = s.ordinal GROUP BY s.band_id),
nested AS (SELECT jurisdiction, lo_hz, hi_hz, COALESCE(services, '') AS services, COALESCE(w.f, '') AS footnotes FROM bands b LEFT JOIN s ON s.band_id = b.band_id LEFT JOIN w ON w.band_id = b.band_id)
{_text_sql("bands", "nested", "jurisdiction lo_hz hi_hz services footnotes")} UNION ALL {_text_sql("footnotes", "footnote_defs", "id class text")}
UNION ALL {_text_sql("rule_parts", "rule_parts", "lo_hz hi_hz part name")} UNION ALL {_text_sql("channels", "channels", "id jurisdiction lo_hz hi_hz name service")}
UNION ALL {_text_sql("meta", "meta", "key value")} UNION ALL {_text_sql("jurisdictions", "jurs", "id name authority country itu_region")}""")
def _(t):
    path, built = _scratch(t, "nested"), _built(t)
    S.export_nested({"bands": t.bands, "services": t.services, "band_footnote": t.band_footnote, "footnotes": t.footnote_defs, "rule_parts": t.rule_parts, "channels": t.channels, "meta": built["meta"]}, path)
    kind = "jurisdiction string, lo_hz long, hi_hz long, services array<struct<name:string,primary:boolean,footnotes:array<string>>>, footnotes array<string>"
    shown = F.transform("services", lambda s: F.concat(s["name"], F.lit("["), s["primary"].cast("string"), F.lit(" "), F.array_join(s["footnotes"], " "), F.lit("]")))
    bands = t.spark.read.schema(kind).json(f"{path}/bands").withColumn("services", F.array_join(shown, ";")).withColumn("footnotes", F.array_join("footnotes", " "))
    read = {"footnotes": "id class text", "rule_parts": "lo_hz hi_hz part name", "channels": "id jurisdiction lo_hz hi_hz name service", "meta": "key value", "jurisdictions": "id name authority country itu_region"}
    return _all([_text("bands", bands, "jurisdiction lo_hz hi_hz services footnotes"), *[_text(k, t.spark.read.schema(", ".join(f"{c} string" for c in v.split())).json(f"{path}/{k}"), v) for k, v in read.items()]])


@query("s5_export_minimal", f"""
WITH m AS (SELECT jurisdiction AS j, lo_hz AS lo, hi_hz AS hi, '[' || COALESCE(string_agg('["' || name || '",' || CASE WHEN is_primary THEN '1' ELSE '0' END || ']', ',' ORDER BY ordinal), '') || ']' AS s
FROM bands b LEFT JOIN services s ON s.band_id = b.band_id GROUP BY b.band_id, jurisdiction, lo_hz, hi_hz), c AS (SELECT lo_hz AS lo, hi_hz AS hi, name AS n, service AS sv, '' AS d FROM channels)
{_text_sql("bands", "m", "j lo hi s")} UNION ALL {_text_sql("channels", "c", "lo hi n sv d")}""")
def _(t):
    path = _scratch(t, "minimal")
    S.export_minimal({"bands": t.bands, "services": t.services, "channels": t.channels}, path)
    read = lambda name, columns: _text(name, t.spark.read.schema(", ".join(f"{c} string" for c in columns.split())).json(f"{path}/{name}"), columns)
    return _all([read("bands", "j lo hi s"), read("channels", "lo hi n sv d")])


@query("s6_serving_tables", f"""
WITH {LABELS}, {JURIS}, b AS (SELECT lo_hz, hi_hz, COALESCE(label, '') AS label, code, p_size = 50 AS empty FROM bands b LEFT JOIN labels l ON l.band_id = b.band_id JOIN juris ON jid = jurisdiction JOIN part ON p_partkey = b.band_id),
w AS (SELECT 'bands' AS layer, max(hi_hz - lo_hz) AS widest FROM bands UNION ALL SELECT 'channels', max(hi_hz - lo_hz) FROM channels)
{_text_sql("bands", "b", "lo_hz hi_hz label code empty")} UNION ALL {_text_sql("channels", "channels", "lo_hz hi_hz name service")} UNION ALL {_text_sql("spans", "w", "layer widest")}""")
def _(t):
    empty = t.part.select(F.col("p_partkey").alias("band_id"), (F.col("p_size") == 50).alias("not_allocated"))
    served = S.serving_tables(t.bands.join(empty, "band_id"), t.services, t.channels)
    return _all([_text("bands", served["bands"], "lo_hz hi_hz label code not_allocated"), _text("channels", served["channels"], "lo_hz hi_hz name service"), _text("spans", served["spans"], "layer widest")])


# ------------------------------------------------------------------------- the stream
@query("t1_summary_stream", SUMMARY.replace("SIGHTINGS", "sightings_low"))
def _(t):
    """A stream over files of sightings, run to their end; the sink is what is returned."""
    from .streaming.summary import summary_stream

    path = _scratch(t, "stream")
    rows = t.sightings_low.select("sighting_id", "hz")
    rows.write.parquet(f"{path}/in")
    out = summary_stream(t.spark.readStream.schema(rows.schema).parquet(f"{path}/in"), t.channels, t.bands, t.services)
    run = out.select("sighting_id", "summary").writeStream.format("parquet").option("checkpointLocation", f"{path}/state").trigger(availableNow=True).start(f"{path}/out")
    run.awaitTermination()
    return t.spark.read.schema("sighting_id long, summary string").parquet(f"{path}/out")
