"""What is at a frequency, or in a span: interval joins, ranking, answers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hertz import jurisdictions
from ..plans.intervals import MANY, cut, least_at, least_in, point_join, ranked_at, ranked_in, segment_lookup, span_join
from ..plans.ordered import numbered, scan
from ..plans.storage import stored

NO_RECORD = "No allocation on record"
NO_TEXT = "(not reproduced in the FCC source document)"
EMPTY_LABEL = {"serving": "", "report": "no service listed", "ranked": "(no service listed)"}


def channels_at(sightings: DataFrame, channels: DataFrame, how: str | None = None) -> DataFrame:
    """L1: every channel that covers each point."""
    return point_join(sightings, channels, how=how)


def bands_at(sightings: DataFrame, bands: DataFrame, how: str | None = None) -> DataFrame:
    """L2: every band that covers each point, with its jurisdiction's name. Unknown jurisdictions go."""
    return _with_names(point_join(sightings, bands, how=how))


def channels_in(spans: DataFrame, channels: DataFrame, how: str | None = None) -> DataFrame:
    """L3: every channel that overlaps each span (p_lo, p_hi)."""
    return span_join(spans, channels, how)


def bands_in(spans: DataFrame, bands: DataFrame, how: str | None = None) -> DataFrame:
    """L4: every band that overlaps each span, with its jurisdiction's name."""
    return _with_names(span_join(spans, bands, how))


def _with_names(matches: DataFrame) -> DataFrame:
    names = jurisdictions(matches.sparkSession).select(F.col("id").alias("jurisdiction"), F.col("name").alias("jname"))
    return matches.join(F.broadcast(names), "jurisdiction")  # seven rows


def part_number(part: Column) -> Column:
    """The integer that a part begins with ('74D' is 74), 0 if none."""
    digits = F.regexp_extract(part, r"^\d+", 0)
    return F.when(digits == "", 0).otherwise(digits.try_cast("int")).cast("int")


def united(rule_parts: DataFrame) -> DataFrame:
    """part, name, lo_hz, hi_hz, ended: what the intervals of each part and name cover together, as intervals apart from each other; ended: where the one before ends, null for the first.

    A span meets a part and name first in the one that it meets with ended at or below its low edge.
    """
    change = F.explode(F.array(F.struct(F.col("lo_hz").alias("x"), F.lit(1).cast("long").alias("by")), F.struct(F.col("hi_hz").alias("x"), F.lit(-1).cast("long").alias("by"))))
    edges = rule_parts.where("lo_hz < hi_hz").select("part", "name", change.alias("e")).groupBy("part", "name", F.col("e.x").alias("x")).agg(F.sum("e.by").alias("by"))
    edges = scan(edges.where("by != 0"), ["part", "name"], ["x"], sums={"over": F.col("by")}).where("over = 0 or over = by").select("part", "name", "x", "over")
    begun, ended = F.when(F.col("over") != 0, F.col("x")), F.when(F.col("over") == 0, F.col("x"))
    runs = scan(edges, ["part", "name"], ["x"], before={"lo_hz": begun, "ended": ended}).where("over = 0")
    return runs.select("part", "name", "lo_hz", F.col("x").alias("hi_hz"), "ended")


def _by_id(probes: DataFrame, probe_id: str) -> tuple[DataFrame, DataFrame]:
    """Probes whose id comes once, and the others, null ids among them."""
    repeated = probes.groupBy(probe_id).agg(F.count("*").alias("_n")).where("_n > 1").select(probe_id)
    known = probes.where(F.col(probe_id).isNotNull())
    return known.join(repeated, probe_id, "left_anti"), known.join(repeated, probe_id, "left_semi").select(probes.columns).unionByName(probes.where(F.col(probe_id).isNull()))


def _rule_parts(probes: DataFrame, rule_parts: DataFrame, probe_id: str, join) -> DataFrame:
    met = join(probes, rule_parts).select(probe_id, "part", "name").distinct()
    return met.withColumn("position", F.row_number().over(Window.partitionBy(probe_id).orderBy(part_number(F.col("part")), "part", "name")))


def rule_parts_at(probes: DataFrame, rule_parts: DataFrame, probe_id: str, how: str | None = None) -> DataFrame:
    """Distinct (part, name) of each probe with their order in it: by number, part, name.

    The intervals of a part and name are united, so that a probe meets it once: nothing is made
    distinct or sorted for a probe. An id that comes more than once is one probe: only
    those are joined, made distinct and sorted. how: all of them, by that plan.
    """
    join = point_join if "hz" in probes.columns else span_join
    if how:
        return _rule_parts(probes, rule_parts, probe_id, lambda a, b: join(a, b, how=how))
    edges = ["hz"] if "hz" in probes.columns else ["p_lo", "p_hi"]
    once, again = _by_id(probes.select(probe_id, *edges), probe_id)
    parts, at = united(rule_parts), ranked_at if "hz" in probes.columns else ranked_in
    found = at(once, parts, [part_number(F.col("part")), "part", "name", "lo_hz"], ["part", "name", "ended"], "_m")
    first = F.filter("_m", lambda x: x["ended"].isNull() | (x["ended"] <= F.col(edges[0])))
    listed = found.select(probe_id, F.posexplode(first).alias("_i", "_x")).select(probe_id, "_x.part", "_x.name", (F.col("_i") + 1).alias("position"))
    return listed.unionByName(_rule_parts(again, parts, probe_id, join))


def rank(matches: DataFrame, probe_id: str, item: str) -> DataFrame:
    """Order of the matches of a probe, narrowest first; ties by lo, hi, then item."""
    order = Window.partitionBy(probe_id).orderBy(F.col("hi_hz") - F.col("lo_hz"), "lo_hz", "hi_hz", item)
    return matches.withColumn("rank", F.row_number().over(order))


def _ranked(probes: DataFrame, probe_id: str, intervals: DataFrame, order: list[Column | str], shown: list[str], n: int | None = None) -> DataFrame:
    """The columns of probes (hz), rank from 1 and shown of the intervals over each, in order, the first n; all of them by default.

    Probes take the ranked list of their segment. An id that comes more than once, with
    several frequencies, is one probe with all their matches: only those are joined and sorted.
    """
    once, again = _by_id(probes, probe_id)
    met = ranked_at(once, intervals, order, shown, "_m", n=n)
    lists = met.select(*probes.columns, F.posexplode("_m").alias("_i", "_x")).select(*probes.columns, (F.col("_i") + 1).alias("rank"), "_x.*")
    keys = F.struct(*[(x if isinstance(x, Column) else F.col(x)).alias(f"k{i}") for i, x in enumerate(order)])
    narrow = intervals.select("lo_hz", "hi_hz", keys.alias("_key"), F.struct(*shown).alias("_x"))
    pairs = point_join(again, narrow)
    pairs = pairs.withColumn("rank", F.row_number().over(Window.partitionBy(probe_id).orderBy("_key"))).select(*probes.columns, "rank", "_x.*")
    return lists.unionByName(pairs if n is None else pairs.where(F.col("rank") <= n))


def narrowest_first(sightings: DataFrame, intervals: DataFrame, probe_id: str, item: str, n: int | None = None) -> DataFrame:
    """L6 and L7 without a window over probes: the columns of sightings (hz), rank from 1 and item.

    The n narrowest intervals over each point, all by default; ties as in rank(). A point
    without any has no row.
    """
    return _ranked(sightings, probe_id, intervals, [F.col("hi_hz") - F.col("lo_hz"), "lo_hz", "hi_hz", item], [item], n)


def top_n(matches: DataFrame, probe_id: str, item: str, n: int = 32) -> DataFrame:
    """The n narrowest matches of each probe. For one, a partial aggregate instead of a sort."""
    if n > 1:
        return rank(matches, probe_id, item).where(F.col("rank") <= n)
    key = F.struct(F.col("hi_hz") - F.col("lo_hz"), "lo_hz", "hi_hz", item)
    best = matches.groupBy(probe_id).agg(F.min_by(F.struct(*[c for c in matches.columns if c != probe_id]), key).alias("m"))
    return best.select(probe_id, "m.*").withColumn("rank", F.lit(1))


def narrowest_at(sightings: DataFrame, intervals: DataFrame, item: str) -> DataFrame:
    """L7 for one match, without the join: the columns of sightings (hz) and match, a struct of all
    columns of the narrowest interval (ties as in L6), null where none covers the point."""
    rest = [c for c in intervals.columns if c not in (item, "lo_hz", "hi_hz")]
    order = F.struct((F.col("hi_hz") - F.col("lo_hz")).alias("width"), "lo_hz", "hi_hz", item, *rest)
    return sightings.join(least_at(sightings, intervals, order, "match"), "hz", "left")


def count_matches(probes: DataFrame, intervals: DataFrame, probe_id: str) -> DataFrame:
    """Number of overlapping intervals of each span (p_lo, p_hi), 0 if none or empty, without the join.

    Of well-formed intervals, those that begin below p_hi less those that end at or below
    p_lo. Both are ranks among sorted edges: one sort by ranges of equal depth, in which at
    one frequency high edges come first, then probes, then low edges. Equal edges and equal
    probes are one row each.
    """
    real = probes.where("p_lo < p_hi").select(probe_id, "p_lo", "p_hi")
    good = intervals.where("lo_hz < hi_hz")
    zero = F.lit(0).cast("long")
    edge = lambda c, turn: good.groupBy(F.col(c).alias("x")).agg(F.count("*").alias("n")).select("x", F.lit(turn).alias("turn"), F.when(F.lit(turn == 2), F.col("n")).otherwise(zero).alias("lows"), F.when(F.lit(turn == 0), F.col("n")).otherwise(zero).alias("highs"))
    asked = real.select(F.explode(F.array("p_lo", "p_hi")).alias("x")).distinct().select("x", F.lit(1).alias("turn"), zero.alias("lows"), zero.alias("highs"))
    rows = scan(edge("hi_hz", 0).unionByName(asked).unionByName(edge("lo_hz", 2)), [], ["x", "turn"], sums={"begun": F.col("lows"), "ended": F.col("highs")}).where("turn = 1")
    counted = real.join(rows.select(F.col("x").alias("p_hi"), "begun"), "p_hi").join(rows.select(F.col("x").alias("p_lo"), "ended"), "p_lo")
    counted = counted.select(probe_id, (F.col("begun") - F.col("ended")).alias("n_matches"))
    return probes.select(probe_id).join(counted, probe_id, "left").select(probe_id, F.coalesce("n_matches", F.lit(0)).cast("long").alias("n_matches"))


def services_label(services: DataFrame, kind: str = "serving") -> DataFrame:
    """band_id and label of each band with services, in printed order.

    kind: serving and report mark secondary services, ranked does not. Bands without
    services have no row; their label is EMPTY_LABEL[kind].
    """
    name = F.col("name") if kind == "ranked" else F.concat("name", F.when(F.col("is_primary"), "").otherwise(" (secondary)"))
    lines = F.array_sort(F.collect_list(F.struct("ordinal", name.alias("shown"))))
    return services.groupBy("band_id").agg(F.array_join(F.transform(lines, lambda x: x["shown"]), ", ").alias("label"))


def band_services(bands: DataFrame, services: DataFrame) -> DataFrame:
    """Adds services, the ordered (ordinal, name, is_primary) of each band; empty if none."""
    listed = services.groupBy("band_id").agg(F.array_sort(F.collect_list(F.struct("ordinal", "name", "is_primary"))).alias("services"))
    kind = "array<struct<ordinal:int,name:string,is_primary:boolean>>"
    return bands.join(listed, "band_id", "left").withColumn("services", F.coalesce(F.col("services").cast(kind), F.array().cast(kind)))


def band_footnotes(bands: DataFrame, bridge: DataFrame, footnotes: DataFrame) -> DataFrame:
    """Distinct (band_id, id, class, text) of each band, both scopes merged; undefined ids go."""
    cited = bridge.select("band_id", F.col("footnote_id").alias("id")).distinct()
    return bands.select("band_id").distinct().join(cited, "band_id").join(footnotes.select("id", "class", "text"), "id")


def filter_jurisdiction(channels: DataFrame, j: str = "all") -> DataFrame:
    """The curated layer restricted to one jurisdiction; all: as it is. Applied before joins."""
    return channels if j == "all" else channels.where(F.col("jurisdiction") == j)


def ranked_layers(sightings: DataFrame, channels: DataFrame, bands: DataFrame, services: DataFrame, prefix: str = "us") -> DataFrame:
    """Channels and bands (jurisdictions with the prefix) at each point, narrowest first over both.

    sighting_id, layer, what, lo_hz, hi_hz, rank. Ties: lo, hi, layer, what, then the item's id.
    """
    labels = services_label(services, "ranked")
    upper = bands.where(F.col("jurisdiction").startswith(prefix)).join(labels, "band_id", "left")
    upper = upper.select(F.lit("band").alias("layer"), F.coalesce("label", F.lit(EMPTY_LABEL["ranked"])).alias("what"), F.col("band_id").cast("string").alias("item"), "lo_hz", "hi_hz")
    lower = channels.select(F.lit("channel").alias("layer"), F.col("name").alias("what"), F.col("id").alias("item"), "lo_hz", "hi_hz")
    order = [F.col("hi_hz") - F.col("lo_hz"), "lo_hz", "hi_hz", "layer", "what", "item"]
    shown = ["layer", "what", "lo_hz", "hi_hz"]
    return _ranked(sightings.select("sighting_id", "hz"), "sighting_id", lower.unionByName(upper), order, shown).select("sighting_id", *shown, "rank")


def _rank_key(item: str, *shown: Column) -> Column:
    return F.struct((F.col("hi_hz") - F.col("lo_hz")).alias("width"), F.col("lo_hz").alias("lo"), F.col("hi_hz").alias("hi"), F.col(item).cast("string").alias("item"), *shown)


def _summary_segments(channels: DataFrame, bands: DataFrame, services: DataFrame) -> tuple[DataFrame, int, int]:
    """summary_segments(), their number and the highest edge."""
    us = bands.where(F.col("jurisdiction").startswith("us")).select("band_id", "lo_hz", "hi_hz")
    order = F.struct((F.col("hi_hz") - F.col("lo_hz")).alias("width"), F.col("lo_hz").alias("lo"), F.col("hi_hz").alias("hi"), F.col("band_id").alias("item"))
    tiles = cut(channels, us)
    n, top = tiles.agg(F.count("*"), F.max("s_lo")).first()
    found = least_in(tiles, channel=(channels, _rank_key("id", F.col("name").alias("name"))), band=(us, order))
    found = found.withColumn("band_id", F.col("band.item")).join(services_label(services), "band_id", "left")
    text = F.coalesce("channel.name", F.when(F.col("label") != "", F.col("label")), F.lit(NO_RECORD))
    return found.select("s_lo", "s_hi", text.alias("summary")), n, top


def summary_segments(channels: DataFrame, bands: DataFrame, services: DataFrame) -> DataFrame:
    """Disjoint segments with the tooltip text of every point in them: L14 moved to the static side."""
    return _summary_segments(channels, bands, services)[0]


def with_summaries(sightings: DataFrame, channels: DataFrame, bands: DataFrame, services: DataFrame) -> DataFrame:
    """The columns of sightings, a stream or not, and each one's summary, by segments."""
    segments, n, top = _summary_segments(channels, bands, services)
    return segment_lookup(sightings, segments if n <= MANY else stored(segments, "segments"), top, n <= MANY)


def summary(sightings: DataFrame, channels: DataFrame, bands: DataFrame, services: DataFrame, how: str = "segments") -> DataFrame:
    """One line for each row of sightings, repeated ids included: sighting_id and summary.

    The narrowest channel's name; else the services of the narrowest US band (federal
    or not; ties by lo, hi, band); else, also if that band has no services, the default.
    how: segments (no shuffle of sightings, no ranking), dyadic (least intervals of each
    different frequency) or broadcast (all pairs, then the least; for few intervals).
    """
    if how == "segments":
        return with_summaries(sightings, channels, bands, services).select("sighting_id", "summary")
    points = sightings.select("sighting_id", "hz")
    channels = channels.select("id", "name", "lo_hz", "hi_hz")
    us = bands.where(F.col("jurisdiction").startswith("us")).join(services_label(services), "band_id", "left").select("band_id", "label", "lo_hz", "hi_hz")
    if how == "broadcast":
        probe = points.select("hz").distinct()
        best = top_n(channels_at(probe, channels, how), "hz", "id", 1).select("hz", "name")
        first = top_n(point_join(probe, us, how=how), "hz", "band_id", 1).select("hz", "label")
    else:
        best = narrowest_at(points.select("hz").distinct(), channels, "id").select("hz", "match.name")
        first = narrowest_at(points.select("hz").distinct(), us, "band_id").select("hz", "match.label")
    out = points.join(best, "hz", "left").join(first, "hz", "left")
    return out.select("sighting_id", F.coalesce("name", F.when(F.col("label") != "", F.col("label")), F.lit(NO_RECORD)).alias("summary"))


def collapse_regions(matches: DataFrame, probe_id: str) -> DataFrame:
    """ITU bands of a probe that say the same, as one row with a label of first and last region.

    matches: probe, jurisdiction, lo_hz, hi_hz, services (an ordered array).
    """
    region = F.substring("jurisdiction", 6, 1)
    same = matches.where(F.col("jurisdiction").startswith("itu-r")).groupBy(probe_id, "lo_hz", "hi_hz", "services").agg(F.array_sort(F.collect_set(region)).alias("r"))
    label = F.when(F.size("r") > 1, F.concat(F.lit("ITU Regions "), F.element_at("r", 1), F.lit("–"), F.element_at("r", -1))).otherwise(F.concat(F.lit("ITU Region "), F.element_at("r", 1)))
    return same.select(probe_id, "lo_hz", "hi_hz", "services", label.alias("label"))


def us_allocation(matches: DataFrame, services: DataFrame, notes: DataFrame) -> DataFrame:
    """The US bands of an answer with label and footnote ids joined by ', ' ('' if none)."""
    labels = services_label(services, "report")
    ids = notes.groupBy("band_id").agg(F.array_join(F.array_sort(F.collect_set("id")), ", ").alias("footnotes"))
    us = matches.where(F.col("jurisdiction").startswith("us")).join(labels, "band_id", "left").join(ids, "band_id", "left")
    return us.withColumn("label", F.coalesce("label", F.lit(EMPTY_LABEL["report"]))).withColumn("footnotes", F.coalesce("footnotes", F.lit("")))


#: Words of 64 footnotes up to which a band's footnotes are that many columns; beyond, a row for each word that it has.
WIDE = 64


def footnote_bits(notes: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """Footnotes as bits: (id, text, word, bit) of each id, (band_id, word, bits) of each band and word, and the number of words.

    notes: of L11. Bits are numbered in order of the ids. An id with several texts has the least.
    """
    dim = numbered(notes.groupBy("id").agg(F.min("text").alias("text")), "_no", "id")
    dim = dim.select("id", "text", F.shiftright("_no", 6).cast("int").alias("word"), F.col("_no").bitwiseAND(63).cast("int").alias("bit"))
    n_words = (dim.agg(F.max("word")).first()[0] or 0) + 1
    one = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit"))
    held = notes.select("band_id", "id").join(dim.select("id", "word", "bit"), "id").groupBy("band_id", "word").agg(F.bit_or(one).alias("bits"))
    return dim, held, n_words


def footnote_texts(matches: DataFrame, notes: DataFrame, probe_id: str) -> DataFrame:
    """Distinct footnotes over all matched bands of each probe; a null text is replaced. Order is by id.

    A band's footnotes are bits of a few 64-bit words. A probe's are the words of its bands,
    merged by bit-or, partly before the shuffle, and decoded once.
    """
    dim, held, n_words = footnote_bits(notes)
    met = matches.select(probe_id, "band_id")
    if n_words <= WIDE:
        words = [f"w{i}" for i in range(n_words)]
        wide = held.groupBy("band_id").agg(*[F.coalesce(F.bit_or(F.when(F.col("word") == i, F.col("bits"))), F.lit(0).cast("long")).alias(w) for i, w in enumerate(words)])
        merged = met.join(wide, "band_id").groupBy(probe_id).agg(*[F.bit_or(w).alias(w) for w in words])
        merged = merged.select(probe_id, F.posexplode(F.array(*words)).alias("word", "bits"))
    else:
        merged = met.join(held, "band_id").groupBy(probe_id, "word").agg(F.bit_or("bits").alias("bits"))
    bits = F.filter(F.sequence(F.lit(0), F.lit(63)), lambda i: F.getbit(F.col("bits"), i) == 1)
    found = merged.where("bits != 0").select(probe_id, "word", F.explode(bits).alias("bit"))
    return found.join(dim, ["word", "bit"]).select(probe_id, "id", F.coalesce("text", F.lit(NO_TEXT)).alias("text"))


def _layers(channels: DataFrame, bands: DataFrame, services: DataFrame, bridge: DataFrame, footnotes: DataFrame, rule_parts: DataFrame) -> DataFrame:
    """Channels, bands (with names, services and footnotes) and rule parts as one table of intervals, a struct of each layer's columns in it."""
    notes = band_footnotes(bands, bridge, footnotes).groupBy("band_id").agg(F.array_sort(F.collect_list(F.struct("id", "class", "text"))).alias("footnotes"))
    rich = _with_names(band_services(bands.select("band_id", "jurisdiction", "lo_hz", "hi_hz"), services).join(notes, "band_id", "left"))
    rich = rich.withColumn("footnotes", F.coalesce("footnotes", F.array().cast("array<struct<id:string,class:string,text:string>>")))

    def narrow(items: DataFrame, item: str, name: str) -> DataFrame:
        rest = [c for c in items.columns if c not in ("lo_hz", "hi_hz", item)]
        return items.select("lo_hz", "hi_hz", F.struct((F.col("hi_hz") - F.col("lo_hz")).alias("width"), "lo_hz", "hi_hz", item, *rest).alias(name))

    by_number = F.struct(part_number(F.col("part")).alias("number"), "part", "name", "ended").alias("rule_parts")
    parts = united(rule_parts).select("lo_hz", "hi_hz", by_number)
    return narrow(channels, "id", "channels").unionByName(narrow(rich, "band_id", "bands"), True).unionByName(parts, True)


def _answers(found: DataFrame, matches: str, low: str | None) -> DataFrame:
    """found with the arrays channels, bands and rule_parts, from one array of matches of all layers, in rank order.

    low: the column of a probe's low edge, by which a part and name comes once; null: by comparing.
    """

    def of(layer: str) -> Column:
        return F.filter(F.col(matches)[layer], lambda x: x.isNotNull())

    out = found.withColumn("_parts", of("rule_parts")).withColumn("channels", of("channels")).withColumn("bands", of("bands"))
    if low:
        out = out.withColumn("_parts", F.array_sort(F.filter("_parts", lambda x: x["ended"].isNull() | (x["ended"] <= F.col(low)))))
    else:
        out = out.withColumn("_parts", F.array_sort(F.array_distinct(F.transform("_parts", lambda x: x.dropFields("ended")))))
    return out.withColumn("rule_parts", F.transform("_parts", lambda x: F.struct(x["part"], x["name"]))).drop("_parts", matches)


def answer(probes: DataFrame, channels: DataFrame, bands: DataFrame, services: DataFrame, bridge: DataFrame, footnotes: DataFrame, rule_parts: DataFrame, probe_id: str) -> DataFrame:
    """One row a probe with arrays channels, bands (services and footnotes in them) and rule_parts.

    Arrays are narrowest first (rule parts by number) and empty where nothing matches.
    Services and footnotes (id, class and text, by id) are attached to bands before
    anything meets a probe; an undefined footnote is left out. The three layers are one
    table of intervals, rule parts united. Probes take what they meet from the ranked list of
    their cell or segment. An id that comes more than once, with several spans, has all
    their matches in each of its rows: only those are joined and gathered.
    """
    layers = _layers(channels, bands, services, bridge, footnotes, rule_parts)
    shown = ["channels", "bands", "rule_parts"]
    order = [F.col("hi_hz") - F.col("lo_hz"), "lo_hz", "hi_hz", *shown]
    if "hz" in probes.columns:
        return _answers(ranked_at(probes, layers, order, shown, "_found"), "_found", "hz")
    once, again = _by_id(probes, probe_id)
    out = _answers(ranked_in(once, layers, order, shown, "_found"), "_found", "p_lo")
    ranks = F.struct(*[(x if isinstance(x, Column) else F.col(x)).alias(f"o{i}") for i, x in enumerate(order)])
    met = span_join(again.select(probe_id, "p_lo", "p_hi"), layers).groupBy(probe_id).agg(F.array_sort(F.collect_list(F.struct(ranks.alias("o"), *shown))).alias("_all"))
    same = F.col(probe_id) == F.col("_id")
    kind = out.sparkSession.createDataFrame([], layers.select(F.array(F.struct(*shown)).alias("a")).schema).schema["a"].dataType
    gathered = again.join(met.withColumnRenamed(probe_id, "_id"), same, "left").drop("_id").withColumn("_found", F.coalesce(F.transform("_all", lambda x: F.struct(*[x[c].alias(c) for c in shown])), F.array().cast(kind))).drop("_all")
    return out.unionByName(_answers(gathered, "_found", None).select(out.columns))
