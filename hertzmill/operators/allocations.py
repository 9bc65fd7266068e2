"""Assigned cells to bands and rule parts (P16-P18), footnote prose."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.cells import FOOTNOTE, is_pointer, let, lines_of, rejoin_lines, split_bands, strip_line
from ..plans.ordered import scan

# The words of headings and marks, and the column's jurisdictions.
JURISDICTION_OF = {"itu_r1": "itu-r1", "itu_r2": "itu-r2", "itu_r3": "itu-r3", "us_federal": "us-federal", "us_non_federal": "us-non-federal"}
NOTES_START = "(a) Allocation Table."
HEADINGS = {
    "itu": "International footnotes.",
    "us": "United States Footnotes.",
    "ng": "Non-Federal Government (NG) Footnotes.",
    "g": "Federal Government (G) footnotes.",
}
TABLE_MARK = "[table omitted -- see source document]"
UNKNOWN = "unknown"
RESERVED = "[reserved]"


def _only(text: Column, characters: str) -> Column:
    """Whether a text has characters, and no others than these."""
    return (text != "") & (F.translate(text, characters, "") == "")


def _bracketed(text: Column) -> Column:
    """What stands between the first and last character, without white space, if these are brackets."""
    tight = F.regexp_replace(text, r"\s", "")
    return F.when(F.startswith(tight, F.lit("(")) & F.endswith(tight, F.lit(")")), F.substring(tight, 2, F.length(tight) - 2))


def part_of(line: Column) -> Column:
    """(name, part) of a line that ends with a number in brackets, with a capital letter or without: 'Aviation (87F)'."""
    shown = F.rtrim(line)
    last = F.element_at(F.split(shown, r"\("), -1)
    name = F.trim(F.substring(shown, 1, F.length(shown) - F.length(last) - 1))
    part = F.rtrim(F.substring(last, 1, F.length(last) - 1))
    number = F.regexp_replace(part, "[A-Z]$", "")
    good = F.endswith(last, F.lit(")")) & (name != "") & _only(number, "0123456789")
    return F.struct(F.when(good, name).otherwise("").alias("name"), F.when(good, part).otherwise("").alias("part"))


def entry_of(text: Column) -> Column:
    """(id, said) of a paragraph that opens an entry: numerals in brackets, once or more, a footnote's id, and the rest; null for others."""
    known = F.regexp_extract(text, FOOTNOTE, 0)
    marks = F.split_part(text, known, F.lit(1))
    rest = F.substr(text, F.length(marks) + F.length(known) + 1)
    numerals = F.split(_bracketed(marks), r"\)\(")
    good = (known != "") & F.forall(numerals, lambda x: _only(F.upper(x), "0123456789IVXLC")) & ~F.rlike(rest, F.lit(r"^[\w.]"))
    return F.when(good, F.struct(known.alias("id"), F.trim(F.regexp_replace(rest, r"^\s+", "")).alias("said")))


def is_reserved(text: Column) -> Column:
    """Whether a paragraph is numbers or ranges of them in brackets, followed by the mark of a reserved entry."""
    lower = F.lower(text)
    return F.contains(lower, F.lit(RESERVED)) & F.coalesce(_only(_bracketed(F.substring_index(lower, RESERVED, 1)), "0123456789-()"), F.lit(False))


def drop_pointers(cells: DataFrame) -> DataFrame:
    """Cells that only point to the page before go."""
    return cells.where(~is_pointer(F.col("text")))


def chunks(cells: DataFrame) -> DataFrame:
    """P9 to P14 on cells (doc_id, table_index, row_index, cell_index, columns, text, unit): a row a chunk.

    Adds source, chunk (its number in the cell) and what parse_cell() gives.
    """
    parts = cells.select("doc_id", "table_index", "row_index", "cell_index", "columns", F.posexplode(split_bands(F.col("text"), F.col("unit"))).alias("chunk", "x"))
    source = F.format_string("tbl%d:row%d", F.col("table_index").cast("long"), F.col("row_index").cast("long"))
    return parts.select("doc_id", "table_index", "row_index", "cell_index", "columns", source.alias("source"), "chunk", "x.*")


def _alone() -> Column:
    """Whether a cell covers the rule-part column and no other."""
    return F.col("columns") == F.array(F.lit("fcc_parts"))


def _order() -> list[str]:
    return ["table_index", "row_index", "cell_index"]


def rule_parts(cells: DataFrame) -> DataFrame:
    """(doc_id, lo_hz, hi_hz, part, name, seq...) of cells that cover the rule-part column.

    Each rejoined line 'Name (99A)' takes the range of the latest chunk with a range
    before it in the document, from a cell that went the band path; none, no row.
    """
    over = F.array_contains("columns", "fcc_parts")
    lines = let(lines_of(F.col("text")), rejoin_lines)
    hits = F.filter(F.transform(lines, part_of), lambda s: s["part"] != "")
    marked = drop_pointers(cells).withColumn("hits", F.when(over, hits).otherwise(F.array().cast("array<struct<name:string,part:string>>")))
    marked = marked.withColumn("alone", _alone())
    spans = F.filter(split_bands(F.col("text"), F.col("unit")), lambda c: c["lo_hz"].isNotNull())
    last = let(spans, lambda s: F.when(F.size(s) > 0, F.struct(F.element_at(s, -1)["lo_hz"].alias("lo_hz"), F.element_at(s, -1)["hi_hz"].alias("hi_hz"))))
    # a cell is off the band path if it is of that column only, or a line of it was found, which takes a range before it
    maybe = marked.select("doc_id", *_order(), "hits", F.when(~F.col("alone") & (F.size("hits") == 0), last).alias("own"), F.when(~F.col("alone") & (F.size("hits") > 0), last).alias("loose"))
    # cells with hits and no range yet keep to the band path, so the first such cell may give the first range
    ranged = scan(maybe, ["doc_id"], _order(), before={"earlier": F.col("own")}, firsts={"first_loose": F.col("loose")})
    ranged = ranged.withColumn("span", F.coalesce("earlier", "first_loose"))
    return ranged.where("span is not null").select("doc_id", *_order(), "span.lo_hz", "span.hi_hz", F.posexplode("hits").alias("line", "h")).select("doc_id", *_order(), "line", "lo_hz", "hi_hz", "h.part", "h.name")


def band_cells(cells: DataFrame, parts: DataFrame) -> DataFrame:
    """Cells on the band path: no pointers, none of the rule-part column only, none that gave a rule part."""
    gave = parts.select("doc_id", *_order()).distinct()
    return drop_pointers(cells).where(~_alone()).join(gave, ["doc_id", *_order()], "left_anti")


def fold_spills(parsed: DataFrame) -> DataFrame:
    """One row for each chunk with a range and column; chunks without one are folded into the band before.

    Per column, a spill's ids (band-level, then those of its services) and its services
    are appended to the latest band of the column, each if it is not there yet. A spill
    before any band goes. What the band itself repeats stays.
    """
    one = parsed.withColumn("column", F.explode("columns"))
    order = ["table_index", "row_index", "cell_index", "chunk"]
    one = scan(one, ["doc_id", "column"], order, sums={"no": F.col("lo_hz").isNotNull().cast("int")}).where("no > 0")
    ids = F.concat("footnotes", F.flatten(F.transform("services", lambda s: s["footnotes"])))
    spill = F.struct(*order, ids.alias("ids"), F.col("services"))
    folded = one.groupBy("doc_id", "column", "no").agg(
        F.max(F.when(F.col("lo_hz").isNotNull(), F.struct(*order, "source", "lo_hz", "hi_hz", "services", "footnotes", "not_allocated", "raw_text"))).alias("b"),
        F.array_sort(F.collect_list(F.when(F.col("lo_hz").isNull(), spill))).alias("spills"),
    )

    def added(start: Column, items: Column, same) -> Column:
        return F.aggregate(items, start, lambda acc, x: F.when(F.exists(acc, lambda y: same(x, y)), acc).otherwise(F.concat(acc, F.array(x))))

    more_ids = F.flatten(F.transform("spills", lambda s: s["ids"]))
    more_services = F.flatten(F.transform("spills", lambda s: s["services"]))
    return folded.select(
        "doc_id", "column", *[F.col(f"b.{c}").alias(c) for c in (*order, "source", "lo_hz", "hi_hz", "not_allocated", "raw_text")],
        added(F.col("b.services"), more_services, lambda x, y: x["name"] == y["name"]).alias("services"),
        added(F.col("b.footnotes"), more_ids, lambda x, y: x == y).alias("footnotes"),
    )


def to_bands(folded: DataFrame) -> DataFrame:
    """Bands of the jurisdictions that columns stand for; other columns go."""
    known = F.create_map(*[F.lit(x) for pair in JURISDICTION_OF.items() for x in pair])
    return folded.withColumn("jurisdiction", F.try_element_at(known, F.col("column"))).where("jurisdiction is not null").drop("column")


def parse_footnotes(blocks: DataFrame) -> DataFrame:
    """(doc_id, id, class, text) of the prose blocks (doc_id, block_index, kind, text) of each document.

    Entries begin after the paragraph that opens the notes and a class heading. A
    heading or a reserved entry closes the open one; other paragraphs and tables go on
    with it. Of entries with one id the later wins. Documents without notes give nothing.
    """
    text = strip_line(F.coalesce("text", F.lit("")))
    is_text = F.col("kind") == "p"
    begins = blocks.where(is_text & F.contains("text", F.lit(NOTES_START))).groupBy(F.col("doc_id").alias("_doc")).agg(F.min("block_index").alias("_begins"))
    rows = blocks.withColumn("t", F.when(is_text, text)).join(begins, (F.col("doc_id") == F.col("_doc")) & (F.col("block_index") >= F.col("_begins"))).where("kind != 'p' or t != ''")
    heading = F.lit(None).cast("string")
    for name, words in reversed(HEADINGS.items()):
        heading = F.when(F.contains(F.substring("t", 1, 80), F.lit(words)), F.lit(name)).otherwise(heading)
    rows = rows.select("doc_id", "block_index", "kind", "t", heading.alias("heading")).withColumn("entry", F.when(F.col("heading").isNull(), entry_of(F.col("t")))).withColumn("id", F.col("entry.id"))
    closes = F.coalesce(F.col("heading").isNotNull() | (is_reserved(F.col("t")) & F.col("id").isNull()), F.lit(False))
    turns = F.when(F.col("id").isNotNull() | closes, 1).otherwise(0)
    rows = scan(rows, ["doc_id"], ["block_index"], sums={"event": turns}, lasts={"class": F.col("heading")}).where("class is not null")
    rows = rows.withColumn("closes", closes)
    said = F.when(F.col("id").isNotNull(), F.col("entry.said")).when(F.col("kind") != "p", TABLE_MARK).otherwise(F.col("t"))
    lines = F.transform(F.array_sort(F.collect_list(F.struct("block_index", said.alias("said")))), lambda x: x["said"])
    entries = rows.groupBy("doc_id", "event").agg(F.max("id").alias("id"), F.max_by("class", F.when(F.col("id").isNotNull(), F.col("block_index"))).alias("class"), F.min("block_index").alias("at"), strip_line(F.array_join(F.filter(lines, lambda x: x != ""), "\n")).alias("text"))
    return entries.where("id is not null").groupBy("doc_id", "id").agg(F.max_by(F.struct("class", "text"), "at").alias("x")).select("doc_id", "id", "x.class", "x.text")


def source_revision(blocks: DataFrame, among: int = 40) -> DataFrame:
    """P20: text after 'Revised on' in the first blocks of each document, else 'unknown'."""
    first = F.rank().over(Window.partitionBy("doc_id").orderBy("block_index")) <= among
    found = F.nullif(F.regexp_extract("text", r"Revised on\s+(.+?)\s*$", 1), F.lit(""))
    near = blocks.withColumn("near", first).withColumn("revision", F.when(F.col("near") & (F.col("kind") == "p"), found))
    return near.groupBy("doc_id").agg(F.coalesce(F.min_by("revision", F.when(F.col("revision").isNotNull(), F.col("block_index"))), F.lit(UNKNOWN)).alias("revision"))
