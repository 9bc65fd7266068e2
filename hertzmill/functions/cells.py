"""Cell texts to ranges, services and footnotes, as column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# How the printed tables write ids, ranges and pointers.
FOOTNOTE = r"\b(?:5\.\d+[A-Z]*|US\d+[A-Z]*|NG\d+[A-Z]*|G\d+[A-Z]*)\b"
SERVICE = "struct<name:string,is_primary:boolean,footnotes:array<string>>"
CHUNK = f"struct<lo_hz:long,hi_hz:long,services:array<{SERVICE}>,footnotes:array<string>,not_allocated:boolean,raw_text:string>"
_NUMBER = r"(\d[\d\s\u00a0\u2009.]*)"


def let(value: Column, body) -> Column:
    """body(value), with value evaluated once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def strip_line(line: Column) -> Column:
    return F.regexp_replace(line, r"^[\s\u00a0\u2009]+|[\s\u00a0\u2009]+$", "")


def normalize_text(text: Column) -> Column:
    """Runs of spaces and no-break spaces to one space, lines stripped, empty ones dropped."""
    lines = F.transform(F.split(text, "\n"), lambda x: strip_line(F.regexp_replace(x, "[ \\u00a0]+", " ")))
    return F.array_join(F.filter(lines, lambda x: x != ""), "\n")


def lines_of(text: Column) -> Column:
    return F.filter(F.transform(F.split(text, "\n"), strip_line), lambda x: x != "")


def _scale(unit: Column) -> Column:
    return F.when(unit == "kHz", 1e3).when(unit == "MHz", 1e6).when(unit == "GHz", 1e9)


def _hz(number: Column, unit: Column) -> Column:
    digits = F.regexp_replace(number, r"[\s\u00a0\u2009]", "")
    return F.rint(digits.try_cast("double") * _scale(unit)).cast("long")


def parse_range(line: Column, unit: Column) -> Column:
    """Struct (lo_hz, hi_hz) of 'lo-hi' or 'Below hi', null for any other line."""
    text = strip_line(F.replace(line, F.lit("(Not Allocated)"), F.lit("")))
    below = F.regexp_extract(text, rf"^Below[\s\u00a0\u2009]+{_NUMBER}$", 1)
    lo, hi = (F.regexp_extract(text, rf"^{_NUMBER}-{_NUMBER}$", i) for i in (1, 2))
    return F.when(below != "", F.struct(F.lit(0).cast("long").alias("lo_hz"), _hz(below, unit).alias("hi_hz"))).when(
        lo != "", F.struct(_hz(lo, unit).alias("lo_hz"), _hz(hi, unit).alias("hi_hz"))
    )


def extract_footnotes(line: Column) -> Column:
    """All footnote ids of a line, in order, repeats kept."""
    return F.regexp_extract_all(line, F.lit(FOOTNOTE), F.lit(0))


def is_footnote_only(line: Column) -> Column:
    return (line != "") & (strip_line(F.regexp_replace(line, FOOTNOTE, "")) == "")


def rejoin_lines(lines: Column) -> Column:
    """P10: undoes hard wraps. A joint depends on its two lines alone: a hyphen glues, and '(' or a small letter goes on after a space."""
    def glued(x: Column, i: Column) -> Column:
        before = F.get(lines, i - 1)
        sep = F.when(before.isNull(), "").when(before.endswith("-"), "").when(x.rlike(r"^(?:\(|\p{Ll})"), " ").otherwise("\n")
        return F.concat(sep, x)

    joined = F.array_join(F.transform(lines, glued), "")
    return F.when(F.size(lines) == 0, F.array().cast("array<string>")).otherwise(F.split(joined, "\n"))


def is_primary(name: Column) -> Column:
    """The first word that starts with a letter has two letters or more, all capitals."""
    word = F.regexp_extract(name, r"(?:^|[\s\u00a0\u2009])(\p{L}\S*)", 1)
    return F.regexp_replace(word, r"\P{L}", "").rlike(r"^\p{Lu}{2,}$")


def parse_services(body: Column) -> Column:
    """Struct (services, footnotes) of a cell's lines below its range, wraps undone.

    The trailing run of id-only lines is the band's own footnotes. An id-only line above
    belongs to the service before it, or to the band if there is none yet. A line of ids
    and commas isn't id-only and has no name, so its ids are lost, as in print.
    """
    last = F.array_max(F.transform(body, lambda x, i: F.when(~is_footnote_only(x), i).otherwise(-1)))
    state = f"struct<services:array<{SERVICE}>,footnotes:array<string>>"
    start = F.struct(F.array().cast(f"array<{SERVICE}>").alias("services"), F.array().cast("array<string>").alias("footnotes")).cast(state)
    numbered = F.transform(body, lambda x, i: F.struct(x.alias("line"), (i > F.coalesce(last, F.lit(-1))).alias("tail")))

    def step(acc: Column, x: Column) -> Column:
        line, ids = x["line"], extract_footnotes(x["line"])
        name = F.regexp_replace(F.regexp_replace(F.regexp_replace(line, FOOTNOTE, ""), r"[\s\u00a0\u2009]{2,}", " "), r"^[ \t.,]+|[ \t.,]+$", "")
        services, notes, n = acc["services"], acc["footnotes"], F.size(acc["services"])
        head = F.slice(services, F.lit(1), F.greatest(n - 1, F.lit(0)))
        top = F.try_element_at(services, F.lit(-1))
        grown = F.struct(top["name"].alias("name"), top["is_primary"].alias("is_primary"), F.concat(top["footnotes"], ids).alias("footnotes"))
        own = F.struct(name.alias("name"), is_primary(name).alias("is_primary"), ids.alias("footnotes"))
        to_band = x["tail"] | (is_footnote_only(line) & (n == 0))
        return F.struct(
            F.when(to_band, services).when(is_footnote_only(line), F.concat(head, F.array(grown))).when(name == "", services).otherwise(F.concat(services, F.array(own))).alias("services"),
            F.when(to_band, F.concat(notes, ids)).otherwise(notes).alias("footnotes"),
        ).cast(state)

    return F.aggregate(numbered, start, step)


def not_allocated(lines: Column) -> Column:
    """The first line says so."""
    return F.coalesce(F.contains(F.get(lines, F.lit(0)), F.lit("Not Allocated")), F.lit(False))


def is_pointer(text: Column) -> Column:
    """Cells that only point to the page before."""
    return text.rlike(r"(?i)see previous page")


def parse_cell(text: Column, unit: Column) -> Column:
    """One chunk: range of the first line, if it has one, and what the other lines say."""
    def chunk(lines: Column) -> Column:
        span = parse_range(F.get(lines, F.lit(0)), unit)
        body = F.when(span.isNotNull(), F.slice(lines, F.lit(2), F.greatest(F.size(lines) - 1, F.lit(0)))).otherwise(lines)
        told = let(rejoin_lines_once(body), parse_services)
        return let(told, lambda x: F.struct(span["lo_hz"].alias("lo_hz"), span["hi_hz"].alias("hi_hz"), x["services"].alias("services"), x["footnotes"].alias("footnotes"), not_allocated(lines).alias("not_allocated"), text.alias("raw_text")))

    return let(lines_of(text), chunk)


def rejoin_lines_once(body: Column) -> Column:
    return let(body, rejoin_lines)


def split_bands(text: Column, unit: Column) -> Column:
    """The chunks of a cell: one for each range line if there are two or more, else the whole cell.

    With two or more, lines above the first range vanish and each chunk's raw_text is its own.
    """
    def chunks(lines: Column) -> Column:
        starts = F.filter(F.transform(lines, lambda x, i: F.when(parse_range(x, unit).isNotNull(), i)), lambda i: i.isNotNull())

        def cut(s: Column) -> Column:
            def part(at: Column, k: Column) -> Column:
                end = F.coalesce(F.get(s, k + 1), F.size(lines))
                return parse_cell(F.array_join(F.slice(lines, at + 1, end - at), "\n"), unit)

            return F.when(F.size(s) >= 2, F.transform(s, part)).otherwise(F.array(parse_cell(text, unit)))

        return let(starts, cut)

    return let(lines_of(text), chunks)
