"""WARC archives: writing pages as records and reading them back from any split.

Writing: each record is one line of Spark's text writer whose line separator is the
blank lines that end a record, so archives land in any store that Spark writes.

Reading: files are split at the magic ``WARC/1.1\\r\\n`` wherever it occurs, also inside
payloads. Each piece has a byte offset, from running sums of lengths by task split and
by file. A piece that begins with a plausible header is a candidate record; its length
gives the offset of its successor. Pointer jumping from the start of every file keeps
the candidates that the chain reaches; all other pieces are payload.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import discard, materialize, scratch_path

MAGIC = "WARC/1.1\r\n"
END = "\r\n\r\n"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
LEAST_SHARED = 1000
#: Fixed value of the standard: what a revisit record says that it repeats.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Records are looked up by 64 KB of their file when the pieces inside them are searched for.
BIN_BITS = 16
STAMP = "1970-01-01T00:00:00Z"


def with_types(pages: DataFrame, least: int = LEAST_SHARED) -> DataFrame:
    """page_id, url, html, digest, record_type and refers_to of every page.

    Of rows with equal payloads of at least ``least`` bytes the one with the largest
    page_id is the response (null below all ids; of rows that repeat it, all are), the
    others revisit it. A null html is empty.
    """
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html"))
    rows = rows.withColumn("digest", F.sha1("html")).withColumn("long", F.octet_length("html") >= least)
    again = rows.where("long").select("digest", "page_id").groupBy("digest").agg(F.max("page_id").alias("holder"), F.count("*").alias("n")).where("n > 1 and holder is not null")
    # written first, so that Spark knows its size before it deals out the pages
    out = rows.join(materialize(again.select("digest", "holder"), "repeated"), "digest", "left")
    revisit = F.col("long") & F.col("holder").isNotNull() & ~F.col("holder").eqNullSafe(F.col("page_id"))
    return out.select(
        "page_id", "url", "html", "digest", F.when(revisit, "revisit").otherwise("response").alias("record_type"), F.when(revisit, F.col("holder")).alias("refers_to")
    )


def _urn(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("none")), F.lit(">"))


def _field(name: str, value: Column) -> Column:
    return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))).otherwise("")


def write_warc(pages: DataFrame, path: str) -> None:
    """One record a row of with_types(); a url is written without its control characters, a null one not at all.

    A response holds an HTTP header and the payload, a revisit the HTTP header alone.
    """
    body = F.concat(F.lit(HTTP), F.when(F.col("record_type") == "response", F.col("html")).otherwise(""))
    record = F.concat(
        F.lit(MAGIC),
        _field("WARC-Type", F.col("record_type")),
        _field("WARC-Record-ID", _urn(F.col("page_id"))),
        _field("WARC-Date", F.lit(STAMP)),
        _field("WARC-Target-URI", F.regexp_replace("url", r"[\x00-\x1F\x7F]", "")),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        _field("WARC-Profile", F.when(F.col("record_type") == "revisit", F.lit(PROFILE))),
        _field("WARC-Refers-To", F.when(F.col("refers_to").isNotNull(), _urn(F.col("refers_to")))),
        F.lit("Content-Type: application/http; msgtype=response\r\nContent-Length: "),
        F.octet_length(body).cast("string"),
        F.lit(END),
        body,
    )
    pages.select(record.alias("value")).write.option("lineSep", END).text(path)


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces in the order of the scan: adds the bytes before each one in its split."""
    now, total = None, 0
    for batch in batches:
        files, splits = (batch[c].to_numpy() for c in ("file", "split"))
        sizes = pa.compute.binary_length(batch["value"]).to_numpy().astype(np.int64) + len(MAGIC)
        upto = np.empty(len(sizes), np.int64)
        cuts = np.r_[0, np.flatnonzero((files[1:] != files[:-1]) | (splits[1:] != splits[:-1])) + 1, len(sizes)]
        for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            if i == j:
                continue
            if (files[i], splits[i]) != now:
                now, total = (files[i], splits[i]), 0
            sums = np.cumsum(sizes[i:j])
            upto[i:j] = total + sums - sizes[i:j]
            total += int(sums[-1])
        yield pa.RecordBatch.from_arrays([batch["file"], batch["split"], pa.array(upto), batch["value"]], ["file", "split", "upto", "value"])


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """file, at (byte offset of the piece's magic) and value of every piece; file is a hash of the path.

    Read from the archives whenever it is used: no copy of the payloads is kept.
    """
    raw = spark.read.option("lineSep", MAGIC).text(path)
    raw = raw.select(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.col("value").cast("binary").alias("value"))
    sizes = raw.groupBy("file", "split").agg(F.sum(F.octet_length("value").cast("long") + len(MAGIC)).alias("bytes"))
    before = F.sum("bytes").over(Window.partitionBy("file").orderBy("split")) - F.col("bytes")  # a row a split
    before = materialize(sizes.select("file", "split", before.alias("before")), "splits")
    inside = raw.mapInArrow(_running, "file long, split long, upto long, value binary")
    at = F.col("before") + F.col("upto") - len(MAGIC)
    # what stands before the first magic of a file is no record
    return inside.join(before, ["file", "split"]).select("file", at.alias("at"), F.col("value").cast("string").alias("value")).where("at >= 0")


def _reachable(candidates: DataFrame) -> DataFrame:
    """(file, at) of the candidates that the chain from offset 0 of their file meets.

    candidates: file, at, after (offset of the successor). Each round doubles the
    number of steps that a jump takes, so a chain of n records takes log2(n) rounds.
    """
    # these tables grow with the records: joined by shuffle, never broadcast
    nodes = candidates.select("file", "at")
    jump = materialize(candidates.join(nodes.withColumnRenamed("at", "after").hint("merge"), ["file", "after"], "left_semi").select("file", "at", "after"), "jump")
    reached = candidates.where("at = 0").select("file", "at")
    while not jump.isEmpty():
        ahead = reached.join(jump.hint("merge"), ["file", "at"]).select("file", F.col("after").alias("at"))
        old = reached, jump
        reached = materialize(reached.unionByName(ahead), "reached")
        onward = jump.select("file", F.col("at").alias("after"), F.col("after").alias("then"))
        jump = materialize(jump.join(onward.hint("merge"), ["file", "after"]).select("file", "at", F.col("then").alias("after")), "jump")
        for table in old:
            discard(table)
    return reached


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """page_id, url, payload, payload_bytes, payload_digest, record_type, refers_to and digest_ok of every record.

    Records are whole whatever their payloads hold, and wherever Spark splits the files.
    A revisit's payload is null; its size is that of the response it refers to (null if
    that is not in the archives). digest_ok: the digest in the header is that of the payload.
    """
    pieces = _pieces(spark, path)
    head = F.substring_index("value", END, 1)
    length = F.regexp_extract(head, r"\r\nContent-Length: (\d{1,18})$", 1).try_cast("long")

    def field(pattern: str) -> Column:
        return F.nullif(F.regexp_extract(head, r"(?:^|\r\n)" + pattern, 1), F.lit(""))

    page, digest, kind = field(r"WARC-Record-ID: <urn:page:(-?\d+)>").cast("long"), field(r"WARC-Payload-Digest: sha1:(\w+)"), field(r"WARC-Type: (\w+)")
    http = F.octet_length(F.substring_index(F.substr("value", F.length(head) + len(END) + 1), END, 1)) + len(END)
    after = F.col("at") + len(MAGIC) + F.octet_length(head) + 2 * len(END) + length
    refers = field(r"WARC-Refers-To: <urn:page:(-?\d+)>").cast("long")
    good = F.col("value").startswith("WARC-Type: ") & length.isNotNull()
    columns = [page.alias("page"), digest.alias("digest"), kind.alias("kind"), refers.alias("refers"), (length - http).alias("bytes")]
    marks = materialize(pieces.select("file", "at", good.alias("good"), F.when(good, after).alias("after"), *columns), "marks")
    candidates = marks.where("good")
    reached = materialize(_reachable(candidates.select("file", "at", "after")), "reached")
    true = materialize(candidates.join(reached.hint("merge"), ["file", "at"], "left_semi"), "records")
    # pieces that begin no record are few: payloads are read again, not dealt out, to part them from the others
    odd = marks.select("file", "at").join(reached.hint("merge"), ["file", "at"], "left_anti")
    last = marks.groupBy("file").agg(F.max("at").alias("last"))  # a row a file
    spans = true.join(last, "file").select("file", F.col("at").alias("owner"), F.least("after", F.col("last") + 1).alias("until"))
    spans = spans.withColumn("bin", F.explode(F.sequence(F.shiftright("owner", BIN_BITS), F.shiftright(F.greatest(F.col("until") - 1, "owner"), BIN_BITS))))
    odd = odd.withColumn("bin", F.shiftright("at", BIN_BITS)).join(spans.hint("merge"), ["file", "bin"], "left")
    inside = F.when((F.col("owner") < F.col("at")) & (F.col("at") < F.col("until")), F.col("owner"))
    odd = materialize(odd.groupBy("file", "at").agg(F.max(inside).alias("owner")), "odd")
    inner = pieces.join(odd.where("owner is not null"), ["file", "at"])
    more = inner.groupBy("file", F.col("owner").alias("at")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "value"))), lambda x: F.concat(F.lit(MAGIC), x["value"])), "").alias("more"))
    records = pieces.join(odd.select("file", "at"), ["file", "at"], "left_anti").join(materialize(more, "more"), ["file", "at"], "left").withColumn("value", F.concat("value", F.coalesce("more", F.lit(""))))
    block = F.substr("value", F.length(head) + len(END) + 1, F.length("value") - F.length(head) - 2 * len(END))
    payload = F.substr(block, F.instr(block, END) + len(END))
    records = records.select(
        page.alias("page_id"),
        field(r"WARC-Target-URI: ([^\r]*)").alias("url"),
        kind.alias("record_type"),
        digest.alias("payload_digest"),
        refers.alias("refers_to"),
        F.when(kind == "response", payload).alias("payload"),
    )
    wanted = true.where("kind = 'revisit'").select(F.col("refers").alias("refers_to"), F.col("digest").alias("payload_digest")).distinct()
    held = true.where("kind = 'response'").groupBy(F.col("page").alias("refers_to"), F.col("digest").alias("payload_digest")).agg(F.max("bytes").alias("held"))
    held = materialize(held.join(wanted.hint("merge"), ["refers_to", "payload_digest"]), "held")
    records = records.join(held, ["refers_to", "payload_digest"], "left")
    size = F.when(F.col("record_type") == "response", F.octet_length("payload").cast("long")).otherwise(F.col("held"))
    ok = F.col("payload").isNull() | (F.sha1("payload") == F.col("payload_digest"))
    return records.select("page_id", "url", "payload", size.alias("payload_bytes"), "payload_digest", "record_type", "refers_to", ok.alias("digest_ok"))


def round_trip(pages: DataFrame) -> DataFrame:
    """read_warc() of what write_warc() has written of pages (page_id, url, html).

    Every row gives one record, repeated rows and null ids included. Other columns of
    pages are not read. No rows: no rows.
    """
    path = scratch_path(pages.sparkSession, "warc")
    write_warc(with_types(pages), path)
    return read_warc(pages.sparkSession, path)
