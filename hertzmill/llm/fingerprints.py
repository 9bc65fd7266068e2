"""Fingerprints by consistent weighted sampling, in DataFrame functions only.

A term (five consecutive words, lower-cased) weighs as often as it occurs. For each of 32
samples a term draws r and c from the gamma distribution (2, 1) and b from the unit interval,
all by hash, so equal terms draw alike in every text. With t = floor(ln(weight) / r + b)
its rank is ln(c) - r (t + 1 - b), and the term of least rank, with its t, is the sample:
two texts share a sample with a probability of their generalised Jaccard likeness, the sum
of the lesser over the sum of the greater weights.

Texts move once, by blocks of neighbouring ids; all later steps keep that partitioning.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .quality import _let, _pairs

WORDS = 5
SAMPLES = 32
#: Samples that one row of a term draws; the others are drawn by further rows, so that generated code stays small.
AT_ONCE = 4
#: Quantiles of the gamma distribution that a draw chooses from.
QUANTILES = 1024
#: A sample is ordered by its rank, in 2^-36 above -64, before 20 bits that name the term and t.
BITS, SCALE, LOWEST = 20, 1 << 36, 64


def gamma_quantiles(n: int = QUANTILES) -> list[float]:
    """The quantiles (i + 1/2) / n of the gamma distribution (2, 1), whose share up to x is 1 - (1 + x) exp(-x)."""
    out, x = [], 0.0
    for i in range(n):
        lo, hi, share = x, 64.0, (i + 0.5) / n
        while hi - lo > 1e-12:
            x = (lo + hi) / 2
            lo, hi = (x, hi) if 1 - (1 + x) * math.exp(-x) < share else (lo, x)
        out.append(x)
    return out


def _constant(values: list[float]) -> Column:
    return F.split(F.lit(",".join(map(repr, values))), ",").cast("array<double>")


def words(text: Column) -> Column:
    """Lower-cased words of a text; empty strings among them where spaces follow each other."""
    for space in "\t\n\x0b\f\r":
        text = F.replace(text, F.lit(space), F.lit(" "))
    return F.split(F.lower(text), " ", -1)


def _counts(s: Column) -> Column:
    """How often each value of a sorted array comes."""
    starts = F.filter(F.transform(s, lambda x, i: F.when((i == 0) | (F.get(s, i - 1) != x), i)), lambda i: i.isNotNull())
    return _let(starts, lambda at: F.transform(at, lambda i, k: F.coalesce(F.get(at, k + 1), F.size(s)) - i))


def with_terms(texts: DataFrame, text: str) -> DataFrame:
    """texts without the text, but with terms, the distinct terms of it, and weights, null where each of them comes once.

    With fewer than five words all of them are one term, without words there is none. Each
    step is a column of its own, so that none is evaluated twice.
    """
    keys = [c for c in texts.columns if c != text]
    out = texts.select(*keys, F.array_remove(F.transform(words(F.col(text)), lambda w: F.xxhash64(w)), F.xxhash64(F.lit(""))).alias("a"))
    out = out.select(*keys, "a", _pairs(F.col("a"), 1).alias("two")).select(*keys, "a", _pairs(F.col("two"), 2).alias("four"))
    n = F.greatest(F.size("a") - (WORDS - 1), F.lit(0))
    fives = F.zip_with(F.slice("four", F.lit(1), n), F.slice("a", F.lit(WORDS), n), lambda x, y: F.xxhash64(x, y))
    whole = F.aggregate("a", F.lit(0).cast("long"), lambda h, x: F.xxhash64(h, x))
    out = out.select(*keys, F.when(F.size("a") >= WORDS, fives).when(F.size("a") > 0, F.array(whole)).otherwise(F.array().cast("array<long>")).alias("s"))
    out = out.select(*keys, "s", F.array_distinct("s").alias("d"))
    again = F.size("d") < F.size("s")
    return out.select(*keys, F.when(again, F.sort_array("d")).otherwise(F.col("d")).alias("terms"), F.when(again, _let(F.sort_array("s"), _counts)).alias("weights"))


def sampled(texts: DataFrame, text: str) -> DataFrame:
    """The columns of texts but the text, and samples, an array of SAMPLES names; null for a text without words.

    Rows with equal other columns are taken as one.
    """
    keys = [c for c in texts.columns if c != text]
    quantiles = gamma_quantiles()
    r_of, c_of = _constant(quantiles), _constant([math.log(x) for x in quantiles])
    rows = with_terms(texts, text).withColumn("some", F.size("terms") > 0)
    rows = rows.select(*keys, "some", "weights", F.posexplode_outer("terms").alias("i", "term")).select(*keys, "some", "term", F.log(F.coalesce(F.get("weights", F.col("i")), F.lit(1)).cast("double")).alias("lw"))
    rows = rows.withColumn("g", F.explode(F.array(*[F.lit(g) for g in range(SAMPLES // AT_ONCE)])))
    each = range(AT_ONCE)
    # ten bits of a hash choose r, ten c, twenty b; the others name the term
    rows = rows.select(*keys, "some", "g", "lw", *[F.xxhash64("term", "g", F.lit(j)).alias(f"h{j}") for j in each])
    r = [F.get(r_of, F.col(f"h{j}").bitwiseAND(QUANTILES - 1).cast("int")).alias(f"r{j}") for j in each]
    b = [((F.shiftrightunsigned(f"h{j}", 20).bitwiseAND((1 << 20) - 1) + 0.5) / (1 << 20)).alias(f"b{j}") for j in each]
    rows = rows.select("*", *r, *b).select("*", *[F.floor(F.col("lw") / F.col(f"r{j}") + F.col(f"b{j}")).alias(f"t{j}") for j in each])

    def draw(j: int) -> Column:
        h, t = F.col(f"h{j}"), F.col(f"t{j}")
        log_c = F.get(c_of, F.shiftrightunsigned(h, 10).bitwiseAND(QUANTILES - 1).cast("int"))
        rank = ((log_c - F.col(f"r{j}") * (t + 1 - F.col(f"b{j}")) + LOWEST) * SCALE).cast("long")
        name = F.shiftrightunsigned(h, 44).bitwiseXOR(t * 0x9E377).bitwiseAND((1 << BITS) - 1)
        return F.shiftleft(rank, BITS).bitwiseOR(name)

    least = rows.groupBy(*keys, "g").agg(F.max("some").alias("some"), *[F.min(draw(j)).alias(f"m{j}") for j in each])
    names = F.array(*[F.col(f"m{j}").bitwiseAND((1 << BITS) - 1).cast("int") for j in each])
    grouped = least.groupBy(*keys).agg(F.max("some").alias("some"), F.array_sort(F.collect_list(F.struct("g", names.alias("names")))).alias("a"))
    return grouped.select(*keys, F.when(F.col("some"), F.flatten(F.transform("a", lambda x: x["names"]))).alias("samples"))


def shown(samples: Column) -> Column:
    """A fingerprint: five hexadecimal digits a sample; empty without samples."""
    return F.coalesce(F.array_join(F.transform(samples, lambda x: F.lpad(F.lower(F.hex(x)), BITS // 4, "0")), ""), F.lit(""))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal samples; two texts without words are alike, one and another that has some are not."""
    same = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda x: x)) / F.lit(float(SAMPLES))
    return F.when(a.isNull() & b.isNull(), F.lit(1.0)).otherwise(F.coalesce(same, F.lit(0.0)))


#: Documents a block, and most blocks; the driver sees the least id of each.
BLOCK_ROWS, MOST_BLOCKS = 256, 1 << 16


def _blocks(docs: DataFrame) -> tuple[list[int], bool]:
    """Ids at which blocks of about equal numbers of documents begin, and whether an id is null.

    Every so many-th id of each range of ids begins a block, the first one of a range too.
    """
    n, nulls = docs.agg(F.count("*"), F.count_if(F.col("doc_id").isNull())).first()
    rows = max(BLOCK_ROWS, -(-n // MOST_BLOCKS))
    ids = docs.select("doc_id").where(F.col("doc_id").isNotNull()).repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    place = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    found = ids.withColumn("place", place).where(F.col("place") % rows == 0).select("doc_id").distinct().collect()
    return sorted(r["doc_id"] for r in found), nulls > 0


def _block_of(bounds: list[int]) -> Column:
    """Number of the block that doc_id lies in, 0 for null; two searches among 256 bounds each."""
    rows = [bounds[i : i + 256] for i in range(0, len(bounds), 256)] or [[]]
    nested = F.from_json(F.lit(str(rows)), "array<array<bigint>>")
    coarse = F.from_json(F.lit(str([r[0] for r in rows if r])), "array<bigint>")
    place = lambda a: F.greatest(F.size(F.filter(a, lambda x: x <= F.col("doc_id"))) - 1, F.lit(0))
    return _let(place(coarse), lambda k: k * 256 + place(F.get(nested, k)))


def in_order(docs: DataFrame) -> DataFrame:
    """doc_id, text and next_text, the text of the next document by doc_id (the first one's after the last); block, place and guest.

    Every block ends with a guest, a copy of the row after its last. Texts are shuffled
    once, by block. Nulls come first, rows that repeat an id are ordered by text.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    bounds, nulls = _blocks(docs)
    last = max(len(bounds) - 1, 0)
    starts = F.from_json(F.lit(str(bounds)), "array<bigint>")
    first = F.col("doc_id").isNull() if nulls else F.col("doc_id") == (bounds[0] if bounds else 0)
    visits = F.when(first, F.lit(last)).when((F.col("own") > 0) & (F.get(starts, F.col("own")) == F.col("doc_id")), F.col("own") - 1)
    places = F.filter(F.array(F.struct(F.col("own").alias("block"), F.lit(False).alias("guest")), F.struct(visits.alias("block"), F.lit(True).alias("guest"))), lambda x: x["block"].isNotNull())
    rows = docs.withColumn("own", _block_of(bounds)).withColumn("p", F.explode(places)).select("p.block", "p.guest", "doc_id", "text")
    order = Window.partitionBy("block").orderBy("guest", F.asc_nulls_first("doc_id"), "text")
    rows = rows.select("*", F.row_number().over(order).alias("place"), F.lead("text").over(order).alias("next_text"), F.lag("guest").over(order).alias("behind"))
    return rows.where("not (guest and coalesce(behind, false))").drop("behind")


def edited_texts(docs: DataFrame) -> DataFrame:
    """in_order() with n_chars and edited: the last half of the code points replaced by as many first ones of the next document."""
    half = F.floor(F.col("n_chars") / 2).cast("int")
    out = in_order(docs).withColumn("n_chars", F.length("text").cast("long"))
    edited = F.concat(F.substring("text", F.lit(1), (F.col("n_chars") - half).cast("int")), F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), half))
    return out.select("block", "place", "guest", "doc_id", "text", "n_chars", F.when(~F.col("guest"), edited).alias("edited"))


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next of each row of docs.

    Equal texts have equal fingerprints whatever their ids. A null text is an empty one; a
    text without words has an empty fingerprint. Repeated rows give repeated rows; rows
    that repeat an id follow each other by text; a null doc_id comes first. One row alone
    is its own next. Only doc_id and text are read. No rows: no rows.
    """
    rows = edited_texts(docs).withColumn("row", F.col("place").cast("long") * 2)
    both = F.array(F.struct(F.col("row").alias("row"), F.col("text").alias("t")), F.struct((F.col("row") + 1).alias("row"), F.col("edited").alias("t")))
    texts = rows.select("block", F.explode(F.filter(both, lambda x: x["t"].isNotNull())).alias("x")).select("block", "x.row", "x.t")
    order = Window.partitionBy("block").orderBy("row")
    found = sampled(texts, "t").select("*", F.lead("samples", 1).over(order).alias("edited"), F.lead("samples", 2).over(order).alias("next"))
    # what isn't sampled is joined again, so that the keys of the samples are numbers only
    own = rows.where("not guest").select("block", "row", "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"))
    return own.join(found, ["block", "row"]).select(
        "doc_id", "n_chars", "edited_sha256", shown(F.col("samples")).alias("fingerprint"), shown(F.col("edited")).alias("edited_fingerprint"),
        likeness(F.col("samples"), F.col("edited")).alias("near_edited"), likeness(F.col("samples"), F.col("next")).alias("near_next"),
    )
