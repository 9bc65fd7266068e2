"""Fingerprints against a plain computation, and their likeness against that of the weighted sets."""

import hashlib
import math
import random
import re
from collections import Counter
from fractions import Fraction

import xxhash
from pyspark.sql import functions as F

from hertzmill.llm import fingerprints as P

SCHEMA = "doc_id long, text string, block int, place int, term long"
MASK = (1 << 64) - 1


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def xx(*values, seed=42):
    for v in values:
        raw = v.encode() if isinstance(v, str) else v.to_bytes(4 if isinstance(v, Int) else 8, "little", signed=True)
        seed = xxhash.xxh64_intdigest(raw, seed=seed)
    return signed(seed)


class Int(int):
    """A 32-bit integer, which is hashed otherwise than a 64-bit one."""


def weights(text):
    words = [w for w in "".join(" " if c in "\t\n\x0b\f\r" else c for c in (text or "").lower()).split(" ") if w]
    h = [xx(w) for w in words]
    if len(h) >= 5:
        two = [xx(a, b) for a, b in zip(h, h[1:])]
        four = [xx(a, b) for a, b in zip(two, two[2:])]
        return Counter(xx(a, b) for a, b in zip(four, h[4:]))
    whole = 0
    for x in h:
        whole = xx(whole, x)
    return Counter([whole] if h else [])


def samples(text):
    q = P.gamma_quantiles()
    out = []
    for i in range(P.SAMPLES):
        least = None
        for term, weight in weights(text).items():
            h = xx(term, Int(i // P.AT_ONCE), Int(i % P.AT_ONCE)) & MASK
            r, log_c, b = q[h & 1023], math.log(q[h >> 10 & 1023]), ((h >> 20 & 0xFFFFF) + 0.5) / (1 << 20)
            t = math.floor(math.log(weight) / r + b)
            rank = int((log_c - r * (t + 1 - b) + 64) * (1 << 36))
            found = rank, (h >> 44 ^ t * 0x9E377) & 0xFFFFF
            least = found if least is None or found < least else least
        out.append(least and least[1])
    return out


def print_of(text):
    s = samples(text)
    return "" if s[0] is None else "".join(f"{x:05x}" for x in s)


def near(a, b):
    a, b = samples(a), samples(b)
    if a[0] is None or b[0] is None:
        return 1.0 if a == b else 0.0
    return sum(x == y for x, y in zip(a, b)) / P.SAMPLES


def plain(rows):
    rows = sorted(((d, t or "") for d, t, *_ in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))
    out = []
    for k, (d, t) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        half = len(t) // 2
        edited = t[: len(t) - half] + following[:half]
        out.append((d, len(t), hashlib.sha256(edited.encode()).hexdigest(), print_of(t), print_of(edited), near(t, edited), near(t, following)))
    return sorted(out, key=str)


def ours(df):
    return sorted(map(tuple, P.fingerprints(df).collect()), key=str)


def made():
    rnd = random.Random(4)
    words = [f"wort{i}" for i in range(40)] + ["é", "漢字", "ü\n", "\tx"]
    rows = [(i * 3, " ".join(rnd.choice(words) for _ in range(rnd.choice([0, 1, 3, 5, 9, 60])))) for i in range(40)]
    rows += [(None, "null id"), (None, None), (6, "an id that comes again"), (6, "an id that comes again"), (9, None), (-4, "  "), (500, "LIKE Like like " * 30), (501, "x" * 5000)]
    return [(*r, 1, 2, 3) for r in rows]


def test_equals_the_plain_computation(spark, monkeypatch):
    rows = made()
    assert ours(spark.createDataFrame(rows, SCHEMA)) == plain(rows)
    for size in (1, 7):  # many blocks, some of one row
        monkeypatch.setattr(P, "BLOCK_ROWS", size)
        assert ours(spark.createDataFrame(rows, SCHEMA).repartition(3)) == plain(rows)
        some = [r for r in rows if r[0] is not None]
        assert ours(spark.createDataFrame(some, SCHEMA)) == plain(some)


def test_few_rows(spark):
    assert P.fingerprints(spark.createDataFrame([], SCHEMA)).count() == 0
    for rows in ([(1, "a b c d e f g", 0, 0, 0)], [(None, None, 0, 0, 0)], [(None, "a", 0, 0, 0), (None, "b", 0, 0, 0)]):
        assert ours(spark.createDataFrame(rows, SCHEMA)) == plain(rows)


def test_blocks_of_more_than_256_bounds(spark):
    bounds = list(range(-5000, 5000, 7))
    got = spark.range(-5100, 5100, 13).select(F.col("id").alias("doc_id")).withColumn("b", P._block_of(bounds)).collect()
    assert all(r["b"] == max(0, sum(x <= r["doc_id"] for x in bounds) - 1) for r in got)


def test_likeness_is_the_generalised_jaccard_likeness(spark):
    rnd, pairs = random.Random(8), []
    for k in range(120):
        a = [f"w{k}x{i}" for i in range(80)]
        shared = rnd.randrange(0, 81)
        b = a[:shared] + [f"v{k}x{i}" for i in range(80 - shared)]
        if k % 2:  # repeated passages weigh more
            a, b = a + a[:30] * 3, b + b[:30] * rnd.randrange(0, 5)
        pairs.append((k, " ".join(a), " ".join(b)))
    df = spark.createDataFrame(pairs, "k long, a string, b string")
    a, b = (P.sampled(df.select("k", c), c).withColumnRenamed("samples", c) for c in "ab")
    got = {r["k"]: r["near"] for r in a.join(b, "k").select("k", P.likeness(F.col("a"), F.col("b")).alias("near")).collect()}
    errors = []
    for k, x, y in pairs:
        x, y = weights(x), weights(y)
        errors.append(got[k] - float(Fraction(sum((x & y).values()), sum((x | y).values()))))
    assert abs(sum(errors) / len(errors)) < 0.02 and max(map(abs, errors)) < 0.3
    assert math.sqrt(sum(e * e for e in errors) / len(errors)) < 0.0884  # at most that of 32 independent samples


def test_no_python_and_texts_are_shuffled_once(spark, sf_dir):
    df = P.fingerprints(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
    by_block = [x for x in plan.split("\n") if re.search(r"Exchange hashpartitioning\(block#\d+, \d+\)", x) and "Reused" not in x]
    assert len(by_block) == 1 and "ReusedExchange" in plan and "Exchange SinglePartition" not in plan


def test_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").orderBy("doc_id").limit(25)
    rows = [tuple(r) for r in docs.collect()]
    assert ours(spark.createDataFrame(rows, "doc_id long, text string")) == plain(rows)
