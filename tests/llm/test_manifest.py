"""The Merkle manifest against a plain recursion, and on odd inputs."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from hertzmill.llm.manifest import manifest, proof_digest

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, key string, LO string, n long"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(x):
    return "-" if x is None else f"{len(str(x).encode())}:{x}"


def leaf(row, text):
    return H(*map(field, (*row[:4], text)))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([H(*out[-1][i : i + 3]) for i in range(0, len(out[-1]), 3)])
    return out


def steps(tree, i):
    for nodes in tree[:-1]:
        lo = i - i % 3
        yield "".join(nodes[lo:i]), "".join(nodes[i + 1 : lo + 3])
        i //= 3


def plain(rows):
    by_source = {}
    for r in rows:
        by_source.setdefault(r[1], []).append(r)
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        by_source[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[4])))
        trees[s] = levels([leaf(r, r[4]) for r in by_source[s]])
    top = levels([trees[s][-1][0] for s in order])
    out = []
    for k, s in enumerate(order):
        for i, r in enumerate(by_source[s]):
            path = [*steps(trees[s], i), *steps(top, k)]
            changed = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[4] is not None
            at = leaf(r, r[4].replace("\n", "") if changed else r[4])
            for left, right in path:
                at = H(left, at, right)
            out.append((r[0], trees[s][0][i], trees[s][-1][0], top[-1][0], H(*[a + b for a, b in path]), at, at == top[-1][0]))
    return sorted(out, key=str)


def ours(df):
    got = manifest(df).select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("proof")), "folded_root", "verified")
    return sorted(map(tuple, got.collect()), key=str)


def made(n):
    rows = [(i, "hot" if i % 3 else f"s{i % 7}", "en", 5, f"line {i}\nnext" if i % 2 else "one line", "x", "y", i) for i in range(n)]
    rows += [(None, None, None, None, None, None, None, None), (None, "hot", "é", 1, "ü\n", None, "z", 0), (-3, "", "", 0, "", "x", "y", 1)]
    return rows + rows[:4] + [(7, "hot", "en", 5, "another text with an id that comes again\n", "x", "y", 1), (8, "lonely", "en", 5, "\n" * 2000 + "long " * 40000, "x", "y", 1)]


@pytest.mark.parametrize("n", [0, 1, 27, 28, 300])
def test_equals_the_recursion(spark, n):
    rows = made(n)
    got = ours(spark.createDataFrame(rows, SCHEMA).repartition(5))
    assert got == plain(rows)
    assert {r[6] for r in got} == {True, False}


def test_one_source_and_one_row(spark):
    rows = [(5, "a", "en", 3, "abc", "", "", 0)]
    (row,) = ours(spark.createDataFrame(rows, SCHEMA))
    assert row[1] == row[2] == row[3] == row[5] and row[4] == H() and row[6]
    many = [(i, "a", "en", 3, "abc", "", "", 0) for i in range(30)]
    assert ours(spark.createDataFrame(many, SCHEMA)) == plain(many)


def test_no_rows(spark):
    none = manifest(spark.createDataFrame([], SCHEMA))
    assert none.count() == 0 and "verified" in none.columns


def test_many_sources(spark):
    rows = [(i, f"s{i:03}", "en", 1, "a\nb", "", "", 0) for i in range(200)]
    assert ours(spark.createDataFrame(rows, SCHEMA)) == plain(rows)


def test_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text")
    assert ours(docs) == plain([tuple(r) for r in docs.collect()])
