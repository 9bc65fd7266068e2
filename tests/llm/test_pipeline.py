"""The pipeline as a run: what each stage keeps, odd rows and empty tables."""

import re

import pytest

import corpus_pipeline as P
from hertzmill.llm.jaccard import one_of_each

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def stages(spark, folder):
    """Rows of the documents and of what each stage but the last keeps, then the last one's rows."""
    docs, out = spark.read.parquet(f"{folder}/documents.parquet"), []
    out.append(docs.collect())
    for _, stage in P.STAGES:
        kept = stage(spark, docs, folder)
        out.append(kept.collect())
        docs = spark.createDataFrame(out[-1], kept.schema)
    return out


def words(text):
    return len(re.findall(r"[^ \t-\r]+", text or ""))


def written(spark, tmp_path, rows):
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    return str(tmp_path)


def test_run_equals_its_stages(spark, sf_dir):
    read, good, single, cut, mixed, packed = stages(spark, sf_dir)
    got = P.run(spark, sf_dir).collect()
    known = {r["doc_id"]: r for r in read}
    assert all(tuple(r) == tuple(known[r["doc_id"]]) for r in [*good, *single])  # rows that stay are as they were
    assert len({r["doc_id"] for r in single}) == len(single) <= len(good) <= len(read)
    again = one_of_each(spark.createDataFrame(single, SCHEMA)).count()
    assert again == len(single)  # nothing alike is left
    assert all(len(r["text"]) <= len(known[r["doc_id"]]["text"]) and r["n_chars"] == len(r["text"]) for r in cut if r["text"] != known[r["doc_id"]]["text"])
    sizes = {r["doc_id"]: words(r["text"]) for r in cut}
    times = {}
    for r in mixed:
        times[r["doc_id"]] = times.get(r["doc_id"], 0) + 1
    assert set(times) <= set(sizes) and max(times.values()) <= 2 and len({r["doc_id"] for r in cut}) >= len(times)
    for rows in (packed, got):
        tokens = {}
        for r in rows:
            tokens[r["doc_id"]] = tokens.get(r["doc_id"], 0) + r["length"]
        whole = {r["doc_id"]: r["doc_tokens"] for r in rows}
        assert tokens == {d: whole[d] * times[d] for d in times}
        fill = {}
        for r in rows:
            fill[r["sequence_id"]] = fill.get(r["sequence_id"], 0) + r["length"]
        assert max(fill.values()) <= 1024


def test_odd_rows_and_no_rows(spark, sf_dir, tmp_path):
    some = [(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").limit(40).collect()]
    odd = [(None, None, None, None, None), (10**6, None, "en", "a", 0), (10**6 + 1, "", None, None, 0), (10**6 + 2, " \n\t ", "en", "a", 4), (None, some[0][1], "en", "a", 5), some[3], some[3]]
    got = P.run(spark, written(spark, tmp_path / "odd", some + odd)).collect()
    assert got and {r["doc_id"] for r in got} - {None} <= {r[0] for r in some}
    none = P.run(spark, written(spark, tmp_path / "none", []))
    assert none.count() == 0 and "sequence_id" in none.columns


@pytest.mark.parametrize("k", range(4))
def test_stages_keep_the_columns(spark, tmp_path, k):
    empty = spark.createDataFrame([], SCHEMA + ", key string, value long")
    assert P.STAGES[k][1](spark, empty, "").columns == empty.columns
