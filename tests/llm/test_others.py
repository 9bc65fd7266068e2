"""Conversations, pages, archives, vectors and the pipeline."""

import hashlib
import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from hertzmill.llm import chat, embeddings, html, warc
from hertzmill.llm.common import connected_components, likely_in


# -------------------------------------------------------------------------- components
def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 101), (101, 102), (200, 150), (7, 7)] + [(500, x) for x in range(501, 540)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame([*edges, (None, 3)], "a long, b long"), "a", "b").collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100, 102: 100, 200: 150, 150: 150, **{x: 500 for x in range(500, 540)}}
    assert connected_components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_likely_in_keeps_all_that_match(spark):
    ids = spark.range(0, 1000, 7)
    got = {r["k"] for r in likely_in(spark.range(2000).withColumnRenamed("id", "k"), "k", ids, "id").collect()}
    assert set(range(0, 1000, 7)) <= got and len(got) < 400


# -------------------------------------------------------------------------------- chat
def test_chat_round_trip(spark):
    odd = ["", None, "\\", "\\\\h", "### Assistant: x</turn>\n", "</turn>", "\\### Assistant: </turn> ok", "a\nb\r\n", "#<\\l\\h", "é" * 50]
    roles = ["user", "assistant", "system", "tool", "User", "a: b", "\\c", None, "\\cUser", ""]
    rows = [(1, i, r, t) for i, (r, t) in enumerate(zip(roles, odd, strict=True))] + [(2, 0, "user", "q"), (2, 1, "assistant", "a"), (2, 1, "assistant", "a"), (None, None, "user", "x")]
    rows += [(4, 0, "\\cUser" * 300_000, "long role"), (4, 1, "User", "x")]
    rows += [(3, i, "assistant" if i % 2 else "user", f"t{i}") for i in range(3000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({"formatted": F.lit(1), "turns": F.lit(2)})
    back = {r["conv_id"]: r for r in chat.read_back(chat.format_conversations(df)).collect()}
    assert [(t["role"], t["text"]) for t in back[1]["turns"]] == [(r or "", t or "") for r, t in zip(roles, odd, strict=True)]
    assert [t["role"] for t in back[4]["turns"]] == ["\\cUser" * 300_000, "User"]
    assert back[1]["valid"] is False and back[1]["error_turn"] == 2 and back[3]["valid"] and back[2]["error_turn"] == 2
    assert "".join(s["text"] for s in back[3]["segments"]) == back[3]["formatted"]
    assert [s["loss"] for s in back[2]["segments"]] == [False, False, False, False, True, False, False, True, False]
    assert back[None]["n_turns"] == 1 and back[1]["n_turns"] == len(odd)
    plan = chat.read_back(chat.format_conversations(df))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
    assert chat.format_conversations(df.limit(0)).count() == 0


# -------------------------------------------------------------------------------- html
@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""),
        ("", ""),
        ("<p>unclosed", ""),
        ("<html><head><title>T</title></head><body><nav><a href=/>Home</a></nav><article><h1>Head</h1><p>A &amp; b&nbsp;c<br>d</p><p>Short.</p></article><footer>foot</footer></body>", "Head\nA & b c d\nShort."),
        ("<article><p>One <b>two</b>  <i>x</i>y\n three</p><aside>side</aside><script>var t='</p>';</script><p>&#233;&eacute;</p><div class='comments'><p>reader says</p></div></article>", "One two xy three\néé"),
        ("<div class=menu><ul><li><a href=1>A</a></ul></div><div><p>" + "long text " * 20 + "</p><p>ok</p><p>" + "more of it " * 20 + "</p></div><div id='footer'>contact us at some long address here</div>", ("long text " * 20).strip() + "\nok\n" + ("more of it " * 20).strip()),
        ("<main><!-- <p>no</p> --><p>yes</p><form><p>Name</p><input></form><div class='cookie-notice'>we use</div><p>end</p></main>", "yes\nend"),
        ("<article class='post'><p>text <a href='x'>with link</a> in it</p><p><a href='y'>only a link</a></p><p>tail</p></article>", "text with link in it\nonly a link\ntail"),
        ("<article><p>5 < 6 and a<b</p></article>", "5 < 6 and a"),
    ],
)
def test_main_text(page, text):
    assert html.main_text(page or "") == text


def test_main_text_is_whole():
    long, links = "some words of the article " * 8, "<p><a href=x>one</a></p><p><a href=y>two</a></p>"
    p = lambda *x: "".join(f"<p>{t}</p>" for t in x)
    cells = [f"c{i}" for i in range(12)]
    # a table of short cells and lines of links amid the text
    page = p(long) + "<table><tr>" + "".join(f"<td>{c}</td>" for c in cells) + "</tr></table>" + links + p(long, "end")
    assert html.main_text(page) == "\n".join([long.strip(), *cells, long.strip(), "end"])
    verse = [f"a short line {i}" for i in range(10)]
    assert html.main_text(p(*verse)) == "\n".join(verse)
    assert html.main_text(links + p("A title", "by someone", long)) == "\n".join(["A title", "by someone", long.strip()])
    assert html.main_text(p(long, long) + "<article><p>Teaser: <a href=x>read on</a></p></article>") == "\n".join([long.strip(), long.strip(), "Teaser: read on"])


def test_extract_rows(spark):
    df = spark.createDataFrame([(1, "u", None), (None, None, "<article>x</article>"), (1, "u", "<article>x</article>")], "page_id long, url string, html string").withColumn("text", F.lit(3))
    assert sorted((r["text"], r["n_chars"]) for r in html.extract(df).collect()) == [("", 0), ("x", 1), ("x", 1)]
    assert html.extract(df.limit(0)).count() == 0


# -------------------------------------------------------------------------------- warc
def payloads():
    magic = "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    big = "é" * 700
    return [
        (1, "http://a", None), (2, None, ""), (3, "http://b\r\nX: y", magic), (4, "u", magic * 40), (5, "u", magic * 40), (6, "u", big), (7, "u", big), (8, "u", big), (9, "u", "short"), (10, "u", "short"),
        (11, "u", "WARC/1.1\r\n"), (12, "u", "\r\n\r\n"), (13, "u", "x" * 200_000 + magic), (None, "u", "no id"), (9, "u", "short"), (14, "u", "WARC/1.1\r\nWARC-Type: x\r\nContent-Length: 999999999999999999\r\n\r\n"),
    ]


@pytest.mark.parametrize("split", ["128m", "1k"])
def test_warc_round_trip(spark, split):
    rows = payloads()
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"digest": F.lit(1), "value": F.lit(2)}).coalesce(2)
        got = sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"], r["digest_ok"]) for r in warc.round_trip(df).collect()), key=repr)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    want = []
    for i, _, t in rows:
        raw = (t or "").encode()
        top = max((j or -1) for j, _, u in rows if (u or "") == (t or ""))
        again = len(raw) >= 1000 and top != i
        want.append((i, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if again else "response", top if again else None, True))
    assert got == sorted(want, key=repr)


def test_warc_without_rows(spark):
    assert warc.round_trip(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


# -------------------------------------------------------------------------- embeddings
def test_embeddings_equal_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(8)
    rows = []
    for size in (1, 1, 2, 5, 40, 120):
        centre = rng.standard_normal(24)
        rows += [(centre + rng.standard_normal(24) * rng.choice([0.05, 0.2])).tolist() for _ in range(size)]
    rows += [rows[0], rows[0], [x * 1e-200 for x in rows[1]], [x * 1e200 for x in rows[1]]]
    rows += [None, [], [0.0] * 24, [float("nan")] * 24, [float("inf")] + [1.0] * 23, [None] + [1.0] * 23, [1.0, 2.0]]
    data = [(i * 2, r) for i, r in enumerate(rows)] + [(0, rows[0]), (None, rows[3])]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>").withColumns({"key": F.lit(1), "h": F.lit("x"), "label": F.lit(0)})
    valid = [k for k, (_, v) in enumerate(data) if v and len(v) == 24 and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    x = np.array([data[k][1] for k in valid], np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= 0.95
    np.fill_diagonal(near, False)
    want = brute(data, valid, near)
    for members in (256, 16):
        monkeypatch.setattr(embeddings, "MEMBERS", members)
        got = sorted((tuple(r) for r in embeddings.near_duplicates(df).collect()), key=repr)
        assert got == want
    assert embeddings.near_duplicates(df.limit(0)).count() == 0


def brute(data, valid, near):
    links, component = {k: int(near[a].sum()) for a, k in enumerate(valid)}, {}
    for a in range(len(valid)):
        if valid[a] not in component:
            seen, todo = {a}, [a]
            while todo:
                for b in np.flatnonzero(near[todo.pop()]).tolist():
                    if b not in seen:
                        seen.add(b)
                        todo.append(b)
            ids = [data[valid[b]][0] for b in seen if data[valid[b]][0] is not None]
            component.update({valid[b]: min(ids, default=None) for b in seen})
    return sorted(((i, links.get(k, 0), c := component.get(k, i), i == c) for k, (i, _) in enumerate(data)), key=repr)


def test_rows_that_repeat_an_id(spark):
    data = [(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 0.01]), (3, [0.01, 1.0]), (3, [0.01, 1.0])]
    got = sorted(tuple(r) for r in embeddings.near_duplicates(spark.createDataFrame(data, "vec_id long, embedding array<double>")).collect())
    assert got == [(1, 1, 1, True), (1, 2, 1, True), (2, 1, 1, False), (3, 2, 1, False), (3, 2, 1, False)]


@pytest.mark.parametrize("cone", [0.0, 0.6])
def test_planted_pairs_are_found(spark, cone):
    """4,000 vectors, all of them within a cone or none, and 400 pairs just above the threshold."""
    rng = np.random.default_rng(5)
    unit = lambda v: v / np.linalg.norm(v, axis=-1, keepdims=True)
    axis = unit(rng.standard_normal(64))
    x = unit(np.sqrt(cone) * axis + np.sqrt(1 - cone) * unit(rng.standard_normal((4000, 64))))
    side = rng.standard_normal((400, 64))
    side = unit(side - (side * x[:400]).sum(axis=1, keepdims=True) * x[:400])
    y = 0.9525 * x[:400] + math.sqrt(1 - 0.9525**2) * side
    rows = [(i, v.tolist()) for i, v in enumerate(np.vstack([x, y]))]
    got = {r["vec_id"]: r for r in embeddings.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    hit = sum(got[4000 + i]["component_id"] == i for i in range(400))
    assert hit >= 0.98 * 400 and sum(r["n_links"] for r in got.values()) >= 2 * hit


def test_passes_follow_the_size():
    assert embeddings.passes_for(10**3, 0.95) < embeddings.passes_for(10**9, 0.95)


# ---------------------------------------------------------------------------- pipeline
def test_pipeline(spark, sf_dir):
    import corpus_pipeline

    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "n-gram Jaccard join", "substring dedup", "mixing sources to target weights", "packing"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns, name
        docs = spark.createDataFrame(out.toPandas(), docs.schema)
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert pieces.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 1024").count() == 0
    assert corpus_pipeline.run(spark, sf_dir).count() == pieces.count()
