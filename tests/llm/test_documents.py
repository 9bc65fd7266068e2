"""Document operators against brute force, with nulls, ties, repeats and clashing columns."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from hertzmill.llm import common, jaccard, language, mixing, packing, passages, quality

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(rb"[^\x20\x09-\x0d]+")


def words(text, fold=True):
    raw = (text or "").encode()
    return WORD.findall(raw.lower() if fold else raw)


@pytest.fixture(scope="module")
def texts():
    rnd = random.Random(11)
    vocab = ["".join(rnd.choice("abcdeéüñ") for _ in range(rnd.randint(1, 7))) for _ in range(900)]
    make = lambda n: " ".join(rnd.choice(vocab) for _ in range(n))
    out = [None, "", " \n\t ", "one", "One", "two words", "\x1c odd \x85 breaks", "a b c", "A B C"]
    base = [make(rnd.choice([5, 40, 120, 300])) for _ in range(40)]
    passage = make(70)
    for i, t in enumerate(base):
        out.append(t)
        if i % 3 == 0:
            w = t.split(" ")
            w[rnd.randrange(len(w))] = "changed"
            out.append(" ".join(w))
        if i % 5 == 0:
            out += [t, t.upper()]
        if i % 7 == 0:
            out.append(make(30) + "\n" + passage + " " + make(20))
    group = make(400).split(" ")
    for _ in range(30):
        w = list(group)
        for _ in range(rnd.randint(1, 9)):
            w[rnd.randrange(len(w))] = rnd.choice(vocab)
        out.append(" ".join(w))
    out.append(" ".join(rnd.choice(vocab[:40]) for _ in range(60_000)))  # a very long text
    out += ["\n".join(["same line here"] * 30), "BUY NOW!!! $$$ " * 20, "x" * 5000]
    return out


@pytest.fixture(scope="module")
def docs(spark, texts):
    ids = [i * 3 for i in range(len(texts))]
    rows = [(i, t, "en", f"s{i % 3}" if i % 4 else None, len(t or "")) for i, t in zip(ids, texts, strict=True)]
    rows.append((None, "a text without an id that is not short at all and has some words", None, None, None))
    rows.append((15, texts[5], "en", "s0", 9))  # a repeated row
    df = spark.createDataFrame(rows, SCHEMA).repartition(3, "doc_id")
    return df.withColumns({"n_words": F.lit("clash"), "component": F.lit(1), "hash": F.lit(2), "value": F.lit(3)})


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


# ------------------------------------------------------------------------ quality rules
def test_measures(docs):
    got = {(r["doc_id"], r["n_words"]): r for r in quality.judge(docs).collect()}
    for row in docs.collect():
        t = row["text"] or ""
        w = re.findall(r"[^\x20\x09-\x0d]+", t)
        r = got[row["doc_id"], len(w)]
        windows = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
        covered = {j for i in range(len(w) - 7) if windows[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
        lines, dup = set(), 0
        for line in t.split("\n"):
            if re.search(r"[^\x20\x09-\x0d]", line):
                dup += line in lines
                lines.add(line)
        failed = len(w) < 20 or 100 * len(covered) > 30 * len(w)
        assert (r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == (sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(covered), failed)
        assert not (r["kept"] and failed)


def test_vocabulary_of_the_whole_text(spark):
    varied = [f"w{i}" for i in range(400)]
    rows = [(1, " ".join(varied + ["a", "b", "c"] * 3000)), (2, " ".join(["a", "b"] * 200 + [f"v{i}" for i in range(9000)])), (3, " ".join(varied)), (4, "a b " * 30), (5, ""), (6, " ".join(varied[:5] * 100))]
    at = [r.name for r in quality.RULES].index("vocabulary")
    got = {r["doc_id"]: (r["n_distinct"], r["votes"][at]) for r in quality.votes(quality.measures(spark.createDataFrame(rows, "doc_id long, text string"))).collect()}
    assert got == {1: (400 + 23 * 3, -1), 2: (2 + 9000, 0), 3: (400, 0), 4: (2, -1), 5: (0, 0), 6: (10, -1)}


def test_estimation_finds_the_good_rules(spark):
    rnd = random.Random(2)
    truth, rows = [], []
    for _ in range(3000):
        good = rnd.random() < 0.7
        truth.append(good)
        rows.append(([(1 if (rnd.random() < a) == good else -1) if rnd.random() < 0.8 else 0 for a in (0.95, 0.85, 0.6)],))
    voted = spark.createDataFrame(rows, "votes array<int>")
    accuracies, prior = quality.estimate(voted, 3)
    assert accuracies[0] > accuracies[1] > accuracies[2] and abs(accuracies[0] - 0.95) < 0.05 and abs(prior - 0.7) < 0.06


def test_quality_plan_is_native(docs, empty):
    plan = quality.judge(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
    assert quality.judge(empty).count() == 0 and quality.without_rejected(empty).columns == empty.columns
    kept = quality.without_rejected(docs)
    assert kept.columns == docs.columns and 0 < kept.count() < docs.count()


# ---------------------------------------------------------------------------- Jaccard
def components(rows, n, percent):
    sets = {}
    for i, t in rows:
        w = words(t)
        if i is not None and w:
            sets[i] = frozenset(tuple(w[k : k + n]) for k in range(len(w) - n + 1)) or frozenset([tuple(w)])
    up = {i: i for i, _ in rows if i is not None}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for a in range(len(ids)):
        for b in range(a):
            x, y = sets[ids[a]], sets[ids[b]]
            if 100 * len(x & y) >= percent * len(x | y):
                p, q = root(ids[a]), root(ids[b])
                up[max(p, q)] = min(p, q)
    return {i: (len(sets.get(i, ())), root(i)) for i in up}


@pytest.mark.parametrize(("n", "percent"), [(3, 90), (5, 80)])
def test_jaccard_equals_brute_force(docs, n, percent, monkeypatch):
    want = components([(r["doc_id"], r["text"]) for r in docs.collect()], n, percent)
    got = jaccard.jaccard_components(docs, n, percent).collect()
    assert len(got) == docs.count()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got if r["doc_id"] is not None} == want
    # the same when blocks are so small that most groups have several, and when tokens are counted as hot ones are
    monkeypatch.setattr(jaccard, "LEAST_HOT", 40)
    monkeypatch.setattr(jaccard, "TOKEN_BLOCK", 4)
    monkeypatch.setattr(jaccard, "CLUSTER_BLOCK", 4)
    again = jaccard.jaccard_components(docs, n, percent).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in again if r["doc_id"] is not None} == want


def test_prefix_tree():
    rnd = np.random.default_rng(1)
    base = [np.unique(rnd.integers(0, 60, 20).astype(np.uint64)) for _ in range(120)]
    tree = jaccard.PrefixTree(60)
    for i, s in enumerate(base):
        want = {j for j in range(i) if 100 * len(np.intersect1d(s, base[j])) >= 60 * len(np.union1d(s, base[j]))}
        assert set(tree.near(s, lambda x: False)) == want
        tree.add(s, i)


def test_one_of_each(docs, empty):
    want = components([(r["doc_id"], r["text"]) for r in docs.collect()], 5, 80)
    left = jaccard.one_of_each(docs)
    assert left.columns == docs.columns
    assert {r["doc_id"] for r in left.collect()} == {i for i, (_, c) in want.items() if i == c} | {None}
    assert jaccard.jaccard_components(empty).count() == 0


# ---------------------------------------------------------------------------- passages
def test_windows_are_the_cartesian_tree():
    rnd = np.random.default_rng(4)
    for n in (3, 10, 200):
        s = rnd.integers(0, 1 << 62, n).astype(np.uint64)
        k, value, c, left, right = passages.compact_windows(s, 8, 2)
        got = set(zip(k.tolist(), value.tolist(), c.tolist(), left.tolist(), right.tolist(), strict=True))
        want = set()
        for f in range(2):
            h = passages.mix(s ^ passages._SEEDS[f])
            for i in range(n):
                a, b = i, i
                while a and h[a - 1] > h[i]:
                    a -= 1
                while b + 1 < n and h[b + 1] > h[i]:
                    b += 1
                if b - a + 1 >= 8:
                    want.add((f, int(h[i]), i, a, b))
        assert got == want


def test_passages(docs, empty):
    rows = {r["doc_id"]: words(r["text"]) for r in docs.where("doc_id is not null").collect()}
    found = passages.repeated_passages(docs).collect()
    for r in found:
        a = {tuple(rows[r["doc_id"]][i : i + 5]) for i in range(r["start"], r["end"] - 4)}
        b = {tuple(rows[r["match_doc_id"]][i : i + 5]) for i in range(r["match_start"], r["match_end"] - 4)}
        assert len(a & b) >= 0.8 * len(a | b) and r["end"] - r["start"] >= 50 and r["match_doc_id"] < r["doc_id"]
    first, covered, repeated, missed = {}, defaultdict(set), 0, 0
    for r in found:
        covered[r["doc_id"]].update(range(r["start"], r["end"]))
    for d in sorted(rows):
        for i in range(len(rows[d]) - 54):
            key = tuple(rows[d][i : i + 55])
            if first.setdefault(key, d) != d:
                repeated += 1
                missed += not covered[d] >= set(range(i, i + 55))
    assert repeated > 1000 and missed == 0
    assert {d for d in rows if any(first[tuple(rows[d][i : i + 55])] != d for i in range(len(rows[d]) - 54))} <= set(covered)
    clean = {d for d in rows if d not in covered}
    left = passages.without_passages(docs, passages.repeated_passages(docs))
    assert left.columns == docs.columns
    after = {r["doc_id"]: r for r in left.collect()}
    before = {r["doc_id"]: r for r in docs.collect()}
    assert all(after[d] == before[d] for d in clean) and None in after
    assert all(len(r["text"]) == r["n_chars"] < len(before[d]["text"]) for d, r in after.items() if d in covered)
    assert passages.repeated_passages(empty).count() == 0


def test_passages_of_repeated_ids(spark):
    """Every text of an id is looked at, also where rows of one id differ."""
    rnd = random.Random(8)
    make = lambda n: " ".join("".join(rnd.choice("abcdefgh") for _ in range(6)) for _ in range(n))
    shared, other = make(60), make(60)
    rows = [(1, make(30) + " " + shared), (1, "zz " + make(200)), (1, "aa " + make(100)), (2, shared + " " + make(20)), (2, shared + " " + make(20)), (3, other), (2, make(70) + " " + other)]
    got = {(r["doc_id"], r["start"], r["end"], r["match_doc_id"], r["match_start"]) for r in passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(2, 0, 60, 1, 30), (3, 0, 60, 2, 70)}


@pytest.mark.parametrize("every", [45, 60])
def test_near_passages_are_found(spark, every):
    """Passages of 60 to 200 words of which every so many a word is changed, in long documents of frequent lines."""
    rnd = random.Random(every)
    make = lambda n: ["".join(rnd.choice("abcdefghij") for _ in range(6)) for _ in range(n)]
    lines = [make(12) for _ in range(30)]
    text = lambda: [w for _ in range(8) for w in (*make(9), *rnd.choice(lines))]
    rows, places = [], {}
    for i in range(60):
        p = make(rnd.randint(60, 200))
        q = [("changed" + str(i) if j % every == every // 2 else w) for j, w in enumerate(p)]
        front = text()
        places[1000 + i] = (len(front), len(front) + len(q))
        rows += [(i, " ".join(text() + p + text())), (1000 + i, " ".join(front + q + text()))]
    found = defaultdict(set)
    for r in passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        found[r["doc_id"]].update(range(r["start"], r["end"]))
    hit = [d for d, (a, b) in places.items() if len(found[d] & set(range(a, b))) >= 0.8 * (b - a)]
    assert len(hit) >= 0.95 * len(places)


def test_frequent_windows_meet_the_same(spark, monkeypatch):
    """A passage and a line that many documents have: the way of frequent values finds what the other one does."""
    rnd = random.Random(6)
    make = lambda n: " ".join("".join(rnd.choice("abcdefgh") for _ in range(6)) for _ in range(n))
    line, passage = make(20), make(70)
    rows = [(i, make(40) + "\n" + (passage if i % 3 else line) + "\n" + make(rnd.randint(30, 60))) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)

    def covered():
        out = defaultdict(set)
        for r in passages.repeated_passages(docs).collect():
            out[r["doc_id"]].update(range(r["start"], r["end"]))
        return out

    usual = covered()
    monkeypatch.setattr(passages, "LEAST_HOT", 20)
    assert covered() == usual and set(usual) == {i for i in range(300) if i % 3} - {1}
    assert all(usual[i] >= set(range(40, 110)) for i in usual)


def test_passages_of_frequent_lines(spark):
    """Two documents share four lines of which each also stands in earlier documents."""
    rnd = random.Random(5)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(6))
    make = lambda n: " ".join(word() for _ in range(n))
    lines = [make(13) for _ in range(40)]
    rows = [(i, "\n".join(make(9) + "\n" + x for x in rnd.sample(lines, 12))) for i in range(60)]
    shared = ["\n".join(rnd.sample(lines, 4)) for _ in range(40)]
    rows += [(100 + 2 * i + k, make(20) + "\n" + p + "\n" + make(20)) for i, p in enumerate(shared) for k in (0, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    covered = defaultdict(set)
    for r in passages.repeated_passages(df).collect():
        covered[r["doc_id"]].update(range(r["start"], r["end"]))
    assert [i for i in range(40) if not covered[101 + 2 * i] >= set(range(20, 72))] == []


def test_windows_meet_alike_in_any_batches():
    """Pairs don't depend on batch edges or on how many windows of a value are held."""
    rng = np.random.default_rng(3)
    n = 400
    value, doc = np.sort(rng.integers(0, 12, n)), rng.integers(0, 200, n)
    order = np.lexsort((doc, value))
    columns = [value[order], doc[order], np.arange(n), rng.integers(0, 5, n) << 20, rng.integers(0, 4, n) | rng.integers(0, 4, n) << 32, rng.integers(0, 4, n) | rng.integers(0, 3, n) << 32]
    table = pa.table(dict(zip(["value", "doc", "c", "ends", "sides", "rest"], map(pa.array, columns), strict=True)))
    found = []
    for size, most in ((1000, 1000), (7, 1000), (7, 20), (50, 1), (1, 3)):
        met = pa.Table.from_batches(list(passages._meet(most)(iter(table.to_batches(max_chunksize=size)))))
        met = met.sort_by([("key", "ascending"), ("doc", "ascending"), ("a", "ascending")])
        out = pa.Table.from_batches(list(passages._meet_sorted(iter(met.to_batches(max_chunksize=size)))))
        found.append({(r["doc"], r["src"], r["a"], r["b"]) for r in out.to_pylist()})
    assert len(found[0]) > n and all(x == found[0] for x in found)


# ------------------------------------------------------------------------------ mixing
def test_mixing(docs, empty):
    rows = mixing.mix(docs).collect()
    assert len(rows) == docs.count()
    total, by = sum(r["size"] for r in rows), defaultdict(list)
    for r in rows:
        by[r["source"]].append(r)
    assert abs(sum(x[0]["target"] for x in by.values()) - 1.5 * total) < 1e-6 * total
    for x in by.values():
        z, biggest = x[0]["source_size"], max(r["size"] for r in x)
        assert z == sum(r["size"] for r in x) and x[0]["target"] <= 2 * z + 1e-9
        assert all(r["taken"] in (0, r["size"], 2 * r["size"]) for r in x)
        assert abs(sum(r["taken"] for r in x) - x[0]["target"]) <= biggest
    again = {(r["doc_id"], r["size"]): r["taken"] for r in mixing.mix(docs.repartition(5)).collect()}
    assert again == {(r["doc_id"], r["size"]): r["taken"] for r in rows}
    assert sorted(mixing.mixed(docs).columns) == sorted(docs.columns)
    assert mixing.mixed(docs).count() == sum(r["copies"] for r in rows)
    assert mixing.mix(empty).count() == 0 and mixing.mixed(empty).count() == 0


def test_nested_thresholds(docs):
    """A larger budget takes a superset."""
    small = {r["doc_id"] for r in mixing.mix(docs, amount=0.3).collect() if r["copies"]}
    large = {r["doc_id"] for r in mixing.mix(docs, amount=0.6).collect() if r["copies"]}
    assert small <= large


def water_fill(sizes, weights=(5, 2, 1), amount=1.5, most=2.0):
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight, target, left = {s: weights[i % len(weights)] for i, s in enumerate(order)}, {}, amount * sum(sizes.values())
    while True:
        rate = left / max(1, sum(weight[s] for s in order if s not in target))
        over = [s for s in order if s not in target and most * sizes[s] <= rate * weight[s]]
        if not over:
            return target | {s: rate * weight[s] for s in order if s not in target}
        for s in over:
            target[s] = most * sizes[s]
            left -= target[s]


def test_shares(spark):
    rnd = random.Random(9)
    many = {f"host-{i}": int(rnd.paretovariate(0.7)) for i in range(500)} | {None: 100, "é": 0}
    for sizes in ({"a": 10, "b": 1000, None: 100}, many, {"only": 7}, {"a": 0}):
        rows = mixing.shares(spark.createDataFrame(list(sizes.items()), "source string, source_size long").repartition(3)).collect()
        want = water_fill(sizes)
        assert {r["source"]: r["target"] for r in rows} == pytest.approx(want) and len(rows) == len(sizes)


def test_reserved_names_do_not_clash(spark):
    """Rows may have any other columns, also those that the operators add on their way."""
    clash = ["_id", "_key", "_s", "_times", "_below", "_copy", "_spans", "mix_s", "MIX_COPY", "mix_times", "linked_id", "cut_id", "cuts", "whole_row", "kept", "t", "w", "posterior", "hash", "key"]
    text = " ".join(f"w{i % 60}" for i in range(120))
    rows = [(i, text + f" x{i}", "en", "s", 1, *["v"] * len(clash)) for i in range(6)]
    docs = spark.createDataFrame(rows, SCHEMA + ", " + ", ".join(f"`{c}` string" for c in clash))
    for out in (quality.without_rejected(docs), jaccard.one_of_each(docs), passages.without_passages(docs, passages.repeated_passages(docs)), mixing.mixed(docs)):
        assert out.columns == docs.columns and all(r["_id"] == "v" and r["MIX_COPY"] == "v" for r in out.collect())
    assert packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json")).count() >= 6


def test_shuffles_go_when_their_stage_is_done(spark, docs, monkeypatch):
    """Windows and pairs aren't on disk any more while texts are compared; the session's setting stays as it was."""
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    write, setting, held = passages.materialize, common.DELETE_SHUFFLES, []

    def shuffles():
        names = (blocks.getAllFiles().apply(i).getName() for i in range(blocks.getAllFiles().size()))
        return {x for x in names if x.startswith("shuffle_")}

    def watched(df, name, **options):
        before = shuffles()
        out = write(df, name, **options)
        held.append((name, len(shuffles() - before)))
        return out

    monkeypatch.setattr(passages, "materialize", watched)
    for value in (None, "false"):
        spark.conf.set(setting, value) if value else spark.conf.unset(setting)
        default = spark.conf.get(setting, None)
        assert passages.repeated_passages(docs).count() > 10
        assert spark.conf.get(setting, None) == default
    spark.conf.unset(setting)
    assert held == [(x, 0) for x in ("passage_pairs", "sources", "members")] * 2


def test_cuts_are_read_as_they_were_sent():
    """Of chunks and slices, rows without a cut and cuts without a shingle."""
    starts, sizes = [[3], [], [0, 9, 40], [7], [5, 5]], [[4], [], [2, 0, 3], [0], [1, 6]]
    cuts = [[np.arange(n, dtype=np.uint32) + 10 * i for n in row] for i, row in enumerate(sizes)]
    columns = [pa.array(starts, pa.list_(pa.int64())), pa.array([[x.tobytes() for x in row] for row in cuts], pa.list_(pa.binary()))]
    batch = pa.RecordBatch.from_arrays(columns, ["starts", "cuts"])
    table = pa.Table.from_batches([batch.slice(1, 2), batch.slice(0, 1), batch.slice(2, 3), batch.slice(3, 0)])
    got = list(passages._cuts(table))
    for (s, place), row in zip(got, [1, 2, 0, 2, 3, 4], strict=True):
        assert s.tolist() == [v for x in cuts[row] for v in x.tolist()]
        assert place.tolist() == [at + k for at, x in zip(starts[row], cuts[row], strict=True) for k in range(len(x))]


# ----------------------------------------------------------------------------- packing
def test_packing(spark, docs):
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter()
    odd = [(900_001, "a <|endoftext|> b<|endoftext|>"), (900_002, "<|endoftext|>" * 300), (900_003, "x\xa0 y\x85\n z"), (900_004, "  \n\n a \t"), (900_005, "w" * 3000 + " " * 500)]
    docs = docs.select("doc_id", "text").unionByName(spark.createDataFrame(odd, "doc_id long, text string"))
    rows = packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), size=256, most_open=4).collect()
    ids = {}
    for r in docs.collect():
        ids.setdefault((r["doc_id"], len(e := tok.encode(r["text"] or "", add_special_tokens=False).ids) + 1), []).append(np.array([*e, 0], "<u4"))
        want[r["doc_id"], len(e) + 1] += len(e) + 1
    pieces, seqs = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"], r["doc_tokens"]].append(r)
        seqs[r["sequence_id"]].append(r)
    assert {k: sum(r["length"] for r in v) for k, v in pieces.items()} == want
    for k, v in pieces.items():
        for r in v:
            assert any(zlib.crc32(x[r["start"] : r["start"] + r["length"]].tobytes()) == r["ids_crc32"] for x in ids[k])
    for v in seqs.values():
        at = 0
        for r in sorted(v, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 256


def test_ids_equal_the_tokenizer(texts, monkeypatch):
    path = public_tokenizers.path("byte_bpe_50k.json")
    tok, own, rnd = Tokenizer.from_file(path), packing.Encoder(path), random.Random(3)
    assert np.frombuffer(own.ids("a <|endoftext|> b"), "<u4").tolist() == [64, 220, 50256, 275]
    pool = ["a", "Zo", "é", " ", "  ", "\n", "\t", "\r\n", "\xa0", "\x1c", "\x85", "\u2003", "'s", "'ll", "12", "!?", "ж", "漢", "<|endoftext|>", "\u180e", "\u200b", "😀", "x" * 70]
    made = ["".join(rnd.choice(pool) for _ in range(rnd.randint(0, 40))) for _ in range(3000)]
    for remembered in (1 << 17, 50):
        monkeypatch.setattr(packing, "REMEMBERED", remembered)
        for t in [*made, *(x for x in texts if x)]:
            assert np.frombuffer(own.ids(t), "<u4").tolist() == tok.encode(t, add_special_tokens=False).ids, t
        assert len(own.known) <= remembered and max(map(len, own.known), default=0) <= 64


def test_ids_of_plain_texts_come_whole(monkeypatch):
    """Texts up to U+017F without a special token take no detour by words; all others agree with the tokenizer too."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    tok, own, rnd = Tokenizer.from_file(path), packing.Encoder(path), random.Random(4)
    plain = [chr(c) for c in range(0x180) if not chr(c).isspace()] + [" ", "  ", "\n", "\t", "\r\n", "'s", "'LL", "été", "12"] * 20
    made = ["".join(rnd.choice(plain) for _ in range(rnd.randint(0, 60))) for _ in range(3000)] + [a + b + " " + b + a for a in plain[:379] for b in "a1!é "]
    long = [x * 5000 for x in ("x", " ", " \n", "é1", "ab ", "!? x")]
    other = ["<|endoftext|>", "a<|endoftext|>b é", "ж é", "a\xa0b", "e\u0301 \u0180", "<|endoftext|", "x" * 300 + "<|endoftext|>"]
    for at_once in (packing.AT_ONCE, 40):
        monkeypatch.setattr(packing, "AT_ONCE", at_once)
        for t in [*made, *long]:
            assert np.frombuffer(own.ids(t), "<u4").tolist() == tok.encode(t, add_special_tokens=False).ids, t
        assert bool(own.known) == (at_once == 40)
        for t in other:
            assert np.frombuffer(own.ids(t), "<u4").tolist() == tok.encode(t, add_special_tokens=False).ids, t
        own.known, own.older = {}, {}


def test_packing_rounds_and_empty(spark, empty):
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.repeat(F.lit("word "), (F.col("id") % 37 + 1).cast("int")).alias("text")).repartition(70)
    rows = packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), size=64, most_open=2).collect()
    fills = Counter()
    for r in rows:
        fills[r["sequence_id"]] += r["length"]
    assert {r["doc_id"] for r in rows} == set(range(400)) and max(fills.values()) <= 64
    # with two open windows, and pieces of over half a window among them, best fit fills half at least
    assert sum(fills.values()) / (64 * len(fills)) > 0.5
    assert packing.pack(empty, public_tokenizers.path("byte_bpe_50k.json")).count() == 0


# ---------------------------------------------------------------------------- language
def test_language(spark, sf_dir, empty):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2
    model = language.fit(docs.where(~held).select("doc_id", "text", "lang").dropna())
    out = language.identify(docs, model).join(docs.select("doc_id", "lang"), "doc_id").where(held)
    assert out.where("lang = lang_pred").count() >= 0.95 * out.count()
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "123 !! $$"), (None, "the and of with"), (5, "ж" * 300_000), (6, "² ½"), (7, "①Ⅷ"), (8, "ª")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in language.identify(odd, model).collect()}
    assert [got[i]["lang_pred"] for i in (1, 2, 3, 6, 7)] == ["und"] * 5 and got[8]["lang_pred"] != "und" and got[1]["score"] == 0.0
    assert got[5]["lang_pred"] != "und" and not got[5]["accepted"] and 0 <= got[5]["score"] <= 1
    none = language.fit(empty.select("doc_id", "text", "lang"))
    assert language.identify(odd, none).where("lang_pred != 'und'").count() == 0
    assert language.identify(empty, model).count() == 0
