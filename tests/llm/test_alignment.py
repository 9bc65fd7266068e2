"""Alignment against a plain walk over both token lists, with whole texts encoded at once."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from hertzmill.llm import alignment as A

PATH_A, PATH_B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def plain_tokens(text, cache={}):  # noqa: B006
    """[(id, end)] of A and of B; None where they don't spell the text."""
    if not cache:
        a = Tokenizer.from_file(PATH_A)
        a.encode_special_tokens = True
        cache.update(a=a, b=sentencepiece.SentencePieceProcessor(model_file=PATH_B), tools=A.Reader(PATH_A, PATH_B))
    raw, found = (" " + text).encode(), []
    spelt = cache["tools"]
    for ids, pieces in ((cache["a"].encode(" " + text, add_special_tokens=False).ids, spelt.a.bytes), (cache["b"].encode(text), spelt.b.bytes)):
        at, tokens = 0, []
        for i in ids:
            at += len(pieces[i])
            tokens.append((i, at))
        if b"".join(pieces[i] for i in ids) != raw:
            return None
        found.append(tokens)
    return found


def plain(rows):
    seen, pairs = [], Counter()
    for doc_id, text in rows:
        found = plain_tokens(text) if text else None
        if not found:
            seen.append((doc_id, 0, 0, 0, [], ""))
            continue
        a, b = found
        ends = sorted({e for _, e in a} & {e for _, e in b})
        groups, lo = [], 0
        for hi in ends:
            groups.append("|".join(",".join(str(i) for i, e in side if lo < e <= hi) for side in (a, b)) if len(a) < 400 else None)
            lo = hi
        if len(a) >= 400:  # the same, in one walk
            cut = {e: n for n, e in enumerate(ends)}
            told = [([], []) for _ in ends]
            for k, side in enumerate((a, b)):
                n = 0
                for i, e in side:
                    told[n][k].append(str(i))
                    n = cut[e] + 1 if e in cut else n
            groups = ["|".join((",".join(x), ",".join(y))) for x, y in told]
        links = [(i, j) for (i, e) in a for j in [dict((e2, j2) for j2, e2 in b).get(e)] if j is not None] if len(a) < 400 else [(i, by[e]) for by in [{e2: j2 for j2, e2 in b}] for i, e in a if e in by]
        pairs.update(links)
        seen.append((doc_id, len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    best = defaultdict(int)
    for (_, j), n in pairs.items():
        best[j] = max(best[j], n)
    return sorted(((d, a, b, g, len(links), sum(pairs[x] == best[x[1]] for x in links), sum(pairs[x] for x in links), sha) for d, a, b, g, links, sha in seen), key=str)


def ours(df):
    return sorted(map(tuple, A.align(df, PATH_A, PATH_B).collect()), key=str)


ODD = [
    None, "", " ", "  ", "a", " a", "a ", "a  b\n\nc", "\ta\r\n", "x" * 300, "▁x", "a▁b", "     b", "é ü 漢字 \U0001f600 ① ﬁ é",
    "<|endoftext|> <s> </s> <unk> <0x0A>", "a\x00b", "The quick brown fox. The quick-brown fox!\nThe  end", "  　x  y", "1234567 89.10", "same text", "same text",
]
SCHEMA = "doc_id long, text string, block long, kind int"


def test_odd_texts(spark):
    rows = [(i if i % 5 else None, t) for i, t in enumerate(ODD)]
    assert ours(spark.createDataFrame([(*r, 1, 2) for r in rows], SCHEMA)) == plain(rows)


def test_documents_whole(spark, sf_dir, monkeypatch):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    assert ours(docs.repartition(3)) == plain([tuple(r) for r in docs.collect()])


def test_long_texts_are_cut_where_both_have_an_edge(monkeypatch):
    monkeypatch.setattr(A, "AT_ONCE", 64)
    tools = A.Reader(PATH_A, PATH_B)
    for text in ("One, two; three  four.   five \n six <|endoftext|> " * 40, "nospaces" * 60, "ends in spaces " * 30 + "   "):
        assert len(list(A._stretches(text))) > 1 or "nospaces" in text
        assert "".join(A._stretches(text)) == " " + text
        cut = A._aligned(tools, text)
        monkeypatch.setattr(A, "AT_ONCE", 1 << 20)
        whole = A._aligned(tools, text)
        monkeypatch.setattr(A, "AT_ONCE", 64)
        assert cut[:4] == whole[:4] and cut[4].tolist() == whole[4].tolist()


def test_blocks_don_t_change_counts(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    assert ours(docs.repartition(7)) == ours(docs.coalesce(1))


@pytest.mark.parametrize("seed", range(4))
def test_overlaps_of_any_tilings(seed):
    rng = np.random.default_rng(seed)
    n = 60
    a, b = (np.unique(np.append(rng.integers(1, n, 20), n)) for _ in range(2))
    order, begins, i, j = A.coalesce(a, b)
    spans = [list(zip([0, *e[:-1]], e, strict=True)) for e in (a, b)]
    want = {(x, y) for x, (s, e) in enumerate(spans[0]) for y, (s2, e2) in enumerate(spans[1]) if s < e2 and s2 < e}
    assert set(zip(i.tolist(), j.tolist(), strict=True)) == want and len(i) == len(want)
    assert begins.sum() == len(set(a) & set(b)) and len(order) == len(a) + len(b)


def test_no_rows(spark):
    assert A.align(spark.createDataFrame([], SCHEMA), PATH_A, PATH_B).count() == 0
