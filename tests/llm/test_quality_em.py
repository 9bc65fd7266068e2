"""Posterior and verdict of the quality rules against a plain estimation, and what labels say of them."""

import math

import pytest

from hertzmill.llm import quality


def plain_em(votes, n, start=0.75, prior=0.7):
    accuracies = [start] * n

    def posterior(v):
        odds = math.log(prior / (1 - prior)) + sum(x * math.log(a / (1 - a)) for x, a in zip(v, accuracies, strict=True))
        return 1 / (1 + math.exp(-odds))

    for _ in range(25):
        p = [posterior(v) for v in votes]
        now = []
        for j in range(n):
            cast = sum(v[j] != 0 for v in votes)
            right = sum(q if v[j] == 1 else 1 - q for v, q in zip(votes, p, strict=True) if v[j])
            now.append(round(min(0.99, max(0.55, right / cast)), 6) if cast else accuracies[j])
        share = round(min(0.95, max(0.05, sum(p) / len(p))), 6)
        moved = max(abs(a - b) for a, b in zip([*now, share], [*accuracies, prior], strict=True))
        accuracies, prior = now, share
        if moved < 1e-5:
            break
    return [posterior(v) for v in votes]


def test_posterior_equals_plain_estimation(spark, sf_dir):
    rows = quality.judge(spark.read.parquet(f"{sf_dir}/documents.parquet")).collect()
    want = plain_em([list(r["votes"]) for r in rows], len(quality.RULES))
    assert [r["posterior"] for r in rows] == pytest.approx(want, abs=1e-4)
    assert all(r["kept"] == (not r["base_failed"] and r["posterior"] >= 0.5) for r in rows)


def test_labelled_documents(spark, sf_dir):
    """Of documents labelled good none goes by the method; of junk some goes by it beyond the base rules."""
    verdict = quality.judge(spark.read.parquet(f"{sf_dir.replace('sf0.001', 'sf0.01')}/documents.parquet"))
    labels = spark.read.parquet(f"{sf_dir.replace('sf0.001', 'sf0.01')}/labels.parquet")
    rows = verdict.join(labels, "doc_id").where("not base_failed").collect()
    good, junk = [r["kept"] for r in rows if r["quality"] == 1], [r["kept"] for r in rows if r["quality"] == 0]
    assert good.count(False) <= 0.02 * len(good) and junk.count(False) > 0.2 * len(junk)
