"""The near-duplicate stage against exact Jaccard similarity."""

from __future__ import annotations

import random
from itertools import combinations

import brute

from marketlake.llm import simhash


def kept_of(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return sorted(r.doc_id for r in simhash.drop_similar(docs).collect())


def exact(texts):
    sets = [brute.shingle_set(t) for t in texts]
    near = {i: [] for i in range(len(texts))}
    for a, b in combinations(range(len(texts)), 2):
        if brute.jaccard(sets[a], sets[b]) >= 0.8:
            near[a].append(b)
    return sorted({*brute.components(near).values()})


def words(rng, n):
    return [f"w{rng.randrange(10**6)}" for _ in range(n)]


def test_edited_copies_are_found(spark):
    rng, texts = random.Random(3), []
    for _ in range(20):
        base = words(rng, 200)
        texts += [base, base + words(rng, 45)]  # an appended tail, 0.81
        base = words(rng, 245)
        texts += [base, base[:200]]  # cut off
        base = words(rng, 300)
        texts += [base, base[:100] + words(rng, 25) + base[125:]]  # a block replaced
        base = words(rng, 50)
        texts += [base, base[:-1] + words(rng, 1)]  # short
        base = words(rng, 9)
        texts += [base, base[:-1]]  # 4 of 5 shingles
    texts = [" ".join(t) for t in texts]
    assert exact(texts) == list(range(0, len(texts), 2))
    assert kept_of(spark, texts) == exact(texts)


def test_threshold_is_exact(spark):
    rng, texts = random.Random(5), []
    for tail in range(30, 70):  # 196 shingles and a tail: from 0.87 to 0.74
        base = words(rng, 200)
        texts += [" ".join(base), " ".join(base + words(rng, tail))]
    assert kept_of(spark, texts) == exact(texts)


def test_hot_group_is_not_compared_pairwise(spark, monkeypatch):
    """Copies of one text meet in all postings; only comparisons with a hub are made, and unlike ones stay."""
    rng = random.Random(7)
    base = words(rng, 400)
    texts = [" ".join(base)] + [" ".join([*base[: 2 * k], f"new{k}", *base[2 * k + 1 :]]) for k in range(150)]
    texts += [" ".join(rng.sample(base, len(base))) for _ in range(5)]
    looked, verified = [], simhash._verified

    def count(pairs, *rest):
        looked.append(pairs.count())
        return verified(pairs, *rest)

    monkeypatch.setattr(simhash, "_verified", count)
    assert kept_of(spark, texts) == [0, *range(151, 156)]
    assert sum(looked) < 25 * len(texts)
