"""The near-duplicate stage goes through the fingerprint index, and close copies that are no links are not paired."""

from __future__ import annotations

import random

import corpus_pipeline
import numpy as np
import pytest
from test_similar import exact, kept_of, words

from marketlake.llm import simhash


def close_copies(rng, n):
    """Copies with four words of their own each: alike by 0.66, so hardly any is a link; a few have a copy of their own."""
    base, texts = words(rng, 200), []
    for _ in range(n):
        own = list(base)
        for at in rng.sample(range(2, 198), 4):
            own[at] = words(rng, 1)[0]
        texts.append(" ".join(own))
    return texts + [t + " tail" for t in texts[::20]]


def test_stage_uses_the_fingerprint_index(spark, docs_of, monkeypatch):
    seen, link = [], simhash.link

    def spy(fps, *rest):
        out = link(fps, *rest)
        seen.append(out.count())
        return out

    monkeypatch.setattr(simhash, "link", spy)
    rng = random.Random(11)
    text = cut = ""
    while simhash.simhash(text, 5) == simhash.simhash(cut, 5) or (simhash.simhash(text, 5) ^ simhash.simhash(cut, 5)).bit_count() > simhash.BITS:
        base = words(rng, 300)
        text, cut = " ".join(base), " ".join(base[:-1])
    out = corpus_pipeline.near_dedup(spark, docs_of([(1, text), (2, cut), (3, "another text")]), "")
    assert sorted(r.doc_id for r in out.collect()) == [1, 3]
    assert seen == [1]  # the pair is linked by its fingerprints


@pytest.mark.parametrize("tile", [1 << 20, 2000])
def test_close_copies_are_not_paired(spark, monkeypatch, tile):
    monkeypatch.setattr(simhash, "TILE", tile, raising=False)
    texts = close_copies(random.Random(13), 200)
    looked, verified = [], simhash._verified

    def count(pairs, *rest):
        looked.append(pairs.count())
        return verified(pairs, *rest)

    monkeypatch.setattr(simhash, "_verified", count)
    assert kept_of(spark, texts) == exact(texts)
    assert sum(looked) < 20 * len(texts)


@pytest.mark.parametrize("mains", [1, 3])
@pytest.mark.parametrize("others", [1, 4])
def test_every_pair_of_groups_meets_in_a_tile(spark, mains, others):
    rows = [(i, i if i % 3 else 0, 0, mains, others) for i in range(60)]  # group 0 is the main one
    df = spark.createDataFrame(rows, "node long, group long, main long, mains long, others long")
    tiles = {r.node: set(r.tiles) for r in df.select("node", simhash._tiles().alias("tiles")).collect()}
    group = {r[0]: r[1] for r in rows}
    assert all(tiles[a] & tiles[b] for a in tiles for b in tiles if group[a] != group[b])
    assert all(len(tiles[n]) == (others if group[n] == 0 else mains + others - 1) for n in tiles)


def test_links_across_joins_groups():
    sets = [np.arange(a, a + 100, dtype=np.uint64) for a in (0, 5, 10, 500, 505, 900)]
    edges = simhash.links_across(np.arange(6), np.array([7, 7, 8, 9, 10, 11]), 7, sets)
    groups = [{0, 1}, {2}, {3}, {4}, {5}]
    for a, b in edges:
        assert len(np.intersect1d(sets[a], sets[b])) / len(np.union1d(sets[a], sets[b])) >= simhash.SIMILAR
        one, two = (next(g for g in groups if n in g) for n in (a, b))
        if one is not two:
            groups = [g for g in groups if g not in (one, two)] + [one | two]
    assert sorted(map(sorted, groups)) == [[0, 1, 2], [3, 4], [5]]


def test_rows_are_told_apart_without_a_shuffle(spark):
    rows = spark.range(100_000).withColumnRenamed("id", "row")
    for some in ([], [0, 1, 7, 32767, 32768, 32769, 99_999]):
        wanted = spark.createDataFrame([(n,) for n in some], "row long")
        flags = simhash._marked_in(rows, wanted, "row", "maybe")
        assert flags.count() == 100_000
        found = {r.row for r in flags.where("maybe").collect()}
        assert set(some) <= found and len(found) <= len(some) + 5 * bool(some)


def test_single_documents_stay_out_of_the_last_join(spark, monkeypatch):
    joined, marked_in = [], simhash._marked_in

    def spy(rows, some, by, flag):
        out = marked_in(rows, some, by, flag)
        joined.append(out.where(flag).count())
        return out

    monkeypatch.setattr(simhash, "_marked_in", spy, raising=False)
    texts = [" ".join(words(random.Random(n), 60)) for n in range(50)]
    texts += texts[:3]
    assert kept_of(spark, texts) == exact(texts)
    assert joined == [0, 3]  # no candidates; three copies
