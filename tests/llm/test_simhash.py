"""Shards and BK-trees: every link is found, shards hold many members, searches look at part of them."""

import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from creditloom.llm import simhash
from tests.llm import reference


def some_prints(rng, n):
    """Random fingerprints, families within a few bits, and families that share most bits."""
    prints = {rng.getrandbits(64) for _ in range(n)}
    for _ in range(n // 20):
        base = rng.getrandbits(64)
        for _ in range(rng.randrange(2, 40)):
            prints.add(base ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(0, 5))))
    prints |= {0, 1, 3, 7, 2**64 - 1, 2**63}
    return sorted(prints)


def components(prints, links):
    top = {p: p for p in prints}
    for a, b in links:
        while top[a] != a:
            a = top[a]
        while top[b] != b:
            b = top[b]
        top[max(a, b)] = min(a, b)

    def of(p):
        while top[p] != p:
            p = top[p]
        return p

    return {p: of(p) for p in prints}


@pytest.mark.parametrize(("radius", "members", "crowded"), [(2, 64, 4096), (2, 8, 12), (0, 64, 4096), (3, 4, 30)])
def test_links_against_all_pairs(spark, radius, members, crowded):
    rng = random.Random(radius + crowded)
    prints = some_prints(rng, 600)
    df = spark.createDataFrame([(simhash.signed(p),) for p in prints + prints[:50]], "fingerprint long").repartition(4)
    found = {(r.a % 2**64, r.b % 2**64) for r in simhash.links(df, radius, members, crowded).collect()}
    close = [(a, b) for a, b in combinations(prints, 2) if (a ^ b).bit_count() <= radius]
    assert all((a ^ b) and a in set(prints) for a, b in found)
    assert components(prints, found) == components(prints, close)
    sizes = simhash.shards(df, radius, members, crowded).groupBy("mask", "shard").count()
    assert sizes.agg(F.max("count")).first()[0] <= max(crowded, 1)


def test_shards_hold_many_members_and_trees_prune(spark):
    rng = random.Random(4)
    prints = [rng.getrandbits(64) for _ in range(8_000)]
    df = spark.createDataFrame([(simhash.signed(p),) for p in prints], "fingerprint long")
    sizes = simhash.shards(df, 2).groupBy("mask", "shard").count()
    row = sizes.agg(F.avg("count").alias("mean"), F.sum("count").alias("rows")).first()
    assert row["rows"] == 3 * 8_000 and row["mean"] > 20
    tree = simhash.BkTree(prints[0])
    for p in prints[1:]:
        tree.add(p)
    looked = [sum(1 for _ in tree.visited(p, 2)) for p in prints[:200]]
    assert sum(looked) / len(looked) < 0.5 * len(prints)
    assert all(p in tree.within(p ^ 0b101, 2) for p in prints[:200])


def test_blocks_cover_all_bits():
    for fixed in (0, 0xFFFF, 0x8000000000000001):
        masks = simhash.block_masks(fixed, 3)
        assert all(m & fixed == fixed for m in masks)
        union = 0
        for m in masks:
            assert (m & ~fixed) & union == 0
            union |= m & ~fixed
        assert union | fixed == 2**64 - 1
    assert simhash.block_masks(2**64 - 1, 3) == [2**64 - 1]


def test_whole_job_with_crowded_shards(spark, monkeypatch):
    monkeypatch.setattr(simhash, "MEMBERS", 2)
    rng = random.Random(9)
    words = [f"w{k}" for k in range(400)]
    base = [rng.choice(words) for _ in range(300)]
    texts = {k: " ".join([*base[: rng.randrange(280, 300)], rng.choice(words)]) for k in range(120)}
    texts |= {200 + k: " ".join(rng.choice(words) for _ in range(40)) for k in range(60)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    found = {r.doc_id: r.component_id for r in simhash.near_copies(docs).collect()}
    assert found == {i: c for i, (_, c) in reference.simhash_components(texts).items()}
