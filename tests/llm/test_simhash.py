import random

import pytest
import xxhash
from pyspark.sql import functions as F

from quotaloom.llm import simhash
from quotaloom.llm.common import components


def brute_print(text, n=3):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    fp = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    return fp - (1 << 64) if fp >> 63 else fp


def brute_components(prints, bits):
    parent = {p: p for p in prints}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in prints:
        for b in prints:
            if ((a ^ b) & (2**64 - 1)).bit_count() <= bits:
                parent[max(top(a), top(b))] = min(top(a), top(b))
    return {p: top(p) for p in prints}


def test_fingerprints(messy):
    got = simhash.find_near_groups(messy).select("id", "fp").collect()
    want = [(r.doc_id, brute_print(r.text)) for r in messy.collect()]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


@pytest.mark.parametrize("bits", [1, 2, 3, 4])
def test_links_equal_brute_force(spark, bits):
    draw = random.Random(bits)
    prints = {0, 1 << 63, (1 << 64) - 1}
    for _ in range(12):  # families of different width, the widest beyond the bit distance
        base = draw.getrandbits(64)
        for _ in range(25):
            prints.add(base ^ sum(1 << b for b in draw.sample(range(64), draw.randint(0, 5))))
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    labels = {r.fp: r.label for r in simhash.near_links(spark.createDataFrame([(p,) for p in signed], "fp long"), bits).collect()}
    want = brute_components(signed, bits)
    assert {p: labels.get(p, p) for p in signed} == want


def test_chain_of_hub_neighbours(spark):
    chain = [(1 << k) - 1 for k in range(0, 60, 3)]  # each three bits from the next
    got = simhash.near_links(spark.createDataFrame([(p,) for p in chain], "fp long")).collect()
    assert {r.label for r in got} == {0} and len(got) == len(chain)


def test_components_of_a_long_path(spark):
    path = spark.createDataFrame([(i, i + 1) for i in range(300)], "a long, b long")
    assert components(path).agg(F.max("label"), F.count("v")).first()[:] == (0, 301)


def test_one_document_of_each_group_stays(messy, nothing):
    groups = simhash.find_near_groups(messy).collect()
    kept = simhash.drop_near_copies(messy)
    assert kept.columns == messy.columns
    ids = [r.doc_id for r in kept.collect()]
    # The texts without a word share one group, whose smallest id is 3.
    assert {r.component_id for r in groups if r.id in (3, 4, 5)} == {3}
    assert sorted(ids, key=str) == sorted({r.component_id for r in groups}, key=str)
    assert simhash.drop_near_copies(nothing).count() == simhash.find_near_groups(nothing).count() == 0


def test_components_of_paths_trees_and_rings_in_few_rounds(spark, monkeypatch):
    rng = random.Random(7)
    path = rng.sample(range(1000), 400)  # a path whose numbers are in no order
    edges = [*zip(path, path[1:], strict=False)]
    edges += [(1000 + i, 1000 + rng.randrange(i)) for i in range(1, 200)] + [(2000 + i, 2000 + (i + 1) % 150) for i in range(150)]
    edges += [(3000, 3000), (3001, 3002), (3002, 3001), (3001, 3002)]
    rounds = []
    monkeypatch.setattr("quotaloom.llm.common.discard", lambda spark, path: rounds.append(path))
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).select("v", "label").collect()))
    low = min(path)
    want = dict.fromkeys(path, low) | dict.fromkeys(range(1000, 1200), 1000) | dict.fromkeys(range(2000, 2150), 2000)
    assert got == want | {3001: 3001, 3002: 3001}
    assert len(rounds) <= 12
