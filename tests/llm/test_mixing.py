import pytest
from pyspark.sql import functions as F

from quotaloom.llm import mixing


def reshared(sizes, weights, total, most=3):
    """The rule spelled out: share by weight, cap, share the excess again."""
    goal, capped, left = [0.0] * len(sizes), set(), float(total)
    while len(capped) < len(sizes):
        rest = [i for i in range(len(sizes)) if i not in capped]
        level = left / sum(weights[i] for i in rest)
        over = [i for i in rest if level * weights[i] > most * sizes[i]]
        if not over:
            for i in rest:
                goal[i] = level * weights[i]
            break
        for i in over:
            goal[i] = float(most * sizes[i])
            left -= goal[i]
            capped.add(i)
    return goal


@pytest.mark.parametrize("sizes", [[100, 100, 100], [1000, 1, 2, 3], [5, 0, 50, 500, 1, 1, 1], [0, 0], [7]])
def test_targets(sizes):
    weights = [(1, 2, 3)[i % 3] for i in range(len(sizes))]
    got = mixing.capped_targets(sizes, weights, sum(sizes))
    assert got == pytest.approx(reshared(sizes, weights, sum(sizes)))


def test_flow_prefers_fresh_text_and_fills_quotas():
    # Source 0 has its own text; source 1 has little of its own and shares a pattern with 0.
    flows = mixing.route([((0,), 100), ((0, 1), 100), ((1,), 10)], [100, 90])
    assert [sum(f.get(s, 0) for f in flows) for s in (0, 1)] == [100, 90]
    assert all(sum(f.values()) <= t for f, t in zip(flows, (100, 100, 10), strict=True))  # no repetition is needed
    flows = mixing.route([((0,), 10)], [25])
    assert flows == [{0: 25}]
    assert mixing.route([((0,), 10)], [50]) == [{0: 30}]  # three times at most


def test_taken_words_come_near_targets(spark):
    rows = [(i, "w " * (i % 37), ["big", "mid", "low", "tiny"][0 if i % 3 else (i // 3) % 4]) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mixed, sources = mixing.mix_with_targets(df, F.array("source"))
    got = mixed.withColumn("name", F.col("members")[0]).groupBy("name").agg(F.sum("taken").alias("taken")).collect()
    goal = {r.name: r.target for r in sources.collect()}
    for r in got:
        assert abs(r.taken - goal[r.name]) <= 2 * 37
    assert mixed.agg(F.max("copies")).first()[0] <= 3
    again, _ = mixing.mix_with_targets(df.repartition(5), F.array("source"))
    assert sorted(map(str, mixed.collect())) == sorted(map(str, again.collect()))


def test_overlapping_sources_share_documents(spark):
    rows = [(i, "w " * 10, ["a", "b"] if i % 2 else ["a"]) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, sources array<string>")
    mixed, sources = mixing.mix_with_targets(df, F.col("sources"), weights=(1, 1))
    got = mixed.select(F.explode("given").alias("source", "times"), "size").groupBy("source").agg(F.sum(F.col("times") * F.col("size")).alias("w"))
    goal = {r.number: r.target for r in sources.collect()}
    assert all(abs(r.w - goal[r.source]) <= 20 for r in got.collect())


def test_very_many_sources(spark):
    """A source a document, nearly: more patterns than are broadcast, and none that the driver holds."""
    n = 200_000
    df = spark.range(n).select(F.col("id").alias("doc_id"), F.expr("repeat('w ', 1 + int(id % 7))").alias("text"), F.expr("concat('s', id div 2)").alias("source"))
    mixed, sources = mixing.mix_with_targets(df, F.array("source"))
    assert sources.count() == n // 2
    sizes = {r.name: (r.number, r.source_size, r.target) for r in sources.collect()}
    order = sorted(sizes)
    goal = mixing.capped_targets([sizes[s][1] for s in order], [(1, 2, 3)[i % 3] for i in range(len(order))], sum(x[1] for x in sizes.values()))
    assert [sizes[s][0] for s in order] == list(range(len(order)))
    assert [sizes[s][2] for s in order] == pytest.approx(goal)
    taken = mixed.groupBy(F.col("members")[0].alias("name")).agg(F.sum("taken").alias("taken"), F.sum("size").alias("size"))
    worst = taken.join(sources, "name").agg(F.max(F.abs(F.col("taken") - F.col("target"))), F.max(F.col("taken") - 3 * F.col("size"))).first()
    assert worst[0] <= 14 and worst[1] <= 0


def test_parts_solved_apart_equal_one_flow(spark):
    members = [["a"], ["a", "b"], ["b"], ["c", "d"], ["d"], ["e"], None, [None, "e"], ["f"]]
    rows = [(i, "w " * (1 + i % 5), members[i % 9]) for i in range(900)]
    df = spark.createDataFrame(rows, "doc_id long, text string, sources array<string>")
    patterns = df.select(F.col("sources").alias("members"), F.size(F.split("text", " ")).alias("t"))
    mixed, sources = mixing.mix_with_targets(df, F.col("sources"))
    named = sorted(sources.collect(), key=lambda r: r.number)
    assert [r.name for r in named] == ["a", "b", "c", "d", "e", "f", None]
    totals = mixed.groupBy("members").agg(F.sum("size").alias("t"), F.sum("taken").alias("taken")).collect()
    number = {r.name: r.number for r in named}
    network = [(tuple(sorted(number[s] for s in r.members)), r.t) for r in totals]
    flows = mixing.route(network, [round(r.target) for r in named])
    got = dict.fromkeys(range(len(named)), 0)
    for r in mixed.collect():
        for s, times in r.given.items():
            got[s] += times * r["size"]
    for i in got:
        assert abs(got[i] - sum(f.get(i, 0) for f in flows)) <= 5 * 3
    assert all(r.copies == 0 for r in mixed.collect() if not r.members)
    assert patterns.count() == 900


def test_messy_and_empty(messy, nothing):
    mixed = mixing.mix(messy, F.array("source")).collect()
    assert len(mixed) == messy.count()
    assert all(r.copies == 0 for r in mixed if r["size"] == 0)
    taken = mixing.take(messy, F.array("source"))
    assert taken.columns == messy.columns and {r.copies for r in taken.collect()} <= {"own"}
    assert mixing.mix(nothing, F.array("source")).count() == mixing.take(nothing, F.array("source")).count() == 0
