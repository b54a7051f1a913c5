"""Mixing sources to target weights by min-cost flow over membership patterns.

Documents are aggregated by the set of sources they belong to. Token capacity flows from each
pattern to the quotas of its sources; every repetition of a pattern is an arc of the same
capacity at a higher cost (convex), so text is repeated only where fresh text has run out. The
flow network has one node per pattern and source and no more, however many documents there are, and falls
apart into connected parts: a source that shares no document with another is filled from its own tokens
in closed form, however many such sources there are; each part with several sources is solved in a task of its own.
Documents are then selected in a seeded order, laid out by distributed prefix sums.
"""

from __future__ import annotations

from collections import deque

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quotaloom.functions.numbering import number_rows
from quotaloom.llm.common import WORD, components, cut, fresh, lookup, text_of

#: Weights of the sources in code point order, repeating; the most often a document may be taken.
WEIGHTS = (1, 2, 3)
MOST = 3
#: The seeded order is cut into so many slices of each pattern, so that a hot pattern is laid out by many tasks.
SLICES = 4096
#: Plans of up to so many patterns are broadcast to the documents; larger ones are joined by shuffles, hot patterns salted.
BROADCAST_PATTERNS = 100_000
#: Intervals of a pattern's axis.
SPANS = "array<struct<source:long,low:long,high:long>>"


def capped_targets(sizes: list[int], weights: list[float], total: int, most: int = MOST) -> list[float]:
    """Share ``total`` by weight; a share stops at ``most`` times its size and the excess is shared again.

    The fixed point of that resharing is min(cap, level * weight), found by filling the sources in
    the order in which they reach their caps.
    """
    order = sorted(range(len(sizes)), key=lambda i: (most * sizes[i] / weights[i], i))
    left, weight, out = total, sum(weights), [0.0] * len(sizes)
    for k, i in enumerate(order):
        cap = most * sizes[i]
        if cap * weight <= left * weights[i]:
            out[i], left, weight = float(cap), left - cap, weight - weights[i]
            continue
        level = left / weight
        for j in order[k:]:
            out[j] = level * weights[j]
        break
    return out


def route(patterns: list[tuple[tuple[int, ...], int]], quotas: list[int], most: int = MOST) -> list[dict[int, int]]:
    """Min-cost flow of pattern capacity to source quotas: for each pattern, tokens per source.

    ``patterns``: (sources, tokens). The r-th repetition of a pattern's tokens costs r * r. Paths are
    augmented by least cost first (Bellman-Ford queue), each by its whole capacity.
    """
    n, goal = len(patterns) + len(quotas) + 2, len(patterns) + len(quotas) + 1
    arcs: list[list[int]] = []  # to, capacity, cost; the reverse arc of i is i ^ 1
    out: list[list[int]] = [[] for _ in range(n)]

    def arc(a: int, b: int, capacity: int, cost: int) -> None:
        out[a].append(len(arcs))
        arcs.append([b, capacity, cost])
        out[b].append(len(arcs))
        arcs.append([a, 0, -cost])

    for p, (sources, tokens) in enumerate(patterns):
        for r in range(most):
            arc(0, 1 + p, tokens, r * r)
        for s in sources:
            arc(1 + p, 1 + len(patterns) + s, most * tokens, 0)
    for s, quota in enumerate(quotas):
        arc(1 + len(patterns) + s, goal, quota, 0)
    while True:
        cost, via, queue, queued = [None] * n, [-1] * n, deque([0]), [False] * n
        cost[0] = 0
        while queue:
            a = queue.popleft()
            queued[a] = False
            for i in out[a]:
                b, room, price = arcs[i]
                if room and (cost[b] is None or cost[a] + price < cost[b]):
                    cost[b], via[b] = cost[a] + price, i
                    if not queued[b]:
                        queue.append(b)
                        queued[b] = True
        if cost[goal] is None:
            break
        path, at = [], goal
        while at:
            path.append(via[at])
            at = arcs[via[at] ^ 1][0]
        flow = min(arcs[i][1] for i in path)
        for i in path:
            arcs[i][1] -= flow
            arcs[i ^ 1][1] += flow
    first = 1 + len(patterns)
    return [
        {arcs[i][0] - first: arcs[i ^ 1][1] for i in out[1 + p] if arcs[i][0] >= first and arcs[i ^ 1][1]}
        for p in range(len(patterns))
    ]


def seeded(id_col: Column, seed: int) -> Column:
    """A fixed pseudo-random 60-bit number per id (null as the empty text)."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("")))), 1, 15)
    return F.conv(digits, 16, 10).cast("long")


def source_targets(patterns: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """The sources of ``patterns`` (members, tokens): number, name, source_size, target (as ``capped_targets``).

    Sources are numbered in code point order, null last. A round finds the level at which the sources that are not
    full share what is left by weight, and fills those that would get more than ``most`` times their size; full ones only raise the level,
    so the rounds end when none is added. A round is one aggregate over the sources.
    """
    sizes = patterns.select(F.explode("members").alias("name"), "tokens").groupBy("name").agg(F.sum("tokens").alias("source_size"))
    placed = number_rows(sizes.withColumn("last", F.col("name").isNull()), ["last", "name"], "place")
    kinds = F.array(*[F.lit(float(w)) for w in weights])
    number = F.col("place") - 1
    named = cut(placed.select(number.alias("number"), "name", "source_size", F.get(kinds, (number % len(weights)).cast("int")).alias("weight")))
    cap = F.col("source_size") * most
    total = patterns.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]
    level, full = 0.0, -1
    while True:
        is_full = cap <= level * F.col("weight")
        r = named.agg(
            F.count_if(is_full).alias("full"),
            F.coalesce(F.sum(F.when(is_full, cap)), F.lit(0)).alias("caps"),
            F.sum(F.when(~is_full, F.col("weight"))).alias("weight"),
        ).first()
        if r["full"] == full or not r["weight"]:
            break
        full, level = r["full"], (total - r["caps"]) / r["weight"]
    target = F.when(cap <= level * F.col("weight"), cap.cast("double")).otherwise(F.lit(level) * F.col("weight"))
    return cut(named.select("number", "name", "source_size", target.alias("target")))


def axes(patterns: DataFrame, named: DataFrame, most: int = MOST) -> DataFrame:
    """How far each pattern's tokens go: pattern, spans (intervals of its axis by source), total.

    A source whose documents are in no other has one pattern, and takes its quota of that, ``most`` times at most. The other
    sources and their patterns fall into connected parts; ``route`` solves each in one task, which holds that part's patterns
    and sources (totals, no documents). Patterns from which no source takes anything may be absent.
    """
    quota = F.rint("target").cast("long").alias("quota")
    links = patterns.select("pattern", "tokens", F.size("members").alias("n"), F.explode("members").alias("name"))
    sources = named.select(F.col("name").alias("of"), F.col("number").alias("source"), quota)
    links = cut(links.join(sources, F.col("name").eqNullSafe(F.col("of"))).select("pattern", "tokens", "n", "source", "quota"))
    shared = cut(links.where("n > 1").select("source").distinct())
    alone = links.join(shared, "source", "left_anti")
    taken = F.least(F.col("quota"), F.col("tokens") * most)
    own = F.array(F.struct("source", F.lit(0).cast("long").alias("low"), taken.alias("high"))).cast(SPANS)
    spans = alone.where(taken > 0).select("pattern", own.alias("spans"), taken.alias("total"))
    if not shared.count():
        return spans
    together = cut(links.join(shared, "source"))
    # Vertices: sources as they are, patterns as negative numbers.
    parts = components(together.select(F.col("source").alias("a"), (-F.col("pattern") - 1).alias("b")))
    parted = together.join(parts.withColumnRenamed("v", "source"), "source")
    routed = parted.groupBy("label").applyInPandas(_route_part(most), "pattern long, spans " + SPANS + ", total long")
    return spans.unionByName(routed)


def _route_part(most: int):
    def solve(part):
        import pandas as pd

        part = part.sort_values(["pattern", "source"])
        quotas = dict(zip(part["source"].tolist(), part["quota"].tolist(), strict=True))
        names = sorted(quotas)
        number = {s: i for i, s in enumerate(names)}
        nodes = []
        for pattern, own in part.groupby("pattern"):
            nodes.append((tuple(number[s] for s in own["source"].tolist()), int(own["tokens"].iloc[0]), pattern))
        nodes.sort()  # by sources, which tell patterns apart, so that reruns break ties alike
        out = []
        flows = route([n[:2] for n in nodes], [quotas[s] for s in names], most)
        for (_, _, pattern), flow in zip(nodes, flows, strict=True):
            at, spans = 0, []
            for s, amount in sorted(flow.items()):
                spans.append({"source": names[s], "low": at, "high": at + amount})
                at += amount
            out.append((pattern, spans, at))
        return pd.DataFrame(out, columns=["pattern", "spans", "total"])

    return solve


def mix(
    docs: DataFrame,
    members: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    weights: tuple[float, ...] = WEIGHTS,
    most: int = MOST,
    seed: int = 42,
) -> DataFrame:
    """Choose how often each document of ``docs`` is taken so that sources come near their targets.

    ``members``: array of the source names a document belongs to; null stands for the unnamed
    source and orders last. Sizes are words of the text (null text: 0). Returns one row per row of
    ``docs``: id, members, size, copies (times taken, 0 to ``most``), taken (size * copies),
    given (map of source number to the times the document counts for it). Sources are numbered in
    code point order; targets share all words by weight (``capped_targets``). Rows that repeat an id are told apart by their size and, if that ties, get their own
    place in the order. A null array of members counts as no source. An empty table gives no rows. Documents of size 0 are never taken.
    """
    frame, _ = mix_with_targets(docs, members, id_col, text_col, weights, most, seed)
    return frame


def mix_with_targets(
    docs: DataFrame,
    members: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    weights: tuple[float, ...] = WEIGHTS,
    most: int = MOST,
    seed: int = 42,
) -> tuple[DataFrame, DataFrame]:
    """As ``mix``, and the sources: number, name, source_size, target."""
    rows = cut(
        docs.select(
            F.col(id_col).cast("long").alias("id"),
            F.coalesce(F.array_sort(F.array_distinct(members)), F.array()).alias("members"),
            F.regexp_count(text_of(text_col), F.lit(WORD)).cast("long").alias("size"),
        )
    )
    patterns = rows.groupBy("members").agg(F.sum("size").alias("tokens"), F.count(F.lit(1)).alias("rows"))
    patterns = cut(patterns.withColumn("pattern", F.monotonically_increasing_id()))
    named = source_targets(patterns, weights, most)
    plan = cut(patterns.join(axes(patterns, named, most), "pattern", "left"))

    # A pattern's axis: its documents in seeded order, laid end to end, ``most`` times over. Sources take intervals of it.
    plan = plan.withColumns({"spans": F.coalesce("spans", F.array().cast(SPANS)), "total": F.coalesce("total", F.lit(0).cast("long"))})
    if plan.count() <= BROADCAST_PATTERNS:
        placed = rows.join(F.broadcast(plan.drop("rows")), "members")
    else:  # a pattern of very many documents is salted
        placed = lookup(rows, plan, ["members"], "rows", ["id"]).drop("rows")
    placed = placed.withColumn("luck", seeded(F.col("id"), seed))
    placed = placed.withColumn("slice", F.shiftright("luck", 48).cast("int"))
    slices = placed.groupBy("pattern", "slice").agg(F.sum("size").alias("slice_size"))
    before = Window.partitionBy("pattern").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.withColumn("slice_at", F.coalesce(F.sum("slice_size").over(before), F.lit(0))).drop("slice_size")
    inside = Window.partitionBy("pattern", "slice").orderBy("luck", "id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumn("in_slice", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    placed = placed.join(slices, ["pattern", "slice"]).withColumn("at", F.col("slice_at") + F.col("in_slice"))
    starts = F.transform(F.sequence(F.lit(0), F.lit(most - 1)), lambda r: F.col("at") + r * F.col("tokens"))
    starts = F.when(F.col("size") > 0, F.filter(starts, lambda x: x < F.col("total"))).otherwise(F.array().cast("array<long>"))
    given = F.transform(
        "spans",
        lambda s: F.struct(
            s["source"].alias("source"),
            F.size(F.filter("starts", lambda x: (x >= s["low"]) & (x < s["high"]))).alias("times"),
        ),
    )
    placed = placed.withColumn("starts", starts).withColumn("copies", F.size("starts"))
    frame = placed.select(
        "id",
        "members",
        "size",
        "copies",
        (F.col("size") * F.col("copies")).alias("taken"),
        F.map_from_entries(F.filter(given, lambda g: g["times"] > 0)).alias("given"),
    )
    return frame, named


def take(docs: DataFrame, members: Column, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it; columns as in ``docs``.

    Rows are matched by id and size; rows that repeat both all get the rounded mean of what the mix gives them.
    """
    mixed, _ = mix_with_targets(docs, members, id_col, text_col, **options)
    key, size, copies, copy = fresh(docs, "_id", "_size", "_copies", "_copy")
    own = [F.coalesce(F.col("id").cast("string"), F.lit("")).alias(key), F.col("size").alias(size)]
    chosen = mixed.groupBy(*own).agg(F.round(F.avg("copies")).cast("int").alias(copies)).where(F.col(copies) > 0)
    keyed = docs.withColumns(
        {
            key: F.coalesce(F.col(id_col).cast("long").cast("string"), F.lit("")),
            size: F.regexp_count(text_of(text_col), F.lit(WORD)).cast("long"),
        }
    )
    each = keyed.join(chosen, [key, size]).withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copies))))
    return each.select(*[F.col(f"`{c}`") for c in docs.columns])
