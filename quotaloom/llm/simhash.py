"""SimHash near-duplicates by deletion-variant signatures.

Fingerprints within ``max_bits`` of each other, cut into floor(max_bits / 2) + 1 segments, have one
segment that differs by at most one bit. Each segment is indexed under every variant of itself
with one bit left out, so an equality join on (segment, bit left out, rest) brings every such pair
together; pairs are then verified on all 64 bits.

Inside a bucket no pairs are listed: every fingerprint is compared with a few hubs of its bucket. After the links
found that way are closed into components, only fingerprints that are still outside their bucket's
main component are compared with the bucket's other components. So links between different
fingerprints are all found, and a bucket of m near copies costs a small multiple of m.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from quotaloom.llm.common import components, cut, fresh, lookup, text_of
from quotaloom.llm.worker import keep

SHINGLE = 3
MAX_BITS = 3
SEED = 42
BITS = 64
#: Hubs of a bucket: the members nearest to these numbers by exclusive or.
HUBS = (0, 0x5555555555555555, 0x3333333333333333, 0x0F0F0F0F0F0F0F0F)
#: Hashes whose bits are counted at a time.
BLOCK = 1 << 16


def simhash(text: str, shingle: int = SHINGLE) -> int:
    """The fingerprint as a signed 64-bit number: a bit is 1 if set in over half the shingles' hashes; no word: 0."""
    import numpy as np
    import xxhash

    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    line = b" ".join(words)
    width = min(shingle, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[: len(ends) - width] + 1]).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(line[a:b], SEED) for a, b in zip(starts, ends[width - 1 :].tolist(), strict=True)), np.uint64, len(starts)
    )
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), BLOCK):
        block = hashes[at : at + BLOCK].astype("<u8")
        bits = np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    packed = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(packed.view("<i8")[0])


def with_fingerprints(docs: DataFrame, text_col: str, name: str, shingle: int = SHINGLE) -> DataFrame:
    """``docs`` with the fingerprint of its text as the last column, ``name`` (long)."""
    where = docs.columns.index(text_col)
    names = [*docs.columns, name]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep("simhash", lambda: None)
        for batch in batches:
            got = [simhash(t.as_py() or "", shingle) for t in batch.column(where)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(got, pa.int64())], names=names)

    return docs.mapInArrow(run, _plus(docs, name))


def _plus(docs: DataFrame, name: str) -> StructType:
    return StructType([*docs.schema.fields, StructField(name, LongType())])


def _bits_apart(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def near_links(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Components of distinct fingerprints ``prints`` (fp: long) under at most ``max_bits`` differing bits.

    Returns (fp, label): label is the smallest fingerprint reachable; fingerprints without a partner
    have no row.
    """
    parts = max_bits // 2 + 1
    if parts > 8:
        raise ValueError("max_bits may be 15 at most")
    edges_at = [BITS * i // parts for i in range(parts + 1)]
    variants = []
    for low, high in zip(edges_at, edges_at[1:], strict=False):
        for bit in range(low, high):
            mask = ((1 << high) - (1 << low)) & ~(1 << bit)
            mask = mask - (1 << 64) if mask >> 63 else mask
            rest = F.col("fp").bitwiseAND(F.lit(mask).cast("long"))
            variants.append(F.xxhash64(F.lit(bit), rest))  # a shared key only proposes a pair: bits are compared below
    keyed = prints.select("fp", F.explode(F.array(*variants)).alias("key"))
    # Keys with company first, by a count; both sides are shuffled at any size, as the hint keeps one plan.
    company = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = cut(keyed.join(company.hint("merge"), "key"))
    nearest = [F.min(F.col("fp").bitwiseXOR(F.lit(h).cast("long"))).bitwiseXOR(F.lit(h).cast("long")) for h in HUBS]
    hubs = members.groupBy("key").agg(F.array(*nearest).alias("hubs"))
    met = cut(members.join(hubs.hint("merge"), "key"))
    near = met.select("fp", F.explode(F.array_distinct("hubs")).alias("hub")).where("fp <> hub")
    near = near.where(_bits_apart(F.col("fp"), F.col("hub")) <= max_bits).select(F.col("hub").alias("a"), F.col("fp").alias("b"))
    first = components(near)
    # What is still apart: bucket members outside the component of the bucket's first hub.
    named = met.where("n > 2").join(first.withColumnRenamed("v", "fp").hint("merge"), "fp", "left")
    named = named.select("fp", "key", F.col("hubs")[0].alias("hub"), F.coalesce("label", "fp").alias("label"))
    main = first.select(F.col("v").alias("hub"), F.col("label").alias("main"))
    named = named.join(main.hint("merge"), "hub", "left").withColumn("main", F.coalesce("main", "hub"))
    outside = cut(named.where("label <> main").select("fp", "key", "label"))
    if outside.isEmpty():
        return first.withColumnsRenamed({"v": "fp"})
    other = outside.select("key", F.col("fp").alias("fp2"), F.col("label").alias("label2"))
    pairs = named.select("fp", "key", "label").join(other.hint("merge"), "key")
    pairs = pairs.where((F.col("label") != F.col("label2")) & (_bits_apart(F.col("fp"), F.col("fp2")) <= max_bits))
    more = pairs.select(F.col("label").alias("a"), F.col("label2").alias("b")).distinct()
    # Whole components are what is linked now; a label is its component's smallest fingerprint, so the smallest label stays right.
    tops = components(more).withColumnRenamed("label", "top")
    joined = first.join(tops.withColumnRenamed("v", "label").hint("merge"), "label", "left")
    alone = tops.join(first.hint("merge"), "v", "left_anti").select(F.col("v").alias("fp"), F.col("top").alias("label"))
    return joined.select(F.col("v").alias("fp"), F.coalesce("top", "label").alias("label")).union(alone)


def _grouped(docs: DataFrame, id_col: str, text_col: str, shingle: int, max_bits: int) -> DataFrame:
    """One row per row of ``docs``: id, fp, component_id, label (the component's smallest fingerprint)."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))
    rows = cut(with_fingerprints(rows, "text", "fp", shingle).select("id", "fp"))
    prints = cut(rows.groupBy("fp").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("n")))
    labels = near_links(prints.select("fp"), max_bits)
    named = cut(prints.join(labels, "fp", "left").withColumn("label", F.coalesce("label", "fp")))
    tops = named.groupBy("label").agg(F.min("least").alias("component_id"))
    groups = cut(named.join(tops, "label").select("fp", "n", "component_id", "label"))
    return lookup(rows, groups, ["fp"], "n", ["id"]).select("id", "fp", "component_id", "label")


def find_near_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS
) -> DataFrame:
    """One row per row of ``docs``: id, fp (long), component_id (smallest id reachable by links, itself included).

    Words are runs of anything but ASCII white space, A-Z in lower case; a text of fewer words than
    ``shingle`` is one shingle; null and empty texts have fingerprint 0 and link like any other. Null ids
    rank after any other id, so component_id is null only where a component has no other. Repeated rows are
    returned as often as they come. Other columns are ignored; an empty table gives no rows.
    """
    return _grouped(docs, id_col, text_col, shingle, max_bits).drop("label")


def drop_near_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS
) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: of each group one row with the smallest id.

    If that id has several rows in its group, one of those with the smallest fingerprint stays. Nulls
    as in ``find_near_groups``.
    """
    groups = _grouped(docs, id_col, text_col, shingle, max_bits)
    own = F.coalesce(F.col(id_col).cast("long").cast("string"), F.lit(""))
    key, fp, text = fresh(docs, "_key", "_fp", "_text")
    groups = groups.withColumn(key, F.coalesce(F.col("id").cast("string"), F.lit("")))
    first = groups.where(F.col("id").eqNullSafe(F.col("component_id")))
    stay = cut(first.groupBy("label", key).agg(F.min("fp").alias(fp)))
    if groups.join(stay, key, "left_semi").count() == stay.count():
        return docs.withColumn(key, own).join(stay, key, "left_semi").drop(key)
    # Some id is repeated: its rows are told apart by their fingerprints.
    marked = with_fingerprints(docs.withColumns({key: own, text: text_of(text_col)}), text, fp, shingle)
    kept = marked.join(stay, [key, fp], "left_semi")
    return kept.dropDuplicates([key, fp]).drop(key, fp, text)
