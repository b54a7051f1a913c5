"""Document fingerprints by one-permutation MinHash, with built-in functions only.

Every shingle is hashed once: the high bits choose a bin, the smallest hash of each bin stays. Empty bins
are filled by optimal densification: bin b borrows from the first filled bin in an order of its own, the same for
every document, so two documents borrow alike where they agree. Of each bin the low-order bits
are stored, one hexadecimal digit each; agreement by chance, one in sixteen, is corrected for in the likeness.
"""

from __future__ import annotations

import random
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quotaloom.llm.common import SPACE, let, text_of

SHINGLE = 5
BIN_BITS = 7
BINS = 1 << BIN_BITS
#: Low-order bits kept of a bin.
LOW_BITS = 4
#: An empty bin looks among so many others first, then among the rest.
PROBES = 8
#: Rows of a slice of the id order, and the most slices whose bounds the driver holds.
SLICE_ROWS = 4096
MAX_SLICES = 10_000


def probe_order(seed: int = 7) -> list[list[int]]:
    """For each bin, all other bins in its own fixed random order."""
    draw = random.Random(seed)
    orders = []
    for b in range(BINS):
        others = [j for j in range(BINS) if j != b]
        draw.shuffle(others)
        orders.append(others)
    return orders


def _numbers(values: list[int]) -> Column:
    """A constant array that the optimizer folds to one literal."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<int>")


def shingle_hashes(text: Column, width: int = SHINGLE) -> Column:
    """One hash per shingle of ``width`` words, repeats included; fewer words: one hash of all; none: no hash."""
    words = F.filter(F.split(F.lower(text), f"{SPACE}+"), lambda w: w != "")
    hashed = F.transform(words, lambda w: F.xxhash64(w))
    return let(
        hashed,
        lambda h: F.when(F.size(h) == 0, F.array().cast("array<long>")).otherwise(
            F.transform(
                F.sequence(F.lit(0), F.greatest(F.size(h) - width, F.lit(0))),
                lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(width)]),
            )
        ),
    )


def fingerprint(text: Column, width: int = SHINGLE) -> Column:
    """BINS hexadecimal digits; the empty string for a text without a word (null text: as the empty text)."""
    flat = _numbers([j for order in probe_order() for j in order])

    def bin_of(h: Column) -> Column:
        return F.shiftrightunsigned(h, 64 - BIN_BITS).cast("int")

    def digits(mins: Column) -> Column:
        return let(F.transform(mins, bin_of), lambda bins: fill(mins, bins))

    def fill(mins: Column, bins: Column) -> Column:
        def place(b: Column) -> Column:
            def held(skip: int, n: int) -> Column:
                order = F.slice(flat, b * (BINS - 1) + (1 + skip), n)
                return F.get(F.filter(order, lambda j: F.array_contains(bins, j)), F.lit(0))

            return F.when(F.array_contains(bins, b), b).otherwise(F.coalesce(held(0, PROBES), held(PROBES, BINS - 1 - PROBES)))

        full = F.transform(F.sequence(F.lit(0), F.lit(BINS - 1)), place)
        low = F.transform(full, lambda b: F.lower(F.hex(F.get(mins, (F.array_position(bins, b) - 1).cast("int")).bitwiseAND(F.lit(2**LOW_BITS - 1)))))
        return F.array_join(low, "")

    def least(ordered: Column) -> Column:  # the first hash of each bin
        return F.filter(ordered, lambda h, i: (i == 0) | (bin_of(h) != bin_of(F.get(ordered, i - 1))))

    hashes = shingle_hashes(F.coalesce(text, F.lit("")), width)
    mins = let(F.sort_array(hashes), least)
    return let(mins, lambda m: F.when(F.size(m) == 0, F.lit("")).otherwise(digits(m)))


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of two fingerprints: share of equal digits, corrected for chance."""
    same = F.size(F.filter(F.sequence(F.lit(1), F.lit(BINS)), lambda i: F.substr(a, i, F.lit(1)) == F.substr(b, i, F.lit(1))))
    chance = 1 / 2**LOW_BITS
    found = F.greatest((same / F.lit(float(BINS)) - chance) / (1 - chance), F.lit(0.0))
    return F.when(a == b, F.lit(1.0)).when((a == "") | (b == ""), F.lit(0.0)).otherwise(found)


def with_next(docs: DataFrame, id_col: str, carried: list[str]) -> DataFrame:
    """``docs`` with next_<c> for each carried column: its value in the next row by ascending id, the first after the last.

    The id order is cut at quantiles that are ids of the table, so the row a slice needs from the next one is the
    row with that slice's first id; it is sent to both. Rows with a null id are outside the order
    and have null there. Rows that repeat an id follow each other in the order of the carried columns' hash.
    """
    rows = docs.where(F.col(id_col).isNotNull())
    n = rows.count()
    slices = min(MAX_SLICES, max(1, -(-n // SLICE_ROWS)))
    cuts = [i / slices for i in range(1, slices)]
    got = rows.agg(F.min(id_col).alias("least"), F.percentile_approx(id_col, cuts or [0.5], 10 * MAX_SLICES).alias("cuts")).first()
    bounds = sorted({got["least"], *(got["cuts"] if cuts else ())} - {None})
    first = F.split(F.lit(",".join(map(str, bounds or [0]))), ",").cast("array<long>")  # without rows any bound will do
    own = F.size(F.filter(first, lambda b: b <= F.col(id_col))) - 1
    # With one slice the first row is sent twice to the same slice: the copy is told by its number.
    placed = rows.withColumn("_own", own)
    is_first = F.get(first, F.col("_own")) == F.col(id_col)
    before = F.pmod(F.col("_own") - 1, F.lit(max(1, len(bounds))))
    here = F.struct(F.col("_own").alias("slice"), F.lit(0).alias("copy"))
    there = F.struct(before.alias("slice"), F.lit(1).alias("copy"))
    placed = placed.withColumn("_to", F.explode(F.when(is_first, F.array(here, there)).otherwise(F.array(here))))
    order = Window.partitionBy("_to.slice").orderBy("_to.copy", id_col, F.xxhash64(*carried))
    led = placed.withColumns({f"next_{c}": F.lead(c).over(order) for c in carried}).where("_to.copy = 0").drop("_own", "_to")
    alone = docs.where(F.col(id_col).isNull()).withColumns({f"next_{c}": F.lit(None).cast(docs.schema[c].dataType) for c in carried})
    return led.unionByName(alone)


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, text, fingerprint, next_text, next_fingerprint (of the next id).

    Null text counts as empty; a text without a word has the empty fingerprint. Nulls and repeats of the id:
    see ``with_next``. Other columns are ignored; an empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))
    return with_next(rows.withColumn("fingerprint", fingerprint(F.col("text"))), "id", ["text", "fingerprint"])


def compare_with_edit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of each document and of an edit of it: its last half replaced by the start of the next document.

    Columns: id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next. A row with a
    null id has no next document: its last half is cut off and near_next is its likeness to the empty text.
    """
    rows = fingerprint_documents(docs, id_col, text_col)
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substr("text", F.lit(1), n - half), F.substr(F.coalesce("next_text", F.lit("")), F.lit(1), half))
    rows = rows.select("id", n.cast("long").alias("n_chars"), edited.alias("edited"), "fingerprint", F.coalesce("next_fingerprint", F.lit("")).alias("following"))
    rows = rows.withColumn("edited_fingerprint", fingerprint(F.col("edited")))
    return rows.select(
        "id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("following")).alias("near_next"),
    )
