"""Spelling variants by permuterm rotations.

The rotations of a word are those of the word with a terminator behind it. The rotation that ends in an edited character
holds all else as its prefix: ``b$ax`` for the ``x`` of ``axb``. So words that differ in one replaced character share
that prefix, and a word with one character less *is* that prefix, as one of its own rotations. All rotations are
sorted by these prefixes; each range of equal prefixes is scanned once, and every member gets from it how many of the
others are its neighbours and which is the most frequent. Words of a range differ in one character of a small alphabet, so a
range is never longer than that alphabet and one. No pairs are listed.

A pair that differs by one indel can meet in several ranges (``ab`` and ``aab``); it counts in the one where the
left-out character begins its run. A pair that differs by a replacement meets in one range.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotaloom.llm.common import cut, stored, text_of

LETTERS = r"a-zÀ-ÿ"
MIN_LENGTH = 6
MIN_COUNT = 5
#: A form occurs at least so many times as often as the word.
RATIO = 5
#: Of the runs whose checksum this divides, one code point is deleted.
NOISE = 199
END = "$"
#: Longer prefixes are compared by their SHA-256, so that a word of m code points costs a small multiple of m bytes.
LONG_KEY = 64
#: A range member is the whole word, or the word without a character that continues, or begins, a run of equal ones.
WHOLE, CONTINUES, BEGINS = 0, 1, 2


def noisy_words(docs: DataFrame, id_col: str, text_col: str, min_length: int = MIN_LENGTH, noise: int = NOISE) -> DataFrame:
    """One row ``word`` per maximal run of letters, A-Z in lower case, that has ``min_length`` code points after deletion.

    ``noise`` divides the CRC-32 h of ``<id>:<run>``: the run's code point h % length is deleted. Null ids count as empty.
    """
    lowered = F.translate(text_of(text_col), string.ascii_uppercase, string.ascii_lowercase)
    runs = F.regexp_extract_all(lowered, F.lit(f"[{LETTERS}]{{{min_length},}}"), F.lit(0))
    each = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    check = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    marked = each.select("run", check.alias("h"))
    at = F.pmod(F.col("h"), F.char_length("run")).cast("int")
    less = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run")))
    words = marked.select(F.when(F.col("h") % noise == 0, less).otherwise(F.col("run")).alias("word"))
    return words.where(F.char_length("word") >= min_length)


def vocabulary(words: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """The distinct ``word``s of at least ``min_count`` occurrences ``n``, with ``place``: a long that rises with
    falling n, then with the word in code-point order. Occurrences are added up before the shuffle."""
    counted = words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)
    ranked = counted.orderBy(F.col("n").desc(), "word").withColumn("place", F.monotonically_increasing_id())
    return stored(ranked, "spelling-words")


def rotations(words: DataFrame) -> DataFrame:
    """Rows (key, place, kind) of the ranges that each word of ``words`` (word, place) belongs to."""
    size = F.char_length("word")
    turned = words.select("word", "place", F.explode(F.sequence(F.lit(0), size)).alias("at"))
    rotation = F.concat(F.substring("word", F.col("at") + 1, size), F.lit(END), F.substring("word", F.lit(1), F.col("at")))
    last, before = F.substring("word", F.col("at"), F.lit(1)), F.substring("word", F.col("at") - 1, F.lit(1))
    begins = (F.col("at") == 1) | (last != before)
    turned = turned.select("place", "at", rotation.alias("turn"), F.when(begins, BEGINS).otherwise(CONTINUES).alias("kind"))
    whole = F.struct(F.col("turn").alias("key"), F.lit(WHOLE).alias("kind"))
    less = F.struct(F.substring("turn", F.lit(1), F.char_length("turn") - 1).alias("key"), F.col("kind"))
    # The rotation by nothing ends in the terminator, which is not edited.
    members = F.when(F.col("at") > 0, F.array(whole, less)).otherwise(F.array(whole))
    rows = turned.select("place", F.explode(members).alias("m")).select("m.key", "place", "m.kind")
    short = F.when(F.char_length("key") > LONG_KEY, F.sha2("key", 256)).otherwise(F.col("key"))
    return rows.select(short.alias("key"), "place", "kind")


def near_words(words: DataFrame) -> DataFrame:
    """One row per word of ``words`` (word, place) that has near words: place, ``n_near`` and ``best``, the least place of a near word."""
    sorted_range = Window.partitionBy("key").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)

    def place_if(condition: Column) -> Column:
        return F.when(condition, F.col("place"))

    less, begins, whole = F.col("kind") != WHOLE, F.col("kind") == BEGINS, F.col("kind") == WHOLE
    ranges = rotations(words).select(
        "place",
        "kind",
        F.count(F.lit(1)).over(sorted_range).alias("members"),
        F.count(place_if(less)).over(sorted_range).alias("n_less"),
        F.count(place_if(begins)).over(sorted_range).alias("n_begins"),
        F.min(place_if(less)).over(sorted_range).alias("first"),
        F.nth_value(place_if(less), 2, True).over(sorted_range).alias("second"),
        F.min(place_if(begins)).over(sorted_range).alias("first_begins"),
        F.min(place_if(whole)).over(sorted_range).alias("whole"),
    ).where("members > 1")
    other = F.when(F.col("place") == F.col("first"), F.col("second")).otherwise(F.col("first"))
    indel = F.when(begins, F.col("whole"))
    found = ranges.select(
        "place",
        F.when(whole, F.col("n_begins")).otherwise(F.col("n_less") - 1 + indel.isNotNull().cast("long")).alias("near"),
        F.when(whole, F.col("first_begins")).otherwise(F.least(other, indel)).alias("best"),
    ).where("near > 0")
    return found.groupBy("place").agg(F.sum("near").alias("n_near"), F.min("best").alias("best"))


def _roots(links: DataFrame) -> DataFrame:
    """(place, root) of ``links`` (place, form): the place that following forms ends at.

    A form is more frequent by a factor, so chains end and are short; each round doubles the steps taken.
    """
    ahead = cut(links.select("place", F.col("form").alias("root")))
    while True:
        onward = ahead.select(F.col("place").alias("root"), F.col("root").alias("onward"))
        joined = cut(ahead.join(onward, "root", "left").select("place", F.coalesce("onward", "root").alias("root"), F.col("onward").isNotNull().alias("more")))
        if joined.where("more").isEmpty():
            return joined.select("place", "root")
        ahead = joined.select("place", "root")


def group_variants(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH,
    min_count: int = MIN_COUNT, ratio: int = RATIO, noise: int = NOISE,
) -> DataFrame:
    """One row per word of the texts: word, n, n_near, form, form_n, root, as ``noisy_words`` and ``vocabulary`` count them.

    Two words are near if one inserted, deleted or replaced code point makes one the other; n_near counts them. form is the
    near word of largest n (ties: the first in code-point order) if that is at least ``ratio`` times the word's n; else form and form_n are
    null. root follows forms to the last, and is the word itself without one. Null and empty texts have no words; repeated rows
    count as often as they come; other columns are ignored. No words: no rows.
    """
    if ratio < 2:
        raise ValueError("forms must be more frequent than their words by a factor of 2 at least")
    words = vocabulary(noisy_words(docs, id_col, text_col, min_length, noise), min_count)
    near = stored(near_words(words.select("word", "place")), "spelling-near")
    other = words.select(F.col("place").alias("best"), F.col("n").alias("form_n"))
    links = words.select("place", "n").join(near, "place").join(other, "best").where(F.col("form_n") >= ratio * F.col("n"))
    links = stored(links.select("place", F.col("best").alias("form"), "form_n"), "spelling-forms")
    named = words.select(F.col("place").alias("form"), F.col("word").alias("form_word"))
    ends = words.select(F.col("place").alias("root"), F.col("word").alias("root_word"))
    formed = links.join(_roots(links), "place").join(named, "form").join(ends, "root")
    formed = formed.select("place", F.col("form_word").alias("form"), "form_n", F.col("root_word").alias("root"))
    out = words.join(near.select("place", "n_near"), "place", "left").join(formed, "place", "left")
    return out.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form", "form_n", F.coalesce("root", "word").alias("root"))
