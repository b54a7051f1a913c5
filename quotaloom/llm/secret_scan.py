"""Secret scans with built-in functions only: fixed patterns, and character Markov models.

The patterns give the base spans. Two first-order character models, one of random strings and one of
ordinary identifiers, are trained from labelled samples; a further run of token characters is
a secret if the log-likelihood ratio of the two models exceeds the odds against one.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotaloom.llm.common import cut, let, text_of

# The three base patterns, with the shortest match (assign: of its value).
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 6, 20, 24
KINDS = ("assign", "access", "hex", "markov")

#: Runs that the models judge: token characters, this long at least, with a letter among them.
RUN = r"[A-Za-z0-9+/_-]{16,}"
#: Ordinary identifiers in a text.
IDENTIFIER = r"[A-Za-z_][A-Za-z0-9_]{7,}"
#: Labelled samples come from at most so many documents, those with the smallest hashes of their ids.
SAMPLE_DOCS = 20_000
#: A run is a secret if its log-likelihood ratio is above this: odds of one to ten thousand.
MIN_RATIO = math.log(10_000)
#: Counts by which a transition leans on its second character alone.
PRIOR = 20
#: Matches whose places are added up at a time.
SLICE = 256
#: Token characters lie between these code points.
LOW, HIGH = ord("+"), ord("z")
SIDE = HIGH - LOW + 1


def _spans(text: Column, pattern: str, kind: int, keep_group: int, least: int) -> Column:
    """Spans of all leftmost non-overlapping matches: array of (start, kind, end), code points; short ones dropped.

    The pieces between the matches give the positions.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    judged = F.regexp_extract_all(text, F.lit(pattern), F.lit(keep_group)) if keep_group else found
    gaps = F.split(text, pattern, -1)
    parts = F.arrays_zip(
        F.transform(found, F.char_length).alias("n"), F.transform(judged, F.char_length).alias("judged"), F.transform(gaps, F.char_length).alias("gap")
    )
    def spans(p: Column) -> Column:
        # Places add up over all parts before; in slices of SLICE parts, as a growing array is copied at every step.
        numbers = F.sequence(F.lit(0), F.floor((F.size(p) - 1) / SLICE).cast("int"))
        piece = lambda b: F.slice(p, b * SLICE + 1, F.lit(SLICE))
        size = lambda x: x["gap"] + F.coalesce(x["n"], F.lit(0))
        sizes = F.transform(numbers, lambda b: F.aggregate(piece(b), F.lit(0), lambda a, x: a + size(x)))
        sums = F.aggregate(
            sizes,
            F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")),
            lambda a, n: F.struct((a["at"] + n).alias("at"), F.concat(a["out"], F.array(a["at"])).alias("out")),
            lambda a: a["out"],
        )

        def step(a: Column, x: Column) -> Column:
            start = a["at"] + x["gap"]
            span = F.struct(start.alias("start"), F.lit(kind).alias("kind"), (start + x["n"]).alias("end"))
            out = F.when(x["judged"] >= least, F.concat(a["out"], F.array(span))).otherwise(a["out"])
            return F.struct((a["at"] + size(x)).alias("at"), out.alias("out"))

        def own(starts: Column) -> Column:
            first = lambda b: F.struct(F.get(starts, b).alias("at"), none.alias("out"))
            return F.flatten(F.transform(numbers, lambda b: F.aggregate(piece(b), first(b), step, lambda a: a["out"])))

        return let(sums, own)

    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    return F.when(F.rlike(text, F.lit(pattern)), let(parts, spans)).otherwise(none)


def base_spans(text: Column) -> Column:
    """All base spans by start, then kind: array of (start, kind, end)."""
    hex_runs = HEX.replace("+", "{%d,}" % HEX_LEAST)  # a run is matched whole, so a shorter one cannot match at all
    access_runs = ACCESS.replace("+", "{%d,}" % (ACCESS_LEAST - 4))
    return F.array_sort(
        F.concat(
            _spans(text, ASSIGN, 0, 2, ASSIGN_LEAST), _spans(text, access_runs, 1, 0, ACCESS_LEAST), _spans(text, hex_runs, 2, 0, HEX_LEAST)
        )
    )


def labelled_samples(docs: DataFrame) -> DataFrame:
    """(value, random) from ``docs`` (id, text, base).

    Random: the values of base spans, and digests of the ids. Ordinary: identifiers that several documents have,
    each once as it is, in capitals and in small letters, and that are no such value; a random string hardly ever occurs twice.
    Capitals alone are thus no mark of a random string, while case that changes at random stays one.
    """
    rows = docs.select("id", "text", "base")
    taken = F.transform("base", lambda s: F.substr(F.col("text"), s["start"] + 1, s["end"] - s["start"]))
    values = F.transform(taken, lambda v: F.regexp_extract(v, r"[A-Za-z0-9+/_-]+$", 0))
    digest = F.sha2(F.coalesce(F.col("id").cast("string"), F.lit("")), 256)
    made = F.array(digest, F.regexp_replace(F.base64(F.unhex(digest)), "=", ""))
    random = rows.select(F.explode(F.concat(values, made)).alias("value"), F.lit(True).alias("random"))
    plain = rows.select("id", F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(IDENTIFIER), F.lit(0)))).alias("value"))
    plain = plain.groupBy("value").agg(F.min("id").alias("a"), F.max("id").alias("b")).where("a < b")
    plain = plain.join(random, "value", "left_anti")
    cased = F.explode(F.array_distinct(F.array("value", F.upper("value"), F.lower("value")))).alias("value")
    return random.unionByName(plain.select(cased).select("value", F.lit(False).alias("random"))).where(F.char_length("value") > 1)


def _pairs(value: Column) -> Column:
    """Index of each pair of neighbouring characters in a SIDE x SIDE table; characters outside it count as the nearest."""

    def code(i: Column) -> Column:
        return F.least(F.greatest(F.ascii(F.substr(value, i, F.lit(1))), F.lit(LOW)), F.lit(HIGH)) - LOW

    return F.transform(F.sequence(F.lit(2), F.char_length(value)), lambda i: code(i - 1) * SIDE + code(i))


def train(samples: DataFrame) -> list[float]:
    """Log-likelihood ratio, random over ordinary, of each pair of characters (SIDE * SIDE numbers).

    A transition's probability leans on that of its second character by PRIOR counts, which in turn is
    smoothed by one count; so characters that ordinary identifiers lack speak for a random string. Without samples all
    ratios are 0.
    """
    counted = samples.where(F.char_length("value") > 1).select("random", F.explode(_pairs(F.col("value"))).alias("pair"))
    counts = {True: [0] * SIDE**2, False: [0] * SIDE**2}
    for r in counted.groupBy("random", "pair").count().collect():  # at most 2 * SIDE * SIDE rows
        counts[r["random"]][r["pair"]] += r["count"]
    logs = {}
    for label, c in counts.items():
        single = [sum(c[k::SIDE]) + 1 for k in range(SIDE)]
        share = [x / sum(single) for x in single]
        totals = [sum(c[k * SIDE : (k + 1) * SIDE]) for k in range(SIDE)]
        logs[label] = [math.log((x + PRIOR * share[k % SIDE]) / (totals[k // SIDE] + PRIOR)) for k, x in enumerate(c)]
    return [a - b for a, b in zip(logs[True], logs[False], strict=True)]


def ratio(value: Column, table: list[float]) -> Column:
    """The log-likelihood ratio of a run."""
    numbers = F.split(F.lit(",".join(f"{x:.6f}" for x in table)), ",").cast("array<double>")  # folded to one literal
    return F.aggregate(_pairs(value), F.lit(0.0), lambda a, k: a + F.get(numbers, k))


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """One row per row of ``docs``: id, text, spans (array of (start, kind, end) by start, then kind; end exclusive).

    ``kind`` counts in KINDS. All base spans stay; a run that overlaps none and that the models
    find random is added. Null text counts as empty. Rows may repeat ids, and null ids are returned; repeated rows count as
    often in training. Other columns are ignored; an empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))
    ids = rows.select("id").orderBy(F.xxhash64("id"), "id").limit(sample_docs).distinct()
    sample = rows.join(F.broadcast(ids), "id", "left_semi")  # at most ``sample_docs`` ids
    table = train(labelled_samples(cut(sample.withColumn("base", base_spans(F.col("text"))))))

    def judged(text: Column, base: Column) -> Column:
        runs = _spans(text, RUN, 3, 0, 2)
        return F.filter(
            runs,
            lambda s: ~F.exists(base, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
            & F.rlike(F.substr(text, s["start"] + 1, s["end"] - s["start"]), F.lit("[A-Za-z]"))
            & (ratio(F.substr(text, s["start"] + 1, s["end"] - s["start"]), table) > MIN_RATIO),
        )

    whole = let(base_spans(F.col("text")), lambda b: F.array_sort(F.concat(b, judged(F.col("text"), b))))
    return rows.withColumn("spans", whole)


def span_text(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")
