"""Toxicity by class-conditional Kneser-Ney models.

Two models of how words are spelled, one of toxic and one of ordinary documents: interpolated Kneser-Ney over
characters within a word, order 5. Orders 5 to 3 have counts of their own per class; order 2 and
below are shared continuation counts, so an expression that neither class has seen often is
judged alike by both and says nothing. A document's words are scored by the difference of the
two log-likelihoods, normalised by length over windows of words at every word, and the windows' maximum, the
document's mean and its length are calibrated on labelled documents that the counts did not use.

Counting is a distributed aggregate whose size follows the labelled corpus; the finished model has every counted gram
and context, sorted by hash, 12 bytes each.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from quotaloom.llm.common import cut, fresh
from quotaloom.llm.worker import keep

ORDER = 5
#: Absolute discount of each order.
DISCOUNT = 0.75
#: Words of a window that is scored on its own.
WINDOW = 4
#: Labelled documents that the calibration may use: the ones with the smallest hashes of their ids.
CALIBRATION_DOCS = 20_000
#: Labels are broadcast up to so many rows (two numbers each), so that texts need not be shuffled to them.
BROADCAST_LABELS = 4_000_000
#: Words a worker remembers the score of, in each of two generations.
CACHE_WORDS = 200_000
#: Words whose grams are counted or scored at a time.
AT_ONCE = 50_000
CACHE_CHARS = 64
#: Padding before a word and the mark of its end; a longer word is scored in pieces of this many characters.
PAD, END = "\x02", "\x03"
PIECE = 200


def words_of(text: str | None) -> list[str]:
    return (text or "").lower().split()


def _grams(words: list[str]):
    """Code points of all words laid end to end with padding, and for each position its word; padding has -1."""
    import numpy as np

    line = "".join(PAD * (ORDER - 1) + w + END for w in words)
    points = np.frombuffer(line.encode("utf-32-le", "surrogatepass"), "<u4")
    sizes = np.fromiter((len(w) + ORDER for w in words), np.int64, len(words))
    owner = np.repeat(np.arange(len(words)), sizes)
    first = np.repeat(np.cumsum(sizes) - sizes, sizes)
    owner[np.arange(len(points)) - first < ORDER - 1] = -1
    return points, owner


def _hashes(points, order: int):
    """A 64-bit hash of the ``order`` code points that end at each position (junk at the first few)."""
    import numpy as np

    h = np.full(len(points), 0x9E3779B97F4A7C15 * order & (2**64 - 1), np.uint64)
    with np.errstate(over="ignore"):
        for back in range(order - 1, -1, -1):
            shifted = np.zeros(len(points), np.uint64)
            shifted[back:] = points[: len(points) - back]
            h = (h ^ shifted) * np.uint64(0xD6E8FEB86659FD93)
            h ^= h >> np.uint64(32)
    return h


class Scorer:
    """Log-likelihood ratio of words under a finished model: "check" (all hashes, sorted) and "value" arrays."""

    def __init__(self, model: dict):
        self.check, self.value = model["check"], model["value"]
        self.new: dict[str, float] = {}
        self.old: dict[str, float] = {}

    def _find(self, hashes):
        import numpy as np

        if not len(self.check):
            return np.zeros(len(hashes), bool), np.zeros(len(hashes), np.float32)
        at = np.minimum(np.searchsorted(self.check, hashes), len(self.check) - 1)
        return self.check[at] == hashes, self.value[at]

    def _ratios(self, words: list[str]):
        """Sum over a word's characters; each character backs off to the longest gram that training saw."""
        import numpy as np

        points, owner = _grams(words)
        todo = np.flatnonzero(owner >= 0)
        totals = np.zeros(len(words))
        for order in range(ORDER, 2, -1):
            seen, value = self._find(_hashes(points, order)[todo])
            np.add.at(totals, owner[todo[seen]], value[seen])
            todo = todo[~seen]
            if order > 1 and len(todo):  # the weight of backing off in this context
                context = _hashes(points, order - 1)[todo - 1] ^ np.uint64(0xA5A5A5A5A5A5A5A5)
                known, value = self._find(context)
                np.add.at(totals, owner[todo[known]], value[known])
        return totals

    def lookup(self, words: set[str]) -> dict[str, float]:
        if len(self.new) > CACHE_WORDS:
            self.new, self.old = {}, self.new
        new, old, out, unseen = self.new, self.old, {}, []
        for w in words:
            v = new.get(w)
            if v is None:
                v = old.get(w)
                if v is None:
                    unseen.append(w)
                    continue
                new[w] = v
            out[w] = v
        for at in range(0, len(unseen), AT_ONCE):
            part = unseen[at : at + AT_ONCE]
            pieces = [w[i : i + PIECE] for w in part for i in range(0, len(w), PIECE)]
            counts = [-(-len(w) // PIECE) for w in part]
            import numpy as np

            per = np.add.reduceat(self._ratios(pieces), np.cumsum([0, *counts[:-1]])) if part else []
            for w, v in zip(part, per.tolist(), strict=True):
                out[w] = v
                if len(w) <= CACHE_CHARS:
                    new[w] = v
        return out

    def features(self, texts: list[str | None]):
        """Per text: highest mean of a window of words, mean over all words, log of the number of words."""
        import numpy as np

        rows = [words_of(t) for t in texts]
        table = self.lookup(set().union(*rows)) if rows else {}
        out = np.zeros((len(rows), 3))
        for i, words in enumerate(rows):
            if not words:
                continue
            a = np.fromiter(map(table.__getitem__, words), np.float64, len(words))
            if len(a) > WINDOW:  # a window at every word, so that the verdict does not depend on where an expression stands
                sums = np.append(0.0, np.cumsum(a))
                highest = (sums[WINDOW:] - sums[:-WINDOW]).max() / WINDOW
            else:
                highest = a.sum() / max(len(a), WINDOW // 2)
            out[i] = highest, a.mean(), np.log1p(len(a))
        return out


def _scorer(model: dict) -> Scorer:
    """The worker's scorer of this model; its memory outlives a task where Spark reuses workers."""
    return keep(("scorer", model["name"]), lambda: Scorer(model))


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, toxic) to (gram, toxic count, ordinary count), combined within the task."""
    import numpy as np

    held: tuple[Counter, Counter] = (Counter(), Counter())

    keep("gram counts", lambda: None)

    def flush() -> Iterator[pa.RecordBatch]:
        words = list(held[0].keys() | held[1].keys())
        for at in range(0, len(words), AT_ONCE):
            yield counted(words[at : at + AT_ONCE])
        for c in held:
            c.clear()

    def counted(words: list[str]) -> pa.RecordBatch:
        pieces = [(w[i : i + PIECE], w) for w in words for i in range(0, len(w), PIECE)]
        points, owner = _grams([p for p, _ in pieces])
        at = np.flatnonzero(owner >= 0)
        _, first, group = np.unique(_hashes(points, ORDER)[at], return_index=True, return_inverse=True)
        counts = []
        for c in held:
            weight = np.fromiter((c[w] for _, w in pieces), np.float64, len(pieces))
            counts.append(np.bincount(group, weight[owner[at]], len(first)).astype(np.int64))
        ends = at[first]
        grams = ["".join(map(chr, points[e - ORDER + 1 : e + 1])) for e in ends.tolist()]
        return pa.RecordBatch.from_arrays([pa.array(grams, pa.string()), pa.array(counts[0]), pa.array(counts[1])], names=["gram", "t", "o"])

    for batch in batches:
        for text, toxic in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
            held[0 if toxic else 1].update(words_of(text.as_py()))
            if len(held[0]) + len(held[1]) > CACHE_WORDS:
                yield from flush()
    yield from flush()


def fit(labelled: DataFrame, calibration: DataFrame, text_col: str = "text", label_col: str = "toxic", id_col: str = "doc_id") -> dict:
    """Count over all of ``labelled``; calibrate on at most CALIBRATION_DOCS rows of ``calibration``.

    Label 1 is toxic, 0 ordinary; rows with a null label or text are left out. With no row of one class (or
    none at all) every score is the share of label 1 in the calibration rows, or 0 without any.
    """
    import uuid

    import numpy as np

    spark = labelled.sparkSession
    rows = labelled.where(F.col(text_col).isNotNull() & F.col(label_col).isin(0, 1)).select(text_col, F.col(label_col) == 1)
    grams = rows.mapInArrow(_count_grams, "gram string, t long, o long").groupBy("gram").agg(F.sum("t").alias("t"), F.sum("o").alias("o"))
    g = {5: cut(grams)}
    has = lambda c: F.sum((F.col(c) > 0).cast("long")).alias(c)  # noqa: E731  continuation: distinct characters before
    for order in (4, 3):
        g[order] = cut(g[order + 1].groupBy(F.expr("substring(gram, 2)").alias("gram")).agg(has("t"), has("o")))
    shared = g[3].groupBy(F.expr("substring(gram, 2)").alias("gram")).agg(F.count(F.lit(1)).alias("n"))
    g[2] = cut(shared)
    ones = g[2].groupBy(F.expr("substring(gram, 2)").alias("gram")).agg(F.count(F.lit(1)).alias("n"))
    total = ones.agg(F.sum("n")).first()[0] or 1
    d = F.lit(DISCOUNT)
    p1 = ones.select(F.col("gram").alias("low"), (F.col("n") / F.lit(float(total))).alias("p1"))

    def context(frame: DataFrame, *counts: str) -> DataFrame:
        sums = [x for c in counts for x in (F.sum(c).alias(f"sum_{c}"), F.sum((F.col(c) > 0).cast("long")).alias(f"kinds_{c}"))]
        return frame.groupBy(F.expr("substring(gram, 1, length(gram) - 1)").alias("ctx")).agg(*sums)

    def split(frame: DataFrame) -> DataFrame:
        return frame.withColumns({"ctx": F.expr("substring(gram, 1, length(gram) - 1)"), "low": F.expr("substring(gram, 2)")})

    two = split(g[2]).join(context(g[2], "n"), "ctx").join(p1, "low")
    p = two.select(F.col("gram").alias("low"), (((F.col("n") - d) + d * F.col("kinds_n") * F.col("p1")) / F.col("sum_n")).alias("pt"))
    p = p.withColumn("po", F.col("pt"))
    entries = []
    for order in (3, 4, 5):
        c = cut(context(g[order], "t", "o"))
        level = split(g[order]).join(c, "ctx").join(p, "low")

        def mixed(k: str, lower: str) -> Column:
            seen = (F.greatest(F.col(k) - d, F.lit(0.0)) + d * F.col(f"kinds_{k}") * F.col(lower)) / F.col(f"sum_{k}")
            return F.when(F.col(f"sum_{k}") > 0, seen).otherwise(F.col(lower))

        p = cut(level.select(F.col("gram").alias("low"), mixed("t", "pt").alias("pt"), mixed("o", "po").alias("po")))
        entries.append(p.select(F.col("low").alias("gram"), F.lit(False).alias("is_ctx"), F.log(F.col("pt") / F.col("po")).alias("v")))
        back = lambda k: F.when(F.col(f"sum_{k}") > 0, d * F.col(f"kinds_{k}") / F.col(f"sum_{k}")).otherwise(F.lit(1.0))
        entries.append(c.select(F.col("ctx").alias("gram"), F.lit(True).alias("is_ctx"), F.log(back("t") / back("o")).alias("v")))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            grams, is_ctx = b.column(0).to_pylist(), np.array(b.column(1).to_pylist(), bool)
            h = np.zeros(len(grams), np.uint64)
            lengths = np.array([len(x) for x in grams])
            for n in set(lengths.tolist()):
                own = np.flatnonzero(lengths == n)
                points = np.frombuffer("".join(grams[i] for i in own).encode("utf-32-le", "surrogatepass"), "<u4")
                h[own] = _hashes(points, n)[n - 1 :: n]
            h = np.where(is_ctx, h ^ np.uint64(0xA5A5A5A5A5A5A5A5), h)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), b.column(2).cast(pa.float32())], names=["hash", "v"])

    union = entries[0]
    for e in entries[1:]:
        union = union.unionByName(e)
    # Every entry reaches the driver, 12 bytes each: distinct grams and contexts, not occurrences.
    got = union.mapInArrow(hashed, "hash long, v float").toArrow()
    check, value = got.column("hash").to_numpy().view(np.uint64), got.column("v").to_numpy()
    order = np.argsort(check)
    check, value = check[order], value[order]
    model = {"name": uuid.uuid4().hex, "check": check, "value": value, "weights": None}

    sample = calibration.where(F.col(text_col).isNotNull() & F.col(label_col).isin(0, 1))
    sample = sample.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), F.col(label_col).cast("double").alias("y"))
    rated = with_features(sample, model, "text", ["_f0", "_f1", "_f2"]).drop("text").orderBy(F.xxhash64("id"), "id").limit(CALIBRATION_DOCS).toArrow()
    y = rated.column("y").to_numpy()
    x = np.stack([rated.column(f"_f{i}").to_numpy() for i in range(3)], 1) if len(y) else np.zeros((0, 3))
    model["weights"] = _logistic(x, y)
    return model


def _logistic(x, y):
    """Ridge logistic regression by Newton steps until they vanish: (mean, scale, weights); the last weight is the constant."""
    import numpy as np

    if len(y) == 0 or y.min() == y.max():
        share = float(y.mean()) if len(y) else 0.0
        odds = -20.0 if share == 0 else 20.0 if share == 1 else np.log(share / (1 - share))
        return np.zeros(3), np.ones(3), np.array([0.0, 0.0, 0.0, odds])
    mean, scale = x.mean(0), x.std(0) + 1e-9
    a = np.column_stack([(x - mean) / scale, np.ones(len(y))])
    w = np.zeros(4)
    for _ in range(200):  # each step is damped by the ridge term; a vanishing step ends it
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        ridge = 1e-2 * np.array([1, 1, 1, 0])
        step = np.linalg.solve(a.T @ (a * (p * (1 - p))[:, None]) + np.diag(ridge + 1e-9), a.T @ (y - p) - ridge * w)
        w += step
        if abs(step).max() < 1e-8:
            break
    return mean, scale, w


def _with(docs: DataFrame, names: list[str]) -> StructType:
    return StructType([*docs.schema.fields, *[StructField(n, DoubleType()) for n in names]])


def with_features(docs: DataFrame, model: dict, text_col: str, names: list[str]) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast({k: model[k] for k in ("name", "check", "value")})  # 12 bytes an entry
    where = docs.columns.index(text_col)
    every = [*docs.columns, *names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                f = _scorer(shared.value).features(part.column(where).to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns, *[pa.array(f[:, i]) for i in range(3)]], names=every)

    return docs.mapInArrow(run, _with(docs, names))


def with_score(docs: DataFrame, model: dict, text_col: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with a last column ``name`` (replaced if there): 0 to 1, higher if toxic is likelier.

    Null text counts as empty; a text without a word has the score of no evidence.
    """
    docs = docs.drop(name)
    names = fresh(docs, "_f0", "_f1", "_f2")
    mean, scale, w = model["weights"]
    z = F.lit(float(w[3]))
    for i in range(3):
        z = z + F.lit(float(w[i])) * ((F.col(names[i]) - float(mean[i])) / float(scale[i]))
    z = F.greatest(F.least(z, F.lit(30.0)), F.lit(-30.0))
    return with_features(docs, model, text_col, names).withColumn(name, 1 / (1 + F.exp(-z))).drop(*names)


def fold(id_col: str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts`` (a null id: the empty text)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % parts


def labelled_docs(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text, label) of documents with a label; an id labelled twice takes the larger label."""
    own = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("doc_id")).agg(F.max(label_col).alias("toxic"))
    own = cut(own.where("toxic IS NOT NULL"))
    if own.count() <= BROADCAST_LABELS:  # else both sides are shuffled
        own = F.broadcast(own)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.join(own, "doc_id")


def fit_by_fold(docs: DataFrame, labels: DataFrame) -> dict:
    """Counts from labelled documents of folds 1 to 3 of 5, calibration on fold 4; fold 0 stays unseen."""
    part = fold("doc_id", 5)
    seen = labelled_docs(docs.select("doc_id", "text").where(part > 0), labels)
    return fit(seen.where(part < 4), seen.where(part == 4))
