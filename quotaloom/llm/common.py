"""Helpers shared by the corpus operators: inputs, lineage cuts, skew-safe lookups, components."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: ASCII white space as the contracts spell it, and a word: a run of anything else.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
#: A key is hot if it holds more than 1 / HOT_SHARE of all rows, so there are never more than HOT_SHARE.
HOT_SHARE = 1024


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_of(column: str) -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def fresh(df: DataFrame, *names: str) -> list[str]:
    """``names``, each with underscores added until ``df`` has no such column in any case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def shared_dir(spark: SparkSession) -> str:
    """The shared scratch folder: spark.checkpoint.dir; only a local session may go without one.

    A local session that names none (tests) gets a fresh folder; any other session must name
    one, as its executors could not see a folder of the driver's.
    """
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not path:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        path = tempfile.mkdtemp(prefix="corpus-scratch-")
        spark.conf.set("spark.checkpoint.dir", path)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(path)
    return path


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and go on from there (narrow frames; removed when unused)."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name below the shared scratch folder."""
    return f"{shared_dir(spark).rstrip('/')}/corpus-{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` as a parquet table in the shared folder and return that table."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a table that ``scratch_path`` named, once nothing reads it any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def lookup(big: DataFrame, small: DataFrame, on: list[str], size: str, spread: list[str], salts: int = 64) -> DataFrame:
    """Inner join of ``big`` with ``small``, which has one row per key and, in ``size``, the key's rows in ``big``.

    Keys above 1 / HOT_SHARE of all rows, at most HOT_SHARE of them, are broadcast as a mark; their
    rows in ``big`` are salted by ``spread`` and their row in ``small`` is repeated for each salt.
    ``small`` should be a checkpoint: it is read three times.
    """
    total = small.agg(F.sum(size)).first()[0] or 0
    least = max(total // HOT_SHARE, 1000)
    hot = small.where(F.col(size) > least).select(*on, F.lit(1).alias("_hot"))
    marked = big.join(F.broadcast(hot), on, "left")
    salt = F.when(F.col("_hot").isNotNull(), F.pmod(F.xxhash64(*spread), F.lit(salts))).otherwise(F.lit(0))
    salted = marked.withColumn("_salt", salt.cast("int")).drop("_hot")
    each = F.when(F.col(size) > least, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    return salted.join(small.withColumn("_salt", F.explode(each)), [*on, "_salt"]).drop("_salt")


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges`` (a, b: long): one row (v, label) per vertex, label the smallest vertex.

    Labels point towards the smallest vertex. In a round each vertex takes the smallest label of a label among its neighbours and
    hands it to the vertex that its own label names as well, so whole trees of labels move at once and the rounds grow
    with the logarithm of the longest path; the end is a round in which no label changes. A round is one job: both joins are
    sort-merge joins, which AQE splits where a vertex has very many edges or a label very many vertices, and
    the changes are counted while the labels are written. The table of the round before goes then, so the driver
    keeps neither broadcast relations nor checkpoints of earlier rounds. A lost executor costs one round at most.
    """
    spark = edges.sparkSession
    both = stored(edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct(), "links")
    path = scratch_path(spark, "labels")
    both.groupBy(F.col("a").alias("v")).agg(F.min("b").alias("near")).select("v", F.least("v", "near").alias("label")).write.parquet(path)
    while True:
        labels, before = spark.read.schema("v long, label long").parquet(path), path
        up = labels.select(F.col("v").alias("label"), F.col("label").alias("top"))
        now = labels.join(up.hint("merge"), "label").select("v", "label", "top")
        near = both.join(now.select("v", "top").hint("merge"), both.a == F.col("v")).groupBy(F.col("b").alias("v")).agg(F.min("top").alias("near"))
        met = now.join(near.hint("merge"), "v").withColumn("low", F.least("top", "near"))
        own = F.struct("v", F.col("low").alias("to"), F.col("label").alias("was"))
        tree = F.struct(F.col("label").alias("v"), F.col("near").alias("to"), F.lit(None).cast("long").alias("was"))
        moves = met.select(F.inline(F.array(own, tree)))
        found = moves.groupBy("v").agg(F.min("to").alias("label"), F.max("was").alias("was"))
        path, changed = scratch_path(spark, "labels"), Observation()
        found.observe(changed, F.count_if(F.col("label") != F.col("was")).alias("n")).select("v", "label").write.parquet(path)
        discard(spark, before)
        if not changed.get["n"]:
            return spark.read.schema("v long, label long").parquet(path)
