"""What the corpus operators share: written tables, exact ranks without hot tasks, and connected components."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Characters of the word separators that the contracts name: space and U+0009 to U+000D.
SPACES = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir. Where it is unset, a temporary one for a local session,
    as in tests; on a cluster that would lose rows, and raises."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is unset: there is no folder that all executors share")
        found = tempfile.mkdtemp(prefix="spark-shared-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def keep(df: DataFrame) -> DataFrame:
    """Writes ``df`` into the shared folder and reads it back: work is done once, lineage is cut, a lost executor loses
    nothing, and Spark knows the size, so it broadcasts only what is small."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/grantlink-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def with_row(df: DataFrame, name: str = "row") -> DataFrame:
    """A number for each row. Only stable once the result has been kept."""
    return df.withColumn(name, F.monotonically_increasing_id())


def ranked(df: DataFrame, by: list[str], order: list[str], rows: int, out: str = "rank") -> DataFrame:
    """Gapless ranks from 0 inside each ``by`` group, in an order that only depends on ``order`` (which must be unique).

    A group may hold most rows: it is cut into hash buckets of about 100,000 rows, each is numbered by itself, and the
    sums of the buckets before it are added. ``df`` is read twice, so it should be kept; ``by`` columns must not be null.
    """
    buckets = max(16, rows // 100_000)
    cut = df.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    before = Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = cut.groupBy(*by, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    sums = sums.select(*by, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy(*by, "_bucket").orderBy(*order))
    return cut.withColumn("_inside", inside).join(sums, [*by, "_bucket"]).withColumn(out, F.col("_inside") - 1 + F.col("_before")).drop("_inside", "_before", "_bucket")


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(a, b))"), F.expr("sum(cast(xxhash64(b, a) % 1000003 as bigint))")).first())


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """Connected components of the undirected ``edges`` (a, b): rows (node, root), where root is the smallest node.

    Alternates the large-star and small-star steps (Kiveris et al., "Connected Components in MapReduce and Beyond"),
    so a path of n nodes takes about log(n) rounds. The minimum of a node's neighbours is an aggregate with a map-side
    part, and the rest are joins that AQE can split, so a node with very many neighbours makes no hot task.
    Each round is written to the shared folder.
    """
    now = keep(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = _state(now)
    for _ in range(rounds):
        if not seen[0]:
            break
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.greatest("b", "m").alias("a"), F.least("b", "m").alias("b"))
        now = keep(small.union(least.select("a", F.col("m").alias("b"))).distinct())
        was, seen = seen, _state(now)
        if was == seen:
            break
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def utf8(text: str | Column) -> Column:
    """The bytes of a text for Arrow, null as empty."""
    c = F.col(text) if isinstance(text, str) else text
    return F.coalesce(c, F.lit("")).cast("binary")


def widened(df: DataFrame, ddl: str, without: str = "_utf8") -> T.StructType:
    """The schema of ``df`` without the text's bytes, and the columns of ``ddl``."""
    return T.StructType([x for x in df.schema if x.name != without] + T.StructType.fromDDL(ddl).fields)
