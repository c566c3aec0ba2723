"""Joins in which one key may have a large share of the rows."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key with more than this share of the rows is spread; fewer than so many keys can be.
SHARE = 256
#: Tasks that the rows of such a key are spread over.
SPREAD = 64


#: Rows that a task sorts or hashes at once: some 100 MB.
ROWS = 250_000


def tasks_for(rows: DataFrame) -> int:
    """So many tasks that each has about ROWS of ``rows``, which should be cheap to count. Partitions sized by bytes hold
    millions of narrow, well compressed rows, whose sorts and hash tables take gigabytes; a given number is kept."""
    return max(rows.count() // ROWS + 1, rows.sparkSession.sparkContext.defaultParallelism)


def hot_keys(rows: DataFrame, key: str) -> DataFrame:
    """The keys that have more than one in SHARE rows: at most SHARE - 1, so they can be broadcast."""
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("total"))
    return counts.crossJoin(F.broadcast(total)).where(F.col("n") * SHARE > F.col("total")).select(key)  # one row


def spread_join(rows: DataFrame, other: DataFrame, keys: list[str], hot: DataFrame, by: str, how: str = "inner") -> DataFrame:
    """``rows`` joined to ``other`` on ``keys``. Where the first key is ``hot``, rows are dealt over SPREAD salts by a
    hash of ``by``, and the other side's rows of that key occur once for each salt. Joins that keep rows of ``other``
    without a partner would repeat them, and are not for this."""
    marked = F.broadcast(hot.withColumn("_hot", F.lit(True)))
    salt = F.when(F.col("_hot"), F.pmod(F.xxhash64(by), F.lit(SPREAD))).otherwise(0).cast("int")
    every = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(SPREAD - 1))).otherwise(F.array(F.lit(0)))
    left = rows.join(marked, keys[0], "left").withColumn("_salt", salt).drop("_hot")
    right = other.join(marked, keys[0], "left").withColumn("_salt", F.explode(every)).drop("_hot")
    return left.join(right, [*keys, "_salt"], how).drop("_salt")


#: Pairs that a task of ``tiles`` makes, up to so many tasks, and the tiles that it takes.
PAIRS, TASKS, TILES = 250_000, 10_000, 8


#: Pairs of a tile whose sides are wide: a row travels the less often the larger tiles are.
WIDE = 1 << 22


def tiles(left: DataFrame, right: DataFrame, key: str, left_by: str, right_by: str, wide: bool = False, each: int = 0) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both sides of a join on ``key``, of which few values may have many rows on both sides, and the columns on which they
    meet.

    The rows of a value are dealt over stripes by hashes of ``left_by`` and ``right_by``, and each stripe of one side
    meets each of the other in a tile, so that only the sides are shuffled and no pair is: a row travels once for each
    stripe that it meets. Tiles are of about equal sizes and are dealt over tasks, whose number grows with the pairs.
    With ``wide`` rows a task has about one tile of up to WIDE pairs, of four rows of ``left`` for one of ``right``; there
    are fewer copies of either side then. Where pairs take little work, a task makes ``each`` of them, once there are
    tasks for all cores.
    """
    number = lambda side, n: side.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias(n))
    sizes = number(left, "_n").join(number(right, "_m"), key)
    total = sizes.agg(F.sum(F.col("_n").cast("double") * F.col("_m"))).first()[0] or 0
    cores = left.sparkSession.sparkContext.defaultParallelism
    tasks = max(1, min(TASKS, math.ceil(total / PAIRS)))
    tasks = max(min(tasks, 4 * cores), min(TASKS, math.ceil(total / each))) if each else tasks
    across = down = max(32.0, math.sqrt(total / (tasks * TILES)))
    if wide:
        most = min(WIDE, max(PAIRS // TILES, total / (TILES * cores)))
        tasks, across, down = max(1, math.ceil(total / most)), 2 * math.sqrt(most), math.sqrt(most) / 2
    stripes = sizes.select(key, F.ceil(F.col("_n") / across).alias("_n"), F.ceil(F.col("_m") / down).alias("_m"))
    place = lambda by, n: F.pmod(F.xxhash64(by), F.col(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))
    rows = left.join(stripes, key).withColumn("_x", place(left_by, "_n")).withColumn("_y", every("_m")).drop("_n", "_m")
    others = right.join(stripes, key).withColumn("_y", place(right_by, "_m")).withColumn("_x", every("_n")).drop("_n", "_m")
    on = [key, "_x", "_y"]
    return rows.repartition(tasks, *on), others.repartition(tasks, *on), on


#: Pairs that a task makes where they are only put together: some seconds.
PLAIN = 1 << 23


def tiled_join(left: DataFrame, right: DataFrame, key: str, left_by: str, right_by: str, each: int = 0) -> DataFrame:
    """``left`` joined to ``right`` on ``key``, in ``tiles``."""
    rows, others, on = tiles(left, right, key, left_by, right_by, each=each)
    return rows.join(others.hint("merge"), on).drop("_x", "_y")
