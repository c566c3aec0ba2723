"""Sharding by best-fit-decreasing bin packing.

Groups of equal texts are indivisible. Sorted by size, largest first, each enters the shard with the tightest remaining
capacity that still holds it, found in a balanced tree of remaining capacities; a new shard opens only where none does.
Groups of one size are interchangeable, so the packing runs over the sizes and their counts, one tree step for a run of
equal groups. Sizes over 65,536 are rounded up to 12 significant bits, so there are under 260,000 different ones at any
scale; that is all the driver sees. Which group takes which place of its size is settled by a distributed rank.

A group that alone exceeds a shard's fair share cannot stay whole at near equal sizes: it is cut into pieces of whole
rows of that share.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import keep, ranked, table, with_row

SHARDS = 24
OVERHEAD = 8


class CapacityTree:
    """A treap of (remaining capacity, bin): balanced by priorities that are hashes of the keys."""

    __slots__ = ("root",)

    def __init__(self):
        self.root = None

    @staticmethod
    def _priority(key: tuple[int, int]) -> int:
        x = (key[0] * 0x9E3779B97F4A7C15 + key[1] * 0xC2B2AE3D27D4EB4F + 0x165667B19E3779F9) & 0xFFFFFFFFFFFFFFFF
        x = ((x ^ x >> 31) * 0xBF58476D1CE4E5B9) & 0xFFFFFFFFFFFFFFFF
        return x ^ x >> 29

    @classmethod
    def _split(cls, node, key):
        if node is None:
            return None, None
        k, priority, left, right = node
        if k < key:
            a, b = cls._split(right, key)
            return (k, priority, left, a), b
        a, b = cls._split(left, key)
        return a, (k, priority, b, right)

    @classmethod
    def _merge(cls, a, b):
        if a is None or b is None:
            return a or b
        if a[1] > b[1]:
            return (a[0], a[1], a[2], cls._merge(a[3], b))
        return (b[0], b[1], cls._merge(a, b[2]), b[3])

    def add(self, capacity: int, number: int) -> None:
        key = (capacity, number)
        a, b = self._split(self.root, key)
        self.root = self._merge(self._merge(a, (key, self._priority(key), None, None)), b)

    def take_tightest(self, size: int) -> tuple[int, int] | None:
        """Removes and returns the bin with the least capacity that is ``size`` or more."""
        a, b = self._split(self.root, (size, -1))
        if b is None:
            return None
        path = b
        while path[2] is not None:
            path = path[2]
        _, b = self._split(b, (path[0][0], path[0][1] + 1))
        self.root = self._merge(a, b)
        return path[0]


def best_fit_decreasing(sizes: list[tuple[int, int]], capacity: int, most: int | None = None) -> list[tuple[int, int, int]] | None:
    """Packs ``sizes`` (size, count) into bins of ``capacity``: runs (size, count, bin) in the order of packing, sizes
    descending. None if it takes more than ``most`` bins."""
    tree, opened, runs = CapacityTree(), 0, []
    for size, count in sorted(sizes, reverse=True):
        while count:
            found = tree.take_tightest(size)
            if found is None:
                if size > capacity or opened == most:
                    return None
                found, opened = (capacity, opened), opened + 1
            # the bin stays the tightest one while it holds another
            n = min(count, found[0] // size) if size else count
            runs.append((size, n, found[1]))
            count -= n
            tree.add(found[0] - n * size, found[1])
    return runs


def pack(sizes: list[tuple[int, int]], bins: int) -> list[tuple[int, int, int]]:
    """Best-fit-decreasing at about the least capacity that gives ``bins`` bins."""
    total = sum(s * n for s, n in sizes)
    least = max(-(-total // bins), max((s for s, _ in sizes), default=0))
    slack = max(1, least >> 16)
    while True:
        runs = best_fit_decreasing(sizes, least + slack, bins)
        if runs is not None:
            return runs
        slack *= 2


def shard(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """One row per input row: doc_id, size, text_crc32, law ('bytes'), shard, slot, grown_shard (null).

    A null text has no bytes, crc32 0, and forms a group of its own. Repeated rows are rows like others, in their
    group. Empty shards only occur with fewer groups than shards. Of a text only its size, CRC-32 and MD5 are kept, so
    very long ones weigh like others. Other columns play no part; an empty table gives no rows.
    """
    spark = docs.sparkSession
    data = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select("doc_id", (F.length(data) + OVERHEAD).cast("bigint").alias("size"), F.crc32(data).alias("text_crc32"), F.when(F.col("text").isNull(), F.lit("none")).otherwise(F.md5(data)).alias("text_key"))
    rows = keep(with_row(rows))
    groups = rows.groupBy("text_key", "size").agg(F.count(F.lit(1)).alias("n"))
    groups = keep(groups.withColumn("whole", F.col("size") * F.col("n")))
    n_groups, total = groups.agg(F.count(F.lit(1)), F.coalesce(F.sum("whole"), F.lit(0))).first()
    n_rows = rows.count()
    fair = max(1, -(-total // shards))
    # at most `shards` groups are over the fair share
    large = groups.where(F.col("whole") > fair).withColumn("per", F.greatest(F.lit(1), F.floor(F.lit(fair) / F.col("size"))).cast("bigint"))
    pieces = large.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("n") - 1) / F.col("per")))))
    pieces = pieces.select("text_key", "piece", (F.col("size") * F.least(F.col("per"), F.col("n") - F.col("piece") * F.col("per"))).alias("whole"))
    items = groups.where(F.col("whole") <= fair).select("text_key", F.lit(0).cast("bigint").alias("piece"), "whole").union(pieces)
    fine = F.greatest(F.lit(0), F.floor(F.log2(F.greatest("whole", F.lit(1)))) - 11).cast("int")
    step = F.pow(F.lit(2), fine).cast("bigint")
    rounded = F.when(F.col("whole") <= 65_536, F.col("whole")).otherwise(F.ceil(F.col("whole") / step) * step).cast("bigint")
    items = keep(items.withColumn("class", rounded))
    runs = pack([(r[0], r[1]) for r in items.groupBy("class").count().collect()], shards)
    # places of a class: the first of each run, and its shard
    places: dict[int, tuple[list[int], list[int], int]] = {}
    for size, n, bin_ in runs:
        firsts, bins, used = places.get(size, ([], [], 0))
        places[size] = ([*firsts, used], [*bins, bin_], used + n)
    plan = spark.createDataFrame([(k, a, b) for k, (a, b, _) in places.items()], "class long, firsts array<long>, shards array<int>")
    placed = ranked(items, ["class"], ["text_key", "piece"], n_groups).join(F.broadcast(plan), "class")  # a row per class: bounded
    placed = placed.select("text_key", "piece", F.element_at("shards", F.size(F.filter("firsts", lambda x: x <= F.col("rank")))).alias("shard"))
    in_large = ranked(keep(rows.join(F.broadcast(large.select("text_key", "per")), "text_key")), ["text_key"], ["row"], n_rows)
    piece = in_large.select("row", F.floor(F.col("rank") / F.col("per")).cast("bigint").alias("piece"))
    dealt = rows.join(piece, "row", "left").withColumn("piece", F.coalesce("piece", F.lit(0))).join(placed, ["text_key", "piece"])
    dealt = keep(dealt.select("row", "doc_id", "size", "text_crc32", "shard"))
    slots = ranked(dealt, ["shard"], ["row"], n_rows, "slot")
    return slots.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("bigint").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(table(spark, sf_dir, "documents"))


QUERIES = {"op1_sharding": op1_sharding}
ORACLE_SQL: dict[str, str] = {}
