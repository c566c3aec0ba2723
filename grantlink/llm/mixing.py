"""Mixing sources to target weights by Pfair scheduling.

A source's rows, over and over, form a stream of blocks, and its target weight gives the rate of its blocks. Block j of
a source of rate r is released at slot floor(j/r) and due at slot ceil((j+1)/r); of the released blocks the one with the
earliest deadline takes the next slot. So at any slot a source has less than one block more or less than its rate asks.

Rates are kept to 2**-40, so a small source is as near to its target as a large one. The schedule is a number of slots,
not of rows: where the stream is longer than SLOTS blocks of BLOCK_ROWS rows, blocks are longer.
"""

from __future__ import annotations

import heapq
import math
from array import array
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import keep, ranked, table, with_row

BLOCK_ROWS = 16
#: Blocks of BLOCK_ROWS rows or more in a stream, about; those of sources with fewer rows come on top.
SLOTS = 1 << 20
UNIT = 1 << 40
#: A source of fewer rows than a block gives them all in each block, and more only if it has more blocks than these; with
#: many sources than its share of SMALL_SLOTS. So a schedule has about SLOTS + SMALL_SLOTS slots at most.
SMALL_BLOCKS = 4096
SMALL_SLOTS = 1 << 22
MOST_SOURCES = 1 << 16
#: Target weights are the sources' shares to this power, made to sum to one: small sources gain.
TEMPERATURE = 0.9


def block_lengths(count: dict[str, int], weights: dict[str, float], block_rows: int | None = None) -> dict[str, int]:
    """Rows of a block of each source. The stream's length is what the source that needs most asks for."""
    total = math.fsum(weights[s] for s in count)
    stream = max((n * total / weights[s] for s, n in count.items()), default=0)
    block_rows = block_rows or max(BLOCK_ROWS, math.ceil(stream / SLOTS))
    blocks = min(SMALL_BLOCKS, SMALL_SLOTS // max(1, len(count)))
    return {s: min(block_rows, max(n, math.ceil(weights[s] / total * stream / blocks))) for s, n in count.items()}


def rates(weights: dict[str, float], lengths: dict[str, int]) -> dict[str, int]:
    """Blocks of each source in UNIT slots, so that the rows keep to the weights; by largest remainder, at least 1."""
    exact = {s: Fraction(weights[s]) / n for s, n in lengths.items()}
    total = sum(exact.values())
    exact = {s: x / total * (UNIT - len(exact)) for s, x in exact.items()}
    out = {s: 1 + math.floor(x) for s, x in exact.items()}
    order = sorted(exact, key=lambda s: (math.floor(exact[s]) - exact[s], s))
    for s in order[: UNIT - sum(out.values())]:
        out[s] += 1
    return out


def schedule(rate: dict[str, int], need: dict[str, int]) -> Iterator[tuple[str, int, int, int]]:
    """Gives slot by slot, earliest deadline first: (source, block, release, deadline), until each source has given ``need``
    blocks."""
    waiting = [(0, s, 0) for s in sorted(rate)]  # release, source, block
    ready: list[tuple[int, str, int, int]] = []  # deadline, source, block, release
    slot, left = 0, len(rate)
    while left:
        while waiting and waiting[0][0] <= slot:
            release, s, j = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(j + 1) * UNIT // rate[s]), s, j, release))
        deadline, s, j, release = heapq.heappop(ready)
        yield s, j, release, deadline
        slot, left = slot + 1, left - (j + 1 == need[s])
        heapq.heappush(waiting, ((j + 1) * UNIT // rate[s], s, j + 1))


def mix(docs: DataFrame, weights: dict[str, float] | None = None, block_rows: int | None = None, temperature: float = TEMPERATURE) -> DataFrame:
    """Rows (doc struct, source_key, epoch, block, release, deadline, slot, place): the mixed stream, by slot and place.

    The stream ends when each source has given every row once, so nothing is dropped; sources that end earlier start a
    new epoch, as their weight asks. Without ``weights`` the target is the tempered share. A null source is the source
    ''. Repeated rows are rows like others; texts, of whatever length, pass through. Sources without a weight raise, and
    so do weights of 0 or less, and more than MOST_SOURCES sources: each is scheduled on the driver. Weights without
    rows are left out. An empty table gives no rows.
    """
    spark = docs.sparkSession
    doc = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    rows = keep(with_row(docs.select(doc, F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source_key"))))
    count = {r[0]: r[1] for r in rows.groupBy("source_key").count().limit(MOST_SOURCES + 1).collect()}
    if len(count) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    if weights is None:
        weights = {s: n**temperature for s, n in count.items()}
    if missing := [s for s in count if weights.get(s, 0) <= 0]:
        raise ValueError(f"sources without a weight: {sorted(missing)[:5]}")
    length = block_lengths(count, weights, block_rows)
    rate = rates(weights, length)
    names = sorted(count)
    number, slots = {s: i for i, s in enumerate(names)}, array("q")  # four numbers a slot
    for s, *times in schedule(rate, {s: -(-n // length[s]) for s, n in count.items()}):
        slots.extend((number[s], *times))
    slots = np.frombuffer(slots, np.int64).reshape(-1, 4)
    made = dict(zip(names, np.bincount(slots[:, 0], minlength=len(names)).tolist(), strict=True))
    sizes = spark.createDataFrame([(s, length[s], count[s], made[s] * length[s]) for s in count], "source_key string, length long, n long, stream long")
    ranks = ranked(rows.select("row", "source_key"), ["source_key"], ["row"], sum(count.values())).join(F.broadcast(sizes), "source_key")  # MOST_SOURCES rows
    copies = F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("stream") - 1 - F.col("rank")) / F.col("n")))
    stream = ranks.select("row", "source_key", "length", "n", "rank", F.explode(copies).alias("epoch")).withColumn("at", F.col("epoch") * F.col("n") + F.col("rank"))
    stream = stream.select("row", "source_key", "epoch", F.floor(F.col("at") / F.col("length")).alias("block"), (F.col("at") % F.col("length")).alias("place"))
    keys = pa.DictionaryArray.from_arrays(pa.array(slots[:, 0], pa.int32()), pa.array(names, pa.string())).cast(pa.string())
    columns = [keys, *(pa.array(np.ascontiguousarray(c)) for c in slots[:, 1:].T), pa.array(np.arange(len(slots)))]
    placed = keep(spark.createDataFrame(pa.table(columns, ["source_key", "block", "release", "deadline", "slot"])))
    stream = stream.join(placed, ["source_key", "block"]).drop("source_key")
    return rows.join(stream, "row").drop("row")


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The rows of the mixed stream with the columns of ``docs``: a row occurs once per epoch of its source."""
    return mix(docs).select("doc.*")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents").select("doc_id", "source")).select("doc.doc_id", "doc.source", "epoch", "block", "release", "deadline", "slot", "place")


QUERIES = {"op6_mixing": op6_mixing}
ORACLE_SQL: dict[str, str] = {}
