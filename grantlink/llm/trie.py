"""A prefix trie of conversations, with subtree figures by depth-band rollup.

A node is a distinct sequence of first turns. Its identity is its depth and 128 bits: the exclusive-or of two 64-bit
hashes of each turn with its position, so that the identities along a conversation are a running aggregate.

The depths are cut into bands of BAND. A node sends its figures only to its ancestors inside its band, at most BAND
rows. What lies below a band reaches it through the roots of the next band, whose totals must be complete first. These
roots form a tree of their own, BAND times less deep, which is rolled up in the same way: so n depths take about
log(n) / log(BAND) rounds up and down instead of n, and no node ever meets more than BAND others in a round.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import keep, table

BAND = 16
#: A key that has more than this share of the rows is looked up in a broadcast of at most so many keys.
SHARES = 256


NODE = "struct<pos: bigint, a: bigint, b: bigint>"


def _root() -> Column:
    return F.expr("named_struct('pos', 0L, 'a', 0L, 'b', 0L)").cast(NODE)


def _none() -> Column:
    return F.array().cast(f"array<{NODE}>")


def lookup(rows: DataFrame, one: DataFrame, key: str, size: str, total: int) -> DataFrame:
    """Joins ``one``, a row for each key, to ``rows``, of which ``size`` have that key and ``total`` there are in all.

    Fewer than SHARES keys can have more than one row in SHARES each: those are broadcast, so that no task gets all rows
    of a hot key, and the others are shuffled. ``rows`` is read twice, so it should be kept.
    """
    hot = F.broadcast(one.where(F.col(size) * SHARES > total).drop(size))
    rest = one.where(F.col(size) * SHARES <= total).drop(size)
    return rows.join(hot, key).unionByName(rows.join(hot.select(key), key, "left_anti").join(rest, key))


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, rank from 1, chunk, role, digest, size) by turn, null first; equal turns by role, then MD5 of the
    text. Null roles and texts are empty; rows without conv_id belong to no conversation and are left out.

    Rows are sorted by ranges, and ranked inside (conversation, range); the counts of the ranges before are added. Only
    conversations across a border need that, at most one for each border, so these counts are broadcast. ``chunk`` is 0
    in a conversation's first range.
    """
    text = F.coalesce("text", F.lit(""))
    turns = conversations.where("conv_id is not null").select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.md5(text).alias("digest"), F.octet_length(text).cast("bigint").alias("size"))
    order = ["turn", "role", "digest"]
    dealt = turns.repartitionByRange("conv_id", *order).withColumn("part", F.spark_partition_id())
    local = keep(dealt.withColumn("local", F.row_number().over(Window.partitionBy("conv_id", "part").orderBy(*order))))
    counts = local.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    later = counts.withColumn("before", before).where("before > 0").select("conv_id", "part", "before")
    out = local.join(F.broadcast(later), ["conv_id", "part"], "left")
    chunk = F.when(F.col("before") > 0, F.col("part") + 1).otherwise(0)
    return out.select("conv_id", (F.col("local") + F.coalesce("before", F.lit(0))).alias("rank"), chunk.alias("chunk"), "role", "digest", "size")


def with_shared_heads(turns: DataFrame, group: int, most: int) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin with the turns of another: rows as of ordered_turns with pos instead of rank, and a row
    (conv_id, length) for each conversation, turnless ones too.

    Conversation c takes the first h turns of conversation c - c % ``group`` (all if fewer, none if it is absent), then
    its own after its first h; h is the CRC-32 of c in decimal, modulo ``most``.
    """
    turns = keep(turns)
    heads = turns.where(F.col("rank") < most).select(F.col("conv_id").alias("base"), "rank", "role", "digest", "size")
    convs = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    convs = convs.select("conv_id", "n", (F.col("conv_id") - F.col("conv_id") % group).alias("base"), (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).alias("h"))
    bases = convs.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    taken = F.least("h", F.coalesce("base_n", F.lit(0)))
    convs = keep(convs.join(bases, "base", "left").select("conv_id", "base", "n", "h", taken.alias("taken"), (taken + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length")))
    first = convs.join(heads, "base").where("rank <= h").select("conv_id", F.col("rank").alias("pos"), F.lit(0).alias("chunk"), "role", "digest", "size", "length")
    total = turns.count()
    own = lookup(turns, convs.select("conv_id", "h", "taken", "length", "n"), "conv_id", "n", total).where("rank > h")
    own = own.select("conv_id", (F.col("rank") - F.col("h") + F.col("taken")).alias("pos"), "chunk", "role", "digest", "size", "length")
    return first.unionByName(own), convs.select("conv_id", "length")


def paths_of(turns: DataFrame) -> DataFrame:
    """Rows (conv_id, pos, a, b, size, is_end) of turns (conv_id, pos, chunk, role, digest, size, length): the two
    hashes of the first ``pos`` turns. They run inside (conversation, chunk); those of the chunks before are added."""
    salted = turns.select("conv_id", "pos", "chunk", "size", (F.col("pos") == F.col("length")).alias("is_end"), F.xxhash64("pos", "role", "digest").alias("x"), F.xxhash64(F.lit(1), "pos", "role", "digest").alias("y"))
    run = Window.partitionBy("conv_id", "chunk").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    local = keep(salted.withColumn("a", F.expr("bit_xor(x)").over(run)).withColumn("b", F.expr("bit_xor(y)").over(run)))
    cut = local.where("chunk > 0").select("conv_id").distinct()  # at most one for each border between ranges
    sums = local.join(F.broadcast(cut), "conv_id", "left_semi").groupBy("conv_id", "chunk").agg(F.expr("bit_xor(x)").alias("x"), F.expr("bit_xor(y)").alias("y"))
    so_far = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("conv_id", "chunk", F.expr("bit_xor(x)").over(so_far).alias("p"), F.expr("bit_xor(y)").over(so_far).alias("q")).where("chunk > 0")
    out = local.drop("x", "y").join(F.broadcast(sums), ["conv_id", "chunk"], "left")
    return out.select("conv_id", "pos", F.expr("a ^ coalesce(p, 0)").alias("a"), F.expr("b ^ coalesce(q, 0)").alias("b"), "size", "is_end")


def banded(paths: DataFrame, band: int, step: int) -> DataFrame:
    """Rows (node, above, conv_id, size, is_end), one for each turn at a multiple of ``step``: ``above`` holds the nodes
    at the multiples before, from the root of its band on, at most ``band`` of them. A conversation's turns meet band by
    band; a turn that roots a band counts to that band, too, but only as the start of ``above``."""
    at = paths.where(F.col("pos") % step == 0).withColumn("at", F.expr(f"pos div {step}"))
    node = F.struct("pos", "a", "b").cast(NODE).alias("node")
    inner = at.select("conv_id", F.expr(f"(at - 1) div {band}").alias("band"), "at", node, "size", "is_end")
    root = at.where(F.col("at") % band == 0).select("conv_id", F.expr(f"at div {band}").alias("band"), "at", node, "size", "is_end")
    groups = inner.union(root).groupBy("conv_id", "band").agg(F.sort_array(F.collect_list(F.struct("at", "node", "size", "is_end"))).alias("run"))
    ids = F.transform("run", lambda x: x.node)
    groups = groups.withColumn("ids", F.when(F.col("band") == 0, F.concat(F.array(_root()), ids)).otherwise(ids))
    # in band 0 the run starts below the root, in others with the band's root
    first = F.when(F.col("band") == 0, 0).otherwise(1)
    each = F.transform("run", lambda x, i: F.struct(x.node.alias("node"), F.slice("ids", 1, i + 1 - first).alias("above"), x.size.alias("size"), x.is_end.alias("is_end"), (i >= first).alias("inside")))
    rows = groups.select("conv_id", F.explode(each).alias("r")).where("r.inside")
    return rows.select("r.node", "r.above", "conv_id", "r.size", "r.is_end")


def rolled_up(own: DataFrame, paths: DataFrame, deepest: int, band: int) -> DataFrame:
    """Rows (node, n_leaves, saved, n_children): sums over subtrees of ``own`` (node, above, leaf, saved), a row for each
    node but the root, and of the root's own row, whose ``above`` is empty."""
    levels, step = [own], band  # own figures of the nodes at multiples of band ** level, with those of their bands
    while deepest > step:
        held = levels[-1]
        inside = F.col("node.pos") % step != 0
        inner = held.where(inside).select(F.col("above")[0].alias("node"), "leaf", "saved")
        roots = held.where(~inside).select("node", "leaf", "saved")
        sums = inner.union(roots).groupBy("node").agg(F.sum("leaf").alias("leaf"), F.sum("saved").alias("saved"))
        above = banded(paths, band, step).groupBy("node").agg(F.first("above").alias("above"))
        levels.append(keep(sums.join(above, "node", "left").select("node", F.coalesce("above", _none()).alias("above"), "leaf", "saved")))
        step *= band
    total = None
    for level in reversed(range(len(levels))):
        held, step = levels[level], band ** (level + 1)
        if total is not None:  # the band's lowest nodes root the next bands: their totals stand for all below
            lowest = (F.col("node.pos") % step == 0) & (F.size("above") > 0)
            below = held.where(lowest).select("node", "above").join(total.select("node", "leaf", "saved"), "node")
            held = held.where(F.col("node.pos") % step != 0).unionByName(below.withColumn("rooted", F.lit(True)), allowMissingColumns=True)
        else:
            held = held.withColumn("rooted", F.lit(None).cast("boolean"))
        n, full = F.size("above"), F.lit(total is None)
        up = F.transform("above", lambda x, i: F.struct(x.alias("node"), (full | (i > 0)).alias("counts"), (i == F.size("above") - 1).cast("bigint").alias("child")))
        me = F.struct(F.col("node").alias("node"), F.col("rooted").isNull().alias("counts"), F.lit(0).cast("bigint").alias("child"))
        sent = held.select(F.explode(F.concat(F.array(me), up)).alias("t"), "leaf", "saved", n.alias("n"))
        sent = sent.select("t.node", F.when(F.col("t.counts"), F.col("leaf")).otherwise(0).alias("leaf"), F.when(F.col("t.counts"), F.col("saved")).otherwise(0).alias("saved"), "t.child")
        if total is not None:
            sent = sent.unionByName(total.select("node", "leaf", "saved", F.lit(0).cast("bigint").alias("child")))
        total = sent.groupBy("node").agg(F.sum("leaf").alias("leaf"), F.sum("saved").alias("saved"), F.sum("child").alias("child"))
        total = keep(total) if level else total
    return total.select("node", F.col("leaf").alias("n_leaves"), "saved", F.col("child").alias("n_children"))


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's parts, which come one after the other."""
    now, held = None, None
    for batch in batches:
        done = []
        for key, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if key != now:
                done += [(now, held.hexdigest())] if held else []
                now, held = key, hashlib.sha256(part.encode())
            else:
                held.update(b"," + part.encode())
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in done], batch.schema.field(0).type), pa.array([h for _, h in done], pa.string())], ["node", "ends_sha256"])
        last = batch.schema.field(0).type
    if held:
        yield pa.RecordBatch.from_arrays([pa.array([now], last), pa.array([held.hexdigest()], pa.string())], ["node", "ends_sha256"])


def hashed_ends(ends: DataFrame) -> DataFrame:
    """Rows (node, ends_sha256) of ends (node, conv_id): the conv_ids in ascending order, comma-joined. Ids of one range of
    256 are joined first; a node's parts then pass through one hash, a part at a time, as SHA-256 has no other way."""
    part = F.shiftright("conv_id", 8).alias("part")
    parts = ends.groupBy("node", part).agg(F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"))
    dealt = parts.repartition("node").sortWithinPartitions("node", "part").select("node", "ids")
    return dealt.mapInArrow(_hashes, f"node {NODE}, ends_sha256 string")


def trie(turns: DataFrame, conversations: DataFrame, band: int = BAND) -> DataFrame:
    """One row per node: conv_id (the smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens (over the subtree, (n_convs - 1) times the bytes of a node's last text), ends_sha256.

    ``turns``: rows (conv_id, pos from 1, chunk, role, digest, size, length); ``conversations``: a row (conv_id, length)
    for each, turnless ones included, which are members of the root only. No conversations, no nodes.
    """
    paths = keep(paths_of(turns))
    deepest = conversations.agg(F.max("length")).first()[0] or 0
    below = banded(paths, band, 1).groupBy("node").agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id"), F.max("size").alias("size"), F.count_if("is_end").alias("n_ends"), F.first("above").alias("above"))
    top = conversations.agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id"), F.count_if(F.col("length") == 0).alias("n_ends")).where("n_convs > 0")
    nodes = below.unionByName(top.select(_root().alias("node"), "n_convs", "conv_id", F.lit(0).cast("bigint").alias("size"), "n_ends", _none().alias("above")))
    # a node is childless if all its members end there
    nodes = keep(nodes.withColumn("leaf", (F.col("n_ends") == F.col("n_convs")).cast("bigint")).withColumn("saved", (F.col("n_convs") - 1) * F.col("size")).withColumn("parent", F.element_at("above", F.when(F.size("above") > 0, -1))))
    sums = rolled_up(nodes.select("node", "above", "leaf", "saved"), paths, deepest, band)
    ends = paths.where("is_end").select(F.struct("pos", "a", "b").cast(NODE).alias("node"), "conv_id").union(conversations.where("length = 0").select(_root().alias("node"), "conv_id"))
    full = keep(nodes.select("node", "parent", "conv_id", "n_convs").join(sums, "node").join(hashed_ends(ends), "node", "left"))
    parents = full.where("n_children > 0").select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"), "n_children")
    inner = lookup(full.where("parent is not null"), parents, "parent", "n_children", full.count())
    out = inner.unionByName(full.where("parent is null").withColumn("parent_conv_id", F.lit(None).cast("bigint")))
    hashed = F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest()))
    return out.select("conv_id", F.col("node.pos").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"), hashed.alias("ends_sha256"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns, conversations = with_shared_heads(ordered_turns(table(spark, sf_dir, "conversations")), group=5, most=9)
    return trie(turns, conversations)


#: CRC-32 of the decimal digits, bit by bit: each byte is xored in, then shifted out in eight steps.
_CRC = """xor(list_reduce(
  flatten(list_transform(range(1, length(conv_id::VARCHAR) + 1), lambda i: [ascii(substr(conv_id::VARCHAR, i::INT, 1))::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])),
  lambda x, y: CASE WHEN y >= 0 THEN xor(x, y) ELSE xor(x >> 1, (x & 1) * 3988292384) END, 4294967295), 4294967295)"""

_SQL = f"""
WITH RECURSIVE ordered AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(coalesce(text, ''))) AS rank
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT conv_id, n, conv_id - conv_id % 5 AS base, {_CRC} % 9 AS h FROM (SELECT conv_id, count(*) AS n FROM ordered GROUP BY conv_id)
), rebuilt AS (
  SELECT c.conv_id, o.rank AS pos, role, text FROM convs c JOIN ordered o ON o.conv_id = c.base WHERE o.rank <= c.h
  UNION ALL
  SELECT c.conv_id, o.rank - c.h + least(c.h, coalesce(b.n, 0)), role, text
  FROM convs c JOIN ordered o ON o.conv_id = c.conv_id LEFT JOIN convs b ON b.conv_id = c.base WHERE o.rank > c.h
), paths(conv_id, depth, node, parent, size) AS (
  SELECT conv_id, 0::BIGINT, md5(''), NULL::VARCHAR, 0::BIGINT FROM convs
  UNION ALL
  SELECT p.conv_id, p.depth + 1, md5(p.node || md5(r.role) || md5(r.text)), p.node, strlen(r.text)
  FROM paths p JOIN rebuilt r ON r.conv_id = p.conv_id AND r.pos = p.depth + 1
), nodes AS (
  SELECT node, any_value(depth) AS depth, any_value(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(size) AS size FROM paths GROUP BY node
), children AS (
  SELECT parent AS node, count(*) AS n_children FROM nodes WHERE parent IS NOT NULL GROUP BY parent
), sums AS (  -- a node's ancestors are the nodes of any member's shorter prefixes
  SELECT p.node, sum((u.n_convs - 1) * u.size) AS saved_tokens, count(*) FILTER (c.node IS NULL) AS n_leaves
  FROM nodes u LEFT JOIN children c ON c.node = u.node JOIN paths p ON p.conv_id = u.conv_id AND p.depth <= u.depth GROUP BY p.node
), last AS (
  SELECT conv_id, max(depth) AS depth FROM paths GROUP BY conv_id
), ends AS (
  SELECT node, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS ends_sha256 FROM paths JOIN last USING (conv_id, depth) GROUP BY node
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children, n_leaves,
       saved_tokens::BIGINT AS saved_tokens, coalesce(ends_sha256, sha256('')) AS ends_sha256
FROM nodes n JOIN sums USING (node) LEFT JOIN children USING (node) LEFT JOIN ends USING (node) LEFT JOIN nodes p ON p.node = n.parent
"""

QUERIES = {"op13_prefix_trie": op13_prefix_trie}
ORACLE_SQL = {"op13_prefix_trie": _SQL}
