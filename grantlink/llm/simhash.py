"""SimHash near-duplicates: 64-bit fingerprints of word shingles, linked at a small Hamming distance.

Distances are counted bit-sliced: the fingerprints of a bucket are stored as 64 vertical bit planes, a word of a plane
holds one bit of 64 fingerprints, and carry-save counters update 64 distances with a few word operations per plane.
A block of 64 is abandoned as soon as all its distances exceed the radius.

Buckets come from the pigeonhole principle: of five bit ranges, two at least are equal in fingerprints that differ in
at most three bits, so ten tables of two ranges each miss no link. Very many fingerprints take more ranges, which makes
more tables with smaller buckets (six: twenty of three ranges) and finds the same links. A bucket with too many fingerprints is cut into
tiles, so that no task holds a whole hot bucket and still every pair meets. A task returns a spanning forest of the
links that it found, never all pairs.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import components, keep, table, utf8, widened, with_row

RADIUS = 3
#: Random fingerprints in a bucket, about, up to which a number of ranges serves.
CROWD = 64
TILE = 4096
ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def shingle_hashes(text: bytes, words: int = 3) -> list[int]:
    """XXH64 (seed 42) of each shingle of an ASCII-lower-cased text, repeats included."""
    found = text.lower().split()
    if not found:
        return []
    line = b" ".join(found)
    if len(found) <= words:
        return [xxhash.xxh64_intdigest(line, 42)]
    ends = list(itertools.accumulate(len(w) + 1 for w in found))
    hashed = xxhash.xxh64_intdigest
    return [hashed(line[s : e - 1], 42) for s, e in zip([0, *ends], ends[words - 1 :], strict=False)]


def majority(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """For each run of ``counts`` hashes the bits that over half of them have. Bytes of a word count eight bits at once."""
    out = np.zeros(len(counts), np.uint64)
    some = np.flatnonzero(counts)
    if not len(some):
        return out
    n = counts[some]
    parts = (n + 254) // 255  # a byte counts up to 255
    first = np.cumsum(parts) - parts
    starts = np.repeat(np.cumsum(n) - n, parts) + (np.arange(parts.sum()) - np.repeat(first, parts)) * 255
    got = np.zeros(len(some), np.uint64)
    for k in range(8):
        lanes = np.add.reduceat((hashes >> np.uint64(k)) & np.uint64(0x0101010101010101), starts)
        sums = np.add.reduceat(lanes.view(np.uint8).reshape(-1, 8).astype(np.int64), first, axis=0)
        for j in range(8):
            got |= (2 * sums[:, j] > n).astype(np.uint64) << np.uint64(8 * j + k)
    out[some] = got
    return out


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Appends fp to the columns other than the text's bytes."""
    for batch in batches:
        at = batch.schema.get_field_index("_utf8")
        texts, rest = batch.column(at), batch.drop_columns(["_utf8"])
        out, lists, size = [], [], 0

        def flush(lists):
            counts = np.fromiter(map(len, lists), np.int64, len(lists))
            flat = np.fromiter(itertools.chain.from_iterable(lists), np.uint64, int(counts.sum()))
            return majority(flat, counts)

        for text in texts:
            lists.append(shingle_hashes(text.as_py()))
            size += len(lists[-1])
            if size > 500_000:
                out.append(flush(lists))
                lists, size = [], 0
        if lists:
            out.append(flush(lists))
        fps = np.concatenate(out) if out else np.zeros(0, np.uint64)
        yield rest.append_column("fp", pa.array(fps.view(np.int64), pa.int64()))


def fingerprints(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` and its fp (long)."""
    doc = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    packed = docs.select(doc, utf8(f"`{text}`").alias("_utf8"))
    return packed.mapInArrow(_fingerprints, widened(packed, "fp bigint"))


def _union(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Joins the sets of a[i] and b[i]; label holds each row's smallest known member."""
    while len(a):
        la, lb = label[a], label[b]
        if not (odd := la != lb).any():
            break
        a, b, la, lb = a[odd], b[odd], la[odd], lb[odd]
        least = np.minimum(la, lb)
        np.minimum.at(label, la, least)
        np.minimum.at(label, lb, least)
        while (new := label[label]) is not None and (new != label).any():
            label[:] = new


def link(bucket: np.ndarray, fp: np.ndarray, radius: int = 3, chunk: int = 1 << 16) -> tuple[np.ndarray, np.ndarray]:
    """Rows sorted by bucket: (a, b) of a forest that connects the same fingerprints as all pairs within the radius."""
    edge = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(bucket) else np.zeros(0, int)
    size = np.diff(np.r_[edge, len(bucket)])
    fp, size = fp[np.repeat(size > 1, size)], size[size > 1]
    n = len(fp)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    end = np.repeat(np.cumsum(size), size)
    padded = np.zeros((n + 63) // 64 * 64, np.uint64)
    padded[:n] = fp
    planes = [np.packbits(((padded >> np.uint64(b)) & np.uint64(1)).astype(np.uint8), bitorder="little").view(np.uint64) for b in range(64)]
    i = np.flatnonzero(np.arange(n) + 1 < end)
    first, count = (i + 1) >> 6, ((end[i] - 1) >> 6) - ((i + 1) >> 6) + 1
    label = np.arange(n)
    ones = np.array([(1 << k) - 1 for k in range(65)], np.uint64)
    counters = max(1, int(radius).bit_length())
    total = np.cumsum(count)
    cut = 0
    while cut < len(i):  # some queries at a time, each against the blocks of its bucket
        upto = max(cut + 1, int(np.searchsorted(total, (total[cut - 1] if cut else 0) + chunk, "right")))
        c = count[cut:upto]
        q = np.repeat(i[cut:upto], c)
        block = np.repeat(first[cut:upto], c) + np.arange(c.sum()) - np.repeat(np.cumsum(c) - c, c)
        lanes = ones[np.minimum(end[q] - 64 * block, 64)] & ~ones[np.maximum(q + 1 - 64 * block, 0)]
        over, own = ~lanes, fp[q]
        sums = [np.zeros(len(q), np.uint64) for _ in range(counters)]
        for b in range(64):
            carry = planes[b][block] ^ (np.uint64(0) - ((own >> np.uint64(b)) & np.uint64(1)))
            for s in sums:
                s_and = s & carry
                s ^= carry
                carry = s_and
            over |= carry
            if b % 8 == 7 and b < 63:
                alive = over != ALL
                if not alive.all():
                    q, block, over, own, sums = q[alive], block[alive], over[alive], own[alive], [s[alive] for s in sums]
        hit = np.flatnonzero(over != ALL)
        row, lane = np.nonzero(np.unpackbits((~over[hit]).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
        a, b = q[hit[row]], 64 * block[hit[row]] + lane
        near = np.bitwise_count(fp[a] ^ fp[b]) <= radius  # counters end at a power of two
        _union(label, a[near], b[near])
        cut = upto
    linked = np.flatnonzero(label != np.arange(n))
    return fp[linked], fp[label[linked]]


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches sorted by bucket; a bucket may go on in the next batch."""
    g, f = np.zeros(0, np.int64), np.zeros(0, np.uint64)

    def out(g, f):
        a, b = link(g, f)
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    for batch in batches:
        g = np.concatenate([g, batch.column(0).to_numpy()])
        f = np.concatenate([f, batch.column(1).to_numpy().view(np.uint64)])
        if len(g) >= 60_000:
            cut = int(np.searchsorted(g, g[-1]))  # the last bucket waits
            if cut:
                yield out(g[:cut], f[:cut])
                g, f = g[cut:], f[cut:]
    if len(g):
        yield out(g, f)


def ranges_for(count: int) -> list[tuple[int, int]]:
    """The fewest bit ranges (first bit, bits) whose tables leave CROWD random fingerprints to a bucket, or fewer."""
    for n in range(RADIUS + 2, 64):
        bits = [64 // n + (i < 64 % n) for i in range(n)]
        if count <= CROWD << sum(sorted(bits)[: n - RADIUS]) or n == 9:
            return [(sum(bits[:i]), b) for i, b in enumerate(bits)]


def links(fps: DataFrame) -> DataFrame:
    """Distinct fingerprints (fp) to edges (a, b) with the components of all pairs that differ in 3 bits or fewer."""
    ranges = ranges_for(fps.count())
    parts = [F.shiftrightunsigned("fp", first).bitwiseAND(F.lit((1 << bits) - 1)) for first, bits in ranges]
    tables = list(itertools.combinations(range(len(ranges)), len(ranges) - RADIUS))
    keys = []
    for n, chosen in enumerate(tables):
        key = F.lit(n).cast("bigint")
        for i in chosen:
            key = F.shiftleft(key, ranges[i][1]).bitwiseOR(parts[i])
        keys.append(key)
    rows = fps.select("fp", F.explode(F.array(*keys)).alias("bucket"))
    hot = keep(rows.groupBy("bucket").count().where(F.col("count") > TILE).select("bucket", F.ceil(F.col("count") / TILE).cast("int").alias("cuts")))
    if not hot.isEmpty():
        salt = F.pmod(F.xxhash64("fp", F.lit(7)), F.col("cuts")).cast("int")
        rows = rows.join(hot, "bucket", "left").withColumn("salt", salt)
        other = F.explode(F.when(F.col("cuts").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("cuts") - 1)))
        tile = F.when(F.col("cuts").isNull(), F.col("bucket")).otherwise(F.xxhash64("bucket", F.least("salt", "other"), F.greatest("salt", "other")))
        rows = rows.withColumn("other", other).select("fp", tile.alias("bucket"))
    rows = rows.select("bucket", "fp").repartition("bucket").sortWithinPartitions("bucket", "fp")
    return rows.mapInArrow(_links, "a long, b long").distinct()


def near_groups(fps: DataFrame) -> DataFrame:
    """Rows (doc_id, row, fp) to (fp, component_id, first_row): the smallest doc_id that links reach from a fingerprint,
    null only where all are null, and the row that stays of the component (smallest doc_id, nulls last, then row)."""
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), F.col("row").alias("row"))
    least = keep(fps.groupBy("fp").agg(F.min(order).alias("least")))
    roots = components(links(least.select("fp"))).select(F.col("node").alias("fp"), "root")
    least = keep(least.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp")))
    linked = least.groupBy("root").agg(F.min("least").alias("first"))
    return least.join(linked, "root").select("fp", F.col("first.id").alias("component_id"), F.col("first.row").alias("first_row"))


def near_duplicates(docs: DataFrame, text: str = "text") -> DataFrame:
    """Near-duplicate classes of documents: (doc_id, fingerprint, component_id), one row per input row.

    Null and empty texts, and texts of white space only, have fingerprint 0 and link like any other. Repeated rows and
    ties stay separate rows of one class. A null doc_id stays null and never names a class that has another id. Very long
    texts are hashed whole, one at a time. Other columns play no part; an empty table gives no rows.
    """
    fps = keep(with_row(fingerprints(docs.select("doc_id", text), text).select("doc.doc_id", "fp")))
    hexed = F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint")
    return fps.join(near_groups(fps), "fp").select("doc_id", hexed, "component_id")


def drop_near_duplicates(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with one row of each near-duplicate class: the one of the smallest doc_id; of repeated rows one stays, and
    a null doc_id only where its class has no other. Other columns pass through, whatever their names. Nulls, empty and
    very long texts count as in ``near_duplicates``."""
    kept = keep(with_row(fingerprints(docs, text)))
    fps = kept.select("doc.doc_id", "row", "fp")
    stay = near_groups(fps).select(F.col("first_row").alias("row")).distinct()
    return kept.join(stay, "row", "left_semi").select("doc.*")


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


QUERIES = {"op4_simhash_near_dedup": op4_simhash_near_dedup}
ORACLE_SQL: dict[str, str] = {}
