"""Benchmark decontamination with suffix arrays of the training documents.

Each block of documents gets the suffix array of its words: all suffixes, sorted by prefix doubling to the length of a
window. Every benchmark suffix is found in it by binary search, in steps of 8, 4, 2 and 1 words; the places found are
joined along their diagonals to the longest verbatim matches, with their place in document and item. A document lies in
one block as a whole, so no result crosses blocks.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import keep, table, utf8, widened, with_row

WINDOW = 13
#: Benchmark text of one pass over the documents; a larger benchmark takes several, one after the other. A pass of 4.2 MB
#: of text (620,000 words) takes 28 MB in memory and 43 MB while it is made, as measured.
PASS_BYTES = 4 << 20
BLOCK_WORDS = 400_000
#: Separators become spaces, A-Z lower case; 0x00 is free to mark the ends of documents.
FOLD = bytes(32 if c < 0x30 or 0x3A <= c <= 0x60 and not 0x41 <= c <= 0x5A or 0x7B <= c <= 0x7F else c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))
END = b"\x00"


def words_of(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


@dataclass
class Windows:
    """The texts of some benchmark items, one after the other, as word numbers; equal texts once. Window n: the words
    from start[n] on, length[n] of them, of text which[n], where it is the place[n]-th."""

    vocabulary: list[bytes]
    words: np.ndarray
    start: np.ndarray
    length: np.ndarray
    which: np.ndarray
    place: np.ndarray
    owners: list[tuple[str, ...]]  # the ids of the items of each text, sorted; none if null


def windows_of(items: Iterator[tuple[str | None, bytes]], window: int = WINDOW) -> Windows:
    vocabulary: dict[bytes, int] = {}
    owners: dict[bytes, set] = {}
    for item, text in items:
        owners.setdefault(b" ".join(words_of(text)), set()).update(() if item is None else (item,))
    owners.pop(b"", None)
    coded = [np.array([vocabulary.setdefault(w, len(vocabulary)) for w in text.split()], np.int32) for text in owners]
    sizes = np.array([len(x) for x in coded], np.int64)
    count = np.maximum(1, sizes - window + 1)
    which = np.repeat(np.arange(len(coded)), count)
    place = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    start = (np.cumsum(sizes) - sizes)[which] + place
    return Windows(list(vocabulary), np.concatenate([*coded, np.zeros(0, np.int32)]), start, np.minimum(sizes, window)[which], which, place, [tuple(sorted(x)) for x in owners.values()])


class SuffixArray:
    """All suffixes of a block's words, sorted by their first words, by prefix doubling up to a window and more.

    Level k numbers the distinct runs of 2**k words in their order; a run that a document's end cuts has end marks in it.
    """

    def __init__(self, texts: list[bytes], window: int = WINDOW):
        tokens = (b" \x00 ".join([t.translate(FOLD) for t in texts]) + b" \x00").split()
        self.vocabulary: dict[bytes, int] = {END: 0}
        number = self.vocabulary.setdefault
        ids = np.fromiter((number(x, len(self.vocabulary)) for x in tokens), np.int64, len(tokens))
        self.ends = np.flatnonzero(ids == 0)
        self.starts = np.r_[0, self.ends[:-1] + 1] if len(texts) else self.ends
        self.levels = [ids]
        self.pairs: list[np.ndarray] = []  # distinct (first half, second half) of each level, sorted
        self.order = np.arange(0)
        while 1 << len(self.levels) - 1 < window:
            key = self._pair(self.levels[-1], 1 << len(self.levels) - 1)
            self.order = np.argsort(key)
            key = key[self.order]
            new = np.r_[True, key[1:] != key[:-1]][: len(key)]
            level = np.empty(len(key), np.int64)
            level[self.order] = np.cumsum(new) - 1
            self.levels.append(level)
            self.pairs.append(key[new])

    @staticmethod
    def _pair(level: np.ndarray, step: int) -> np.ndarray:
        after = np.r_[level[step:], np.zeros(min(step, len(level)), np.int64)]
        return level * (len(level) + 1) + after

    def find(self, test: np.ndarray, start: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """For runs of ``length`` words of ``test`` (numbers of this block's vocabulary, -1 for words not in it) from
        each ``start``: the first and the one past the last of the suffixes that begin with it."""
        wide = len(self.levels[0]) + 1
        runs = [test]  # numbers of the test's runs of 2**k words, -1 where the block has none
        for k, pairs in enumerate(self.pairs):
            if 2 << k > length:
                break
            half = runs[-1]
            after = np.r_[half[1 << k :], np.full(min(1 << k, len(half)), -1)]
            key = np.where((half >= 0) & (after >= 0), half * wide + after, -1)
            at = np.searchsorted(pairs, key)
            at[at == len(pairs)] = 0
            runs.append(np.where(pairs[at] == key, at, -1) if len(pairs) else np.full(len(key), -1))
        group, test_group, done = np.zeros(len(self.order), np.int64), np.zeros(len(start), np.int64), 0
        lo, alive = np.zeros(len(start), np.int64), np.ones(len(start), bool)
        hi = np.full(len(start), len(self.order))
        padded = lambda level, at: np.r_[level, 0][np.minimum(at, len(level))]
        for k in reversed(range(len(runs))):
            if length & 1 << k:
                part = runs[k][np.minimum(start + done, len(test) - 1)]
                alive &= part >= 0
                # inside a group of suffixes that agree so far, the next run ascends: binary search of all tests at once
                key = group * wide + padded(self.levels[k], self.order + done)
                wanted = np.where(alive, test_group * wide + part, -1)
                lo, hi = np.searchsorted(key, wanted, "left"), np.searchsorted(key, wanted, "right")
                alive &= hi > lo
                done += 1 << k
                new = np.r_[0, np.cumsum(key[1:] != key[:-1])][: len(key)]
                group, test_group = new, new[np.minimum(lo, len(new) - 1)] if len(new) else test_group
        return np.where(alive, lo, 0), np.where(alive, hi, 0)


def search(suffixes: SuffixArray, w: Windows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All occurrences of windows in a block: (document, place, window)."""
    number = suffixes.vocabulary.get
    test = np.array([number(x, -1) for x in w.vocabulary] or [-1], np.int64)[w.words]
    found = []
    for length in np.unique(w.length).tolist():
        mine = np.flatnonzero(w.length == length)
        lo, hi = suffixes.find(test, w.start[mine], length)
        n = hi - lo
        at = suffixes.order[np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
        found.append((at, np.repeat(mine, n)))
    at, which = (np.concatenate([x[i] for x in found] or [np.zeros(0, np.int64)]) for i in (0, 1))
    doc = np.searchsorted(suffixes.ends, at)
    return doc, at - suffixes.starts[doc], which


def covered(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Union of (start, length), sorted."""
    out: list[list[int]] = []
    for s, n in sorted(spans):
        if out and s <= out[-1][0] + out[-1][1]:
            out[-1][1] = max(out[-1][1], s + n - out[-1][0])
        else:
            out.append([s, n])
    return [(s, n) for s, n in out]


def longest(doc: np.ndarray, place: np.ndarray, which: np.ndarray, w: Windows) -> tuple[np.ndarray, ...]:
    """Maximal verbatim matches (document, text, place in text, place in document, words) of window occurrences: those
    that follow each other on one diagonal of a document and a text are one match."""
    text, item_place, length = w.which[which], w.place[which], w.length[which]
    order = np.lexsort((place, place - item_place, text, doc))
    doc, text, item_place, place, length = (x[order] for x in (doc, text, item_place, place, length))
    diagonal = place - item_place
    new = np.ones(len(doc), bool)
    # on a diagonal, matches that touch are one: each of the words between lies in both
    new[1:] = (doc[1:] != doc[:-1]) | (text[1:] != text[:-1]) | (diagonal[1:] != diagonal[:-1]) | (place[1:] > place[:-1] + length[:-1])
    first = np.flatnonzero(new)
    last = np.r_[first[1:], len(doc)][: len(first)] - 1
    return doc[first], text[first], item_place[first], place[first], place[last] + length[last] - place[first]


MATCH = "array<struct<item:string,item_start:int,start:int,words:int>>"
RESULT = f"n_words bigint, spans array<struct<start:int,words:int>>, items array<string>, matches {MATCH}"


def _matches(w_of, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    w: Windows = w_of.value
    kinds = [pa.int64(), pa.list_(pa.struct([("start", pa.int32()), ("words", pa.int32())])), pa.list_(pa.string()), pa.list_(pa.struct([("item", pa.string()), ("item_start", pa.int32()), ("start", pa.int32()), ("words", pa.int32())]))]
    for batch in batches:
        texts, size, from_row = [], 0, 0

        def flush(texts, from_row):
            suffixes = SuffixArray(texts)
            columns = list(zip(*longest(*search(suffixes, w), w), strict=True))
            spans, items, matches = [None] * len(texts), [None] * len(texts), [None] * len(texts)
            for d, part in itertools.groupby(columns, key=lambda x: x[0]):
                part = [tuple(map(int, x[1:])) for x in part]
                spans[d] = [{"start": s, "words": n} for s, n in covered([(s, n) for _, _, s, n in part])]
                items[d] = sorted({i for t in {x[0] for x in part} for i in w.owners[t]})
                matches[d] = [{"item": next(iter(w.owners[t]), None), "item_start": q, "start": s, "words": n} for t, q, s, n in part]
            rest = batch.slice(from_row, len(texts)).drop_columns(["_utf8"])
            made = [pa.array(x, k) for x, k in zip((suffixes.ends - suffixes.starts, spans, items, matches), kinds, strict=True)]
            return pa.RecordBatch.from_arrays([*rest.columns, *made], [*rest.schema.names, "n_words", "spans", "items", "matches"])

        column = batch.column(batch.schema.get_field_index("_utf8"))
        for n, text in enumerate(column):
            texts.append(text.as_py())
            size += len(texts[-1])
            if size > 6 * BLOCK_WORDS:
                yield flush(texts, from_row)
                texts, size, from_row = [], 0, n + 1
        if texts:
            yield flush(texts, from_row)


def _passes(items: DataFrame, total: int) -> DataFrame:
    """``items`` with the pass of each: texts of about PASS_BYTES, split by hash; equal texts meet in one."""
    parts = max(1, -(-2 * total // PASS_BYTES)) if total > PASS_BYTES else 1
    cut = keep(items.withColumn("part", F.pmod(F.xxhash64("bytes"), F.lit(parts))))
    sizes = cut.groupBy("part").agg(F.sum(F.length("bytes")).alias("n"))  # a row per PASS_BYTES / 2
    upto = F.sum("n").over(Window.orderBy("part"))
    return cut.join(sizes.select("part", F.floor(F.greatest(F.lit(0), upto - 1) / PASS_BYTES).alias("pass")), "part").drop("part")


def find_matches(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """Rows (doc struct, n_words, spans, items, matches): which words of a document lie in a benchmark window, of which
    items, and the longest verbatim matches with both places (null where there are none). Items of one text are one in
    ``matches``, under the smallest id.

    The benchmark is broadcast in passes of about PASS_BYTES of text, as measured first. One pass is the usual case.
    With more, the documents are numbered and kept once, each pass searches them all and keeps what it found before the
    next is read, and the passes meet by row number.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), utf8("text").alias("bytes"))
    total = items.agg(F.coalesce(F.sum(F.length("bytes")), F.lit(0))).first()[0]
    struct = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    packed = docs.select(struct, utf8(f"`{text}`").alias("_utf8"))

    def one(rows: DataFrame, own: DataFrame):
        known = spark.sparkContext.broadcast(windows_of((r[0], bytes(r[1])) for r in own.select("item", "bytes").toLocalIterator()))
        return known, rows.mapInArrow(lambda batches: _matches(known, batches), widened(rows, RESULT))

    if total <= PASS_BYTES:
        return one(packed, items)[1]
    rows, items = keep(with_row(packed)), keep(_passes(items, total))
    found = None
    for part in range(items.agg(F.max("pass")).first()[0] + 1):
        known, new = one(rows.select("row", "_utf8"), items.where(F.col("pass") == part))
        new = keep(new if part == 0 else new.where("spans is not null"))
        known.destroy()
        found = new if found is None else found.union(new)
    flat = lambda c: F.flatten(F.collect_list(c))
    any_ = lambda c, x: F.when(F.size(x) > 0, x).alias(c)
    found = found.groupBy("row").agg(F.max("n_words").alias("n_words"), any_("spans", flat("spans")), any_("items", F.array_sort(F.array_distinct(flat("items")))), any_("matches", flat("matches")))
    return rows.select("row", "doc").join(found, "row").drop("row")


def _n_hit(spans: str = "spans") -> F.Column:
    """Words in the union of spans, which are sorted by start."""
    step = lambda acc, x: F.struct(
        (acc["n"] + F.greatest(F.lit(0), x["start"] + x["words"] - F.greatest(acc["upto"], x["start"])).cast("bigint")).alias("n"),
        F.greatest(acc["upto"], x["start"] + x["words"]).alias("upto"),
    )
    return F.aggregate(F.array_sort(F.coalesce(F.col(spans), F.array())), F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).alias("upto")), step, lambda acc: acc["n"])


def judged(found: DataFrame) -> DataFrame:
    """Adds n_hit and contaminated (a twentieth of the words or more are hit)."""
    found = found.withColumn("n_hit", _n_hit())
    return found.withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The report, one row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, and the longest
    verbatim match: match_words, match_start (word of the document), match_item, match_item_start (word of the item);
    of equally long ones the first in the document, then the smallest item id (null last) and place in the item.

    Null and empty texts have no words and are never contaminated; null and empty items have no windows. A very long
    text is a block of its own. Repeated rows give repeated rows. An item without id hits, but is neither counted nor
    listed.
    """
    found = judged(find_matches(docs.select("doc_id", "text"), benchmark))
    listed = F.coalesce(F.col("items"), F.array().cast("array<string>"))
    ordered = F.transform("matches", lambda m: F.struct((-m["words"]).alias("n"), m["start"].alias("s"), m["item"].isNull().alias("none"), m["item"].alias("i"), m["item_start"].alias("q")))
    best = F.array_min(ordered)
    place = lambda x: best[x].cast("bigint")
    return found.select(
        "doc.doc_id", "n_words", "n_hit", F.size(listed).cast("bigint").alias("n_items"), F.sha2(F.array_join(listed, ","), 256).alias("items_sha256"), "contaminated",
        (-place("n")).alias("match_words"), place("s").alias("match_start"), best["i"].alias("match_item"), place("q").alias("match_item_start"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the contaminated ones; columns pass through, and no row is shuffled. Null and empty texts have no
    words and stay; repeated rows get one verdict; very long texts are searched whole. An empty benchmark, or one of
    nulls, takes no document away."""
    return judged(find_matches(docs, benchmark)).where(~F.col("contaminated")).select("doc.*")


def items_digest(items: list[str]) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: The report by a join of word windows: a row per word with the 13 words from it on. Shorter items match as its start.
_SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), []) AS w
  FROM documents
), b AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
         coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), []) AS w
  FROM benchmark
), words AS (
  SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d WHERE len(w) > 0
), grams AS (
  SELECT r, p, word, string_agg(word, ' ') OVER (PARTITION BY r ORDER BY p ROWS BETWEEN CURRENT ROW AND {WINDOW - 1} FOLLOWING) AS gram FROM words
), starts AS (
  SELECT item, w, unnest(range(1, greatest(1, len(w) - {WINDOW - 1}) + 1)) AS q FROM b WHERE len(w) > 0
), windows AS (
  SELECT DISTINCT item, array_to_string(w, ' ') AS whole, q, array_to_string(w[q : q + {WINDOW - 1}], ' ') AS gram, w[q] AS word, least(len(w), {WINDOW}) AS k FROM starts
), hits AS (
  SELECT r, p, k, item, whole, q FROM grams JOIN windows USING (gram) WHERE k = {WINDOW}
  UNION ALL SELECT r, p, k, item, whole, q FROM grams JOIN windows USING (word) WHERE k < {WINDOW} AND starts_with(grams.gram || ' ', windows.gram || ' ')
), runs AS (
  SELECT *, p - row_number() OVER (PARTITION BY r, item, whole, p - q ORDER BY p) AS run FROM hits
), matches AS (
  SELECT r, item, max(p + k) - min(p) AS match_words, min(p) - 1 AS match_start, min(q) - 1 AS match_item_start FROM runs GROUP BY r, item, whole, p - q, run
), best AS (
  SELECT r, item AS match_item, match_words, match_start, match_item_start FROM matches
  QUALIFY row_number() OVER (PARTITION BY r ORDER BY match_words DESC, match_start, item IS NULL, item, match_item_start) = 1
), hit_words AS (
  SELECT r, count(DISTINCT place) AS n_hit FROM (SELECT DISTINCT r, unnest(range(p, p + k)) AS place FROM hits) GROUP BY r
), hit_items AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM hits WHERE item IS NOT NULL) GROUP BY r
), found AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
         match_words, match_start, match_item, match_item_start
  FROM d LEFT JOIN hit_words USING (r) LEFT JOIN hit_items USING (r) LEFT JOIN best USING (r)
)
SELECT *, n_hit > 0 AND 20 * n_hit >= n_words AS contaminated FROM found
"""

QUERIES = {"op5_benchmark_decontamination": op5_benchmark_decontamination}
ORACLE_SQL = {"op5_benchmark_decontamination": _SQL}
