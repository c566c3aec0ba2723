"""LM scoring with a weighted backoff automaton over every word, bigram and trigram of the training part.

Smoothing is Bayesian (a Dirichlet prior around the next lower order, after MacKay and Peto): P(w | h) = (c(h w) + M *
P(w | shorter h)) / (c(h) + M). So a seen n-gram is an arc with that weight, and the failure arc of a state carries
M / (c(h) + M). The lowest order is the base distribution, (c + 0.1) / (N + 0.1 (V + 1)). A document is scored in one
left-to-right traversal that carries the state.

Nothing is cut, so the model grows with the corpus, and no task holds it. Documents are put into blocks of about
BLOCK_TOKENS. A block asks for the counts of its own n-grams and builds the part of the automaton that its documents can
reach; other states do not change their scores. The counts meet by ranges of the n-grams' 64-bit hashes: a block sends
one row per range, sorted and delta-coded, with its own training counts, and gets the totals back in the same order.

Words and bigrams meet first, and the answer tells which of them lie in several blocks. The trigrams around a bigram of
one block lie in that block, too, so their counts are known; only those of two wider spread bigrams meet. Two n-grams of one hash would share
their count: below 10^10 n-grams about three such pairs are to be expected.
"""

from __future__ import annotations

import itertools
import math
import zlib
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import keep, table, utf8, with_row

SMOOTH = 0.1
#: Weight of the lower order in words, for bigrams and trigrams.
PRIOR = (8.0, 4.0)
#: The end token. A word has no white space, so none is equal.
END = b"\n"
BLOCK_TOKENS = 1_500_000
#: Tokens whose arcs are hashed at once.
CHUNK_TOKENS = 150_000
#: n-grams of all blocks that one range holds, about.
RANGE_CODES = 1_500_000
ROOT, START = 0, 1  # local word numbers begin with the end token, whose state is where a document starts
CODES = "block bigint, range int, codes binary, counts binary"
TOTALS = "block bigint, range int, totals binary, types bigint"


def tokens_of(text: bytes) -> list[bytes]:
    return [*text.lower().split(), END]


def narrow(x: np.ndarray) -> bytes:
    """Numbers from 0 on, in as few bytes each as the largest needs; the first byte says how many."""
    width = max(1, -(-int(x.max()).bit_length() // 8)) if len(x) else 1
    return bytes([width]) + np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()


def wide(x: bytes) -> np.ndarray:
    out = np.zeros(((len(x) - 1) // x[0], 8), np.uint8)
    out[:, : x[0]] = np.frombuffer(x, np.uint8, offset=1).reshape(-1, x[0])
    return out.view("<u8").ravel()


def _first(ranges: int) -> np.ndarray:
    """The least code of each range, and one past the last."""
    return np.array([min((-(-(r << 32) // ranges)) << 32, (1 << 64) - 1) for r in range(ranges + 1)], np.uint64)


def pack(codes: np.ndarray, counts: np.ndarray, ranges: int) -> Iterator[tuple[int, bytes, bytes]]:
    """Rows (range, gaps between the codes, counts) of sorted distinct codes."""
    first = _first(ranges)
    edges = np.r_[np.searchsorted(codes, first[:-1]), len(codes)]
    for r, (s, e) in enumerate(itertools.pairwise(edges.tolist())):
        if s < e:
            yield r, narrow(np.diff(codes[s:e], prepend=first[r])), narrow(counts[s:e])


def unpack(first: np.uint64, codes: bytes) -> np.ndarray:
    return first + np.cumsum(wide(codes), dtype=np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def _coded(x: np.ndarray, order: int) -> np.ndarray:
    """Hashes whose last two bits tell the order."""
    return (x & ~np.uint64(3)) | np.uint64(order)


# -- blocks ----------------------------------------------------------------------------------------------------------


def _made_block(docs: list[pa.StructArray], vocabulary: dict, ids: list[np.ndarray]) -> pa.RecordBatch:
    flat = np.concatenate(ids)
    docs_ = pa.concat_arrays(docs)
    hashes = np.fromiter((xxhash.xxh64_intdigest(w, 42) for w in itertools.islice(vocabulary, 1, None)), np.uint64, len(vocabulary) - 1)
    lengths = np.fromiter(map(len, ids), np.int64, len(ids))
    planes = zlib.compress(np.ascontiguousarray(flat.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes(), 1)
    trained = int(lengths[~docs_.field(1).to_numpy(zero_copy_only=False).astype(bool)].sum())
    columns = [pa.ListArray.from_arrays(pa.array([0, len(docs_)], pa.int32()), docs_), *(pa.array([x], pa.binary()) for x in (planes, narrow(lengths), hashes.tobytes()))]
    return pa.RecordBatch.from_arrays([*columns, pa.array([len(flat)], pa.int64()), pa.array([trained], pa.int64())], ["docs", "ids", "lengths", "words", "n", "n_train"])


def _blocks(size: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, held_out, _utf8) to a row per block: its documents, and their words as numbers of its own."""

    def fresh() -> dict:
        new = defaultdict(lambda: len(new), {None: ROOT, END: START})
        return new

    vocabulary, ids, docs, held = fresh(), [], [], 0
    for batch in batches:
        meta = pa.StructArray.from_arrays([batch.column(0), batch.column(1)], ["doc_id", "held_out"])
        begin = 0
        for i, text in enumerate(batch.column(2)):
            words = tokens_of(text.as_py())
            ids.append(np.fromiter(map(vocabulary.__getitem__, words), np.uint32, len(words)))
            held += len(words)
            if held >= size:
                yield _made_block([*docs, meta.slice(begin, i + 1 - begin)], vocabulary, ids)
                vocabulary, ids, docs, held, begin = fresh(), [], [], 0, i + 1
        if begin < len(meta):
            docs.append(meta.slice(begin))
    if ids:
        yield _made_block(docs, vocabulary, ids)


@dataclass
class Block:
    """A block's n-grams. ``ids``: the words, a document's end last; before the first word stands an end, too."""

    ids: np.ndarray
    lengths: np.ndarray
    train: np.ndarray  # of each token
    words: np.ndarray  # hashes by local number, that of the root left out

    def __post_init__(self):
        self.width = len(self.words) + 1
        before = np.r_[START, self.ids[:-1]]
        self.bigrams, self.pair = np.unique(before * self.width + self.ids, return_inverse=True)
        # a trigram's middle word is no end: there a new document begins
        self.third = np.flatnonzero(before != START)
        self.trigrams, triple = np.unique(self.pair[self.third - 1] * self.width + self.ids[self.third], return_inverse=True)
        self.triple = np.full(len(self.ids), -1)
        self.triple[self.third] = triple
        self.tail = np.zeros(len(self.trigrams), np.int64)  # the bigram of a trigram's last two words
        self.tail[triple] = self.pair[self.third]
        self.hash2 = _mix(self._hash(self.bigrams // self.width) * np.uint64(0x9E3779B97F4A7C15) + self._hash(self.bigrams % self.width))

    @classmethod
    def of(cls, row: dict) -> Block:
        raw = np.frombuffer(zlib.decompress(row["ids"]), np.uint8).reshape(4, -1)
        ids = np.ascontiguousarray(raw.T).view("<u4").ravel().astype(np.int64)
        lengths = wide(row["lengths"]).astype(np.int64)
        train = np.repeat([not d["held_out"] for d in row["docs"]], lengths)
        return cls(ids, lengths, train, np.frombuffer(row["words"], np.uint64))

    def _hash(self, numbers: np.ndarray) -> np.ndarray:
        return self.words[numbers - 1]

    def _trained(self, index: np.ndarray, mask: np.ndarray, size: int) -> np.ndarray:
        return np.bincount(index[mask], minlength=size)

    def low(self) -> tuple[np.ndarray, np.ndarray]:
        """Codes of words and bigrams, unsorted, and their training counts in this block."""
        codes = np.r_[_coded(self.words, 0), _coded(self.hash2, 1)]
        return codes, np.r_[self._trained(self.ids, self.train, self.width)[1:], self._trained(self.pair, self.train, len(self.bigrams))]

    def high(self, spread: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Training counts of the trigrams in this block; those that may occur in other blocks, as ``spread`` tells of
        low(); and their codes."""
        shared = spread[len(self.words) :]
        own = self._trained(self.triple, self.train & (self.triple >= 0), len(self.trigrams))
        ask = np.flatnonzero(shared[self.trigrams // self.width] & shared[self.tail])
        head = self.trigrams[ask] // self.width
        return own, ask, _coded(_mix(self.hash2[head] * np.uint64(0xD6E8FEB86659FD93) + self._hash(self.trigrams[ask] % self.width)), 2)


def _sent(block: int, codes: np.ndarray, counts: np.ndarray, ranges: int) -> pa.Table:
    order = np.argsort(codes)
    rows = [*pack(codes[order], counts[order], ranges)]
    columns = [[x[i] for x in rows] for i in range(3)]
    return pa.table([pa.array([block] * len(rows), pa.int64()), pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.binary()), pa.array(columns[2], pa.binary())], ["block", "range", "codes", "counts"])


def _received(codes: np.ndarray, rows: list[tuple[int, bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """From (range, totals) rows: the total of each of ``codes`` as it was sent, and whether several blocks have it."""
    out = np.zeros(len(codes), np.int64)
    if len(codes):
        out[np.argsort(codes)] = np.concatenate([wide(x) for _, x in sorted(rows)])
    return out >> 1, out & 1 > 0


def _low_codes(ranges: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            yield from _sent(row["block"], *Block.of(row).low(), ranges).to_batches()


def _totals(ranges: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of codes sorted by range to the totals of each, doubled, and one more where several blocks have the code.
    ``types``: how many words of training lie in the range; one of its rows says so. Memory: the range's distinct
    n-grams, and the rows as they came."""
    first = _first(ranges)

    def summed(parts):
        code, n, blocks = (np.concatenate([x[i] for x in parts]) for i in range(3))
        order = np.argsort(code, kind="stable")
        code = code[order]
        edge = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
        return code[edge], np.add.reduceat(n[order], edge), np.minimum(np.add.reduceat(blocks[order], edge), 2)

    def out(r, rows):
        parts = []
        for _, codes, counts in rows:
            parts.append((unpack(first[r], codes), n := wide(counts).astype(np.int64), np.ones(len(n), np.int64)))
            if len(parts) > 64:
                parts = [summed(parts)]
        code, n, blocks = summed(parts)
        doubled = 2 * n + (blocks > 1)
        types = int(((code & np.uint64(3) == 0) & (n > 0)).sum())
        totals = [narrow(doubled[np.searchsorted(code, unpack(first[r], codes))]) for _, codes, _ in rows]
        return pa.RecordBatch.from_arrays(
            [pa.array([x[0] for x in rows], pa.int64()), pa.array([r] * len(rows), pa.int32()), pa.array(totals, pa.binary()), pa.array([types] + [0] * (len(rows) - 1), pa.int64())],
            ["block", "range", "totals", "types"],
        )

    now, rows = None, []
    for batch in batches:
        for block, r, codes, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if r != now and rows:
                yield out(now, rows)
                rows = []
            now = r
            rows.append((block, codes, counts))
    if rows:
        yield out(now, rows)


def _split(table_: pa.Table) -> tuple[dict, list[tuple[int, bytes]]]:
    """A block's own row, and its totals."""
    rows = table_.to_pylist()
    return next(r for r in rows if r["totals"] is None), [(r["range"], r["totals"]) for r in rows if r["totals"] is not None]


def _high_codes(ranges: int, met: pa.Table) -> pa.Table:
    row, low = _split(met)
    block = Block.of(row)
    own, ask, codes = block.high(_received(block.low()[0], low)[1])
    return _sent(row["block"], codes, own[ask], ranges)


# -- the automaton ---------------------------------------------------------------------------------------------------


class Automaton:
    """The part of the automaton that a block can reach. States: 0 is the root, then the words by number, then the
    bigrams: width + number of the bigram. n1, n2, n3: training counts by the block's numbers; p1: the base distribution.

    The arcs of word states are found by bisection in the sorted bigrams. Those of bigram states, which most steps take,
    are hashed, for as many documents at once as ``load`` is asked for.
    """

    def __init__(self, b: Block, n1: np.ndarray, n2: np.ndarray, n3: np.ndarray, p1: np.ndarray):
        m2, m3 = PRIOR
        self.block, self.n3 = b, n3
        self.unigram = np.log10(p1).tolist()
        self.back = np.log10(m2 / (n1 + m2)).tolist()  # weight of each word state's failure arc, to the root
        first, second = b.bigrams // b.width, b.bigrams % b.width
        p2 = (n2 + m2 * p1[second]) / (n1[first] + m2)
        self.weight2 = np.where(n2 > 0, np.log10(p2), 1.0)  # 1: no such arc
        self.back2 = np.log10(m3 / (n2 + m3))  # of each bigram state's failure arc, to the state of its last word
        head = b.trigrams // b.width
        self.weight3 = np.log10((n3 + m3 * p2[b.tail]) / (n2[head] + m3))
        self.arcs: dict[int, int] = {}

    def load(self, begin: int, end: int) -> None:
        """Makes the arcs of bigram states ready for the tokens from ``begin`` to ``end``."""
        used = self.block.triple[begin:end]
        used = np.unique(used[used >= 0])
        used = used[self.n3[used] > 0]
        self.arcs = dict(zip(self.block.trigrams[used].tolist(), used.tolist(), strict=True))

    def score(self, ids: list[int]) -> float:
        """log10 probability of a document's words, in one traversal from the start."""
        width, unigram, back, arcs = self.block.width, self.unigram, self.back, self.arcs.get
        bigrams, tail, weight2, weight3, back2 = map(memoryview, (self.block.bigrams, self.block.tail, self.weight2, self.weight3, self.back2))
        state, total = START, 0.0
        for w in ids:
            if state >= width:
                arc = arcs((state - width) * width + w)
                if arc is not None:
                    total += weight3[arc]
                    state = width + tail[arc]
                    continue
                total += back2[state - width]
                state = bigrams[state - width] % width
            arc = bisect_left(bigrams, state * width + w)
            if arc < len(bigrams) and bigrams[arc] == state * width + w and weight2[arc] <= 0:
                total += weight2[arc]
                state = width + arc
            else:
                total += back[state] + unigram[w]
                state = w
        return total


def _scores(total: int, types: int, chunk: int, met: pa.Table, high: pa.Table) -> pa.Table:
    row, low = _split(met)
    b = Block.of(row)
    n, spread = _received(b.low()[0], low)
    n1, n2 = np.r_[0, n[: b.width - 1]], n[b.width - 1 :]
    n3, ask, codes = b.high(spread)
    n3[ask] = _received(codes, list(zip(high["range"].to_pylist(), high["totals"].to_pylist(), strict=True)))[0]
    p1 = (n1 + SMOOTH) / (total + SMOOTH * (types + 1))
    model = Automaton(b, n1, n2, n3, p1)
    ends = np.cumsum(b.lengths)
    known = np.add.reduceat(n1[b.ids] > 0, ends - b.lengths, dtype=np.int64)
    base, score, upto = [], [], 0
    for k, e in enumerate(ends.tolist()):
        s = e - int(b.lengths[k])
        if e > upto:  # the next chunk, of whole documents
            upto = int(ends[max(k, int(np.searchsorted(ends, s + chunk, "right")) - 1)])
            model.load(s, upto)
        ids = b.ids[s:e].tolist()
        base.append(math.fsum(map(model.unigram.__getitem__, ids)))
        score.append(model.score(ids))
    docs = met["docs"].filter(met["docs"].is_valid()).combine_chunks().flatten()
    return pa.table([docs.field(0), docs.field(1), pa.array(b.lengths), pa.array(known), pa.array(base, pa.float64()), pa.array(score, pa.float64())], ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"])


def score_documents(docs: DataFrame, held_out: str = "pmod(crc32(cast(cast(doc_id as string) as binary)), 10) = 0") -> DataFrame:
    """One row per input row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    The model learns from the rows where ``held_out`` is false; a null doc_id counts as the text ''. A null or empty
    text is its end token alone; a very long one makes a block of its own. Repeated rows are all learnt from and all
    scored. Without training rows every probability is that of an unknown word. Other columns play no part.
    """
    rows = docs.select("doc_id", F.coalesce(F.expr(held_out), F.expr("pmod(crc32(cast('' as binary)), 10) = 0")).alias("held_out"), utf8("text").alias("_utf8"))
    doc = T.ArrayType(T.StructType(rows.schema.fields[:2]))
    kind = T.StructType([T.StructField("docs", doc), *T.StructType.fromDDL("ids binary, lengths binary, words binary, n bigint, n_train bigint").fields])
    size, chunk = BLOCK_TOKENS, CHUNK_TOKENS
    blocks = keep(with_row(rows.mapInArrow(lambda b: _blocks(size, b), kind), "block"))
    tokens, total = blocks.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("n_train"), F.lit(0))).first()
    ranges = max(32, tokens // RANGE_CODES)

    def totals(codes: DataFrame) -> DataFrame:
        return codes.repartition("range").sortWithinPartitions("range").mapInArrow(lambda b: _totals(ranges, b), TOTALS)

    low = keep(totals(blocks.mapInArrow(lambda b: _low_codes(ranges, b), CODES)))
    types = low.agg(F.coalesce(F.sum("types"), F.lit(0))).first()[0]
    met = blocks.drop("n", "n_train").unionByName(low.drop("types"), allowMissingColumns=True).groupBy("block")
    high = totals(met.applyInArrow(lambda t: _high_codes(ranges, t), CODES)).drop("types")
    out = T.StructType([*rows.schema.fields[:2], *T.StructType.fromDDL("n_tokens bigint, n_known bigint, base_score double, score double").fields])
    scored = met.cogroup(high.groupBy("block")).applyInArrow(lambda left, right: _scores(total, types, chunk, left, right), out)
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("bigint").alias("train_tokens"), "base_score", "score")


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"))


QUERIES = {"op8_lm_scoring": op8_lm_scoring}
ORACLE_SQL: dict[str, str] = {}
