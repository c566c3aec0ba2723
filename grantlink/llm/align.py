"""Cross-tokenizer alignment: which tokens of one tokenizer overlap which of another, and how usual that is.

Both token sequences of a text cover the same bytes. One numpy state vector holds a pair of pointers (into the A and the
B tokens) for each document of a batch, or for each piece of LANE A tokens of a longer one. Every step emits the link
between the two tokens that each pair points to, marks a cut where both end at one byte, and moves on the pointer whose
token ends first, or both; finished documents are compacted away.

How many documents of the corpus hold a pair of ids linked is counted without sending links. Tasks write blocks: the
distinct pairs of a block with their counts, in PARTS parts by A id, and the documents' pairs as numbers into them.
The rows of a part meet to be summed, then each block gets the sums of its own pairs back. A block's parts are sorted
arrays, so the exchange grows with the corpus as its blocks do. All pairs of an A id are in one part, which also gives
the id's highest count. The pairs of a part are bounded by the two vocabularies.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .chunks import ByChunk, batches_of, byte_letters, pattern_encoder, piece_encoder
from .common import keep, table, utf8

#: A tokens of a document that one pair of pointers passes at most.
LANE = 512
#: Pairs, counted once for each document that holds them, after which a block ends.
BLOCK_PAIRS = 3_000_000
BATCH_CHARS = 1_500_000
PARTS = 256
#: Blocks whose rows of a part are summed in one task before the sums of such groups are.
GROUP = 500
#: A pair's code is its A id times this, plus its B id.
WIDE = np.int64(1 << 20)


def _pack(values: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers, byte plane by byte plane, compressed."""
    planes = np.ascontiguousarray(values.astype("<u4").view("u1").reshape(-1, 4).T)
    return zstandard.compress(planes.tobytes(), 1)


def _unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), "u1")
    return np.ascontiguousarray(planes.reshape(4, -1).T).view("<u4").ravel()


def _pack_codes(codes: np.ndarray) -> bytes:
    """Ascending codes, as their distances, in two halves."""
    far = np.diff(codes, prepend=0)
    return _pack(np.concatenate([far & 0xFFFFFFFF, far >> 32]))


def _unpack_codes(data: bytes) -> np.ndarray:
    low, high = _unpack(data).astype(np.int64).reshape(2, -1)
    return np.cumsum(low | high << 32)


def lockstep(end_a: np.ndarray, end_b: np.ndarray, first: np.ndarray, stop: np.ndarray, at: np.ndarray) -> tuple:
    """Links (as places of A and of B tokens) and cuts (two flags) of many lanes at once.

    ``end_a`` and ``end_b`` are the byte ends of all tokens of a batch, ascending. Lane n covers the A tokens first[n]
    to stop[n] - 1; at[n] is the B token that holds its first byte.
    """
    last_a, last_b = np.zeros(len(end_a), bool), np.zeros(len(end_b), bool)
    links_a, links_b = [], []
    a, b, stop = first.copy(), at.copy(), stop.copy()
    while len(a):
        links_a.append(a)
        links_b.append(b)
        x, y = end_a[a], end_b[b]
        both = x == y
        last_a[a[both]] = last_b[b[both]] = True
        a, b = a + (x <= y), b + (y <= x)
        left = a < stop
        if not left.all():
            a, b, stop = a[left], b[left], stop[left]
    empty = np.zeros(0, np.int64)
    return np.concatenate(links_a or [empty]), np.concatenate(links_b or [empty]), last_a, last_b


class Aligner(ByChunk):
    """Aligns texts batch by batch. A side is (encode, token bytes by id); both cover a space and the text."""

    def __init__(self, a: tuple[Callable, list[bytes]], b: tuple[Callable, list[bytes]]):
        (encode_a, self.bytes_a), (encode_b, self.bytes_b) = a, b
        if max(len(self.bytes_a), len(self.bytes_b)) > WIDE:
            raise ValueError(f"a vocabulary has more than {WIDE} ids")
        self.size_a, self.size_b = (np.array(list(map(len, x)), np.int64) for x in (self.bytes_a, self.bytes_b))
        words_a, words_b = ([str(i) for i in range(len(x))] for x in (self.bytes_a, self.bytes_b))
        #: A token's text by what follows it: an A token, the group's B tokens; a B token, the next group.
        self.words = [w + "," for w in words_a] + [w + "|" for w in words_a] + [w + "," for w in words_b] + [w + ";" for w in words_b]
        super().__init__(encode_a, encode_b)

    def _forget(self) -> None:
        super()._forget()
        self.whole = np.ones(1, bool)

    def learned(self, chunks: list[str], sides: list[tuple[np.ndarray, np.ndarray]]) -> None:
        """Notes which chunks both sides give back byte by byte, with the space before them."""
        want = [b" " + c.encode() for c in chunks]
        fine = np.ones(len(chunks), bool)
        for by, (ids, sizes) in zip((self.bytes_a, self.bytes_b), sides, strict=True):
            if b"".join(map(by.__getitem__, ids.tolist())) != b"".join(want):
                parts = np.split(ids, np.cumsum(sizes)[:-1])
                fine &= [b"".join(map(by.__getitem__, p.tolist())) == w for p, w in zip(parts, want, strict=True)]
        self.whole = np.concatenate([self.whole, fine])

    def tokens(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of A and of B, with where each text's begin; none of a text that is empty or that either does not give
        back. Where all chunks come back the text does; other texts are looked at themselves."""
        numbers, counts = self.numbers(texts)
        sides = [self.gathered(numbers, counts, k) for k in (0, 1)]
        fine = np.logical_and.reduceat(self.whole[numbers], np.cumsum(counts) - counts) if len(texts) else np.zeros(0, bool)
        drop = np.zeros(len(texts), bool)
        for n in np.flatnonzero(~fine).tolist():
            want = b" " + texts[n].encode()
            drop[n] = any(b"".join(map(by.__getitem__, ids[at[n] : at[n + 1]].tolist())) != want for by, (ids, at) in zip((self.bytes_a, self.bytes_b), sides, strict=True))
        if drop.any():
            for k, (ids, at) in enumerate(sides):
                sizes = np.where(drop, 0, np.diff(at))
                sides[k] = (ids[~np.repeat(drop, np.diff(at))], np.concatenate([[0], np.cumsum(sizes)]))
        return [(ids.astype(np.int64), at) for ids, at in sides]

    def align(self, texts: list[str]) -> tuple[dict, np.ndarray, np.ndarray, np.ndarray]:
        """Columns n_a, n_b, n_groups, n_links, groups; distinct pair codes of each document, one document after the
        other, their links, and the number of pairs of each document."""
        (a, at_a), (b, at_b) = self.tokens(texts)
        end_a, end_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        lanes = -(-np.diff(at_a) // LANE)
        doc = np.repeat(np.arange(len(texts)), lanes)
        nth = np.arange(len(doc)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        first = at_a[doc] + nth * LANE
        stop = np.minimum(first + LANE, at_a[doc + 1])
        begin = np.concatenate([[0], end_a])[first]
        link_a, link_b, last_a, last_b = lockstep(end_a, end_b, first, stop, np.searchsorted(end_b, begin, "right"))
        doc_a = np.repeat(np.arange(len(texts)), np.diff(at_a))
        n_links = np.bincount(doc_a[link_a], minlength=len(texts))
        code = a[link_a] * WIDE + b[link_b]
        code += doc_a[link_a] << 40
        code.sort()
        starts = np.flatnonzero(np.diff(code, prepend=-1))
        links = np.diff(starts, append=len(code))
        code = code[starts]
        n_pairs = np.bincount(code >> 40, minlength=len(texts))
        # a group's A tokens stand before its B tokens
        cuts_a, cuts_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        b_until, a_until = np.concatenate([[0], np.flatnonzero(last_b) + 1]), np.concatenate([[0], np.flatnonzero(last_a) + 1])
        word = np.empty(len(a) + len(b), np.int64)
        word[np.arange(len(a)) + b_until[cuts_a]] = a + last_a * len(self.bytes_a)
        word[np.arange(len(b)) + a_until[cuts_b + 1]] = 2 * len(self.bytes_a) + b + last_b * len(self.bytes_b)
        word, bounds = word.tolist(), (at_a + at_b).tolist()
        groups = ["".join(map(self.words.__getitem__, word[i:j]))[:-1] for i, j in pairwise(bounds)]
        figures = {"n_a": np.diff(at_a), "n_b": np.diff(at_b), "n_groups": np.diff(np.concatenate([[0], np.cumsum(last_a)])[at_a]), "n_links": n_links, "groups": groups}
        return figures, code & ((1 << 40) - 1), links, n_pairs


def sides(path_a: str, path_b: str) -> tuple[tuple, tuple]:
    """A: a byte-level BPE file of the tokenizers library, given a space before the text. B: a piece model with byte
    fallback of the sentencepiece library, which adds that space."""
    import sentencepiece
    from tokenizers import Tokenizer

    letters = {chr(c): b for b, c in byte_letters().items()}
    model_a, model_b = Tokenizer.from_file(path_a), sentencepiece.SentencePieceProcessor(model_file=path_b)
    entries = [model_a.id_to_token(i) or "" for i in range(model_a.get_vocab_size())]
    bytes_a = [bytes(map(letters.__getitem__, e)) if all(c in letters for c in e) else e.encode() for e in entries]
    pieces = [(i, model_b.id_to_piece(i)) for i in range(model_b.get_piece_size())]
    bytes_b = [bytes([int(p[3:5], 16)]) if model_b.is_byte(i) else p.replace("▁", " ").encode() for i, p in pieces]
    return (pattern_encoder(path_a, before=" ", specials_as_text=True), bytes_a), (piece_encoder(path_b), bytes_b)


@cache
def _worker_aligner(path_a: str, path_b: str) -> Aligner:
    """One in a Python worker, which Spark uses for many tasks."""
    return Aligner(*sides(path_a, path_b))


FIGURES = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string"


def _blocks(paths: tuple[str, str], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each block a row with its documents, and a row for each part of its pairs."""
    aligner, compress = _worker_aligner(*paths), lambda s: hashlib.sha256(s.encode()).hexdigest() if s else ""
    block, held, size = TaskContext.get().partitionId() << 32, [], 0

    def ended() -> pa.RecordBatch:
        codes, links, n_pairs = (np.concatenate([h[k] for h in held]) for k in (2, 3, 4))
        found, place, docs = np.unique(codes, return_inverse=True, return_counts=True)
        part = found // WIDE % PARTS
        by_part = np.argsort(part, kind="stable")
        rank = np.empty(len(found), np.int64)
        rank[by_part] = np.arange(len(found))
        place = rank[place]
        order = np.lexsort((place, np.repeat(np.arange(len(n_pairs)), n_pairs)))
        place, links = place[order], links[order]
        start = np.zeros(len(place), bool)
        start[(np.cumsum(n_pairs) - n_pairs)[n_pairs > 0]] = True
        far = np.where(start, place, np.diff(place, prepend=0))  # ascending inside a document
        figures = {k: [x for h in held for x in h[1][k]] for k in ("n_a", "n_b", "n_groups", "n_links", "groups_sha256")}
        told = pa.RecordBatch.from_pydict({"doc_id": pa.array([i for h in held for i in h[0]], pa.int64())} | figures)
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, told.schema) as out:
            out.write_batch(told)
        rows = [{"block": block, "part": -1, "figures": zstandard.compress(sink.getvalue().to_pybytes(), 1), "places": _pack(far), "links": _pack(links), "n_pairs": _pack(n_pairs)}]
        bounds = np.searchsorted(part[by_part], np.arange(PARTS + 1))
        for p in np.flatnonzero(np.diff(bounds)).tolist():
            own = by_part[bounds[p] : bounds[p + 1]]
            rows.append({"block": block, "part": p, "codes": _pack_codes(found[own]), "docs": _pack(docs[own])})
        return pa.RecordBatch.from_pylist(rows, schema=BLOCKS)

    for batch in batches:
        numbers = iter(batch.column(0).to_pylist())
        for texts in batches_of(batch.column(1), BATCH_CHARS):
            figures, codes, links, n_pairs = aligner.align(texts)
            figures["groups_sha256"] = list(map(compress, figures.pop("groups")))
            held.append(([next(numbers) for _ in texts], figures, codes, links, n_pairs))
            size += len(codes)
            if size >= BLOCK_PAIRS:
                yield ended()
                block, held, size = block + 1, [], 0
    if held:
        yield ended()


BLOCKS = pa.schema([("block", pa.int64()), ("part", pa.int32()), *((c, pa.binary()) for c in ("figures", "places", "links", "n_pairs", "codes", "docs"))])
BLOCK_COLUMNS = "block bigint, part int, figures binary, places binary, links binary, n_pairs binary, codes binary, docs binary"


def _summed(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Ascending codes of all rows and their sums."""
    codes = np.concatenate([_unpack_codes(x.as_py()) for x in rows["codes"]])
    docs = np.concatenate([_unpack(x.as_py()) for x in rows["docs"]]).astype(np.int64)
    order = np.argsort(codes, kind="stable")
    codes = codes[order]
    starts = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]])
    return codes[starts], np.add.reduceat(docs[order], starts)


def _wide(docs: np.ndarray) -> bytes:
    return _pack(np.concatenate([docs & 0xFFFFFFFF, docs >> 32]))


def _narrow(data: bytes) -> np.ndarray:
    low, high = _unpack(data).astype(np.int64).reshape(2, -1)
    return low | high << 32


def _group_sums(key: tuple, rows: pa.Table) -> pa.Table:
    codes, docs = _summed(rows)
    return pa.table({"part": pa.array([key[0].as_py()], pa.int32()), "codes": pa.array([_pack_codes(codes)]), "sums": pa.array([_wide(docs)])})


def _part_sums(key: tuple, rows: pa.Table) -> pa.Table:
    codes = np.concatenate([_unpack_codes(x.as_py()) for x in rows["codes"]])
    docs = np.concatenate([_narrow(x.as_py()) for x in rows["sums"]])
    order = np.argsort(codes, kind="stable")
    codes = codes[order]
    starts = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]])
    codes, docs = codes[starts], np.add.reduceat(docs[order], starts)
    heads = np.flatnonzero(np.r_[True, codes[1:] // WIDE != codes[:-1] // WIDE])
    best = docs == np.repeat(np.maximum.reduceat(docs, heads), np.diff(heads, append=len(codes)))
    return pa.table({"part": pa.array([key[0].as_py()], pa.int32()), "codes": pa.array([_pack_codes(codes)]), "sums": pa.array([_wide(docs * 2 + best)])})


def _answers(key: tuple, rows: pa.Table, sums: pa.Table) -> pa.Table:
    """For each block of a group the sums of its own pairs of a part, in their order."""
    blocks, out = [], []
    if rows.num_rows:
        codes, docs = _unpack_codes(sums["codes"][0].as_py()), _narrow(sums["sums"][0].as_py())
        for block, own in zip(rows["block"].to_pylist(), rows["codes"].to_pylist(), strict=True):
            blocks.append(block)
            out.append(_wide(docs[np.searchsorted(codes, _unpack_codes(own))]))
    return pa.table({"block": pa.array(blocks, pa.int64()), "part": pa.array([key[0].as_py()] * len(blocks), pa.int32()), "sums": pa.array(out, pa.binary())})


def _figures(key: tuple, block: pa.Table, answers: pa.Table) -> pa.Table:
    """The documents of a block, with the sums of their pairs."""
    row = {c: block[c][0].as_py() for c in ("figures", "places", "links", "n_pairs")}
    told = pa.ipc.open_stream(zstandard.decompress(row["figures"])).read_all()
    parts = sorted(zip(answers["part"].to_pylist(), answers["sums"].to_pylist(), strict=True))
    sums = np.concatenate([_narrow(x) for _, x in parts] or [np.zeros(0, np.int64)])
    n_pairs, links, far = _unpack(row["n_pairs"]).astype(np.int64), _unpack(row["links"]).astype(np.int64), _unpack(row["places"]).astype(np.int64)
    starts = np.cumsum(n_pairs) - n_pairs
    run = np.cumsum(far)
    before = np.where(starts > 0, run[np.maximum(starts, 1) - 1], 0) if len(run) else starts
    found = sums[run - np.repeat(before, n_pairs)]
    doc = np.repeat(np.arange(len(n_pairs)), n_pairs)
    best, total = np.zeros(len(n_pairs), np.int64), np.zeros(len(n_pairs), np.int64)
    np.add.at(best, doc, links * (found & 1))
    np.add.at(total, doc, links * (found >> 1))
    return told.append_column("n_best", pa.array(best)).append_column("count_sum", pa.array(total))


def alignments(docs: DataFrame, path_a: str, path_b: str, text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    Groups end where tokens of both end at one byte. A pair's count is the number of documents that hold it linked;
    n_best counts the links whose count is their A id's highest (ties included), count_sum adds the counts of all links.
    Null and empty texts, and texts that either tokenizer does not give back byte by byte, have no tokens: zeros and an
    empty groups_sha256. Repeated rows count as documents of their own. Very long texts are aligned whole, in lanes.
    """
    data = docs.select("doc_id", utf8(f"`{text}`").alias("_utf8"))
    blocks = keep(data.mapInArrow(lambda batches: _blocks((path_a, path_b), batches), BLOCK_COLUMNS))
    pairs = blocks.where("part >= 0").select("block", "part", "codes", "docs")
    groups = max(1, blocks.where("part < 0").count() // GROUP)
    pairs = pairs.withColumn("salt", F.pmod(F.xxhash64("block"), F.lit(groups)).cast("int"))
    sums = pairs.groupBy("part", "salt").applyInArrow(_group_sums, "part int, codes binary, sums binary")
    sums = sums.groupBy("part").applyInArrow(_part_sums, "part int, codes binary, sums binary")
    sums = keep(sums).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    asked = pairs.select("block", "part", "salt", "codes")
    answers = asked.groupBy("part", "salt").cogroup(sums.groupBy("part", "salt")).applyInArrow(_answers, "block bigint, part int, sums binary")
    texts = blocks.where("part < 0").select("block", "figures", "places", "links", "n_pairs")
    return texts.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_figures, FIGURES + ", n_best bigint, count_sum bigint")


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return alignments(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


QUERIES = {"op12_alignment": op12_alignment}
ORACLE_SQL: dict[str, str] = {}
