"""Token ids as bit-packed binary files.

Every id takes the fewest bits that hold the vocabulary. 64 ids fill as many 64-bit words as an id has bits, so that
packing and unpacking are a few numpy operations over all such groups of a block. A file holds, in this order:

    magic                                   8 bytes
    blocks of BLOCK ids, the last one shorter, each filled up to whole groups of 64 ids
    block offsets                           u64, one more than blocks
    block checksums (CRC-32)                u32
    document ids                            i64; the first n_null documents have none
    first id of each document               u64, one more than documents
    width, BLOCK, ids, documents, n_null    u64 each
    offset of the block offsets             u64
    checksum of all tables before           u64
    magic                                   8 bytes

All numbers are little-endian. Block offsets let a reader fetch any run of ids by itself. Tasks write files under names
of their own, and the manifest (a table) lists those of the tasks that succeeded: a file of a lost executor is in none.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .chunks import batches_of, pattern_encoder, worker_chunks
from .common import keep, shared_dir, table, utf8

MAGIC = b"GLIDS\x00\x01\n"
BLOCK = 1 << 16
#: Ids after which a task begins another file, at the end of a document.
FILE_IDS = 1 << 26
#: Ids that a reader unpacks at a time, unless one document alone has more.
READ_IDS = 1 << 20
MANIFEST = "path string, part int, seq int, n_docs bigint, n_ids bigint, n_bytes bigint"


def width_of(vocabulary: int) -> int:
    """Bits for ids below ``vocabulary``."""
    if not 0 < vocabulary <= 1 << 32:
        raise ValueError("a vocabulary has 1 to 2^32 ids")
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    """Id i takes bits i * width and up of the result, low bits first; it is filled up to whole groups of 64 ids."""
    groups = -(-len(ids) // 64)
    if len(ids) and int(ids.max()) >> width:
        raise ValueError(f"an id needs more than {width} bits")
    full = np.zeros(groups * 64, np.uint64)
    full[: len(ids)] = ids
    lanes, words = full.reshape(groups, 64).T.copy(), np.zeros((width, groups), np.uint64)
    for n in range(64):
        at, shift = divmod(n * width, 64)
        words[at] |= lanes[n] << np.uint64(shift)
        if shift + width > 64:
            words[at + 1] |= lanes[n] >> np.uint64(64 - shift)
    return words.T.astype("<u8").tobytes()


def unpack(data: bytes, width: int) -> np.ndarray:
    """The ids of whole groups."""
    words = np.frombuffer(data, "<u8").reshape(-1, width).T.astype(np.uint64, order="C")
    lanes, mask = np.empty((64, words.shape[1]), np.uint32), np.uint64((1 << width) - 1)
    for n in range(64):
        at, shift = divmod(n * width, 64)
        found = words[at] >> np.uint64(shift)
        if shift + width > 64:
            found |= words[at + 1] << np.uint64(64 - shift)
        lanes[n] = found & mask
    return lanes.T.reshape(-1)


class Writer:
    """Writes one file, block by block as ids come."""

    def __init__(self, folder: str, width: int):
        self.fs, place = fs.FileSystem.from_uri(folder)
        self.fs.create_dir(place, recursive=True)
        self.path = f"{folder}/{uuid.uuid4().hex}.ids"
        self.width, self.held, self.n_held, self.n_ids = width, [], 0, 0
        self.offsets, self.sums, self.docs, self.starts, self.n_null = [len(MAGIC)], [], [], [0], 0
        self.out = self.fs.open_output_stream(f"{place}/{self.path.rpartition('/')[2]}")
        self.out.write(MAGIC)

    def _flush(self, every: bool) -> None:
        ids = np.concatenate(self.held) if self.held else np.zeros(0, np.uint32)
        stop = len(ids) if every else len(ids) // BLOCK * BLOCK
        for at in range(0, stop, BLOCK):
            data = pack(ids[at : min(at + BLOCK, stop)], self.width)
            self.out.write(data)
            self.sums.append(zlib.crc32(data))
            self.offsets.append(self.offsets[-1] + len(data))
        self.held, self.n_held = [ids[stop:]], len(ids) - stop

    def add(self, doc_id: int | None, *parts: np.ndarray) -> None:
        """The next document; those without an id come first."""
        if doc_id is None and len(self.docs) > self.n_null:
            raise ValueError("documents without an id come first")
        self.n_null += doc_id is None
        self.docs.append(doc_id or 0)
        self.held += parts
        size = sum(map(len, parts))
        self.n_ids += size
        self.n_held += size
        self.starts.append(self.n_ids)
        if self.n_held >= 8 * BLOCK:
            self._flush(False)

    def close(self) -> dict:
        """Ends the file; what the manifest says of it."""
        self._flush(True)
        tables = np.array(self.offsets, "<u8").tobytes() + np.array(self.sums, "<u4").tobytes() + np.array(self.docs, "<i8").tobytes() + np.array(self.starts, "<u8").tobytes()
        tables += np.array([self.width, BLOCK, self.n_ids, len(self.docs), self.n_null, self.offsets[-1]], "<u8").tobytes()
        tables += np.array([zlib.crc32(tables)], "<u8").tobytes() + MAGIC
        self.out.write(tables)
        self.out.close()
        return {"path": self.path, "n_docs": len(self.docs), "n_ids": self.n_ids, "n_bytes": self.offsets[-1] + len(tables)}


class Reader:
    """Random access to a file: any run of ids, or any document, without reading the blocks before."""

    def __init__(self, path: str):
        system, place = fs.FileSystem.from_uri(path)
        self.file = system.open_input_file(place)
        size = self.file.size()
        tail = self.file.read_at(64, size - 64) if size > 72 else b""
        if tail[-8:] != MAGIC:
            raise ValueError(f"{path} is no whole file of token ids")
        self.width, self.block, self.n_ids, self.n_docs, self.n_null, at, check = np.frombuffer(tail[:56], "<u8").astype(np.int64).tolist()
        tables = self.file.read_at(size - at - 16, at)
        if zlib.crc32(tables) != check:
            raise ValueError(f"the tables of {path} are damaged")
        blocks, place = -(-self.n_ids // self.block), 0

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal place
            place += np.dtype(kind).itemsize * n
            return np.frombuffer(tables, kind, n, place - np.dtype(kind).itemsize * n)

        self.offsets, self.sums = take("<u8", blocks + 1).astype(np.int64), take("<u4", blocks)
        self.docs, self.starts = take("<i8", self.n_docs), take("<u8", self.n_docs + 1).astype(np.int64)

    def ids(self, first: int, stop: int) -> np.ndarray:
        """Ids first to stop - 1 of the file."""
        if not 0 <= first <= stop <= self.n_ids:
            raise IndexError(f"{first}:{stop} of {self.n_ids} ids")
        if first == stop:
            return np.zeros(0, np.uint32)
        a, b = first // self.block, -(-stop // self.block)
        begin = int(self.offsets[a])
        data = self.file.read_at(int(self.offsets[b]) - begin, begin)
        for n in range(a, b):
            if zlib.crc32(data[int(self.offsets[n]) - begin : int(self.offsets[n + 1]) - begin]) != self.sums[n]:
                raise ValueError(f"block {n} is damaged")
        return unpack(data, self.width)[first - a * self.block : stop - a * self.block]

    def document(self, n: int) -> np.ndarray:
        return self.ids(int(self.starts[n]), int(self.starts[n + 1]))


def write_ids(docs: DataFrame, tokenizer_path: str, end_id: int | None = None, text: str = "text", folder: str | None = None) -> DataFrame:
    """Encodes every whole text and writes the ids in ascending doc_id order; returns the manifest, kept as a table.

    Documents are sorted by ranges of doc_id, null first, then by a hash of the text, so the files of a range are ready
    when its task ends, and (part, seq) orders them. A null or empty text has no ids but ``end_id``; repeated rows stay.
    Very long texts stay whole. A task holds one batch of texts and eight blocks of ids, and its documents' numbers.
    """
    folder = folder or f"{shared_dir(docs.sparkSession)}/grantlink-ids-{uuid.uuid4().hex}"
    data = docs.select("doc_id", utf8(f"`{text}`").alias("_utf8")).withColumn("_tie", F.xxhash64("_utf8"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tokenizers import Tokenizer

        width = width_of(Tokenizer.from_file(tokenizer_path).get_vocab_size(with_added_tokens=True))
        known, end = worker_chunks(pattern_encoder, tokenizer_path), () if end_id is None else (np.array([end_id], np.uint32),)
        part, files, now = TaskContext.get().partitionId(), [], None
        for batch in batches:
            numbers = iter(batch.column(0).to_pylist())
            for texts in batches_of(batch.column(1), 4_000_000):
                for ids in known.ids(texts):
                    now = now or Writer(folder, width)
                    now.add(next(numbers), ids, *end)
                    if now.n_ids >= FILE_IDS:
                        files, now = [*files, now.close()], None
        files += [now.close()] if now else []
        rows = [f | {"part": part, "seq": n} for n, f in enumerate(files)]
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("path", pa.string()), ("part", pa.int32()), ("seq", pa.int32()), ("n_docs", pa.int64()), ("n_ids", pa.int64()), ("n_bytes", pa.int64())]))

    dealt = data.repartitionByRange("doc_id", "_tie").sortWithinPartitions("doc_id", "_tie").select("doc_id", "_utf8")
    return keep(dealt.mapInArrow(task, MANIFEST))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            file, at = Reader(row["path"]), 0
            while at < file.n_docs:
                stop = max(at + 1, int(np.searchsorted(file.starts, file.starts[at] + READ_IDS, "right")) - 1)
                stop = min(stop, file.n_docs)
                starts = file.starts[at : stop + 1]
                ids = file.ids(int(starts[0]), int(starts[-1])).astype("<u4").view("u1")
                numbers = pa.array(file.docs[at:stop], mask=np.arange(at, stop) < file.n_null)
                bounds = pa.py_buffer(((starts - starts[0]) * 4).astype("<i8"))
                held = pa.LargeBinaryArray.from_buffers(pa.large_binary(), stop - at, [None, bounds, pa.py_buffer(ids)])
                yield pa.RecordBatch.from_arrays([numbers, pa.array(starts[:-1] + row["start"]), pa.array(np.diff(starts)), held.cast(pa.binary())], ["doc_id", "start", "n_tokens", "ids"])
                at = stop


def read_ids(manifest: DataFrame) -> DataFrame:
    """Rows (doc_id, start, n_tokens, ids) from the files of a manifest: ``start`` counts the ids of all documents
    before, ``ids`` holds the document's own as little-endian unsigned 32-bit numbers. Files are read side by side, a
    run of documents at a time. The manifest has one row for each file (2^26 ids or a task's end), so that summing it in
    order is a small job."""
    before = F.sum("n_ids").over(Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1))
    files = manifest.select("path", F.coalesce(before, F.lit(0)).alias("start"))
    return files.repartition(max(1, manifest.count())).mapInArrow(_read, "doc_id bigint, start bigint, n_tokens bigint, ids binary")


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of each document as read back from the packed files."""
    import public_tokenizers

    manifest = write_ids(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return read_ids(manifest).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


QUERIES = {"op11_token_files": op11_token_files}
ORACLE_SQL: dict[str, str] = {}
