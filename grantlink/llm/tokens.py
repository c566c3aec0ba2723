"""Token counts of a byte-fallback BPE piece model, by rank-synchronous merging of ragged arrays.

A text is cut where no piece can reach across: before each space mark, and at characters that no piece contains. The
distinct cuts of a batch lie side by side in one flat array; every step finds each sequence's lowest-rank pair and
merges all its occurrences at once, until nothing merges; the surviving symbols are counted. Sequences where a merge
has made a pair of lower rank while others of the old rank were merged with it are done again, one merge at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, utf8, widened

MARK = "▁"
NONE = np.int64(1 << 40)
LIMIT = 4096
#: Cuts whose counts a worker remembers, and their characters; beyond either it starts anew.
REMEMBERED = 300_000
REMEMBERED_CHARS = 16_000_000


@dataclass
class Pieces:
    symbol: np.ndarray  # of each code point; 0 to 3: unknown, by its UTF-8 length less 1
    weight: np.ndarray  # tokens that a symbol stands for at the end
    code: np.ndarray  # pairs, sorted
    rank: np.ndarray
    merged: np.ndarray
    width: int
    barrier: bool  # a line feed is in no piece
    run: list[int]  # tokens of 0, 1, 2... space marks alone, up to the longest piece of them

    def marks(self, n: int) -> int:
        longest = len(self.run) - 1
        return n // longest + self.run[n % longest]


def _run(n: int, lengths: set[int]) -> int:
    """Tokens of n space marks: the leftmost two that make a piece are merged, again and again."""
    parts = [1] * n
    while (at := next((i for i in range(len(parts) - 1) if parts[i] + parts[i + 1] in lengths), None)) is not None:
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return len(parts)


def load_pieces(path: str) -> Pieces:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    normal = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    pieces = {model.id_to_piece(i): model.get_score(i) for i in normal}
    runs = {len(p) for p in pieces if set(p) == {MARK}}
    inner = [p for p in pieces if MARK in p[1:] and set(p) != {MARK}]
    longest = max(runs, default=0)
    run = [_run(n, runs) for n in range(2 * longest + 1)]
    if inner or not longest or any(run[n + longest] != run[n] + 1 for n in range(longest)) or len({pieces[MARK * n] for n in runs - {1}}) > 1 or any(pieces[MARK * n] > min(s for p, s in pieces.items() if set(p) != {MARK}) for n in runs - {1}):
        raise ValueError("the cuts need space marks only at the start of a piece, or in runs that merge last, from the left")
    number = {p: n + 4 for n, p in enumerate(pieces)}
    lone = sorted({c for p in pieces for c in p} - pieces.keys())
    number |= {c: n + 4 + len(pieces) for n, c in enumerate(lone)}
    width = len(number) + 4
    symbol = np.zeros(0x110000, np.int64)
    symbol[0x80:] = 1
    symbol[0x800:] = 2
    symbol[0x10000:] = 3
    for c in {c for p in pieces for c in p}:
        symbol[ord(c)] = number[c]
    weight = np.ones(width, np.int64)
    weight[:4] = 1, 2, 3, 4
    for c in lone:
        weight[number[c]] = len(c.encode())
    order = {s: n for n, s in enumerate(sorted({s for p, s in pieces.items()}, reverse=True))}
    found = {}
    for p, score in pieces.items():
        if set(p) == {MARK}:
            continue  # runs of marks are counted by their length
        for cut in range(1, len(p)):
            a, b = number.get(p[:cut]), number.get(p[cut:])
            if a is not None and b is not None:
                found[a * width + b] = (order[score], number[p])
    code = np.array(sorted(found), np.int64)
    rank, merged = np.array([found[c] for c in code.tolist()], np.int64).T
    return Pieces(symbol, weight, code, rank.copy(), merged.copy(), width, "\n" not in set("".join(pieces)), run[: longest + 1])


def merge(strings: list[str], p: Pieces, single: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of each string (none is empty), and whether its first is a lone space mark."""
    size = np.fromiter(map(len, strings), np.int64, len(strings))
    sym = p.symbol[np.frombuffer("".join(strings).encode("utf-32-le", "surrogatepass"), np.uint32)]
    tokens, lone = np.zeros(len(strings), np.int64), np.zeros(len(strings), bool)
    again: list[int] = []
    own = np.arange(len(strings))  # numbers of the sequences that are still merged
    last, many = np.full(len(strings), -1, np.int64), np.zeros(len(strings), bool)
    mark = p.symbol[ord(MARK)]
    while len(own):
        start = np.cumsum(size) - size
        seq = np.repeat(np.arange(len(own)), size)
        code = np.empty(len(sym), np.int64)
        code[:-1] = sym[:-1] * p.width + sym[1:]
        code[start + size - 1] = -1
        at = np.minimum(np.searchsorted(p.code, code), len(p.code) - 1)
        rank = np.where(p.code[at] == code, p.rank[at], NONE)
        best = np.minimum.reduceat(rank, start)
        wrong = many & (best < last)
        over = (best == NONE) | wrong
        if over.any():
            sums = np.add.reduceat(p.weight[sym], start)
            tokens[own[over]] = sums[over]
            lone[own[over]] = sym[start[over]] == mark
            again += own[wrong].tolist()
            stay = ~over[seq]
            sym, at, rank, seq = sym[stay], at[stay], rank[stay], seq[stay]
            own, size, best, last, many = own[~over], size[~over], best[~over], last[~over], many[~over]
            if not len(own):
                break
            seq = np.repeat(np.arange(len(own)), size)
        pick = np.flatnonzero(rank == best[seq])
        if single:
            pick = pick[np.r_[True, seq[pick[1:]] != seq[pick[:-1]]]]
        else:  # in a row of neighbours every second one, from the left
            head = np.r_[True, np.diff(pick) != 1]
            place = np.arange(len(pick))
            pick = pick[(place - np.maximum.accumulate(np.where(head, place, 0))) % 2 == 0]
        sym[pick] = p.merged[at[pick]]
        done = np.bincount(seq[pick], minlength=len(own))
        left = np.ones(len(sym), bool)
        left[pick + 1] = False
        sym, size, last, many = sym[left], size - done, best, done > 1
    if again:
        tokens[again], lone[again] = merge([strings[i] for i in again], p, single=True)
    return tokens, lone


class Counter:
    """Counts tokens of texts, batch by batch."""

    def __init__(self, pieces: Pieces):
        self.p, self.tokens, self.lone, self.chars = pieces, {}, set(), 0

    def learn(self, cuts: set[str]) -> None:
        new = list(cuts)
        self.chars += sum(map(len, new))
        size, begin = 0, 0
        for n, c in enumerate(new):  # some at a time
            size += len(c)
            if size > 1_000_000 or n == len(new) - 1:
                part = new[begin : n + 1]
                strings = [c if self.p.barrier and c[0] == "\n" else MARK + c for c in part]
                tokens, lone = merge(strings, self.p)
                self.tokens.update(zip(part, tokens.tolist(), strict=True))
                self.lone.update(part[i] for i in np.flatnonzero(lone))
                size, begin = 0, n + 1

    def count(self, texts: list[str]) -> list[int]:
        out = []
        cuts = []
        for t in texts:
            t = t.replace(MARK, " ")
            cuts.append((t.replace("\n", " \n") if self.p.barrier else t).split(" ") if t else [])
        wanted = set().union(*cuts)
        wanted.discard("")
        if len(self.tokens) > REMEMBERED or self.chars > REMEMBERED_CHARS:
            self.tokens, self.lone, self.chars = {}, set(), 0
        self.learn(wanted - self.tokens.keys())
        get, run = self.tokens.__getitem__, self.p.marks
        for t, parts in zip(texts, cuts, strict=True):
            if parts and self.p.barrier and t[0] == "\n" and parts[0] == "":
                parts[0] = None  # the text's own mark stands before the line feed
            if "" not in parts and None not in parts:
                out.append(sum(map(get, parts)))
                continue
            n = marks = 0
            for c in parts:
                if not c:
                    marks += 1
                    continue
                n += get(c)
                if marks:
                    if c in self.lone:
                        n, marks = n - 1, marks + 1
                    n, marks = n + run(marks), 0
            out.append(n + run(marks))
        return out


def _counts(known, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counter = Counter(known.value)
    for batch in batches:
        at = batch.schema.get_field_index("_utf8")
        out, texts, size = [], [], 0
        for text in batch.column(at):
            texts.append(text.as_py().decode("utf-8", "replace"))
            size += len(texts[-1])
            if size > 4_000_000:
                out += counter.count(texts)
                texts, size = [], 0
        out += counter.count(texts)
        yield batch.drop_columns(["_utf8"]).append_column("n_tokens", pa.array(out, pa.int64()))


def token_counts(docs: DataFrame, model_path: str, text: str = "text", limit: int = LIMIT) -> DataFrame:
    """Rows (doc_id, n_bytes, n_tokens, over_limit), one for each input row, without special tokens.

    A null text counts as empty: no bytes, no tokens. Repeated rows stay. The model's pair table is broadcast; its size
    is that of the vocabulary. A very long cut (a text without spaces) is merged like any other, over its whole length.
    """
    known = docs.sparkSession.sparkContext.broadcast(load_pieces(model_path))
    data = docs.select("doc_id", utf8(f"`{text}`").alias("_utf8")).select("doc_id", F.length("_utf8").cast("bigint").alias("n_bytes"), "_utf8")
    counted = data.mapInArrow(lambda batches: _counts(known, batches), widened(data, "n_tokens bigint"))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


QUERIES = {"op9_token_counts": op9_token_counts}
ORACLE_SQL: dict[str, str] = {}
