"""Token ids of whole texts through a tokenizer library, which is asked once for each distinct chunk of a worker.

A text is cut at single spaces between characters that are neither white space nor U+2581. Neither tokenizer family used here merges
across such a place: word and byte-level BPE begin a pre-token there, and no piece of a piece model holds a space mark
after another character. The ids of a text are therefore those of its chunks, one after the other.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Callable
from functools import cache
from itertools import chain, pairwise

import numpy as np

CUT = re.compile(r" (?<=[^\s▁] )(?=[^\s▁])")
#: Chunks whose ids a worker remembers, and their characters; beyond either it starts anew.
REMEMBERED = 400_000
REMEMBERED_CHARS = 16_000_000
#: Pre-tokens whose ids an encoder remembers.
PRE_TOKENS = 600_000
#: Characters that go to the library in one call, unless one chunk alone has more.
CALL_CHARS = 1_000_000


#: White space that is rarer than spaces and line feeds, and the space mark of piece models.
RARE = re.compile("[\t\x0b-\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000▁]").search


def chunks_of(text: str) -> list[str]:
    """The chunks of a text; a plain split where it gives the same."""
    if text[:1] == " " or text[-1:] == " " or "  " in text or "\n " in text or " \n" in text or RARE(text):
        return CUT.split(text)
    return text.split(" ")


def ragged(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The runs of ``values`` that begin at ``starts``, one after the other."""
    ends = np.cumsum(sizes)
    return values[np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)]


class _Numbers(dict):
    """Numbers of chunks; a new one gets the next number and is noted."""

    def __init__(self):
        super().__init__({"": 0})
        self.new: list[str] = []

    def __missing__(self, chunk: str) -> int:
        self.new.append(chunk)
        self[chunk] = number = len(self)
        return number


class ByChunk:
    """Distinct chunks are numbered, and each encoder's ids of all chunks lie in one array, so that those of many texts
    are gathered by numpy. An encoder gives the ids of many chunks as little-endian unsigned 32-bit numbers."""

    def __init__(self, *encoders: Callable[[list[str]], list[bytes]]):
        self.encoders = encoders
        self._forget()

    def _forget(self) -> None:
        self.number, self.chars = _Numbers(), 0
        #: For each encoder the ids of all chunks, where each begins, and how many it has.
        self.sides = [(np.zeros(0, np.uint32), np.zeros(1, np.int64), np.zeros(1, np.int64)) for _ in self.encoders]

    def learned(self, chunks: list[str], sides: list[tuple[np.ndarray, np.ndarray]]) -> None:
        """What is to be done with new chunks, their ids and the number of ids of each, for each encoder."""

    def _learn(self, chunks: list[str]) -> None:
        """Asks the encoders for new chunks, some at a time."""
        size = begin = 0
        for n, chunk in enumerate(chunks):
            size += len(chunk)
            if size > CALL_CHARS or n == len(chunks) - 1:
                part, new = chunks[begin : n + 1], []
                for k, encode in enumerate(self.encoders):
                    found = encode(part)
                    new.append((np.frombuffer(b"".join(found), "<u4"), np.fromiter(map(len, found), np.int64, len(found)) // 4))
                    ids, starts, sizes = self.sides[k]
                    self.sides[k] = (np.concatenate([ids, new[k][0]]), np.concatenate([starts, len(ids) + np.cumsum(new[k][1]) - new[k][1]]), np.concatenate([sizes, new[k][1]]))
                self.learned(part, new)
                self.chars += size
                size, begin = 0, n + 1

    def numbers(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The chunks of all texts, as numbers, and how many each text has. An empty text has one, without ids."""
        if len(self.number) > REMEMBERED or self.chars > REMEMBERED_CHARS:
            self._forget()
        cuts = list(map(chunks_of, texts))
        counts = np.fromiter(map(len, cuts), np.int64, len(cuts))
        numbers = np.fromiter(map(self.number.__getitem__, chain.from_iterable(cuts)), np.int64, counts.sum())
        self._learn(self.number.new)
        self.number.new = []
        return numbers, counts

    def gathered(self, numbers: np.ndarray, counts: np.ndarray, side: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """An encoder's ids of all texts, and where each text's begin, with the end."""
        ids, starts, sizes = self.sides[side]
        upto = np.concatenate([[0], np.cumsum(sizes[numbers])])
        return ragged(ids, starts[numbers], sizes[numbers]), upto[np.concatenate([[0], np.cumsum(counts)])]

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        flat, bounds = self.gathered(*self.numbers(texts))
        return [flat[i:j] for i, j in pairwise(bounds.tolist())]


def _bytes(ids: list[int]) -> bytes:
    return array("I", ids).tobytes()


def byte_letters() -> dict[int, int]:
    """The character that stands for each byte in byte-level files: itself where it is printed, else U+0100 and up."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = [b for b in range(256) if b not in shown]
    return {b: b for b in shown} | {b: 0x100 + n for n, b in enumerate(rest)}


def json_encoder(path: str, before: str = "", specials_as_text: bool = False) -> Callable[[list[str]], list[bytes]]:
    """The tokenizers library with the file at ``path``, on one thread; ``before`` is set before every chunk."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks are the parallelism
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(path)
    model.encode_special_tokens = specials_as_text
    return lambda chunks: [_bytes(e.ids) for e in model.encode_batch_fast([before + c for c in chunks], add_special_tokens=False)]


class _PreTokens(dict):
    """Ids of pre-tokens by the library's model alone, each asked for once; bytes are shown as byte-level files do."""

    def __init__(self, model):
        super().__init__()
        self.model, self.shown = model, byte_letters()

    def __missing__(self, pre_token: str) -> bytes:
        self[pre_token] = found = _bytes([t.id for t in self.model.tokenize(pre_token.encode().decode("latin-1").translate(self.shown))])
        return found


#: The pattern that byte-level files with use_regex stand for.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _pattern(told: dict) -> tuple[str, bool] | None:
    """The pattern that cuts a file's pre-tokens, and whether text is lower-cased; None for kinds not known here."""
    norms, cuts = told["normalizer"], told["pre_tokenizer"]
    if norms is None and cuts["type"] == "ByteLevel" and cuts["use_regex"] and not cuts["add_prefix_space"]:
        return BYTE_LEVEL, False
    norms, cuts = [x["type"] for x in (norms or {}).get("normalizers", [])], cuts.get("pretokenizers", [])
    if norms == ["NFC", "Replace", "Lowercase"] and [x["type"] for x in cuts] == ["Split", "ByteLevel"] and cuts[0]["behavior"] == "Removed" and not cuts[1]["use_regex"]:
        return cuts[0]["pattern"]["Regex"], True
    return None


def pattern_encoder(path: str, before: str = "", specials_as_text: bool = False) -> Callable[[list[str]], list[bytes]]:
    """As json_encoder, faster for files that cut pre-tokens by a pattern: byte-level ones, and those that compose and
    lower-case first and drop white space.

    There the library spends most of its time in the pattern. In a chunk of printable ASCII, line feeds and the
    composed letters of Latin-1 there is nothing to compose, so Python's ``re`` splits it by the same pattern, and the library's model is
    asked for each pre-token once. Other chunks, and those with the first character of an added token that counts, go to
    the library whole.
    """
    from tokenizers import Tokenizer

    whole, model = json_encoder(path, before, specials_as_text), Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as f:
        told = json.load(f)
    if not (found := _pattern(told)):
        return whole
    pattern, lower = found
    letters, digits = "a-zß-öø-ÿ" if lower else "A-Za-zÀ-ÖØ-öø-ÿ", "0-9"
    pattern = re.sub(r"(?<!\[)(?<!\\s)(?<!\})\\p\{([LN])\}\+?", lambda m: f"[{m[0][:5]}]{m[0][5:]}", pattern)  # a class by itself
    split = re.compile(pattern.replace(r"\p{L}", letters).replace(r"\p{N}", digits))
    starts = set() if specials_as_text else {x["content"][0] for x in told["added_tokens"]}
    plain = re.compile("[" + "".join(re.escape(chr(c)) for c in (0x0A, *range(0x21, 0x7F), *range(0xC0, 0x100)) if chr(c) not in {*starts, "×", "÷"}) + "]*").fullmatch
    known = _PreTokens(model.model)

    def encode(chunks: list[str]) -> list[bytes]:
        if len(known) > PRE_TOKENS:
            known.clear()
        ids, join, cut = known.__getitem__, b"".join, split.findall
        out = [join(map(ids, cut(before + c.lower() if lower else before + c))) if plain(c) else None for c in chunks]
        rest = [n for n, done in enumerate(out) if done is None]
        for n, done in zip(rest, whole([chunks[n] for n in rest]), strict=True):
            out[n] = done
        return out

    return encode


def piece_encoder(path: str) -> Callable[[list[str]], list[bytes]]:
    """The sentencepiece library with the model at ``path``, on one thread. It sets a space before every chunk itself."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    inner = [p for i in range(model.get_piece_size()) if "▁" in (p := model.id_to_piece(i)).lstrip("▁")]
    if inner:
        raise ValueError("chunks need pieces whose space marks all stand at the start")
    return lambda chunks: list(map(_bytes, model.encode(chunks, num_threads=1)))


def batches_of(texts, most: int):
    """Lists of decoded texts of about ``most`` characters; one longer text is a list by itself."""
    out, size = [], 0
    for text in texts:
        out.append(text.as_py().decode("utf-8", "replace"))
        size += len(out[-1])
        if size >= most:
            yield out
            out, size = [], 0
    if out:
        yield out


@cache
def worker_chunks(kind: Callable, *args) -> ByChunk:
    """One for each encoder in a Python worker, which Spark uses for many tasks."""
    return ByChunk(kind(*args))
