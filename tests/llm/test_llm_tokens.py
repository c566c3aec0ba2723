"""Packed token files, cross-tokenizer alignment and the conversation trie against plain brute-force versions."""

import collections
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tokenizers
from pyspark.sql import functions as F

from grantlink.llm import align, binary, chunks, trie

R = random.Random(11)
PARTS = ["a", "B", "é", "é", "中", "文", "Σ", "ß", " ", "  ", "   ", "\n", "\t", "\r\n", " ", "　", "\x1c", "\x85", "'s", "1", "23", "!", "<|endoftext|>", "▁", "\x00", "😀", "hello", "world", "The", "#$", "‍", "İ"]
ODD = ["".join(R.choice(PARTS) for _ in range(R.randint(1, 25))) for _ in range(400)]
TEXTS = [None, "", " ", "one", "the end", "the end", "word " * 3000, "x" * 20000, *ODD, None]
DOCS = [(None if i in (5, 9) else 3 * i, t) for i, t in enumerate(TEXTS)] + [(12, "same number, another text"), (18, "word " * 3000)]


@pytest.fixture(scope="module")
def docs(spark):
    """With columns whose names clash with the operators' own."""
    df = spark.createDataFrame(DOCS, "doc_id long, text string").repartition(3)
    for c in ("_utf8", "_tie", "start", "ids", "part", "block", "codes", "n_a", "path"):
        df = df.withColumn(c, F.lit(1))
    return df


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string")


def word_ids(text):
    model = word_ids.model = getattr(word_ids, "model", None) or tokenizers.Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return model.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("width", [1, 5, 8, 15, 16, 17, 31, 32])
def test_packing_round_trip(width):
    for n in (0, 1, 63, 64, 65, 1000):
        ids = np.random.default_rng(n).integers(0, 1 << width, n, dtype=np.uint64).astype(np.uint32)
        data = binary.pack(ids, width)
        assert len(data) == -(-n // 64) * 8 * width and (binary.unpack(data, width)[:n] == ids).all()
    with pytest.raises(ValueError):
        binary.pack(np.array([1 << 16]), 16)
    assert [binary.width_of(n) for n in (1, 2, 3, 49408, 1 << 16, 1 << 32)] == [1, 1, 2, 16, 16, 32]


def test_files_give_random_access_and_show_damage(tmp_path, monkeypatch):
    monkeypatch.setattr(binary, "BLOCK", 128)
    g = np.random.default_rng(1)
    texts = [g.integers(0, 50000, n).astype(np.uint32) for n in (0, 1, 700, 64, 0, 5000, 3)]
    writer = binary.Writer(str(tmp_path), 16)
    for n, ids in enumerate(texts):
        writer.add(None if n < 2 else n, ids)
    told, every = writer.close(), np.concatenate(texts)
    reader = binary.Reader(told["path"])
    assert (reader.n_docs, reader.n_ids, reader.n_null, told["n_ids"]) == (7, len(every), 2, len(every))
    for n, ids in enumerate(texts):
        assert (reader.document(n) == ids).all()
    for a, b in [(0, 0), (127, 129), (130, 5000), (0, len(every)), *(sorted(g.integers(0, len(every), 2)) for _ in range(30))]:
        assert (reader.ids(int(a), int(b)) == every[a:b]).all()
    with pytest.raises(IndexError):
        reader.ids(0, len(every) + 1)
    path = told["path"]
    with open(path, "r+b") as f:
        f.seek(300)
        f.write(b"\xff\xfe")
    with pytest.raises(ValueError, match="block 0 is damaged|block 1 is damaged"):
        binary.Reader(path).ids(0, len(every))
    assert (binary.Reader(path).document(6) == texts[6]).all()
    with open(path, "r+b") as f:
        f.truncate(told["n_bytes"] - 5)
    with pytest.raises(ValueError, match="no whole file"):
        binary.Reader(path)


def test_token_files(docs, empty, monkeypatch):
    monkeypatch.setattr(binary, "READ_IDS", 500)
    path = public_tokenizers.path("word_bpe_49k.json")
    manifest = binary.write_ids(docs, path, end_id=2)
    got = binary.read_ids(manifest).withColumn("crc", F.crc32("ids")).collect()
    want = collections.Counter((i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for i, t in DOCS for ids in [[*word_ids(t), 2]])
    assert collections.Counter((r.doc_id, r.n_tokens, r.crc) for r in got) == want
    rows, at = sorted(got, key=lambda r: r.start), 0
    assert [r.doc_id for r in rows] == sorted((i for i, _ in DOCS), key=lambda i: (i is not None, i or 0))
    for r in rows:
        assert r.start == at and len(r.ids) == 4 * r.n_tokens
        at += r.n_tokens
    assert manifest.agg(F.sum("n_ids")).first()[0] == at
    assert binary.read_ids(binary.write_ids(empty, path, end_id=2)).count() == 0
    assert binary.read_ids(binary.write_ids(docs, path)).agg(F.sum("n_tokens")).first()[0] == at - len(DOCS)


def test_many_files_of_a_task_stay_in_order(spark):
    small = spark.createDataFrame([(i, f"text {i} " * (i % 50)) for i in range(300)], "doc_id long, text string")
    whole = binary.read_ids(binary.write_ids(small, public_tokenizers.path("word_bpe_49k.json"), end_id=2))
    got = whole.orderBy("doc_id").collect()
    assert [r.start for r in got] == [sum(r.n_tokens for r in got[:i]) for i in range(300)]


@pytest.mark.parametrize("side", ["word", "byte", "piece"])
def test_chunks_give_the_ids_of_the_library(side):
    texts = [t or "" for t in TEXTS]
    if side == "piece":
        path = public_tokenizers.path("piece_bpe_32k.model")
        encode, want = chunks.piece_encoder(path), sentencepiece.SentencePieceProcessor(model_file=path).encode(texts)
    else:
        path = public_tokenizers.path("word_bpe_49k.json" if side == "word" else "byte_bpe_50k.json")
        model, before = tokenizers.Tokenizer.from_file(path), "" if side == "word" else " "
        model.encode_special_tokens = side == "byte"
        want = [model.encode(before + t, add_special_tokens=False).ids if t else [] for t in texts]
        encode = chunks.pattern_encoder(path) if side == "word" else chunks.pattern_encoder(path, " ", True)
    assert [i.tolist() for i in chunks.ByChunk(encode).ids(texts)] == want


def plain_alignment(rows):
    a_model = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a_model.encode_special_tokens = True
    b_model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    decoder = tokenizers.pre_tokenizers.ByteLevel.alphabet()
    shown = [b for b in range(256) if 33 <= b < 127 or 161 <= b < 173 or b >= 174]
    byte_of = {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in shown)}
    assert set(byte_of) == set(decoder)
    out, holds = [], collections.Counter()
    for doc_id, text in rows:
        a, b = (a_model.encode(" " + text, add_special_tokens=False).ids, b_model.encode(text)) if text else ([], [])
        x = [bytes(byte_of[c] for c in a_model.id_to_token(i)) for i in a]
        y = [bytes([int(b_model.id_to_piece(i)[3:5], 16)]) if b_model.is_byte(i) else b_model.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not text or b"".join(x) != (" " + text).encode() or b"".join(y) != (" " + text).encode():
            out.append((doc_id, 0, 0, [], [], ""))
            continue
        ends_x, ends_y = np.cumsum([len(t) for t in x]).tolist(), np.cumsum([len(t) for t in y]).tolist()
        begin_y = [0, *ends_y[:-1]]
        links = [(i, j) for i, (s, e) in enumerate(zip([0, *ends_x], ends_x, strict=False)) for j in range(len(b)) if begin_y[j] < e and s < ends_y[j]] if len(a) < 200 else None
        if links is None:  # a long one, by two pointers
            links, i, j = [], 0, 0
            while i < len(a):
                links.append((i, j))
                s, e = ends_x[i], ends_y[j]
                i, j = i + (s <= e), j + (e <= s)
        groups, begin = [], (0, 0)
        for cut in sorted(set(ends_x) & set(ends_y)):
            end = (ends_x.index(cut) + 1, ends_y.index(cut) + 1)
            groups.append(",".join(map(str, a[begin[0] : end[0]])) + "|" + ",".join(map(str, b[begin[1] : end[1]])))
            begin = end
        pairs = [(a[i], b[j]) for i, j in links]
        holds.update(set(pairs))
        out.append((doc_id, len(a), len(b), groups, pairs, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    best = collections.Counter()
    for (a, _), n in holds.items():
        best[a] = max(best[a], n)
    return collections.Counter((i, n_a, n_b, len(g), len(p), sum(holds[x] == best[x[0]] for x in p), sum(holds[x] for x in p), h) for i, n_a, n_b, g, p, h in out)


def test_alignment(docs, empty, monkeypatch):
    a, b = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    want = plain_alignment(DOCS)
    assert sum(r[1] == 0 for r in want.elements()) > 20 and max(r[1] for r in want) > 3000
    for groups in (500, 1):  # one group of blocks, then one group for each block
        monkeypatch.setattr(align, "GROUP", groups)
        got = align.alignments(docs, a, b)
        assert collections.Counter(tuple(r[n] for n in names) for r in got.collect()) == want
    assert align.alignments(empty, a, b).count() == 0


def test_lockstep_in_short_lanes_and_small_blocks(monkeypatch):
    aligner = align.Aligner(*align.sides(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")))
    texts = [t for t in TEXTS if t]
    figures, *whole = aligner.align(texts)
    monkeypatch.setattr(align, "LANE", 3)
    again, *short = aligner.align(texts)
    assert figures["groups"] == again["groups"] and all((x == y).all() for x, y in zip(whole, short, strict=True))
    for values in (np.array([0, 5, 1 << 33, 1 << 39]), np.zeros(0, np.int64)):
        assert (align._unpack_codes(align._pack_codes(values)) == values).all() and (align._narrow(align._wide(values)) == values).all()


def plain_trie(rows):
    """The trie by dictionaries of whole prefixes."""
    own = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", hashlib.md5((text or "").encode()).hexdigest(), text or ""))
    own = {c: [(t[2], t[4]) for t in sorted(v)] for c, v in own.items()}
    built = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = own.get(c - c % 5, [])[:h] + own[c][h:]
    members = collections.defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = collections.Counter(k[:-1] for k in members if k)
    out = collections.Counter()
    leaves, saved = collections.Counter(), collections.Counter()
    for k, m in members.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += not children[k]
            saved[k[:d]] += (len(m) - 1) * len(k[-1][1].encode()) if k else 0
    for k, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(built[c]) == len(k))
        out[(min(m), len(k), min(members[k[:-1]]) if k else None, len(m), children[k], leaves[k], saved[k], hashlib.sha256(ends.encode()).hexdigest())] += 1
    return out


def conversation_rows():
    rows = [(None, 1, "user", "no conversation"), (40, None, None, None), (40, 0, "user", None), (40, 0, "user", None), (41, 7, "user", "é" * 9)]
    for c in range(40):
        if c % 5 or c < 25:  # some bases are absent
            for t in range(R.choice([1, 2, 3, 9, 12])):
                rows.append((c, t, "user" if t % 2 == 0 else "assistant", R.choice(["hi", "hello", "ok"]) if t < 3 else R.choice(["x", "yy"])))
    rows += [(100 + 5 * n, t, "user", f"turn {t}") for n in range(6) for t in range(70 + n % 3)]  # long copies
    rows += [(1000 + n, 0, "user", "very common") for n in range(700)]
    rows += [(2000, t, "user", "w" * 200_000 if t == 2 else f"t{t}") for t in range(5)]
    return rows


@pytest.mark.parametrize("band", [16, 2, 3, 100])
def test_trie(spark, band):
    rows = conversation_rows()
    given = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    for c in ("pos", "node", "a", "part", "n", "chunk", "above"):
        given = given.withColumn(c, F.lit(1))
    got = trie.trie(*trie.with_shared_heads(trie.ordered_turns(given), 5, 9), band)
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert collections.Counter(tuple(r[n] for n in names) for r in got.collect()) == plain_trie(rows)


def test_one_long_conversation_spans_ranges(spark):
    rows = [(5, t, "user", str(t % 7)) for t in range(5000)] + [(10 * n, 0, "user", "a") for n in range(20)]
    given = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    turns = trie.ordered_turns(given)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert turns.where("conv_id = 5").agg(F.countDistinct("chunk")).first()[0] > 1
    got = trie.trie(*trie.with_shared_heads(turns, 5, 9))
    row = got.where("depth = 5000").first()
    assert (row.conv_id, row.parent_conv_id, row.n_leaves, got.count()) == (5, 5, 1, 5002)
    assert got.where("depth = 0").first().n_leaves == 2


def test_trie_of_nothing(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert trie.trie(*trie.with_shared_heads(trie.ordered_turns(none), 5, 9)).count() == 0
