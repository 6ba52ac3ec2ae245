"""Byte-level BPE and token records against the public tokenizer libraries."""

import base64
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tabforge.llm import byte_bpe, token_records
from tabforge.llm.arrays import byte_column
from tabforge.session import scratch_path

RANKS = P.path("byte_bpe_50k.tiktoken")
WORDS = P.path("word_bpe_49k.json")
SCRAPS = ["a", "B", " ", "  ", "\n", "é", "'s", "don't", " ", "12", "!", "?", "x\x1cy", "日本", "　", " the", "ing", "\t", "’", "'ll", "\x85", "É", "é", "×", "÷", ",", "(", "...", '"', "<|endoftext|>", "Σ", "😀", "a" * 70]


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(4)
    return ["".join(rng.choice(SCRAPS) for _ in range(rng.randint(0, 40))) for _ in range(400)] + ["", None, "ab" * 2000, " " * 90, "\n\n a  b"]


def codec():
    with open(RANKS, "rb") as f:
        return byte_bpe.codec_of(f.read(), P.PATTERN)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_encode_any_text(text):
    import pyarrow as pa

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))} if not hasattr(test_encode_any_text, "ref") else None
    if ranks:
        test_encode_any_text.ref = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    ids, _ = codec().encode_texts(*byte_column(pa.array([text.encode("utf-8", "ignore").decode()])))
    assert ids.tolist() == test_encode_any_text.ref.encode_ordinary(text.encode("utf-8", "ignore").decode())


def test_encode_and_decode(spark, reference, texts):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)] + [(None, "null id", "y"), (0, "again", "z")], "doc_id long, text string, ids string")
    found = byte_bpe.decode(byte_bpe.encode(df, RANKS, P.PATTERN), RANKS, P.PATTERN).collect()
    assert len(found) == len(texts) + 2
    want = {i: t or "" for i, t in enumerate(texts)}
    for r in found:
        ids = np.frombuffer(bytes(r.ids), "<u4").tolist()
        text = bytes(r.decoded).decode()
        assert r.n_tokens == len(ids) and ids == reference.encode_ordinary(text)
        assert text in (want.get(r.doc_id, "null id"), "again")


def test_encode_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert byte_bpe.decode(byte_bpe.encode(df, RANKS, P.PATTERN), RANKS, P.PATTERN).count() == 0


def test_records_round_trip(spark, texts):
    tokenizer = Tokenizer.from_file(WORDS)
    tokenizer.encode_special_tokens = True
    rows = [(7 * i % 411, t) for i, t in enumerate(texts)] + [(None, "first"), (3, "twice")]
    path = scratch_path(spark, "records-test")
    token_records.write_records(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), path, WORDS, shard_bytes=3000)
    token_records.write_index(spark, path, f"{path}-index")
    index = spark.read.parquet(f"{path}-index")
    found = sorted(token_records.with_starts(token_records.read_records(spark, path), index).collect(), key=lambda r: r.start)
    assert len(found) == len(rows) and index.select("file").distinct().count() > 3
    ids = [-1 if r.doc_id is None else r.doc_id for r in found]
    assert ids == sorted(ids)
    at = 0
    for r in found:
        own = np.frombuffer(bytes(r.ids), "<u4")
        assert r.start == at and r.n_tokens == len(own) and own[-1] == 1
        at += len(own)
    got = sorted((-1 if r.doc_id is None else r.doc_id, zlib.crc32(bytes(r.ids))) for r in found)
    want = sorted((-1 if d is None else d, zlib.crc32(np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [1], "<u4").tobytes())) for d, t in rows)
    assert got == want


def test_special_tokens_have_their_ids(spark, texts):
    tokenizer = Tokenizer.from_file(WORDS)
    more = ["a <|endoftext|> b", "a<|endoftext|>'s", "<|endoftext|>", "<|startoftext|><|endoftext|>x", "a <|ENDOFTEXT|> b", "<|endoftext", "|>", "<<|endoftext|>>", "e<|endoftext|>\u0301 1<|endoftext|>2"]
    rows = list(enumerate([*texts, *more]))
    path = scratch_path(spark, "records-special")
    token_records.write_records(spark.createDataFrame(rows, "doc_id long, text string"), path, WORDS, special=True)
    got = {r.doc_id: np.frombuffer(bytes(r.ids), "<u4").tolist() for r in token_records.read_records(spark, path).collect()}
    assert got == {d: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for d, t in rows}
    assert got[len(texts)] == [320, 49407, 321, 1]


def test_damage_is_found():
    content = bytearray(token_records.frame(5, b"\1\0\2\0", 2) + token_records.frame(None, b"", 2) + b"\n")
    found = list(token_records.frames(bytes(content)))
    assert [(f[2], f[3].tolist()) for f in found] == [(5, [1, 2]), (None, [])]
    for at in (0, 9, 14, 20, len(content) - 3):
        broken = bytearray(content)
        broken[at] ^= 1
        with pytest.raises(token_records.DamagedRecord):
            list(token_records.frames(bytes(broken)))
    with pytest.raises(token_records.DamagedRecord):
        list(token_records.frames(bytes(content[:-4]) + b"\n"))


def test_records_of_an_empty_table(spark):
    path = scratch_path(spark, "records-empty")
    token_records.write_records(spark.createDataFrame([], "doc_id long, text string"), path, WORDS)
    token_records.write_index(spark, path, f"{path}-index")
    assert token_records.with_starts(token_records.read_records(spark, path), spark.read.schema(token_records.INDEX).parquet(f"{path}-index")).count() == 0


class Counting:
    """A tokenizer that counts the texts it is given."""

    def __init__(self, tokenizer):
        self.tokenizer, self.n = tokenizer, 0

    def encode_batch_fast(self, values, **how):
        self.n += len(values)
        return self.tokenizer.encode_batch_fast(values, **how)


def encoder():
    with open(WORDS, encoding="utf-8") as f:
        return token_records.PieceEncoder(f.read())


def ids_of(found, texts, special=False):
    import pyarrow as pa

    ids, counts = found.texts(*byte_column(pa.array(texts, pa.string())), special)
    return [part.tolist() for part in np.split(ids, np.cumsum(counts)[:-1])]


def test_pieces_are_remembered_in_little_memory(monkeypatch):
    """8,000 pieces fit into 1 MB: a second pass sends none of them to the tokenizer."""
    monkeypatch.setattr(token_records, "CACHE_BYTES", 1 << 20)
    rng = random.Random(5)
    words = sorted({"".join(rng.choice("abcdefgh") for _ in range(8)) for _ in range(8000)})
    found = encoder()
    counted = {id(t): Counting(t) for t in (found.tokenizer, getattr(found, "plain", found.tokenizer))}
    found.plain = counted[id(getattr(found, "plain", found.tokenizer))]
    found.tokenizer = counted[id(found.tokenizer)]
    texts = [" ".join(words[:5000]), " ".join(words[3000:]), "", words[0]]
    first = ids_of(found, texts)
    once = sum(c.n for c in counted.values())
    assert once == len(words)
    assert ids_of(found, texts[:2]) == first[:2] and ids_of(found, texts[1:]) == first[1:]
    assert sum(c.n for c in counted.values()) == once


@pytest.mark.parametrize("room", [0, 1500, 64 << 20])
@pytest.mark.parametrize("hashes", [1, 5, 1 << 60])
def test_full_memory_and_equal_hashes(monkeypatch, texts, room, hashes):
    own = token_records.span_hashes
    monkeypatch.setattr(token_records, "span_hashes", lambda *a: own(*a) % np.uint64(hashes))
    monkeypatch.setattr(token_records, "CACHE_BYTES", room)
    tokenizer, found = Tokenizer.from_file(WORDS), encoder()
    for special in (True, False, True):
        tokenizer.encode_special_tokens = not special
        for part in (texts[:150], texts[100:], [None, ""], ["<|endoftext|>"]):
            assert ids_of(found, part, special) == [tokenizer.encode(t or "", add_special_tokens=False).ids for t in part]
    assert token_records.ENTRY_BYTES * len(found.keys) + len(found.text) + 4 * len(found.ids) <= room and len(found.keys) <= hashes


def test_plain_pieces_skip_only_steps_that_leave_them():
    import json

    found = encoder()
    assert found.plain is not found.tokenizer
    letters = "abcdefghijklmnopqrstuvwxyz" + "".join(chr(c) for c in range(0xDF, 0x100) if c != 0xF7)
    values = [a + b + c for a in letters for b in letters for c in ("", "e", "ÿs")] + list(letters)
    assert all(token_records._PLAIN.fullmatch(v) for v in values)
    assert not any(token_records._PLAIN.fullmatch(v) for v in ("É", "a1", "don't", "÷", "e\u0301", "ā", "×", "ª", "a ", "a\n", ""))
    plain, whole = (t.encode_batch_fast(values, add_special_tokens=False) for t in (found.plain, found.tokenizer))
    assert [p.ids for p in plain] == [w.ids for w in whole]
    with open(WORDS, encoding="utf-8") as f:
        other = json.load(f)
    other["normalizer"]["normalizers"].append({"type": "Replace", "pattern": {"String": "é"}, "content": "e"})
    changed = token_records.PieceEncoder(json.dumps(other))
    assert changed.plain is changed.tokenizer and ids_of(changed, ["été é"]) == ids_of(found, ["ete e"])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(max_size=30) | st.lists(st.sampled_from(SCRAPS), max_size=12).map("".join), max_size=6))
def test_ids_of_any_text(parts):
    if not hasattr(test_ids_of_any_text, "both"):
        test_ids_of_any_text.both = encoder(), Tokenizer.from_file(WORDS)
    found, tokenizer = test_ids_of_any_text.both
    parts = [p.encode("utf-8", "ignore").decode() for p in parts]
    assert ids_of(found, parts, True)[: len(parts)] == [tokenizer.encode(p, add_special_tokens=False).ids for p in parts]


def test_index_of_a_damaged_file_raises(spark):
    """The index pass verifies every frame as well, and has all columns but the ids."""
    path = scratch_path(spark, "records-damaged")
    token_records.write_records(spark.createDataFrame([(1, "some words here")], "doc_id long, text string"), path, WORDS)
    assert token_records.read_records(spark, path, with_ids=False).columns == token_records.INDEX.names
    content = token_records.frame(1, b"\1\0\2\0", 2)[:-1] + b"\0"
    spark.createDataFrame([(bytearray(content).decode("latin-1"),)], "value string").write.mode("append").text(path)
    with pytest.raises(Exception, match="DamagedRecord"):
        token_records.write_index(spark, path, f"{path}-index")
