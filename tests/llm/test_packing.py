import struct
import zlib

import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tidewire.llm import packing
from tidewire.llm.queries import table
from tidewire.llm.tables import BoundedTable

from . import cases

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def check(rows, texts, tokenizer, max_length):
    by = {}
    for r in rows:
        by.setdefault(r["doc_tokens"], []).append(r)
    expected = []
    for text in texts:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        start = 0
        for length in packing.piece_lengths(len(ids), max_length):
            expected.append((start, length, zlib.crc32(struct.pack(f"<{length}I", *ids[start : start + length])), len(ids)))
            start += length
    assert sorted((r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in rows) == sorted(expected)
    assert all(r["length"] & (r["length"] - 1) == 0 and r["length"] <= max_length and r["offset"] == 0 for r in rows)
    assert len({r["sequence_id"] for r in rows}) == len(rows)


def test_awkward_documents(spark, tokenizer):
    rows = packing.pack(cases.documents(spark), PATH).collect()
    check(rows, [t for _, t, _ in cases.rows()], tokenizer, 2048)
    assert all(len(r["ids"]) == 4 * r["length"] and zlib.crc32(r["ids"]) == r["ids_crc32"] for r in rows)


def test_whole_table(spark, tokenizer):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    rows = packing.pack(docs, PATH, max_length=256, with_ids=False).collect()
    check(rows, [r["text"] for r in docs.collect()], tokenizer, 256)


def test_other_vocabulary_takes_the_whole_text(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    rows = packing.pack(cases.documents(spark), path, with_ids=False).collect()
    check(rows, [t for _, t, _ in cases.rows()], Tokenizer.from_file(path), 2048)


def test_empty_table_and_buckets(spark, tmp_path):
    assert packing.pack(cases.no_documents(spark), PATH).count() == 0
    pieces = packing.pack(cases.documents(spark), PATH)
    packing.write_buckets(pieces, str(tmp_path / "buckets"))
    back = spark.read.parquet(str(tmp_path / "buckets"))
    assert back.count() == pieces.count()


def test_piece_lengths():
    assert packing.piece_lengths(0) == []
    assert packing.piece_lengths(5000) == [2048, 2048, 512, 256, 128, 8]
    assert packing.piece_lengths(4096) == [2048, 2048]


def test_bounded_table_forgets_and_makes_again():
    made = []
    table = BoundedTable(lambda k: made.append(k) or k * 2, 4)
    assert [table[k % 9] for k in range(40)] == [k % 9 * 2 for k in range(40)]
    assert len(table) <= 4 and len(made) > 9


def test_words_are_forgotten_when_a_task_ends(tokenizer):
    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2], "text": ["some words, Some (words) twice some words", None]})

    def held(table):
        return len(table) + len(table._old) + len(table._new)

    def cut(word_table, **kept):
        made = list(packing._pieces(iter([batch]), PATH, 64, 1, True, word_table, **kept))
        encode = packing.encoder(PATH, word_table)
        return pa.Table.from_batches(made), held(encode._words) + held(encode._parts)

    (pieces, left), (same, stayed) = cut(50, keep_words=False), cut(51, keep_words=True)
    assert left == 0 < stayed and pieces.equals(same)
    ids = struct.unpack(f"<{pieces['doc_tokens'][0]}I", b"".join(pieces["ids"].to_pylist()[:-1]))
    assert list(ids) == [*tokenizer.encode("some words, Some (words) twice some words", add_special_tokens=False).ids, 1]

    unfinished = packing._pieces(iter([batch, batch]), PATH, 64, 1, True, 50, keep_words=False)
    next(unfinished)
    unfinished.close()
    encode = packing.encoder(PATH, 50)
    assert held(encode._words) + held(encode._parts) == 0
