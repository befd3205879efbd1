"""Power-of-two packing: every document is cut into pieces whose lengths are powers of two.

A document of n ids becomes full pieces of ``max_length`` and then one piece per set bit of the
remainder, largest first.  A piece is a sequence of its own, pieces of equal length form a bucket,
so no sequence crosses documents and none is padded.

Defined cases: null or empty text is the separator id alone; a null ``doc_id`` stays null; repeated
rows are packed once each; an empty table gives no rows; further columns are ignored.

Plan: one pass over the table, no shuffle.  Memory is one Arrow batch and two bounded word tables per
worker.
"""

from __future__ import annotations

import functools
import json
import struct
import zlib
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import BoundedTable, release, trim

MAX_LENGTH = 2048
SEPARATOR_ID = 1
#: Most words in each of a worker's tables.
WORD_TABLE = 100_000

# Characters for which lower-casing and letter classes are the same in every Unicode version.
_ENDS = frozenset(b".,;:!?")
_PLAIN = regex.compile("[!-~¡-¬®-ÿ]+")


def _byte_letters() -> list[str]:
    """The printable character that byte-level vocabularies use for each byte."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in printable else next(spare)) for b in range(256)]


class Encoder:
    """Ids of whole texts as little-endian unsigned 32-bit bytes.

    Where the tokenizer drops white space and never merges across it, ids are looked up word by word;
    any other tokenizer encodes the whole text.  Both give what ``Tokenizer.encode`` gives.
    """

    def __init__(self, path: str, word_table: int = WORD_TABLE):
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._model = self._tokenizer.model
        with open(path, encoding="utf-8") as file:
            config = json.load(file)
        self._split = self._word_pattern(config)
        self._marks = [t["content"] for t in config.get("added_tokens", [])]
        self._letters = _byte_letters()
        self._parts = BoundedTable(self._encode_part, word_table)
        self._words = BoundedTable(self._encode_word, word_table)

    @staticmethod
    def _word_pattern(config: dict):
        """The pattern of the parts of a word, if the tokenizer works on words between white space."""
        normal = config.get("normalizer") or {}
        steps = [s.get("type") for s in normal.get("normalizers", [])]
        parts = (config.get("pre_tokenizer") or {}).get("pretokenizers", [])
        known = (
            steps == ["NFC", "Replace", "Lowercase"]
            and normal["normalizers"][1] == {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}
            and [p.get("type") for p in parts] == ["Split", "ByteLevel"]
            and parts[0].get("behavior") == "Removed"
            and parts[0].get("invert") is True
            and not parts[1].get("add_prefix_space")
            and not parts[1].get("use_regex")
            and config.get("post_processor") is None
            and not any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") for t in config.get("added_tokens", []))
        )
        return regex.compile(parts[0]["pattern"]["Regex"]) if known else None

    def _whole(self, text: str) -> bytes:
        ids = self._tokenizer.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def _encode_part(self, part: str) -> bytes:
        mapped = "".join([self._letters[b] for b in part.encode()])
        return b"".join([t.id.to_bytes(4, "little") for t in self._model.tokenize(mapped)])

    def _encode_word(self, word: bytes) -> bytes:
        # Most words are ASCII letters, or those and one mark behind them: parts that need no pattern.
        if word.isalpha():
            return self._parts[word.lower().decode()]
        if word[-1] in _ENDS and word[:-1].isalpha():
            return self._parts[word[:-1].lower().decode()] + self._parts[chr(word[-1])]
        text = word.decode()
        if not _PLAIN.fullmatch(text) or any(mark in text for mark in self._marks):
            return self._whole(text)
        return b"".join([self._parts[p] for p in self._split.findall(text.lower())])

    def __call__(self, text: str) -> bytes:
        if self._split is None:
            return self._whole(text)
        # Bytes split at ASCII white space only; other space characters stay inside a word.
        return b"".join(map(self._words.__getitem__, text.encode().split()))

    def forget(self) -> None:
        """Drop the words looked up so far; the vocabulary stays."""
        self._parts.forget()
        self._words.forget()


@functools.lru_cache(maxsize=2)
def encoder(path: str, word_table: int) -> Encoder:
    """One encoder per worker and vocabulary."""
    return Encoder(path, word_table)


def piece_lengths(n: int, max_length: int = MAX_LENGTH) -> list[int]:
    """Lengths of the pieces of a document of ``n`` ids: full ones, then the binary digits of the rest."""
    rest = n % max_length
    digits = [1 << k for k in range(max_length.bit_length() - 2, -1, -1) if rest >> k & 1]
    return [max_length] * (n // max_length) + digits


def _pieces(batches: Iterator[pa.RecordBatch], path: str, max_length: int, separator: int, with_ids: bool, word_table: int, keep_words: bool):
    encode = encoder(path, word_table)
    try:
        yield from _cut(batches, encode, max_length, separator, with_ids)
    finally:
        if not keep_words:
            encode.forget()
        release()


def _cut(batches: Iterator[pa.RecordBatch], encode: Encoder, max_length: int, separator: int, with_ids: bool) -> Iterator[pa.RecordBatch]:
    tail = struct.pack("<I", separator)
    for batch in batches:
        rows: list[tuple] = []
        ids: list[bytes] = []
        held = 0

        def flush():
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(),) * 5, strict=True)]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            if with_ids:
                columns.append(pa.array(ids, pa.binary()))
                names.append("ids")
            out = pa.RecordBatch.from_arrays(columns, names)
            rows.clear()
            ids.clear()
            return out

        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            data = memoryview(encode(text.as_py() or "") + tail)
            n, start = len(data) // 4, 0
            for length in piece_lengths(n, max_length):
                piece = data[4 * start : 4 * (start + length)]
                rows.append((doc_id, start, length, zlib.crc32(piece), n))
                if with_ids:
                    ids.append(bytes(piece))
                    held += len(piece)
                start += length
                if len(rows) >= 10_000 or held > 1 << 21:
                    held = 0
                    yield flush()
                    trim()
        if rows:
            yield flush()


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    *,
    max_length: int = MAX_LENGTH,
    separator_id: int = SEPARATOR_ID,
    with_ids: bool = True,
    word_table: int = WORD_TABLE,
    keep_words: bool = False,
) -> DataFrame:
    """Pieces of every document: doc_id, sequence_id, offset, start, length, ids_crc32, doc_tokens and ids.

    ``ids`` holds little-endian unsigned 32-bit ids; without it only the digest columns are made.
    ``word_table`` bounds the entries of a worker's tables, about 1.5 kB for each; larger ones are faster where many words are rare.
    A task's words are forgotten when it ends, as workers go on to the tasks of other stages; ``keep_words`` hands them to the worker's next task.
    ``length`` is the bucket.  ``sequence_id`` is unique; ``offset`` is 0 as a piece fills its sequence.
    """
    if max_length < 1 or max_length & (max_length - 1):
        raise ValueError("max_length must be a power of two")
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + ", ids binary" * with_ids
    pieces = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        functools.partial(_pieces, path=tokenizer_path, max_length=max_length, separator=separator_id, with_ids=with_ids, word_table=word_table, keep_words=keep_words),
        schema,
    )
    return pieces.withColumns({"sequence_id": F.monotonically_increasing_id(), "offset": F.lit(0).cast("long")})


def write_buckets(pieces: DataFrame, path: str) -> None:
    """One folder per bucket of equal lengths, so that a reader draws batches without padding."""
    pieces.write.partitionBy("length").parquet(path)
