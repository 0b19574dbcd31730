"""Token files: texts as ids in Simple-8b blocks, in the order of their keys, and back.

A file set is a Parquet table with one row per block: (shard, start, n_ids, keys, lengths, body).
Shards are ranges of keys; start counts the ids of the shard before the block, which holds whole documents.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import simple8b
from .common import new_path, python_tasks

BLOCK_IDS = 1 << 16
END = 2
MOST_BROADCAST = 1_000_000  # shards, that is write tasks, of 16 bytes each
_MEMO_SIZE, _LATER = 300_000, 100_000  # pieces; the first stay with the worker, the others for a task


def byte_characters() -> dict[int, str]:
    """The character that stands for each byte in byte-level vocabularies: printable ones for
    themselves, the others from 256 on in order."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


class Pieces(dict):
    """Ids of the pieces a worker has met, as little-endian 32-bit numbers.  Pieces repeat far more
    than texts do; once full, the memo keeps the pieces it has, mostly the frequent ones, and the
    latest others are held beside it.  A piece goes straight to the vocabulary's merges, unless the tokenizer normalises texts first."""

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.merge = self.tokenizer.model.tokenize if self.tokenizer.normalizer is None else None
        self.characters = byte_characters()
        self.later: dict[str, bytes] = {}

    def whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _ids(self, piece: str) -> list[int]:
        if self.merge is None:
            return self.whole(piece)
        if piece.isascii() and piece.isprintable():  # only the space is written otherwise
            return [t.id for t in self.merge(piece.replace(" ", self.characters[32]))]
        return [t.id for t in self.merge(piece.encode().decode("latin-1").translate(self.characters))]

    def __missing__(self, piece: str) -> bytes:
        coded = self.later.get(piece)
        if coded is None:
            ids = self._ids(piece)
            coded = struct.pack(f"<{len(ids)}I", *ids)
            if len(self) < _MEMO_SIZE:
                self[piece] = coded
            else:
                if len(self.later) >= _LATER:
                    self.later.clear()
                self.later[piece] = coded
        return coded


_pieces: dict[str, Pieces] = {}


def narrow(pattern: str) -> str | None:
    """The pattern in plain character classes, which split texts of the first 256 characters alike
    and faster.  None if it holds classes of other names."""
    import regex

    every = "".join(map(chr, range(256)))
    names = {name: "".join(re.escape(c) for c in regex.findall(name, every)) for name in (r"\p{L}", r"\p{N}", r"\s")}
    out, inside, i = "", False, 0
    while i < len(pattern):
        name = next((n for n in names if pattern.startswith(n, i)), None)
        if name:
            out += names[name] if inside else f"[{names[name]}]"
            i += len(name)
        elif pattern.startswith(r"\S", i) and not inside:
            out, i = out + f"[^{names[chr(92) + 's']}]", i + 2
        elif pattern[i] == "\\":
            return None
        else:
            inside = pattern[i] == "[" or inside and pattern[i] != "]"
            out, i = out + pattern[i], i + 1
    return out


class Encoder:
    """Encodes texts piece by piece, with the library, each new piece once.

    `pattern` has to be the pre-tokenizer's own split, so that pieces encoded alone and texts
    encoded whole give the same ids.  A text that holds the string of an added token is encoded whole."""

    def __init__(self, vocabulary: str, pattern: str):
        import regex

        self.wide = regex.compile(pattern).findall
        plain = narrow(pattern)
        self.fast = re.compile(plain).findall if plain else None
        if vocabulary not in _pieces:
            _pieces[vocabulary] = Pieces(vocabulary)
        self.pieces = _pieces[vocabulary]

    def split(self, text: str) -> list[str]:
        if self.fast and (text.isascii() or len(text.encode("latin-1", "ignore")) == len(text)):
            return self.fast(text)
        return self.wide(text)

    def ids(self, text: str) -> np.ndarray:
        if any(t in text for t in self.pieces.added):
            return np.array(self.pieces.whole(text), "<u4")
        return np.frombuffer(b"".join(map(self.pieces.__getitem__, self.split(text))), "<u4")


def _encode(vocabulary: str, pattern: str, end: int, key_type: pa.DataType):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, shard = Encoder(vocabulary, pattern), TaskContext.get().partitionId()
        start, keys, lengths, ids, closing = 0, [], [], [], np.array([end], "<u4")

        def block() -> pa.RecordBatch:
            body = simple8b.encode(np.concatenate(ids))
            return pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), pa.array([start], pa.int64()), pa.array([sum(lengths)], pa.int64()),
                 pa.array([keys], pa.list_(key_type)), pa.array([lengths], pa.list_(pa.int64())), pa.array([body], pa.binary())],
                ["shard", "start", "n_ids", "keys", "lengths", "body"])

        held = 0
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                coded = encoder.ids(text.as_py() or "")
                keys.append(key)
                lengths.append(len(coded) + 1)
                ids += [coded, closing]
                held += lengths[-1]
                if held >= BLOCK_IDS:
                    yield block()
                    start, held, keys, lengths, ids = start + held, 0, [], [], []
        if keys:
            yield block()
        encoder.pieces.later.clear()

    return encode


def write_tokens(
    docs: DataFrame, path: str, vocabulary: str, pattern: str, end: int = END, key: str = "doc_id", text: str = "text"
) -> None:
    """Writes the token files of `docs` in ascending order of the key (nulls first; equal keys by
    the hash of their text).  Null texts are empty: just the end id.  Every row is written, repeated ones too;
    strings of added tokens get those tokens' ids, as in the library's plain call; no documents: no blocks; other columns are not written."""
    python_tasks(docs.sparkSession)
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    order = [F.col("key").asc_nulls_first(), F.xxhash64("text")]
    kind = dict(rows.dtypes)["key"]
    arrow = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind]
    rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        _encode(vocabulary, pattern, end, arrow),
        f"shard int, start long, n_ids long, keys array<{kind}>, lengths array<long>, body binary",
    ).write.parquet(path)


def _decode(with_ids: bool):
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                start, keys, lengths = batch.column(0)[i].as_py(), batch.column(1).slice(i, 1).flatten(), batch.column(2)[i].as_py()
                ids = simple8b.decode(batch.column(3)[i].as_py()).astype("<u4")
                ends = np.cumsum(lengths)
                parts = np.split(ids, ends[:-1])
                out = [keys, pa.array(start + ends - lengths), pa.array(lengths, pa.int64()),
                       pa.array([zlib.crc32(p.tobytes()) for p in parts], pa.int64())]
                if with_ids:
                    out.append(pa.ListArray.from_arrays(np.append(0, ends).astype(np.int32), pa.array(ids.astype(np.int64))))
                yield pa.RecordBatch.from_arrays(out, ["key", "start", "n_tokens", "ids_crc32", "ids"][: len(out)])

    return decode


def read_tokens(spark: SparkSession, path: str, key: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """(key, start, n_tokens, ids_crc32 [, ids]) per document of the files at `path`.  start counts
    the ids of all documents before it, over all shards."""
    python_tasks(spark)
    blocks = spark.read.parquet(path)
    kind = dict(blocks.dtypes)["keys"][len("array<") : -1]
    shards = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per shard
    shards = shards.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    if shards.count() < MOST_BROADCAST:
        shards = F.broadcast(shards)
    rows = blocks.join(shards, "shard").select((F.col("earlier") + F.col("start")).alias("start"), "keys", "lengths", "body")
    ids = ", ids array<long>" if with_ids else ""
    return rows.mapInArrow(
        _decode(with_ids), f"key {kind}, start long, n_tokens long, ids_crc32 long{ids}"
    ).withColumnRenamed("key", key)


def through_files(docs: DataFrame, vocabulary: str, pattern: str, **options) -> DataFrame:
    """Writes `docs` to new token files in the shared folder and reads them back."""
    path = new_path(docs.sparkSession, "tokens")
    write_tokens(docs, path, vocabulary, pattern, **options)
    return read_tokens(docs.sparkSession, path, options.get("key", "doc_id"))
