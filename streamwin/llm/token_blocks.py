"""Token ids in files of patched frame-of-reference blocks.

A segment holds the ids of some whole documents one after the other, cut into
blocks of 128. Of each block the smallest id is subtracted, and the rest packed
at a width that suits a percentile of the block; what is wider is patched from
an exception list. The percentile is, block by block, the one that takes least
room. A segment is the bytes of

    magic, number of ids, blocks, exceptions and payload bytes (4 numbers)
    per block: smallest id, start of payload, start of exceptions, width
    payload: 128 differences at the block's width, low bits only
    per exception: place in its block, its bits above the width

The starts make the index: any block is read without those before it.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .text import id_and_text, partitions, slices

BLOCK = 128
PERCENTILES = (75, 90, 97, 100)
SEGMENT_IDS = 1 << 16
# Texts whose words are numbered together.
TEXTS_AT_ONCE = 2048
_MAGIC = b"PFB1"
_HEAD = np.dtype([("ids", "<u4"), ("blocks", "<u4"), ("exceptions", "<u4"), ("payload", "<u4")])
_INDEX = np.dtype([("smallest", "<u4"), ("payload", "<u4"), ("exceptions", "<u4"), ("width", "u1")])
_PATCH = np.dtype([("place", "u1"), ("high", "<u4")])

SEGMENT_SCHEMA = (
    "shard int, segment int, first_id long, n_ids long, doc_ids array<long>, doc_sizes array<int>, blocks binary"
)


def _widths(values: np.ndarray) -> np.ndarray:
    """Bits that each value needs, as bytes, which sort fastest."""
    return np.frexp(values.astype(np.float64))[1].astype(np.uint8)


def pack(ids: np.ndarray) -> bytes:
    """The segment of an array of ids below 2**32."""
    count = len(ids)
    blocks = -(-count // BLOCK)
    grid = np.zeros((blocks, BLOCK), np.int64)
    grid.ravel()[:count] = ids
    if count % BLOCK:
        grid[-1, count % BLOCK :] = ids[-1]
    smallest = grid.min(axis=1, initial=1 << 32) if blocks else np.zeros(0, np.int64)
    grid -= smallest[:, None]
    need = np.sort(_widths(grid), axis=1)
    options = need[:, [BLOCK * p // 100 - 1 for p in PERCENTILES]].astype(np.int64)
    over = np.stack([(need > options[:, [k]]).sum(axis=1) for k in range(len(PERCENTILES))], axis=1)
    best = np.argmin(options * (BLOCK // 8) + over * _PATCH.itemsize, axis=1)
    width = np.take_along_axis(options, best[:, None], 1)[:, 0]

    index = np.zeros(blocks, _INDEX)
    index["smallest"], index["width"] = smallest, width
    sizes = width * (BLOCK // 8)
    index["payload"] = np.cumsum(sizes) - sizes
    rows, places = np.nonzero(grid >> width[:, None])
    patches = np.zeros(len(rows), _PATCH)
    patches["place"], patches["high"] = places, grid[rows, places] >> width[rows]
    index["exceptions"] = np.searchsorted(rows, np.arange(blocks))
    payload = np.zeros(int(sizes.sum()), np.uint8)
    for bits in np.unique(width[width > 0]):
        same = np.flatnonzero(width == bits)
        letters = grid[same].astype("<u4").view(np.uint8).reshape(len(same), BLOCK, 4)
        low = np.unpackbits(letters, axis=2, count=int(bits), bitorder="little")
        packed = np.packbits(low.reshape(len(same), -1), axis=1, bitorder="little")
        payload[index["payload"][same].astype(np.int64)[:, None] + np.arange(packed.shape[1])] = packed
    head = np.array([(count, blocks, len(patches), len(payload))], _HEAD)
    return b"".join((_MAGIC, head.tobytes(), index.tobytes(), payload.tobytes(), patches.tobytes()))


class Segment:
    """Reads the ids of a segment, all or those of some blocks."""

    def __init__(self, data: bytes):
        if data[:4] != _MAGIC:
            raise ValueError("not a segment of token blocks")
        head = np.frombuffer(data, _HEAD, 1, 4)[0]
        at = 4 + _HEAD.itemsize
        self.count = int(head["ids"])
        self.index = np.frombuffer(data, _INDEX, int(head["blocks"]), at)
        at += self.index.nbytes
        self.payload = np.frombuffer(data, np.uint8, int(head["payload"]), at)
        self.patches = np.frombuffer(data, _PATCH, int(head["exceptions"]), at + self.payload.nbytes)

    def blocks(self, first: int, last: int) -> np.ndarray:
        """The ids of blocks ``first`` to ``last - 1``, with the filling of the last one."""
        part = self.index[first:last]
        grid = np.zeros((len(part), BLOCK), np.int64)
        width = part["width"].astype(np.int64)
        for bits in np.unique(width[width > 0]):
            same = np.flatnonzero(width == bits)
            at = part["payload"][same].astype(np.int64)[:, None] + np.arange(int(bits) * BLOCK // 8)
            low = np.unpackbits(self.payload[at], axis=1, bitorder="little").reshape(len(same), BLOCK, int(bits))
            wide = np.zeros((len(same), BLOCK, 32), np.uint8)
            wide[:, :, : int(bits)] = low
            grid[same] = np.packbits(wide, axis=2, bitorder="little").view("<u4")[:, :, 0]
        bounds = np.r_[self.index["exceptions"], len(self.patches)].astype(np.int64)
        patches = self.patches[bounds[first] : bounds[last]]
        rows = np.repeat(np.arange(len(part)), np.diff(bounds[first : last + 1]))
        grid[rows, patches["place"]] |= patches["high"].astype(np.int64) << width[rows]
        return (grid + part["smallest"].astype(np.int64)[:, None]).ravel()

    def ids(self, start: int = 0, stop: int | None = None) -> np.ndarray:
        """Ids ``start`` to ``stop - 1``; only the blocks that hold them are unpacked."""
        stop = self.count if stop is None else min(stop, self.count)
        if start >= stop:
            return np.zeros(0, np.int64)
        first = start // BLOCK
        return self.blocks(first, -(-stop // BLOCK))[start - first * BLOCK : stop - first * BLOCK]


class _Codes(dict):
    """Numbers words as they come; the new ones wait in ``fresh``."""

    def __init__(self):
        super().__init__()
        self.fresh: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        self[word] = code = len(self)
        self.fresh.append(word)
        return code


class _Ragged:
    """Arrays of ids under numbers, in one growing array."""

    def __init__(self):
        self.ids, self.ends = np.zeros(1 << 16, "<u4"), np.zeros(1 << 16, np.int64)
        self.rows = self.size = 0

    def append(self, ids: np.ndarray, sizes: np.ndarray) -> None:
        while self.size + len(ids) > len(self.ids):
            self.ids = np.concatenate((self.ids, np.zeros_like(self.ids)))
        while self.rows + len(sizes) + 1 > len(self.ends):
            self.ends = np.concatenate((self.ends, np.zeros_like(self.ends)))
        self.ids[self.size : self.size + len(ids)] = ids
        self.ends[self.rows + 1 : self.rows + len(sizes) + 1] = self.size + np.cumsum(sizes)
        self.rows, self.size = self.rows + len(sizes), self.size + len(ids)

    def gather(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of some rows, one after the other, and their sizes."""
        starts = self.ends[rows]
        sizes = self.ends[rows + 1] - starts
        ends = np.cumsum(sizes)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + sizes, sizes)
        return self.ids[at], sizes


class WordEncoder:
    """Encodes texts with the tokenizers library, each distinct part of a word once.

    For vocabularies that drop blanks before merging: no token reaches across
    an ASCII blank, so the ids of a text are those of its words in turn. Where
    the vocabulary also parts letters from the marks after them and does not
    tell capitals from small letters, an ASCII word is looked up as its small
    letters and its closing marks.
    """

    CACHED_WORDS = 500_000
    CACHED_PARTS = 900_000

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.words, self.word_ids = _Codes(), _Ragged()
        self.parts, self.part_ids = _Codes(), _Ragged()
        whole = self.tokenizer.encode("a b  the", add_special_tokens=False).ids
        if whole != self._encode(["a", "b", "the"])[0].tolist():
            raise ValueError(f"tokens of {path} reach across blanks: its texts can't be encoded word by word")
        self.parted = self._encode(["Ab.,"])[0].tolist() == self._encode(["ab", ".,"])[0].tolist()

    def _encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = self.tokenizer.encode(words, is_pretokenized=True, add_special_tokens=False)
        owner = np.array([at for at in found.word_ids if at is not None], np.int64)
        return np.array(found.ids, "<u4"), np.bincount(owner, minlength=len(words))

    def _merge(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """As ``_encode`` for small ASCII letters, which the library's normalizing and splitting leave as they are."""
        found = [[token.id for token in self.tokenizer.model.tokenize(word)] for word in words]
        return np.fromiter(chain.from_iterable(found), "<u4"), np.array([len(ids) for ids in found], np.int64)

    def _learn(self) -> None:
        """Ids of the words met for the first time, each made of one or two parts."""
        codes, sizes = [], []
        part = self.parts.__getitem__
        for word in self.words.fresh:
            letters = word.rstrip(b".,!?;:|*$%&#")
            if self.parted and letters.isalpha():
                codes.append(part(letters.lower()))
                if len(letters) < len(word):
                    codes.append(part(word[len(letters) :]))
                    sizes.append(2)
                    continue
            elif word:
                codes.append(part(word))
            sizes.append(1 if word else 0)
        self.words.fresh = []
        if self.parts.fresh:
            fresh = [part.decode() for part in self.parts.fresh]
            plain = np.array([self.parted and part.isascii() and part.isalpha() and part.islower() for part in fresh])
            found = _Ragged()
            found.append(*self._merge([fresh[at] for at in np.flatnonzero(plain)]))
            found.append(*self._encode([fresh[at] for at in np.flatnonzero(~plain)]))
            place = np.argsort(np.r_[np.flatnonzero(plain), np.flatnonzero(~plain)])
            self.part_ids.append(*found.gather(place))
            self.parts.fresh = []
        ids, counts = self.part_ids.gather(np.array(codes, np.int64))
        ends = np.r_[0, np.cumsum(counts)][np.r_[0, np.cumsum(sizes)]]
        self.word_ids.append(ids, np.diff(ends))

    def encode(self, batch: pa.Array) -> list[np.ndarray]:
        """The ids of each text. Arrow cuts and numbers the words; only a batch's distinct ones are looked up here."""
        if len(self.words) > self.CACHED_WORDS:
            self.words, self.word_ids = _Codes(), _Ragged()
        if len(self.parts) > self.CACHED_PARTS:
            self.parts, self.part_ids = _Codes(), _Ragged()
        cut = pc.ascii_split_whitespace(pc.fill_null(batch, ""))
        words = cut.flatten().dictionary_encode()
        distinct = words.dictionary.cast(pa.binary()).to_pylist()
        known = np.fromiter(map(self.words.__getitem__, distinct), np.int64, len(distinct))
        if self.words.fresh:
            self._learn()
        ids, sizes = self.word_ids.gather(known[words.indices.to_numpy()])
        ends = (cut.offsets.to_numpy() - cut.offsets[0].as_py())[1:]
        return np.split(ids, np.r_[0, np.cumsum(sizes)][ends][:-1])


_encoders: dict[str, WordEncoder] = {}


def _segments(batches: Iterator[pa.RecordBatch], vocabulary: str, end_id: int) -> Iterator[pa.RecordBatch]:
    """Encode the sorted documents of a partition and close a segment whenever it is full."""
    if vocabulary not in _encoders:
        _encoders[vocabulary] = WordEncoder(vocabulary)
    shard, number, first, held = TaskContext.get().partitionId(), 0, 0, 0
    doc_ids: list[int | None] = []
    parts: list[np.ndarray] = []

    def close() -> pa.RecordBatch:
        ids = np.concatenate(parts)
        row = [shard, number, first, len(ids), doc_ids, [len(part) for part in parts], pack(ids)]
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary()]
        names = ["shard", "segment", "first_id", "n_ids", "doc_ids", "doc_sizes", "blocks"]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names=names)

    for part in slices(batches, TEXTS_AT_ONCE):
        encoded = _encoders[vocabulary].encode(part.column(1))
        for doc_id, ids in zip(part.column(0).to_pylist(), encoded, strict=True):
            doc_ids.append(doc_id)
            parts.append(np.append(ids, np.uint32(end_id)))
            held += len(parts[-1])
            if held >= SEGMENT_IDS:
                yield close()
                number, first, held, doc_ids, parts = number + 1, first + held, 0, [], []
    if parts:
        yield close()


def write_blocks(
    docs: DataFrame,
    folder: str,
    vocabulary: str,
    *,
    end_id: int = 1,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> None:
    """Write the ids of every whole text, with ``end_id`` after each, in ascending id order.

    The texts are dealt by ranges of the id, so that a shard is one range. A
    row of the files is one segment with the ids and sizes of its documents;
    Spark's writer commits whole tasks, so an executor may be lost. Null ids
    come first; rows that repeat an id are ordered by their text; a null text
    is an empty one and leaves the end id alone. No documents leave no segment.
    """
    spark = docs.sparkSession
    ordered = (
        id_and_text(docs, id_column, text_column)
        .repartitionByRange(partitions(spark), F.col("doc_id").asc_nulls_first())
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    )
    encoded = ordered.mapInArrow(lambda batches: _segments(batches, vocabulary, end_id), SEGMENT_SCHEMA)
    encoded.write.option("compression", "none").parquet(folder)


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of each document, from the files alone.

    ``start`` counts the ids of all documents before. The sizes of the shards,
    one row each, are summed up to give where a shard starts.
    """
    segments = spark.read.schema(SEGMENT_SCHEMA).parquet(folder)
    shards = segments.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = shards.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shard_start"))
    read = segments.select("shard", "first_id", "doc_ids", "doc_sizes", "blocks").mapInArrow(
        _read, "shard int, doc_id long, offset long, n_tokens long, ids_crc32 long"
    )
    return read.join(starts, "shard").select(
        "doc_id", (F.col("shard_start") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32"
    )


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches, 1):
        row = {name: column[0].as_py() for name, column in zip(part.schema.names, part.columns, strict=True)}
        ids = Segment(row["blocks"]).ids().astype("<u4")
        sizes = np.array(row["doc_sizes"], np.int64)
        ends = np.cumsum(sizes)
        checks = [zlib.crc32(ids[end - size : end].tobytes()) for size, end in zip(sizes, ends, strict=True)]
        columns = [
            pa.array([row["shard"]] * len(sizes), pa.int32()),
            pa.array(row["doc_ids"], pa.int64()),
            pa.array(row["first_id"] + ends - sizes),
            pa.array(sizes),
            pa.array(checks, pa.int64()),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=["shard", "doc_id", "offset", "n_tokens", "ids_crc32"])


def read_ids(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, ids`` of each document, the end id included."""

    def ids(batches):
        for part in slices(batches, 1):
            stream = Segment(part.column(2)[0].as_py()).ids().astype(np.int64)
            sizes = part.column(1)[0].as_py()
            bounds = pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32))
            values = pa.ListArray.from_arrays(bounds, pa.array(stream))
            yield pa.RecordBatch.from_arrays([pa.array(part.column(0)[0].as_py(), pa.int64()), values], names=["doc_id", "ids"])

    segments = spark.read.schema(SEGMENT_SCHEMA).parquet(folder)
    return segments.select("doc_ids", "doc_sizes", "blocks").mapInArrow(ids, "doc_id long, ids array<long>")
