"""Removal of repeated passages, found by anchors at difference-cover positions.

A window of 13 words that occurs in two texts begins in them at two places that
need not agree modulo anything. The cover {0, 1, 3} modulo 7 holds, for any two
places, a common shift below 7 that takes both into the cover. So if every run
of 7 words that begins at a cover place is hashed, two equal windows share one
of these anchors at the same place inside. Only windows around an anchor that
other documents have too are looked at in full.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .hashing import multipliers, window_hashes, word_hashes
from .text import nullable, partitions, with_nulls

WINDOW = 13
PERIOD = 7
COVER = (0, 1, 3)
_ANCHOR = WINDOW - PERIOD + 1
_ANCHOR_FACTORS = multipliers(_ANCHOR, 1)
_WINDOW_FACTORS = multipliers(WINDOW, 2)
_LOW = np.uint64(0xFFFFFFFF)

_POSTED = "bucket int, block int, kind int, keys binary, extra binary"
_REPLY = "block int, bucket int, kind int, mask binary"


class Block:
    """The texts of one block: their word hashes, anchors and windows."""

    def __init__(self, table: pa.Table, buckets: int):
        self.buckets = buckets
        self.ids = table.column("doc_id").to_pylist()
        self.words = [(text or b"").split() for text in table.column("text").cast(pa.binary()).to_pylist()]
        known = [len(words) >= WINDOW and doc_id is not None for doc_id, words in zip(self.ids, self.words, strict=True)]
        self.rows = np.flatnonzero(known)
        self.hashes = [word_hashes(self.words[row]) for row in self.rows]
        self.sizes = np.array([len(hashes) for hashes in self.hashes], np.int64)
        self.docs = np.array([self.ids[row] for row in self.rows], np.int64)

    def anchors(self) -> None:
        """Places and keys of all anchors; ``found`` are the distinct ones, in order of bucket and key."""
        places, keys = [], []
        for hashes in self.hashes:
            at = np.arange(len(hashes) - _ANCHOR + 1)
            at = at[np.isin(at % PERIOD, COVER)]
            places.append(at)
            keys.append(window_hashes(hashes, _ANCHOR_FACTORS)[at])
        self.places = np.concatenate([*places, np.zeros(0, np.int64)])
        self.owner = np.repeat(np.arange(len(places)), [len(at) for at in places])
        keys = np.concatenate([*keys, np.zeros(0, np.uint64)])
        keys = ((keys >> np.uint64(32)) % np.uint64(self.buckets)) << np.uint64(32) | keys & _LOW
        self.found, self.number = np.unique(keys, return_inverse=True)
        docs = self.docs[self.owner]
        least = np.full(len(self.found), np.iinfo(np.int64).max)
        most = np.full(len(self.found), np.iinfo(np.int64).min)
        np.minimum.at(least, self.number, docs)
        np.maximum.at(most, self.number, docs)
        self.several = least < most

    def windows(self, shared: np.ndarray) -> None:
        """The windows around shared anchors, with the least id of each distinct one in the block."""
        hit = shared[self.number]
        owner, places = self.owner[hit], self.places[hit]
        starts = (places[:, None] - np.arange(PERIOD)).ravel()
        owner = np.repeat(owner, PERIOD)
        fits = (starts >= 0) & (starts <= self.sizes[owner] - WINDOW)
        offset = np.cumsum(self.sizes) - self.sizes
        wanted = np.unique(offset[owner[fits]] + starts[fits])
        self.window_owner = np.searchsorted(offset, wanted, "right") - 1
        self.starts = wanted - offset[self.window_owner]
        keys = np.zeros(len(wanted), np.uint64)
        bounds = np.searchsorted(self.window_owner, np.arange(len(self.hashes) + 1))
        for row, hashes in enumerate(self.hashes):
            first, last = bounds[row], bounds[row + 1]
            if first < last:
                keys[first:last] = window_hashes(hashes, _WINDOW_FACTORS)[self.starts[first:last]]
        self.window_keys, self.window_number = _by_bucket(keys, self.buckets)
        self.least = np.full(len(self.window_keys), np.iinfo(np.int64).max)
        np.minimum.at(self.least, self.window_number, self.docs[self.window_owner])

    def repeated(self, earlier: np.ndarray) -> list[np.ndarray]:
        """For each row with ids and windows, which words a repeated window covers."""
        docs = self.docs[self.window_owner]
        hit = earlier[self.window_number] | (docs > self.least[self.window_number])
        bounds = np.searchsorted(self.window_owner[hit], np.arange(len(self.hashes) + 1))
        starts, covered = self.starts[hit], []
        for row, size in enumerate(self.sizes):
            edges = np.zeros(size + 1, np.int64)
            at = starts[bounds[row] : bounds[row + 1]]
            np.add.at(edges, at, 1)
            np.add.at(edges, at + WINDOW, -1)
            covered.append(np.cumsum(edges)[:size] > 0)
        return covered


def _by_bucket(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order of bucket and key, and the number of each key among them."""
    found, number = np.unique(keys, return_inverse=True)
    order = np.argsort(found % np.uint64(buckets), kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return found[order], place[number]


def _bounds(bucket: np.ndarray, buckets: int) -> np.ndarray:
    return np.searchsorted(bucket, np.arange(buckets + 1, dtype=bucket.dtype))


def _posted(block: int, kind: int, bounds: np.ndarray, keys: np.ndarray, extra) -> pa.Table:
    """One row for each bucket that gets keys; ``extra`` gives the bytes that go with a slice of them."""
    used = np.flatnonzero(np.diff(bounds))
    slices = [(bounds[bucket], bounds[bucket + 1]) for bucket in used]
    columns = [
        pa.array(used, pa.int32()),
        pa.array(np.full(len(used), block), pa.int32()),
        pa.array(np.full(len(used), kind), pa.int32()),
        pa.array([keys[first:last].tobytes() for first, last in slices], pa.binary()),
        pa.array([extra(first, last) for first, last in slices], pa.binary()),
    ]
    return pa.table(columns, names=["bucket", "block", "kind", "keys", "extra"])


def _replies(table: pa.Table, flags: np.ndarray, sizes: list[int]) -> pa.Table:
    """The flags of each posted row, packed, for the block it came from."""
    parts = np.split(flags, np.cumsum(sizes)[:-1])
    masks = pa.array([np.packbits(part).tobytes() for part in parts], pa.binary())
    return pa.table([table["block"], table["bucket"], table["kind"], masks], names=["block", "bucket", "kind", "mask"])


def _ranked(arrays: list[np.ndarray]) -> tuple[np.ndarray, int]:
    """The number of each value among the distinct ones of all arrays."""
    found, number = np.unique(np.concatenate(arrays), return_inverse=True)
    return number, len(found)


def _shared_anchors(table: pa.Table) -> pa.Table:
    """Which anchors of a bucket more than one document has."""
    keys = [np.frombuffer(data, "<u4") for data in table["keys"].to_pylist()]
    sizes = [len(part) for part in keys]
    several = [
        np.unpackbits(np.frombuffer(data, np.uint8), count=size)
        for data, size in zip(table["extra"].to_pylist(), sizes, strict=True)
    ]
    number, count = _ranked(keys)
    seen = np.bincount(number, 1 + np.concatenate(several), count)
    return _replies(table, seen[number] > 1, sizes)


def _earlier_windows(table: pa.Table) -> pa.Table:
    """Which windows of a bucket a document of another block with a smaller id has."""
    keys = [np.frombuffer(data, "<u8") for data in table["keys"].to_pylist()]
    docs = np.concatenate([_ids(data, len(part)) for data, part in zip(table["extra"].to_pylist(), keys, strict=True)])
    number, count = _ranked(keys)
    least = np.full(count, np.iinfo(np.int64).max)
    np.minimum.at(least, number, docs)
    return _replies(table, least[number] < docs, [len(part) for part in keys])


def _id_bytes(ids: np.ndarray) -> bytes:
    """Ids as their least one and what each has above it, in as few bytes as that needs."""
    base = ids.min()
    above = ids.view(np.uint64) - base.view(np.uint64)
    return base.tobytes() + above.astype(np.min_scalar_type(above.max())).tobytes()


def _ids(data: bytes, count: int) -> np.ndarray:
    base = np.frombuffer(data, np.uint64, 1)
    above = np.frombuffer(data, f"u{(len(data) - 8) // count}", count, 8)
    return (above.astype(np.uint64) + base).view(np.int64)


def _masks(replies: pa.Table, kind: int, bounds: np.ndarray) -> np.ndarray:
    """The flags of all of a block's keys, put together from the buckets."""
    flags = np.zeros(bounds[-1], bool)
    for bucket, of, mask in zip(*(replies[name].to_pylist() for name in ("bucket", "kind", "mask")), strict=True):
        if of == kind:
            first, last = bounds[bucket], bounds[bucket + 1]
            flags[first:last] = np.unpackbits(np.frombuffer(mask, np.uint8), count=last - first)
    return flags


def remove_repeats(
    docs: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    keep: tuple[str, ...] = (),
    tidy: bool = True,
    blocks: int | None = None,
) -> DataFrame:
    """Texts without the words of windows that a document with a smaller id has too.

    ``doc_id, text, n_words, n_removed`` and a struct ``kept`` of the columns
    named in ``keep``. The text is the words left, joined by blanks; with
    ``tidy=False`` a text that loses nothing stays as it is. Windows are judged
    on the input. A null text has no words; a row with a null id neither loses
    words nor takes them from others; rows that repeat an id don't take from
    each other, only from larger ids.

    Texts are dealt once, by hash, into blocks that each fit a task. A block
    posts its distinct anchors to buckets, each in one packed row, and gets back
    one bit for each: whether other documents have it. It then posts the
    windows around those, with the least id it has for each, and gets back
    whether a smaller one exists. However often a passage occurs, a block posts
    it once, so no bucket gets more of it than there are blocks; no pairs of
    documents are formed. The exchange of texts is used three times.
    """
    count = blocks or partitions(docs.sparkSession)
    spread = F.pmod(F.xxhash64(id_column, text_column), F.lit(2 * count)).cast("int")
    carried = F.struct(*(F.col(f"`{name}`") for name in keep)) if keep else F.lit(True)
    dealt = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.col(text_column).alias("text"),
        carried.alias("kept"),
        spread.alias("block"),
    ).repartition(count, "block")
    texts = dealt.groupBy("block")

    def post_anchors(table: pa.Table) -> pa.Table:
        block = Block(table, count)
        block.anchors()
        bounds = _bounds((block.found >> np.uint64(32)).astype(np.int64), count)
        keys = (block.found & _LOW).astype("<u4")
        return _posted(
            table["block"][0].as_py(), 0, bounds, keys, lambda a, b: np.packbits(block.several[a:b]).tobytes()
        )

    def with_windows(table: pa.Table, replies: pa.Table) -> tuple[Block, np.ndarray]:
        block = Block(table, count)
        block.anchors()
        shared = _masks(replies, 0, _bounds((block.found >> np.uint64(32)).astype(np.int64), count))
        block.windows(shared)
        return block, _bounds((block.window_keys % np.uint64(count)).astype(np.int64), count)

    def post_windows(table: pa.Table, replies: pa.Table) -> pa.Table:
        block, bounds = with_windows(table, replies)
        return _posted(
            table["block"][0].as_py(),
            1,
            bounds,
            block.window_keys.astype("<u8"),
            lambda a, b: _id_bytes(block.least[a:b]),
        )

    def cut(table: pa.Table, replies: pa.Table) -> pa.Table:
        block, bounds = with_windows(table, replies)
        covered = dict(zip(block.rows.tolist(), block.repeated(_masks(replies, 1, bounds)), strict=True))
        left, removed = [], []
        whole = table["text"].cast(pa.binary()).to_pylist()
        for row, words in enumerate(block.words):
            gone = covered.get(row)
            lost = int(gone.sum()) if gone is not None else 0
            removed.append(lost)
            if lost:
                words = [word for word, out in zip(words, gone.tolist(), strict=True) if not out]
            left.append(b" ".join(words) if lost or tidy else whole[row])
        columns = [
            table["doc_id"],
            pa.array(left, pa.binary()).cast(pa.string()),
            pa.array([len(words) for words in block.words], pa.int64()),
            pa.array(removed, pa.int64()),
            with_nulls(table["kept"]),
        ]
        return pa.table(columns, names=["doc_id", "text", "n_words", "n_removed", "kept"])

    anchors = texts.applyInArrow(post_anchors, _POSTED)
    shared = anchors.groupBy("bucket").applyInArrow(_shared_anchors, _REPLY)
    windows = texts.cogroup(shared.groupBy("block")).applyInArrow(post_windows, _POSTED)
    earlier = windows.groupBy("bucket").applyInArrow(_earlier_windows, _REPLY)
    replies = shared.unionByName(earlier).groupBy("block")
    result = T.StructType().add("doc_id", "long").add("text", "string").add("n_words", "long").add("n_removed", "long")
    return texts.cogroup(replies).applyInArrow(cut, result.add("kept", nullable(dealt.schema["kept"].dataType)))
