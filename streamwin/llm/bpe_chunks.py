"""BPE ids by content-defined chunks: what documents share is encoded once.

A rolling hash over the last 16 bytes cuts every text at places that depend on
nothing but the bytes around them, so equal passages fall into equal chunks
wherever they stand. Distinct chunks are gathered by their 128-bit hash, encoded
once, and their ids sent back to the batches of documents that hold them.

A cut may lie inside a word. So of a chunk only what lies between its first and
its last blank is encoded with it. The rest makes the joins: a join runs from the
last blank of a chunk to the first blank of the next one, over as many chunks as
have no blank at all, and is encoded anew. For the vocabularies admitted here
the encoding starts afresh at every blank, so ids to both sides of the join are
those of the whole text, and the two agree exactly.

    scan -> batches -> (bucket of chunks) encode once -> (batch) put together

Two shuffles: the distinct chunks of a batch, and their ids. Texts themselves
are never shuffled; a batch remembers its documents as lists of chunk numbers.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .hashing import multipliers
from .text import id_and_text, partitions, slices, utf8

# A cut is where the top bits of the hash are zero, one place in 512.
CUT_BITS = 9
LEAST_CHUNK, MOST_CHUNK = 64, 4096
BATCH_BYTES = 16 << 20
_LETTERS = (multipliers(256, 11) >> np.uint64(32)).astype(np.uint16)
_KEY = 16
# Chunks and ids are shuffled packed tightly: it costs less than what it saves.
_LEVEL = 9
_WORDS_AT_ONCE = 2000

_ROW = "bucket int, batch binary, kind int, keys binary, sizes binary, body binary"
_POST, _RECIPE, _REPLY = 0, 1, 2
# Texts with one of these must not change what the words around them give.
_PROBES = ("a", "the", "The.", "x1", "'s", "it's", "é", "é", "日本", "...", "<|endoftext|>", "\U0001f600", "́")


def places_to_cut(letters: np.ndarray) -> np.ndarray:
    """Places before which the rolling hash of the 16 bytes behind is zero in its top bits.

    The hash of a window is the sum of its letters' numbers, each doubled once
    for each place it lies back; it is built by doubling windows. Only starts
    of characters are cut at.
    """
    hashes = _LETTERS[letters]
    for width in (1, 2, 4, 8):
        wider = hashes.copy()
        wider[width:] += hashes[:-width] << np.uint16(width)
        hashes = wider
    hit = (hashes[:-1] >> np.uint16(16 - CUT_BITS)) == 0
    return np.flatnonzero(hit & ((letters[1:] & 0xC0) != 0x80)) + 1


def chunks_of(text: bytes) -> list[bytes]:
    """The chunks of a UTF-8 text, each 64 to 4096 bytes but for the last."""
    if not text:
        return []
    letters, bounds, last = np.frombuffer(text, np.uint8), [0], 0
    for place in chain(places_to_cut(letters).tolist(), (len(text),)):
        while place - last > MOST_CHUNK:
            last += MOST_CHUNK
            while text[last] & 0xC0 == 0x80:
                last -= 1
            bounds.append(last)
        if place - last >= LEAST_CHUNK:
            bounds.append(place)
            last = place
    if bounds[-1] < len(text):
        bounds.append(len(text))
    return [text[start:end] for start, end in zip(bounds, bounds[1:], strict=False)]


class Vocabulary:
    """A tokenizer file whose encoding starts afresh at every ASCII blank."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        parts = [self.tokenizer.encode(text, add_special_tokens=False).ids for text in _PROBES]
        for blank in " \t\n\x0b\x0c\r":
            joined = self.tokenizer.encode(blank.join(["", *_PROBES, ""]), add_special_tokens=False).ids
            if joined != list(chain.from_iterable(parts)):
                raise ValueError(f"{path}: tokens of this vocabulary reach across blanks")
        self.ids = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words one after the other, and how many each has."""
        ids, counts = [np.zeros(0, self.ids)], [np.zeros(0, np.int64)]
        for start in range(0, len(words), _WORDS_AT_ONCE):
            some = words[start : start + _WORDS_AT_ONCE]
            found = self.tokenizer.encode(some, is_pretokenized=True, add_special_tokens=False)
            owner = np.array([at for at in found.word_ids if at is not None], np.int64)
            ids.append(np.array(found.ids, self.ids))
            counts.append(np.bincount(owner, minlength=len(some)))
        return np.concatenate(ids), np.concatenate(counts)

    def tokens(self) -> np.ndarray:
        """The token of each id, as text."""
        size = 1 + max(self.tokenizer.get_vocab(with_added_tokens=True).values())
        return np.array([self.tokenizer.id_to_token(at) or "" for at in range(size)], object)


_vocabularies: dict[str, Vocabulary] = {}
_tokens: dict[str, np.ndarray] = {}


def _vocabulary(path: str) -> Vocabulary:
    if path not in _vocabularies:
        _vocabularies[path] = Vocabulary(path)
    return _vocabularies[path]


def gather(values: np.ndarray, sizes: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values of some rows of a ragged array, one after the other, and the rows' sizes."""
    taken = sizes[rows]
    ends = np.cumsum(taken)
    shift = (np.cumsum(sizes) - sizes)[rows] - (ends - taken)
    return values[np.arange(ends[-1] if len(ends) else 0) + np.repeat(shift, taken)], taken


def _packed(*parts: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=_LEVEL).compress(b"".join(parts))


def _unpacked(body: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(body)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.binary(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
    names = ["bucket", "batch", "kind", "keys", "sizes", "body"]
    columns = zip(*rows, strict=True) if rows else [[]] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def _post(ids: list[int | None], texts: list[bytes], buckets: int) -> pa.RecordBatch:
    """One batch of documents: its distinct chunks for their buckets, and its recipe.

    Chunks are numbered by bucket. The recipe holds how many chunks a document
    has, the ids, which of them are null, and the chunk numbers.
    """
    number: dict[bytes, int] = {}
    bodies: list[bytes] = []
    order, counts, mark = [], [], xxhash.xxh3_128()
    for doc_id, text in zip(ids, texts, strict=True):
        mark.update(b"%r:%d:" % (doc_id, len(text)))
        mark.update(text)
        chunks = chunks_of(text)
        counts.append(len(chunks))
        for chunk in chunks:
            key = xxhash.xxh3_128_digest(chunk)
            at = number.setdefault(key, len(number))
            if at == len(bodies):
                bodies.append(chunk)
            order.append(at)
    batch, keys = mark.digest(), list(number)
    bucket = np.frombuffer(b"".join(keys), "<u8")[::2] % np.uint64(buckets)
    by_bucket = np.argsort(bucket, kind="stable")
    place = np.empty(len(keys), np.uint32)
    place[by_bucket] = np.arange(len(keys))
    ends = np.searchsorted(bucket[by_bucket], np.arange(buckets + 1, dtype=np.uint64))
    rows = []
    for at in np.flatnonzero(np.diff(ends)).tolist():
        mine = by_bucket[ends[at] : ends[at + 1]].tolist()
        sizes = _packed(np.array([len(bodies[k]) for k in mine], "<u2").tobytes())
        rows.append((at, batch, _POST, b"".join(keys[k] for k in mine), sizes, _packed(*(bodies[k] for k in mine))))
    null = np.array([doc_id is None for doc_id in ids], np.uint8)
    known = np.array([doc_id or 0 for doc_id in ids], "<i8")
    recipe = _packed(known.tobytes(), null.tobytes(), place[np.array(order, np.int64)].astype("<u4").tobytes())
    rows.append((int.from_bytes(batch[:4], "little") % buckets, batch, _RECIPE, None, _packed(np.array(counts, "<u4").tobytes()), recipe))
    return _rows(rows)


def _posts(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    ids: list[int | None] = []
    held: list[bytes] = []
    size = 0
    for part in slices(batches):
        for doc_id, text in zip(part.column(0).to_pylist(), utf8(part.column(1)), strict=True):
            ids.append(doc_id)
            held.append(text)
            size += len(text) + 64
            if size >= BATCH_BYTES:
                yield _post(ids, held, buckets)
                ids, held, size = [], [], 0
    if ids:
        yield _post(ids, held, buckets)


def _encode_bucket(table: pa.Table, vocabulary: str) -> pa.Table:
    """Encode each distinct chunk of a bucket once; recipes pass.

    A reply holds, for each chunk posted, the number of its ids and the sizes of
    what lies before its first and after its last blank, in the order of the
    post; then all ids and all those ends of chunks. A chunk without a blank
    comes back whole, with a size of -1 behind it.
    """
    model = _vocabulary(vocabulary)
    posts = [row for row in table.to_pylist() if row["kind"] == _POST]
    number: dict[bytes, int] = {}
    chunks: list[bytes] = []
    wanted = []
    for post in posts:
        body, keys = _unpacked(post["body"]), post["keys"]
        ends = np.cumsum(np.frombuffer(_unpacked(post["sizes"]), "<u2"), dtype=np.int64).tolist()
        mine, start = [], 0
        for at, end in enumerate(ends):
            found = number.setdefault(keys[_KEY * at : _KEY * at + _KEY], len(number))
            if found == len(chunks):
                chunks.append(body[start:end])
            mine.append(found)
            start = end
        wanted.append(np.array(mine, np.int64))
    ids, counts, first, last = _chunk_ids(model, chunks)
    del chunks
    head, tail = _sizes(first), np.where(last.is_null(), -1, _sizes(last))
    heads, tails = (np.frombuffer(b"".join(ends.drop_null().to_pylist()), np.uint8) for ends in (first, last))
    rows = []
    for post, mine in zip(posts, wanted, strict=True):
        sizes = np.stack((counts[mine], head[mine], tail[mine])).astype("<i2")
        parts = ((ids, counts), (heads, head), (tails, np.maximum(tail, 0)))
        body = _packed(*(gather(values, size, mine)[0].tobytes() for values, size in parts))
        rows.append((post["bucket"], post["batch"], _REPLY, None, _packed(sizes.tobytes()), body))
    replies = pa.Table.from_batches([_rows(rows)])
    recipes = table.filter(pc.equal(table["kind"], _RECIPE)).select(replies.schema.names)
    return pa.concat_tables([replies, recipes.cast(replies.schema)])


def _sizes(column: pa.Array) -> np.ndarray:
    return np.asarray(pc.fill_null(pc.binary_length(column), 0)).astype(np.int64)


def _chunk_ids(model: Vocabulary, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray, pa.Array, pa.Array]:
    """Ids between the first and the last blank of each chunk, their number, and what lies before and after.

    Each distinct word among them is given to the library once.
    """
    words = pc.ascii_split_whitespace(pa.array(chunks, pa.binary()).cast(pa.string()))
    ends = np.asarray(words.offsets).astype(np.int64)
    values = words.values
    first = values.take(pa.array(ends[:-1])).cast(pa.binary())
    several = np.diff(ends) > 1
    last = values.take(pa.array(np.where(several, ends[1:] - 1, 0), mask=~several)).cast(pa.binary())
    inner = np.ones(len(values), bool)
    inner[ends[:-1]] = inner[ends[1:] - 1] = False
    coded = values.filter(pa.array(inner)).dictionary_encode()
    word_ids, word_sizes = model.encode(coded.dictionary.to_pylist())
    ids, taken = gather(word_ids, word_sizes, np.asarray(coded.indices).astype(np.int64))
    bounds = np.r_[0, np.cumsum(taken)][np.r_[0, np.cumsum(np.maximum(np.diff(ends) - 2, 0))]]
    return ids, np.diff(bounds), first, last


def _put_together(table: pa.Table, vocabulary: str) -> pa.Table:
    """The ids of a batch's documents, from its recipe and the replies to its chunks."""
    model, rows = _vocabulary(vocabulary), table.to_pylist()
    recipe = next((row for row in rows if row["kind"] == _RECIPE), None)
    if recipe is None:
        raise RuntimeError("a batch came out otherwise when its task ran again; write the documents to a table first")
    counts = np.frombuffer(_unpacked(recipe["sizes"]), "<u4").astype(np.int64)
    body, docs = _unpacked(recipe["body"]), len(counts)
    doc_ids = pa.array(np.frombuffer(body, "<i8", docs), pa.int64(), mask=np.frombuffer(body, np.uint8, docs, 8 * docs) > 0)
    order = np.frombuffer(body, "<u4", -1, 9 * docs).astype(np.int64)

    ids, inner, heads, tails = [np.zeros(0, model.ids)], [np.zeros(0, np.int64)], [], []
    for row in sorted((row for row in rows if row["kind"] == _REPLY), key=lambda row: row["bucket"]):
        count, head, tail = np.frombuffer(_unpacked(row["sizes"]), "<i2").reshape(3, -1).astype(np.int64)
        body, at = _unpacked(row["body"]), int(count.sum()) * model.ids.itemsize
        ids.append(np.frombuffer(body, model.ids, int(count.sum())))
        inner.append(count)
        for sizes, found in ((head, heads), (tail, tails)):
            for size in sizes.tolist():
                found.append(None if size < 0 else body[at : at + size])
                at += max(size, 0)
    ids, inner = np.concatenate(ids), np.concatenate(inner)
    if len(order) and len(inner) <= order.max():
        raise RuntimeError("a batch came out otherwise when its task ran again; write the documents to a table first")

    # Joins are numbered behind the chunks, so that a document is a list of numbers.
    joins: dict[bytes, int] = {}
    pieces, per_doc, start = [], [], 0
    for count in counts.tolist():
        before, join = len(pieces), b""
        for chunk in order[start : start + count].tolist():
            join += heads[chunk]
            if tails[chunk] is not None:
                pieces.append(len(inner) + joins.setdefault(join, len(joins)))
                pieces.append(chunk)
                join = tails[chunk]
        pieces.append(len(inner) + joins.setdefault(join, len(joins)))
        per_doc.append(len(pieces) - before)
        start += count
    join_ids, join_sizes = model.encode([join.decode() for join in joins])
    values, taken = gather(np.concatenate((ids, join_ids)), np.concatenate((inner, join_sizes)), np.array(pieces, np.int64))
    bounds = np.r_[0, np.cumsum(taken)][np.r_[0, np.cumsum(per_doc)]]
    lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values.astype(np.int32)))
    return pa.table([doc_ids, lists], names=["doc_id", "ids"])


def encode(
    docs: DataFrame,
    vocabulary: str,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    buckets: int | None = None,
) -> DataFrame:
    """``doc_id, ids`` of every whole text, as the tokenizers library gives them without added special tokens.

    ``vocabulary`` is the path of a tokenizer file that each executor has; one
    whose tokens reach across blanks is refused. Strings of special tokens in a
    text become their ids. A null or empty text has no ids; null ids stay null;
    rows that repeat an id are encoded each, those that repeat a text from the
    same chunks. Other columns are ignored, whatever their names; no documents
    give no rows.

    What a task holds is bounded by a batch (16 MB of text, or one longer text)
    and by a bucket of distinct chunks, ``buckets`` of them, by default the
    session's shuffle partitions. A chunk that all batches have is posted once
    by each. ``docs`` must give the same rows in the same order when a task is
    run again, as a table read from files does; otherwise the job fails rather
    than mixing up two readings.
    """
    spark = docs.sparkSession
    count = buckets or partitions(spark)
    _vocabulary(vocabulary)
    posted = id_and_text(docs, id_column, text_column).mapInArrow(lambda batches: _posts(batches, count), _ROW)
    replies = (
        posted.repartitionById(count, F.col("bucket"))
        .groupBy("bucket")
        .applyInArrow(lambda table: _encode_bucket(table, vocabulary), _ROW)
    )
    return (
        replies.repartition(count, "batch")
        .groupBy("batch")
        .applyInArrow(lambda table: _put_together(table, vocabulary), "doc_id long, ids array<int>")
    )


def decode(encoded: DataFrame, vocabulary: str, *, ids_column: str = "ids") -> DataFrame:
    """Add ``decoded``, the text the library's ``decode(ids, skip_special_tokens=False)`` gives.

    A vocabulary file without a decoder joins its tokens by blanks; one with a
    decoder is asked for each row. A null list, like an empty one, decodes to
    an empty text. An existing column ``decoded`` is replaced.
    """
    encoded = encoded.select(*(F.col(f"`{name}`") for name in encoded.columns if name.lower() != "decoded"))
    at = encoded.columns.index(ids_column)
    schema = T.StructType([*encoded.schema.fields, T.StructField("decoded", T.StringType())])

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        decoded = pa.array(spelled(part.column(at), vocabulary), pa.string())
        return pa.RecordBatch.from_arrays([*part.columns, decoded], names=[*part.schema.names, "decoded"])

    return encoded.mapInArrow(lambda batches: map(work, slices(batches, 64)), schema)


def spelled(lists: pa.ListArray, vocabulary: str) -> list[str]:
    """The decoded text of each list of ids."""
    tokenizer = _vocabulary(vocabulary).tokenizer
    if tokenizer.decoder is not None:
        return [tokenizer.decode(ids or [], skip_special_tokens=False) for ids in lists.to_pylist()]
    if vocabulary not in _tokens:
        _tokens[vocabulary] = _vocabulary(vocabulary).tokens()
    table, found = _tokens[vocabulary], []
    for row in range(len(lists)):
        ids = lists[row].values
        found.append(" ".join(table[np.asarray(ids)].tolist()) if ids is not None else "")
    return found


def per_list(encoded: DataFrame, work: Callable[[np.ndarray], object], name: str, kind: str, ids_column: str = "ids") -> DataFrame:
    """Add a column that ``work`` computes of each row's array of ids; a null list counts as empty."""
    at = encoded.columns.index(ids_column)
    schema = T.StructType([*encoded.schema.fields, *T._parse_datatype_string(f"{name} {kind}").fields])

    def apply(part: pa.RecordBatch) -> pa.RecordBatch:
        lists = part.column(at)
        rows = (lists[row].values for row in range(len(lists)))
        made = [work(np.asarray(ids) if ids is not None else np.zeros(0, np.int32)) for ids in rows]
        return pa.RecordBatch.from_arrays([*part.columns, pa.array(made)], names=[*part.schema.names, name])

    return encoded.mapInArrow(lambda batches: map(apply, slices(batches, 64)), schema)
