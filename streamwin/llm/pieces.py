"""SentencePiece encoding on a relational lattice of word substrings, and decoding.

The vocabulary at hand merges pairs by rank, and the cheapest path by score
through its lattice is not what its library returns. So the lattice is folded
by merges instead: of all pieces that join two neighbouring ones the best
scored, leftmost is taken until there is none.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import nullable, partitions, per_batch, slices, texts, with_nulls

SPACE = "▁"
# Boundaries of a unit are bits of a long; the few longer words are encoded by the library.
LATTICE_CHARS = 60
# Stands for the id of a letter that is no piece. Ids take 21 bits.
NO_PIECE = (1 << 21) - 1
_WORD = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
# Characters of the texts that are numbered together.
SLAB_CHARS = 6 << 20
# In a reply an id takes three bytes; this bit marks the last one of a unit.
_LAST = 1 << 23
IDS_AT_ONCE = 200_000


def _processor(model: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=model)


def _ordinary(loaded) -> list[int]:
    return [
        at
        for at in range(loaded.get_piece_size())
        if not (loaded.is_control(at) or loaded.is_unknown(at) or loaded.is_byte(at) or loaded.is_unused(at))
    ]


def piece_table(spark: SparkSession, model: str) -> DataFrame:
    """``piece, id, rank, odd`` of the vocabulary's ordinary pieces, best first. Its size is that of the vocabulary.

    Within a stretch whose ends are still boundaries, merges run as if it stood
    alone. So whatever the word, a piece can only be made of the two parts it is
    made of alone. It is odd if one of them does not rank before it.
    """
    loaded = _processor(model)
    ids = _ordinary(loaded)
    order = {score: rank for rank, score in enumerate(sorted(map(loaded.get_score, ids), reverse=True))}
    ranks = {loaded.id_to_piece(at): order[loaded.get_score(at)] for at in ids}

    def odd(piece: str) -> bool:
        parts = list(piece)
        while len(parts) > 2:
            ranked = [(ranks.get(parts[at] + parts[at + 1], len(ranks)), at) for at in range(len(parts) - 1)]
            rank, at = min(ranked)
            if rank == len(ranks):
                return False
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return any(len(part) > 1 and ranks[part] >= ranks[piece] for part in parts)

    rows = [(piece, loaded.piece_to_id(piece), rank, odd(piece)) for piece, rank in ranks.items()]
    return spark.createDataFrame(rows, "piece string, id int, rank int, odd boolean")


def words_of(text: str) -> list[str]:
    """Parts of a text that no piece crosses, its blanks shown, without the blank that leads each of them."""
    return _plain(text).split(" ") if text else []


def _plain(text: str) -> str:
    """The words of a text with one blank between; they have none themselves."""
    if SPACE in text or "  " in text or text[:1] == " " or text[-1:] == " ":
        return " ".join(word[1:] for word in _WORD.findall(SPACE + text.replace(" ", SPACE)))
    return text


class Units:
    """Parts words between letters that no piece has side by side, which merges therefore never join."""

    def __init__(self, model: str):
        loaded = _loaded(model)
        pieces = [loaded.id_to_piece(at) for at in _ordinary(loaded)]
        pairs = {(ord(one), ord(other)) for piece in pieces for one, other in zip(piece, piece[1:], strict=False)}
        self.pairs = np.array(sorted((one << 21) + other for one, other in pairs), np.int64)

    def parted(self, words: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """The units of all words, one after the other, and how many each word has. Its first has the leading blank."""
        led = pc.binary_join_element_wise(pa.scalar(SPACE, words.type), words, pa.scalar("", words.type))
        joined = _joined(led)
        letters = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        first = np.zeros(len(letters) + 1, bool)
        first[np.r_[0, np.cumsum(np.asarray(pc.utf8_length(led)))].astype(np.int64)] = True
        both = (letters[:-1].astype(np.int64) << 21) + letters[1:]
        at = np.minimum(np.searchsorted(self.pairs, both), max(len(self.pairs) - 1, 0))
        beside = self.pairs[at] == both if len(self.pairs) else np.zeros(len(both), bool)
        starts = np.flatnonzero(first[:-1] | np.r_[True, ~beside][: len(letters)])
        counts = np.diff(np.r_[np.flatnonzero(first[starts]), len(starts)]).astype(np.int64)
        sizes = 1 + (letters > 0x7F) + (letters > 0x7FF).astype(np.int64) + (letters > 0xFFFF)
        ends = np.r_[0, np.cumsum(sizes)]
        offsets = np.r_[ends[starts], ends[-1]].astype(np.int64)
        buffers = [None, pa.py_buffer(offsets), pa.py_buffer(joined.encode())]
        return pa.Array.from_buffers(pa.large_string(), len(starts), buffers), counts


def _bit(at: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), at.cast("int"))


def _held(frame: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that is computed once, however often it is used."""
    return frame.select("*", F.explode(F.array(value)).alias(name))


def encode_words(words: DataFrame, vocabulary: DataFrame, first_byte: int, dealt_by: str) -> DataFrame:
    """Add ``ids`` to a table of distinct words of at most 60 characters; other columns stay.

    Every substring that is a piece is an edge of the word's lattice. The table
    is dealt by the column ``dealt_by``, on which a word has one value, so the
    edges of a word meet without a shuffle. The
    fold holds the boundaries left as bits; an edge can be taken if both its
    ends are boundaries and just one lies between. If the parts of all edges
    rank before them, one pass in the order of ranks takes the merges in turn;
    a word with an odd edge is passed again for every merge. A character that
    is no piece becomes the pieces of its bytes.
    """
    others = [name for name in words.columns if name not in ("word", dealt_by)]
    longest = vocabulary.agg(F.max(F.length("piece"))).first()[0] or 1
    size = F.length("word")
    starts = words.withColumn("start", F.explode(F.sequence(F.lit(0), size - 1)))
    spans = starts.withColumn(
        "stop", F.explode(F.sequence(F.col("start") + 1, F.least(F.col("start") + longest, size)))
    ).withColumn("piece", F.col("word").substr(F.col("start") + 1, F.col("stop") - F.col("start")))
    found = spans.join(F.broadcast(vocabulary), "piece", "left").where("id is not null or stop = start + 1")
    # An edge is one number, so that edges sort by rank, then by start: rank, start, stop and id.
    packed = F.call_function("shiftleft", F.coalesce("rank", F.lit(0)).cast("long"), F.lit(33))
    packed = packed + F.col("start").cast("long") * (1 << 27) + F.col("stop").cast("long") * (1 << 21)
    once = (F.col("start") == 0) & (F.col("stop") == 1)
    found = found.select(
        dealt_by,
        "word",
        (packed + F.coalesce("id", F.lit(NO_PIECE))).alias("edge"),
        F.coalesce("odd", F.lit(False)).alias("odd"),
        *(F.when(once, F.col(name)).alias(name) for name in others),
    )
    lattice = found.groupBy(dealt_by, "word").agg(
        F.sort_array(F.collect_list("edge")).alias("edges"),
        F.max("odd").alias("odd"),
        *(F.first(name, True).alias(name) for name in others),
    )

    def place(edge: Column, shift: int) -> Column:
        return F.shiftrightunsigned(edge, shift).bitwiseAND(F.lit(63).cast("long")).cast("int")

    def bits(edge: Column) -> Column:
        start, stop = place(edge, 27), place(edge, 21)
        return F.struct(
            _bit(start).bitwiseOR(_bit(stop)).alias("ends"),
            (_bit(stop) - _bit(start + 1)).alias("inner"),
            edge.alias("edge"),
        )

    def fits(bounds: Column, e: Column, between: int) -> Column:
        left = bounds.bitwiseAND(e["inner"])
        return (bounds.bitwiseAND(e["ends"]) == e["ends"]) & (F.bit_count(left) == between)

    def merged(bounds: Column, e: Column) -> Column:
        return bounds.bitwiseAND(F.bitwise_not(e["inner"]))

    def in_turn(bounds: Column, e: Column) -> Column:
        return F.when(fits(bounds, e, 1), merged(bounds, e)).otherwise(bounds)

    def best(bounds: Column, _: Column) -> Column:
        first = F.get(F.filter("spans", lambda e: fits(bounds, e, 1)), F.lit(0))
        return F.when(bounds < 0, bounds).otherwise(F.coalesce(merged(bounds, first), bounds.bitwiseOR(ended)))

    # The sign tells that nothing can be merged any more.
    ended = F.lit(-(1 << 63))
    whole = _bit(size + 1) - 1
    once_for_each = F.sequence(F.lit(1), F.greatest(size - 1, F.lit(1)))
    lattice = _held(lattice, "spans", F.transform("edges", bits))
    lattice = _held(
        lattice,
        "bounds",
        F.when(F.col("odd"), F.aggregate(once_for_each, whole, best)).otherwise(F.aggregate("spans", whole, in_turn)),
    )
    left = F.filter("spans", lambda e: fits(F.col("bounds"), e, 0))
    places = F.lit((1 << 33) - 1)
    lattice = _held(lattice, "taken", F.sort_array(F.transform(left, lambda e: e["edge"].bitwiseAND(places))))

    def number(edge: Column) -> Column:
        return edge.bitwiseAND(F.lit(NO_PIECE).cast("long")).cast("int")

    def spelled(edge: Column) -> Column:
        letter = F.hex(F.encode(F.col("word").substr(place(edge, 27) + 1, F.lit(1)), "UTF-8"))
        letters = F.transform(
            F.sequence(F.lit(0), (F.length(letter) / 2).cast("int") - 1),
            lambda at: F.conv(F.substring(letter, at * 2 + 1, F.lit(2)), 16, 10).cast("int") + first_byte,
        )
        return F.when(number(edge) == NO_PIECE, letters).otherwise(F.array(number(edge)))

    unknown = F.exists("taken", lambda edge: number(edge) == NO_PIECE)
    ids = F.when(unknown, F.flatten(F.transform("taken", spelled))).otherwise(F.transform("taken", number))
    return lattice.select(dealt_by, "word", *others, ids.alias("ids"))


def encode(
    docs: DataFrame,
    model: str,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    keep: tuple[str, ...] = (),
    blocks: int | None = None,
) -> DataFrame:
    """``doc_id, ids`` of every whole text, with a struct ``kept`` of the columns named in ``keep``.

    ``model`` is the path of a model file that each executor has. Where they
    are read, texts become slabs of some 6 MB: the distinct units of a slab,
    and of each text the numbers of its words. Texts themselves are not
    shuffled. A slab posts its units to buckets; each distinct unit of all is
    encoded once, and a bucket answers a slab by the ids of its units in the
    order in which they were posted. A null or empty text has no ids; null and
    repeated ids are encoded row by row.
    """
    spark = docs.sparkSession
    count = blocks or partitions(spark)
    buckets = 4 * count
    loaded = _processor(model)
    first_byte = loaded.piece_to_id("<0x00>")
    carried = F.struct(*(F.col(f"`{name}`") for name in keep)) if keep else F.lit(True)
    given = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"), carried.alias("kept")
    )
    kept = nullable(given.schema["kept"].dataType)
    shape = T.StructType().add("slab", "long").add("doc_ids", T.ArrayType(T.LongType())).add("kept", T.ArrayType(kept))
    for name in ("units", "starts", "numbers"):
        shape = shape.add(name, "binary")

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slab = TaskContext.get().partitionId() << 33
        for slab, table in enumerate(_slabs(batches), slab):
            rows = [0, table.num_rows]
            lists = [
                pa.ListArray.from_arrays(pa.array(rows, pa.int32()), column.combine_chunks())
                for column in (table["doc_id"], with_nulls(table["kept"]))
            ]
            packed = [pa.array([part], pa.binary()) for part in _numbered(model, table["text"], buckets)]
            yield pa.RecordBatch.from_arrays([pa.array([slab], pa.int64()), *lists, *packed], names=shape.names)

    def post(table: pa.Table) -> pa.Table:
        units = _unpacked(table["units"][0].as_py())
        starts = np.frombuffer(_unpacked(table["starts"][0].as_py()), np.int64)
        filled = np.flatnonzero(np.diff(starts))
        # The blank after the last unit of a bucket is left out.
        parts = [units[starts[k] : starts[k + 1] - 1] for k in filled.tolist()]
        slab = pa.array(np.full(len(filled), table["slab"][0].as_py()), pa.int64())
        words = pa.array(parts, pa.binary()).cast(pa.string())
        return pa.table([slab, pa.array(filled, pa.int32()), words], names=["slab", "bucket", "words"])

    def put_together(table: pa.Table, replies: pa.Table) -> pa.Table:
        sent = replies.sort_by("bucket")["ids"].to_pylist()
        texts_ids, sizes = _ids_of(_unpacked(table["numbers"][0].as_py()), b"".join(sent))
        offsets = pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32))
        ids = pa.ListArray.from_arrays(offsets, pa.array(texts_ids, pa.int32()))
        lists = [table[name].combine_chunks().flatten() for name in ("doc_ids", "kept")]
        return pa.table([lists[0], ids, lists[1]], names=["doc_id", "ids", "kept"])

    # Both uses read the same shuffle, so texts are numbered once.
    grouped = given.mapInArrow(number, shape).repartition(count, "slab").groupBy("slab")
    posted = grouped.applyInArrow(post, "slab long, bucket int, words string").repartition(buckets, "bucket")
    units = posted.select("bucket", "slab", F.posexplode(F.split("words", " ")).alias("at", "word"))
    words = units.groupBy("bucket", "word").agg(F.collect_list(F.struct("slab", "at")).alias("places"))
    encoded = encode_words(words, piece_table(spark, model), first_byte, "bucket")
    marked = F.transform("ids", lambda one, at: F.when(at == F.size("ids") - 1, one + _LAST).otherwise(one))
    spelled = F.array_join(F.transform(marked, lambda one: F.lpad(F.hex(one), 6, "0")), "")
    answers = encoded.select("bucket", F.explode("places").alias("place"), spelled.alias("ids"))
    answers = answers.groupBy("bucket", F.col("place.slab").alias("slab")).agg(
        F.sort_array(F.collect_list(F.struct("place.at", "ids"))).alias("answers")
    )
    replies = answers.select("slab", "bucket", F.unhex(F.array_join("answers.ids", "")).alias("ids"))
    result = T.StructType().add("doc_id", "long").add("ids", T.ArrayType(T.IntegerType())).add("kept", kept)
    return grouped.cogroup(replies.groupBy("slab")).applyInArrow(put_together, result)


def _slabs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows in tables of some :data:`SLAB_CHARS` bytes of text; a longer text is one of its own."""
    waiting, size = [], 0
    for part in slices(batches):
        waiting.append(part)
        size += part.column(1).nbytes
        if size >= SLAB_CHARS:
            yield pa.Table.from_batches(waiting)
            waiting, size = [], 0
    if waiting:
        yield pa.Table.from_batches(waiting)


def _numbered(model: str, column: pa.ChunkedArray, buckets: int) -> tuple[bytes, bytes, bytes]:
    """The distinct units by bucket, where each bucket's begin, and the numbers that make the texts of them.

    Units of more than 60 characters are not posted. Words that have one come
    last, with the ids the library gives them.
    """
    plain = pa.array([_plain(text) if text else None for text in texts(column)], pa.large_string())
    parts = pc.split_pattern(plain, " ")
    sizes = np.asarray(parts.value_lengths().fill_null(0)).astype(np.int64)
    words = parts.flatten().dictionary_encode()
    del plain, parts
    units, counts = _units(model).parted(words.dictionary)
    coded = units.dictionary_encode()
    distinct, of_words = coded.dictionary, np.asarray(coded.indices).astype(np.int64)
    long = np.asarray(pc.utf8_length(distinct)) > LATTICE_CHARS
    bucket = np.where(long, buckets, _hashes(distinct) % np.uint64(buckets)).astype(np.int64)
    order = np.asarray(pc.sort_indices(distinct)).astype(np.int64)
    order = order[np.argsort(bucket[order], kind="stable")]
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    short = len(order) - int(long.sum())
    ends = np.cumsum(np.r_[0, np.asarray(pc.binary_length(distinct))[order[:short]] + 1]).astype(np.int64)
    posted = _joined(distinct.take(pa.array(order[:short])), " ").encode()
    starts = ends[np.searchsorted(bucket[order[:short]], np.arange(buckets + 1))]

    of_words = place[of_words]
    owner = np.repeat(np.arange(len(counts)), counts)
    by_library = np.unique(owner[of_words >= short])
    spelled = [
        np.array(_loaded(model).encode(word.replace(SPACE, " ")), np.int64)
        for word in words.dictionary.take(pa.array(by_library)).to_pylist()
    ]
    whole = np.ones(len(counts), bool)
    whole[by_library] = False
    numbers = [
        sizes,
        np.asarray(words.indices).astype(np.int64),
        np.where(whole, counts, 0),
        of_words[whole[owner]],
        by_library,
        np.array([len(ids) for ids in spelled], np.int64),
        np.concatenate([*spelled, np.zeros(0, np.int64)]),
    ]
    return tuple(_packed(part) for part in (posted, starts.tobytes(), _bytes_of(numbers)))


def _joined(words: pa.Array, end: str = "") -> str:
    """All words in a row, each with ``end`` after it."""
    ended = pc.binary_join_element_wise(words, pa.scalar(end, words.type), pa.scalar("", words.type)) if end else words
    rows = pa.LargeListArray.from_arrays(pa.array([0, len(ended)], pa.int64()), ended)
    return pc.binary_join(rows, pa.scalar("", words.type))[0].as_py()


def _hashes(words: pa.Array) -> np.ndarray:
    """A number for each word that depends on its letters alone."""
    letters = np.frombuffer(_joined(words).encode("utf-32-le"), np.uint32).astype(np.uint64)
    sizes = np.asarray(pc.utf8_length(words)).astype(np.int64)
    if not len(sizes):
        return np.zeros(0, np.uint64)
    starts = np.cumsum(sizes) - sizes
    powers = np.cumprod(np.full(int(sizes.max()), 0x9E3779B97F4A7C15, np.uint64))
    within = np.arange(len(letters)) - np.repeat(starts, sizes)
    sums = np.add.reduceat(letters * powers[within], starts)
    return (sums ^ (sums >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(17)


def _ids_of(numbers: bytes, replies: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The ids of a slab's texts, one after the other, and how many each text has."""
    sizes, words, counts, of_words, by_library, lengths, spelled = _arrays_of(numbers)
    triples = np.frombuffer(replies, np.uint8).reshape(-1, 3).astype(np.int64)
    sent = (triples[:, 0] << 16) + (triples[:, 1] << 8) + triples[:, 2]
    lasts = np.flatnonzero(sent & _LAST) + 1
    of_units = np.diff(np.r_[0, lasts])
    word_ids = _taken((sent & (_LAST - 1)).astype(np.int32), lasts - of_units, of_units, of_words)
    owner = np.repeat(np.arange(len(counts)), counts)
    of_ids = np.bincount(owner, of_units[of_words], len(counts)).astype(np.int64)
    starts = np.cumsum(of_ids) - of_ids
    starts[by_library] = len(word_ids) + np.cumsum(lengths) - lengths
    of_ids[by_library] = lengths
    found = _taken(np.r_[word_ids, spelled.astype(np.int32)], starts, of_ids, words)
    text = np.r_[0, np.cumsum(of_ids[words])][np.r_[0, np.cumsum(sizes)]]
    return found, np.diff(text)


def _taken(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The stretches of ``values`` that are wanted, one after the other."""
    size = sizes[wanted]
    before = np.cumsum(size) - size
    return values[np.repeat(starts[wanted] - before, size) + np.arange(int(size.sum()))]


def _bytes_of(arrays: list[np.ndarray]) -> bytes:
    """Arrays of whole numbers from 0 on, byte by byte: all lowest bytes of an array, then all next ones."""
    parts = [np.array([len(array) for array in arrays], np.int64).tobytes()]
    for array in arrays:
        width = max(1, -(-int(array.max(initial=0)).bit_length() // 8))
        parts.append(bytes([width]))
        parts.extend((array >> 8 * k).astype(np.uint8).tobytes() for k in range(width))
    return b"".join(parts)


def _arrays_of(data: bytes) -> list[np.ndarray]:
    arrays, at = [], 7 * 8
    for size in np.frombuffer(data, np.int64, 7).tolist():
        array, width, at = np.zeros(size, np.int64), data[at], at + 1
        for k in range(width):
            array |= np.frombuffer(data, np.uint8, size, at).astype(np.int64) << 8 * k
            at += size
        arrays.append(array)
    return arrays


def _packed(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(data)


def _unpacked(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


_models: dict = {}


def _loaded(model: str):
    if model not in _models:
        _models[model] = _processor(model)
    return _models[model]


def _units(model: str) -> Units:
    if ("units", model) not in _models:
        _models["units", model] = Units(model)
    return _models["units", model]


def decode(encoded: DataFrame, model: str, *, ids_column: str = "ids") -> DataFrame:
    """Add ``decoded``, the text of the ids: pieces put together, shown blanks and the first one undone.

    Bytes that are no UTF-8 become replacement characters, as a truncated list
    of ids may leave.
    """
    at = encoded.columns.index(ids_column)

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        pool, starts, sizes = _spellings(model)
        lists = part.column(at)
        ids = np.asarray(lists.flatten())
        ends = np.cumsum(np.asarray(lists.value_lengths().fill_null(0)))
        rows, first = [], 0
        for end in ends.tolist():
            parts = (ids[k : min(k + IDS_AT_ONCE, end)] for k in range(first, end, IDS_AT_ONCE))
            rows.append(b"".join(_spelled(part, pool, starts, sizes) for part in parts))
            first = end
        decoded = [row.decode("utf-8", "replace").removeprefix(" ") for row in rows]
        return pa.RecordBatch.from_arrays(
            [*part.columns, pa.array(decoded, pa.string())], names=[*part.schema.names, "decoded"]
        )

    schema = T.StructType([*encoded.schema.fields, T.StructField("decoded", T.StringType())])
    return encoded.mapInArrow(per_batch(work), schema)


def _spellings(model: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of all pieces in a row, and where each id's begin and how many there are."""
    if ("spellings", model) not in _models:
        loaded = _loaded(model)
        pieces = [
            bytes([int(loaded.id_to_piece(k)[3:5], 16)])
            if loaded.is_byte(k)
            else b""
            if loaded.is_control(k)
            else loaded.id_to_piece(k).replace(SPACE, " ").encode()
            for k in range(loaded.get_piece_size())
        ]
        sizes = np.array([len(piece) for piece in pieces], np.int64)
        pool = np.frombuffer(b"".join(pieces), np.uint8)
        _models["spellings", model] = pool, np.cumsum(sizes) - sizes, sizes
    return _models["spellings", model]


def _spelled(ids: np.ndarray, pool: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> bytes:
    size = sizes[ids]
    before = np.cumsum(size) - size
    return pool[np.repeat(starts[ids] - before, size) + np.arange(size.sum())].tobytes()
