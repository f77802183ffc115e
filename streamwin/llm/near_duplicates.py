"""Near-duplicates by an inverted join over the coordinates of MinHash signatures."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components
from .hashing import multipliers, window_hashes, word_hashes
from .text import id_and_text, per_batch, stored, utf8

WORDS = 5
SHARE = 75
# A signature has 64 coordinates: the least hash among those with the same leading bits.
COORDINATE_BITS = 6
# Few shingles leave most coordinates without any, so up to so many are all kept.
WHOLE = 16
# Links of 75 % agree in 48 of 64 coordinates on average and in fewer than 26
# once in 10^10. A text therefore posts all but its 40 % most frequent values.
MATCHES = 40
_FACTORS = multipliers(WORDS, 3)


def shingles(text: bytes) -> np.ndarray:
    """Sorted hashes of the distinct five-word shingles; of fewer words the whole sequence is one."""
    hashes = word_hashes(text.lower().split())
    if len(hashes) < WORDS:
        return window_hashes(hashes, multipliers(len(hashes), 10 + len(hashes))) if len(hashes) else hashes
    return np.unique(window_hashes(hashes, _FACTORS))


def signature(found: np.ndarray) -> np.ndarray:
    """The least hash of each coordinate that has any. The leading bits tell which it is.

    Of a set of at most ``WHOLE`` hashes it is the set itself.
    """
    if len(found) <= WHOLE:
        return found
    coordinate = found >> np.uint64(64 - COORDINATE_BITS)
    return found[np.r_[True, coordinate[1:] != coordinate[:-1]]]


def _signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def _arrays(parts: list[np.ndarray]) -> pa.Array:
    bounds = pa.array(np.r_[0, np.cumsum([len(part) for part in parts])].astype(np.int32))
    values = np.concatenate([*parts, np.zeros(0, np.uint64)])
    return pa.ListArray.from_arrays(bounds, pa.array(_signed(values)))


def _signatures(part: pa.RecordBatch) -> pa.RecordBatch:
    sets = [shingles(text) for text in utf8(part.column(1))]
    keys = [xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None for found in sets]
    sizes = pa.array([len(found) for found in sets], pa.int64())
    columns = [part.column(0), sizes, pa.array(keys, pa.binary()), _arrays([signature(found) for found in sets])]
    return pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_shingles", "set_key", "signature"])


def _full_sets(part: pa.RecordBatch) -> pa.RecordBatch:
    sets = [shingles(text) for text in utf8(part.column(1))]
    sizes = pa.array([len(found) for found in sets], pa.int64())
    return pa.RecordBatch.from_arrays([part.column(0), sizes, _arrays(sets)], names=["doc_id", "size", "found"])


def _prefixes(sets: DataFrame, values: str, percent: int) -> DataFrame:
    """Postings ``value, doc_id, size, place`` of the prefix of each set that others share.

    Values are ordered by how many sets have them, the rarest first, then by
    the value. Two sets that have ``percent`` of the larger one in common also
    share a value among the first of both, if a set posts all but ``percent``
    of its values and one more. Values of one set only lead the order and need
    not be posted.
    """
    each = sets.select("doc_id", "size", F.explode(values).alias("value"))
    common = each.groupBy("value").agg(F.count("*").alias("n")).where("n > 1")
    ordered = (
        each.join(common, "value")
        .groupBy("doc_id")
        .agg(F.first("size").alias("size"), F.sort_array(F.collect_list(F.struct("n", "value"))).alias("values"))
    )
    alone = F.col("size") - F.size("values")
    length = F.col("size") - F.ceil(F.col("size") * percent / 100) + 1 - alone
    first = F.slice("values", F.lit(1), F.greatest(length, F.lit(0)).cast("int"))
    posted = ordered.select("doc_id", "size", alone.alias("alone"), F.posexplode(first).alias("at", "found"))
    return posted.select(
        F.col("found.value").alias("value"), "doc_id", "size", (F.col("alone") + F.col("at")).alias("place")
    )


def _possible(a: str, b: str) -> Column:
    """Whether two sets that share a posted value can be linked.

    The sizes must fit, and after the value, with those before it different,
    enough values must be left. The first value that two sets share passes if
    they are linked, so no link is lost.
    """
    size_a, size_b = F.col(f"{a}.size"), F.col(f"{b}.size")
    left = F.least(size_a - F.col(f"{a}.place"), size_b - F.col(f"{b}.place"))
    fits = 100 * F.least(size_a, size_b) >= SHARE * F.greatest(size_a, size_b)
    return fits & ((100 + SHARE) * left >= SHARE * (size_a + size_b))


def _linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs ``a, b`` whose full sets are alike enough."""
    one = sets.select(F.col("doc_id").alias("a"), F.col("found").alias("found_a"))
    other = sets.select(F.col("doc_id").alias("b"), F.col("found").alias("found_b"))
    both = pairs.join(one, "a").join(other, "b")
    common = F.size(F.array_intersect("found_a", "found_b"))
    union = F.size("found_a") + F.size("found_b") - common
    return both.where(100 * common >= SHARE * union).select("a", "b")


def links(docs: DataFrame, signatures: DataFrame, *, exact: bool = False) -> DataFrame:
    """Links ``a, b`` that connect what the links of all pairs connect.

    ``signatures`` has one row ``doc_id, signature`` for each distinct set.
    Signatures are posted under the values of their coordinates, the most
    frequent ones left out that no link needs; texts without a partner there
    go no further, which ``exact`` leaves out. The others post the prefixes of
    their full sets. On each value all are first compared with its first text.
    What is then connected
    needs no further comparison: texts outside the largest part that meet on a
    value are compared with those of the other parts, and with no others, so
    that a large group of copies is never compared with itself.
    """
    if exact:
        partners = signatures.select("doc_id")
    else:
        sized = signatures.select("doc_id", F.size("signature").cast("long").alias("size"), "signature")
        coarse = _prefixes(sized, "signature", MATCHES)
        met = coarse.groupBy("value").agg(F.count("*").alias("n")).where("n > 1")
        partners = stored(coarse.join(met, "value").select("doc_id").distinct(), "partners")
    texts = id_and_text(docs).join(partners, "doc_id", "left_semi")
    sets = stored(texts.mapInArrow(per_batch(_full_sets), "doc_id long, size long, found array<long>"), "sets")
    postings = stored(_prefixes(sets, "found", SHARE), "postings")

    heads = postings.groupBy("value").agg(F.min(F.struct("doc_id", "size", "place")).alias("head"), F.count("*").alias("n"))
    heads = heads.where("n > 1").select("value", "head.*")
    p, h = postings.alias("p"), heads.alias("h")
    near = p.join(h, (F.col("p.value") == F.col("h.value")) & (F.col("p.doc_id") != F.col("h.doc_id")) & _possible("p", "h"))
    pairs = near.select(F.col("h.doc_id").alias("a"), F.col("p.doc_id").alias("b")).distinct()
    first = stored(_linked(pairs, sets), "links")

    roots = components(first).select(F.col("node").alias("doc_id"), "root")
    known = postings.join(roots, "doc_id", "left").withColumn("root", F.coalesce("root", "doc_id"))
    parts = known.groupBy("value", "root").agg(F.count("*").alias("n"))
    largest = parts.groupBy("value").agg(F.count("*").alias("parts"), F.max(F.struct("n", "root")).alias("top"))
    largest = largest.where("parts > 1").select("value", F.col("top.root").alias("top"))
    open_ = stored(known.join(largest, "value"), "postings")
    a, b = open_.where("root <> top").alias("a"), open_.alias("b")
    across = a.join(
        b,
        (F.col("a.value") == F.col("b.value"))
        & (F.col("a.root") != F.col("b.root"))
        & ((F.col("b.root") == F.col("b.top")) | (F.col("a.doc_id") < F.col("b.doc_id")))
        & _possible("a", "b"),
    )
    pairs = across.select(
        F.least("a.doc_id", "b.doc_id").alias("a"), F.greatest("a.doc_id", "b.doc_id").alias("b")
    ).distinct()
    return first.unionByName(_linked(pairs, sets))


def near_duplicates(
    docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", exact: bool = False
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for each row.

    Texts are linked when 75 % of their five-word shingles agree; a component
    is named by the least id in it, and that document is kept. Copies are one
    class from the start, under their least id, so only distinct sets are
    compared. A text without words is linked with nothing. A row without an id
    is compared with none and kept. Rows that repeat an id are in one
    component, all kept if it is theirs. ``exact`` holds all full sets to each
    other, not only those of texts whose signatures meet; then no link can be
    lost by chance.
    """
    texts = id_and_text(docs, id_column, text_column)
    rows = stored(
        texts.mapInArrow(
            per_batch(_signatures), "doc_id long, n_shingles long, set_key binary, signature array<long>"
        ),
        "signatures",
    )
    named = rows.where(F.col("set_key").isNotNull() & F.col("doc_id").isNotNull())
    classes = named.groupBy("set_key").agg(F.min("doc_id").alias("first_id"), F.first("signature").alias("signature"))
    chosen = classes.groupBy(F.col("first_id").alias("doc_id")).agg(F.first("signature").alias("signature"))
    roots = components(links(texts, chosen, exact=exact)).select(F.col("node").alias("first_id"), "root")
    component = F.coalesce("root", "first_id", "doc_id")
    found = rows.drop("signature").join(
        classes.join(roots, "first_id", "left").select("set_key", "first_id", "root"), "set_key", "left"
    )
    return found.select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNotNull(), component).alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )
