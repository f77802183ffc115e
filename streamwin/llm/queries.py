"""The registered queries of this package and, where SQL can say it, their SQL."""

from __future__ import annotations

import functools
import hashlib
import os

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.scratch import scratch_folder
from . import (
    bpe_chunks,
    digests,
    fill_in_middle,
    mixing,
    near_duplicates,
    pieces,
    quality_cnn,
    rules,
    spelling,
    substrings,
    token_blocks,
    token_counts,
    toxicity,
)
from .text import held_out, importable

# Folder of the tokenizer files; each executor has them.
VOCABULARIES = os.environ.get("LLM_VOCABULARIES") or os.path.dirname(public_tokenizers.path("x"))


def vocabulary(name: str) -> str:
    return os.path.join(VOCABULARIES, name)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents")


def op1_token_blocks(spark: SparkSession, folder: str) -> DataFrame:
    files = scratch_folder(spark, "token-blocks")
    token_blocks.write_blocks(documents(spark, folder), files, vocabulary("word_bpe_49k.json"), end_id=1)
    return token_blocks.read_documents(spark, files)


def op2_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    network = quality_cnn.learn(docs, table(spark, folder, "labels"))
    found = quality_cnn.score(docs, network, threshold=0.3)
    return found.select("doc_id", held_out().alias("held_out"), "score", "predicted")


def op3_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return digests.against_next(documents(spark, folder))


def op4_substrings(spark: SparkSession, folder: str) -> DataFrame:
    left = substrings.remove_repeats(documents(spark, folder))
    return left.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


OP4_SQL = r"""
with w as (
    select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words from documents
), s as (
    select doc_id, words, unnest(range(1, len(words) - 11)) as pos from w where len(words) >= 13
), g as (
    select doc_id, pos, array_to_string(words[pos:pos + 12], ' ') as win from s
), f as (
    select win, min(doc_id) as first_id from g group by win having min(doc_id) < max(doc_id)
), c as (
    select distinct doc_id, unnest(range(pos, pos + 13)) as place from g join f using (win) where doc_id > first_id
), r as (
    select doc_id, list(place) as gone from c group by doc_id
)
select w.doc_id, len(words)::bigint as n_words, coalesce(len(gone), 0)::bigint as n_removed,
    sha256(array_to_string(case when gone is null then words else
        list_filter(words, lambda x, i: not list_contains(gone, i)) end, ' ')) as kept_sha256
from w left join r using (doc_id)
"""


def op5_mix(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(documents(spark, folder), keep=("doc_id",))
    return mixed.select(
        "doc_id",
        F.col("mix_size").alias("size"),
        F.col("mix_source_size").alias("source_size"),
        F.col("mix_target").alias("target"),
        F.col("mix_taken").alias("taken"),
    )


def op6_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates.near_duplicates(documents(spark, folder))


OP6_SQL = r"""
with recursive w as (
    select doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') as words
    from documents
), s as (
    select distinct doc_id, unnest(case when len(words) = 0 then []
        when len(words) < 5 then [array_to_string(words, ' ')]
        else list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) end) as shingle
    from w
), n as (
    select w.doc_id, count(shingle) as size from w left join s using (doc_id) group by w.doc_id
), i as (
    select a.doc_id as a, b.doc_id as b, count(*) as common
    from s a join s b on a.shingle = b.shingle and a.doc_id <> b.doc_id group by all
), l as (
    select a, b from i join n x on a = x.doc_id join n y on b = y.doc_id
    where 100 * common >= 75 * (x.size + y.size - common)
), r as (
    select doc_id, doc_id as other from n
    union
    select r.doc_id, l.b from r join l on r.other = l.a
), c as (
    select doc_id, min(other) as component_id from r group by doc_id
)
select n.doc_id, n.size as n_shingles, component_id, n.doc_id = component_id as kept from n join c using (doc_id)
"""


def op7_pieces(spark: SparkSession, folder: str) -> DataFrame:
    """Piece ids of every whole text, and the digest of what they decode to."""
    model = vocabulary("piece_bpe_32k.model")
    encoded = pieces.decode(pieces.encode(documents(spark, folder), model), model)
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_pieces"),
        F.crc32(F.array_join("ids", " ").cast("binary")).alias("ids_crc32"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    model = toxicity.learn(docs, table(spark, folder, "labels"))
    found = toxicity.score(docs, model, threshold=0.5)
    return found.select("doc_id", held_out().alias("held_out"), "score", "predicted", "worst_start", "worst_stop")


def op9_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    learned = rules.learn_rules(docs, table(spark, folder, "labels"))
    return rules.apply_rules(docs, learned).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


def op10_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    counts = token_counts.count_tokens(documents(spark, folder), vocabulary("byte_bpe_50k.json"))
    return token_counts.with_limit(counts, 512)


def op11_bpe_ids(spark: SparkSession, folder: str) -> DataFrame:
    path = vocabulary("word_bpe_49k.json")
    encoded = bpe_chunks.encode(documents(spark, folder), path)
    marked = bpe_chunks.per_list(
        encoded, lambda ids: hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest(), "ids_sha256", "string"
    )
    decoded = F.sha2("decoded", 256).alias("decoded_sha256")
    return bpe_chunks.decode(marked, path).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids_sha256", decoded
    )


def op12_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    made = fill_in_middle.fill_in_middle(documents(spark, folder))
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(fill_in_middle.restored("form", "output"), 256).alias("restored_sha256"),
    )


OP12_SQL = r"""
with d as (
    select doc_id, coalesce(text, '') as text, sha256('7:' || doc_id) as h,
        regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') as lines
    from documents
), c as (
    select *, len(lines) as n, ('0x' || h[1:8])::bigint as h1, ('0x' || h[9:16])::bigint as h2,
        ('0x' || h[17:24])::bigint as h3, ('0x' || h[25:32])::bigint as h4
    from d
), f as (
    select *, least(h1 % (n + 1), h2 % (n + 1)) as cut1, greatest(h1 % (n + 1), h2 % (n + 1)) as cut2,
        case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>')
            or h3 % 100 >= 100 then 'plain' when h4 % 100 < 50 then 'spm' else 'psm' end as form
    from c
), p as (
    select *, array_to_string(lines[1:cut1], '') as prefix, array_to_string(lines[cut1 + 1:cut2], '') as middle,
        array_to_string(lines[cut2 + 1:], '') as suffix
    from f
)
select doc_id, n, form, case when form <> 'plain' then length(prefix) end as prefix_chars,
    case when form <> 'plain' then length(middle) end as middle_chars,
    sha256(case form when 'plain' then text
        when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
        else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
    sha256(text) as restored_sha256
from p
"""


def op13_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    found = spelling.spelling_variants(documents(spark, folder))
    return found.select("word", "form", "root", "n", "n_near", "form_n")


# CRC-32 letter by letter from a table of the 256 remainders; near words by the words that miss one letter.
OP13_SQL = r"""
with recursive t as (
    select list(list_reduce([b] || range(8),
        lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) order by b) as rest
    from range(256) r(b)
), runs as (
    select doc_id, run, count(*) as times from (
        select doc_id, unnest(regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[a-zÀ-ÿ]+')) as run
        from documents)
    where length(run) >= 6 group by all
), marked as (
    select run, times, xor(4294967295, list_reduce([4294967295::bigint] || list_transform(
        range(0, length(bytes), 2), lambda k: ('0x' || bytes[k + 1:k + 2])::bigint),
        lambda c, b: xor(c >> 8, rest[(xor(c, b) & 255) + 1]))) as h
    from (select *, hex(encode(doc_id || ':' || run)) as bytes from runs), t
), words as (
    select word, sum(times)::bigint as n from (
        select times, case when h % 199 = 0 then run[1:h % length(run)] || run[h % length(run) + 2:] else run end as word
        from marked)
    where length(word) >= 6 group by word having sum(times) >= 5
), cut as (
    select word, place, word[1:place - 1] || word[place + 1:] as rest
    from (select word, unnest(range(1, length(word) + 1)) as place from words)
), near as (
    select a.word, b.word as other from cut a join cut b on a.rest = b.rest and a.place = b.place and a.word <> b.word
    union select word, rest from cut where rest in (select word from words)
    union select rest, word from cut where rest in (select word from words)
), best as (
    select near.word, count(*) as n_near, min((-n, other)) as best
    from near join words on words.word = other group by near.word
), formed as (
    select word, n, coalesce(n_near, 0) as n_near,
        case when -best[1] >= 5 * n then best[2] end as form, case when -best[1] >= 5 * n then -best[1] end as form_n
    from words left join best using (word)
), chain as (
    select word, word as root, form as next from formed
    union all
    select chain.word, formed.word, formed.form from chain join formed on formed.word = chain.next
)
select word, form, root, n, n_near, form_n from formed join chain using (word) where next is null
"""


def _importable(query):
    @functools.wraps(query)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        importable(spark)
        return query(spark, folder)

    return run


_ALL = {
    "op1_token_blocks": op1_token_blocks,
    "op2_quality": op2_quality,
    "op3_fingerprints": op3_fingerprints,
    "op4_substrings": op4_substrings,
    "op5_mix": op5_mix,
    "op6_near_duplicates": op6_near_duplicates,
    "op7_pieces": op7_pieces,
    "op8_toxicity": op8_toxicity,
    "op9_rules": op9_rules,
    "op10_token_counts": op10_token_counts,
    "op11_bpe_ids": op11_bpe_ids,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_spelling_variants": op13_spelling_variants,
}

QUERIES = {name: _importable(query) for name, query in _ALL.items()}

ORACLES = {
    "op4_substrings": OP4_SQL,
    "op6_near_duplicates": OP6_SQL,
    "op12_fill_in_middle": OP12_SQL,
    "op13_spelling_variants": OP13_SQL,
}
