"""BPE by content-defined chunks against its library."""

import random

import pytest
from llm_fixtures import awkward, llm, make_docs, no_docs, words  # noqa: F401
from tokenizers import Tokenizer

from streamwin.llm import bpe_chunks
from streamwin.llm.queries import vocabulary

PATH = vocabulary("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
# Letters that compose, blanks of all kinds, special tokens whole and in part, words without end.
BITS = ["the", "The", "é", "é", "日本語", "<|endoftext|>", "<|startof", "text|>", " ", "  ", "\n", "\t", "\x0b", "\x1c"]
BITS += ["\x85", "　", " ", "'s", "'LL", "...", "3", "1999", "İ", "Σς", "😀", "ﬁ", "x" * 50, "́", "#$%", "​", "ß"]


def expected(text):
    ids = LIBRARY.encode(text or "", add_special_tokens=False).ids
    return ids, LIBRARY.decode(ids, skip_special_tokens=False)


def check(docs, **options):
    found = bpe_chunks.decode(bpe_chunks.encode(docs, PATH, **options), PATH)
    assert found.columns == ["doc_id", "ids", "decoded"]
    got = sorted(((row["doc_id"] is None, row["doc_id"], row["ids"], row["decoded"]) for row in found.collect()), key=str)
    want = sorted(((row["doc_id"] is None, row["doc_id"], *expected(row["text"])) for row in docs.collect()), key=str)
    assert got == want


def test_odd_texts(llm, make_docs):
    rng = random.Random(5)
    texts = ["".join(rng.choices(BITS, k=rng.randrange(400))) for _ in range(600)]
    check(make_docs(*texts))


def test_nulls_repeats_and_long_texts(awkward):
    check(awkward)


def test_very_long_texts(make_docs):
    text = words(200_000)
    check(make_docs(text, "a" * 50_000, "日本" * 20_000, " " * 20_000, text[7:] + " end", text), buckets=3)


def test_no_documents(no_docs):
    assert bpe_chunks.decode(bpe_chunks.encode(no_docs, PATH), PATH).count() == 0


def test_columns_with_clashing_names(llm):
    docs = llm.createDataFrame(
        [(1, "some text", 5, "b", "r", "k")], "doc_id long, text string, bucket int, batch string, ids string, kind string"
    )
    check(docs)


def test_null_ids_decode_to_nothing(llm):
    rows = llm.createDataFrame([(1, None, "x"), (2, [], "y"), (3, [320, 49407], "z")], "doc_id long, ids array<int>, decoded string")
    found = {row["doc_id"]: row["decoded"] for row in bpe_chunks.decode(rows, PATH).collect()}
    assert found == {1: "", 2: "", 3: LIBRARY.decode([320, 49407], skip_special_tokens=False)}


def test_tokens_across_blanks_are_refused(no_docs):
    with pytest.raises(ValueError, match="reach across blanks"):
        bpe_chunks.encode(no_docs, vocabulary("byte_bpe_50k.json"))


def test_chunks_depend_on_what_is_around_a_cut_alone():
    rng = random.Random(1)
    shared = "".join(rng.choices("abcdefgh é日", k=20_000)).encode()
    one = bpe_chunks.chunks_of(b"start " + shared)
    other = bpe_chunks.chunks_of(bytes(rng.choices(b"xyz ", k=3000)) + shared + b" end")
    assert b"".join(one) == b"start " + shared
    assert sum(map(len, set(one) & set(other))) > 0.9 * len(shared)
    for chunk in one[:-1]:
        chunk.decode()
        assert bpe_chunks.LEAST_CHUNK <= len(chunk) <= bpe_chunks.MOST_CHUNK


def test_each_distinct_chunk_is_encoded_once(monkeypatch):
    import pyarrow as pa

    text = " ".join(f"word{k}" for k in range(4000)).encode()
    posts = [bpe_chunks._post([at], [text], 1) for at in range(3)]
    table = pa.Table.from_batches(posts)
    seen = []
    whole = bpe_chunks._chunk_ids
    monkeypatch.setattr(bpe_chunks, "_chunk_ids", lambda model, chunks: seen.extend(chunks) or whole(model, chunks))
    replies = bpe_chunks._encode_bucket(table, PATH)
    assert sorted(seen) == sorted(set(bpe_chunks.chunks_of(text)))
    assert replies.num_rows == 6


def test_a_batch_whose_recipe_is_lost_fails():
    import pyarrow as pa

    text = " ".join(f"word{k}" for k in range(400)).encode()
    replies = bpe_chunks._encode_bucket(pa.Table.from_batches([bpe_chunks._post([1], [text], 1)]), PATH)
    assert bpe_chunks._put_together(replies, PATH)["ids"].to_pylist() == [expected(text.decode())[0]]
    for kept in range(2):
        with pytest.raises(RuntimeError, match="came out otherwise"):
            bpe_chunks._put_together(replies.slice(kept, 1), PATH)
