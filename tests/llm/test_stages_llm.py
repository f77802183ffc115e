"""Each stage of the pipeline on nulls, empty and very long texts, repeats, ties, empty tables and clashing names."""

from collections import Counter

import pytest
from llm_fixtures import awkward, llm, make_docs, no_docs, words  # noqa: F401

import corpus_pipeline

STAGES = dict(corpus_pipeline.STAGES)
CLASHES = ("kept_id", "kept", "n_words", "n_removed", "mix_size", "mix_pass", "row", "score", "block", "ids", "size", "_w", "odd: name,")


@pytest.fixture(scope="module")
def no_labels(llm, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    llm.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder


def ids_of(frame):
    return Counter(row["doc_id"] for row in frame.select("doc_id").collect())


@pytest.mark.parametrize("name", STAGES)
def test_no_documents(llm, no_docs, no_labels, name):
    assert STAGES[name](llm, no_docs, no_labels).count() == 0


@pytest.mark.parametrize("name", STAGES)
def test_clashing_columns_stay(llm, make_docs, no_labels, name):
    docs = make_docs("some words here", None, "other words there")
    for at, clash in enumerate(CLASHES):
        docs = docs.selectExpr("*", f"{at} as `{clash}`")
    found = STAGES[name](llm, docs, no_labels)
    if name == "encode":
        assert ids_of(found) == Counter([0, 1, 2])
        return
    assert found.columns == docs.columns
    rows = found.collect()
    assert {0, 2} <= {row["doc_id"] for row in rows}
    assert all(row[clash] == at for row in rows for at, clash in enumerate(CLASHES))


@pytest.mark.parametrize(
    ("name", "expected"),
    [
        ("quality", [1, 2, 3, 4, 4, 5, 6, None, 7, 7]),
        ("substring_dedup", [1, 2, 3, 4, 4, 5, 6, None, 7, 7]),
        ("near_dedup", [1, 2, 3, 4, 4, 6, None, 7, 7]),
        ("encode", [1, 2, 3, 4, 4, 5, 6, None, 7, 7]),
    ],
)
def test_rows_that_stay(llm, awkward, no_labels, name, expected):
    assert ids_of(STAGES[name](llm, awkward, no_labels)) == Counter(expected)


def test_mix_takes_words_only(llm, awkward, no_labels):
    found = STAGES["mix"](llm, awkward, no_labels)
    assert found.columns == awkward.columns
    rows = found.collect()
    assert not {1, 2, 3} & {row["doc_id"] for row in rows}
    assert all(row["n_chars"] == len(row["text"]) for row in rows)


def test_very_long_text_through_all_stages(llm, make_docs, no_labels):
    long = " ".join(f"w{k % 3000}" for k in range(200_000))
    docs = make_docs((1, "a short text of some words", "a"), (2, long, "a"), (3, long, "b"), (4, "another text", "b"))
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(llm, docs, no_labels), f"long-{name}")
    rows = docs.where("doc_id = 2").collect()
    assert rows and all(len(row["text"]) <= len(long) and len(row["ids"]) == row["n_pieces"] for row in rows)
    assert docs.where("doc_id = 3").count() == 0
