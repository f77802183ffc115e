"""Fill-in-middle against a plain form, and exact restoration."""

import hashlib
import random
import re

import numpy as np
import pytest
from llm_fixtures import awkward, llm, make_docs, no_docs, words  # noqa: F401

from streamwin.llm import fill_in_middle as fim


def plain_form(doc_id, text, unit="lines", seed=7, percent=100, percent_spm=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text) if unit == "lines" else list(text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[k : k + 8], 16) for k in range(0, 32, 8))
    n = len(units)
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = "".join(units[:first]), "".join(units[first:second]), "".join(units[second:])
    if not text or h3 % 100 >= percent or any(mark in text for mark in ("<P>", "<S>", "<M>")):
        return (doc_id, n, "plain", None, None, text, text)
    if h4 % 100 < percent_spm:
        form, made = "spm", f"<S>{suffix}<P>{prefix}<M>{middle}"
    else:
        form, made = "psm", f"<P>{prefix}<S>{suffix}<M>{middle}"
    return (doc_id, n, form, len(prefix), len(middle), made, text)


def check(docs, **options):
    made = fim.fill_in_middle(docs, **options)
    found = made.withColumn("restored", fim.restored("form", "output")).collect()
    want = [plain_form(row["doc_id"], row["text"], **options) for row in docs.collect()]
    assert sorted(map(tuple, found), key=str) == sorted(want, key=str)


@pytest.mark.parametrize("unit", fim.UNITS)
def test_odd_texts(make_docs, unit):
    rng = random.Random(2)
    bits = ["a", "é", "日", "😀", "\n", "\n\n", "\r\n", "<", "<P", "S>", "M>", "<S", ">", " word "]
    texts = ["".join(rng.choices(bits, k=rng.randrange(60))) for _ in range(500)]
    check(make_docs(*texts, "<P>", "x<S>y", "<M>\n", "\n", "😀"), unit=unit)


@pytest.mark.parametrize("unit", fim.UNITS)
def test_nulls_repeats_and_long_texts(awkward, unit):
    check(awkward, unit=unit)


def test_very_long_text(make_docs):
    check(make_docs(words(200_000).replace(" w7", "\né"), "é" * 100_000))


def test_shares(make_docs):
    docs = make_docs(*["one\ntwo\nthree"] * 300)
    check(docs, percent=30, percent_spm=80, seed=3)
    check(docs, percent=0)


def test_no_documents_and_clashing_names(llm, no_docs):
    assert fim.fill_in_middle(no_docs).count() == 0
    check(llm.createDataFrame([(1, "a\nb", "x", 1)], "doc_id long, text string, form string, n int"))


def test_exceptions_convert_both_ways():
    text = "aé日😀b" * 50 + "plain"
    index = fim.Exceptions(np.frombuffer(text.encode(), np.uint8))
    assert len(index.places) == 150
    chars = np.arange(len(text) + 1)
    places = np.array([len(text[:k].encode()) for k in chars])
    assert (index.to_bytes(chars) == places).all() and (index.to_chars(places) == chars).all()
    assert len(fim.Exceptions(np.frombuffer(b"only ascii", np.uint8)).places) == 0


def test_sentinels_that_overlap_are_refused(no_docs):
    for marks in (("<P>", "<P>", "<M>"), ("aba", "c", "d"), ("ab", "bc", "d"), ("", "a", "b")):
        with pytest.raises(ValueError, match="sentinels"):
            fim.fill_in_middle(no_docs, sentinels=fim.Sentinels(*marks))


def test_unknown_unit(no_docs):
    with pytest.raises(ValueError, match="unit"):
        fim.fill_in_middle(no_docs, unit="bytes")
