"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

import pytest
from llm_fixtures import awkward, llm, make_docs, no_docs  # noqa: F401

from streamwin.llm import spelling
from streamwin.llm.text import stored


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:k] + long[k + 1 :] == short for k in range(len(long)))


def brute(texts, times=5):
    counted = Counter()
    for doc_id, text in texts:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for run in re.findall("[a-zÀ-ÿ]+", low):
            mark = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if mark % 199 == 0:
                run = run[: mark % len(run)] + run[mark % len(run) + 1 :]
            counted[run] += 1
    n = {word: k for word, k in counted.items() if len(word) >= 6 and k >= 5}
    near = {word: [other for other in n if other != word and one_edit(word, other)] for word in n}
    form = {}
    for word, others in near.items():
        best = min(others, key=lambda other: (-n[other], other), default=None)
        form[word] = best if best is not None and n[best] >= times * n[word] else None
    rows = set()
    for word in n:
        root = word
        while form[root] is not None:
            root = form[root]
        rows.add((word, form[word], root, n[word], len(near[word]), n.get(form[word])))
    return rows


def found(docs, **options):
    rows = [tuple(row) for row in spelling.spelling_variants(docs, **options).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.fixture(scope="module")
def vocabulary(llm):
    """Words of few letters, with runs of equal ones, so that most have near words at all places."""
    rng = random.Random(3)
    made = {"".join(rng.choices("aabÿ", k=rng.randrange(6, 10))) for _ in range(900)}
    made |= {"prefix" + "".join(rng.choices("ab", k=rng.randrange(0, 6))) for _ in range(60)}
    made |= {"x" * k for k in range(6, 50)} | {"y" * 40 + "".join(rng.choices("ab", k=rng.randrange(0, 4))) for _ in range(30)}
    return sorted(made)


@pytest.mark.parametrize("group_words", [1, 3, 20, 100, 5000])
def test_near_words_whatever_the_groups(llm, vocabulary, group_words):
    words = stored(llm.createDataFrame([(word,) for word in vocabulary], "word string"), "words")
    got = [tuple(row) for row in spelling.near_words(words, group_words=group_words).collect()]
    assert len(got) == len(set(got))
    want = {
        (a, b) if (len(a), a) < (len(b), b) else (b, a)
        for at, a in enumerate(vocabulary)
        for b in vocabulary[at + 1 :]
        if one_edit(a, b)
    }
    assert set(got) == want


def test_acceptor_is_the_smallest(vocabulary):
    machine = spelling.Acceptor(vocabulary)
    assert sorted(machine.shared(machine.start, machine.start)) == vocabulary
    # Two states are equal if they accept the same rests.
    rests = {tuple(sorted(machine.shared(at, at))) for at in range(len(machine.arcs))}
    assert len(rests) == len(machine.arcs)
    assert len(spelling.Acceptor([]).arcs) == 1


def test_variants_of_documents(make_docs):
    rng = random.Random(4)
    words = ["".join(rng.choices("abcdeé", k=rng.randrange(5, 9))) for _ in range(40)]
    texts = []
    for at in range(150):
        some = []
        for word in rng.choices(words, [2.0**-k + 0.01 for k in range(40)], k=60):
            if rng.random() < 0.2:
                place = rng.randrange(len(word))
                word = word[:place] + rng.choice(["", "a", "É"]) + word[place + 1 :]
            some.append(word.upper() if rng.random() < 0.1 else word)
        texts.append((at if at % 50 else None, " ".join(some) + "\n3×4", "s"))
    want = brute([row[:2] for row in texts])
    assert any(row[1] != row[2] for row in want if row[1]), "no chain of forms"
    assert found(make_docs(*texts)) == want
    assert found(make_docs(*texts), group_words=4) == want


def test_nulls_repeats_and_long_texts(awkward):
    rows = [(row["doc_id"], row["text"]) for row in awkward.collect()]
    assert found(awkward) == brute(rows)


def test_ties_go_to_the_first_by_code_point(make_docs):
    rows = [("letters " * 5 + "lettera " * 30 + "letterz " * 30,)]
    got = {row[0]: row for row in found(make_docs(*(text for (text,) in rows)), change_one_in=None)}
    assert got["letters"] == ("letters", "lettera", "lettera", 5, 2, 30)


def test_very_long_words_and_texts(make_docs):
    long = "x" * 20_000
    text = " ".join([long, long + "y", "z" + long] * 5 + ["filler"] * 150_000)
    got = found(make_docs(text), change_one_in=None)
    assert {(row[0], row[3], row[4]) for row in got} == {
        (long, 5, 2),
        (long + "y", 5, 1),
        ("z" + long, 5, 1),
        ("filler", 150_000, 0),
    }


def test_no_documents_and_clashing_names(llm, no_docs):
    assert found(no_docs) == set()
    docs = llm.createDataFrame([(1, "letters " * 6, "w", 3)], "doc_id long, text string, word string, n int")
    assert found(docs, change_one_in=None) == {("letters", None, "letters", 6, 0, None)}


def test_a_form_is_more_frequent(no_docs):
    with pytest.raises(ValueError, match="twice"):
        spelling.spelling_variants(no_docs, times=1)
