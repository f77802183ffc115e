"""Spelling variants: words one edit apart, found by composing finite-state machines.

The vocabulary is an acceptor A; a transducer E that copies letters and makes
just one edit is put between A and A. Its composition A . E . A accepts the
pairs of words that are one edit apart. Before the edit both words have run
through the same letters, so a state of the composition is one state of A and a
flag; after it, both go on through the letters they share.

The machine is parted by its initial letters. A prefix that more than
``GROUP_WORDS`` words begin with is not run through by one task: there the edit is
taken in the first step after the prefix, and what follows has to be the same,
which is a join on the rest of the word; or it comes later, and the longer prefix
is an initial state of its own. What is left are prefixes with few words, each a
minimised acceptor that one task builds, composes and enumerates.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import id_and_text, slices, stored, utf8

# Fixed value: the letters of words, once A to Z are small.
LETTERS = "[a-zÀ-ÿ]"
LEAST_LETTERS, LEAST_COUNT, CHANGE_ONE_IN, TIMES = 6, 5, 199, 5
GROUP_WORDS = 4000
SALTS = 64
# Distinct words a task counts before it passes the counts on.
WORDS_HELD = 200_000
# Prefixes are looked at up to this length; beyond it every place of a word is joined on.
LONGEST_PREFIX = 32


class Acceptor:
    """The smallest deterministic machine that accepts some words, given in code-point order.

    ``arcs`` are the steps from each state by letter, ``final`` tells whether a
    word may end there, ``least`` and ``most`` how long its rest can be. Words
    are added in order; once a word leaves a path, states behind it are
    complete, and each is replaced by an equal one if there is one.
    """

    def __init__(self, words: list[str]):
        self.arcs: list[dict[str, int]] = []
        self.final: list[bool] = []
        self.least: list[int] = []
        self.most: list[int] = []
        self._known: dict[tuple, int] = {}
        path: list[tuple[dict[str, int], list[bool]]] = [({}, [False])]
        last = ""
        for word in words:
            same = next((k for k, (one, other) in enumerate(zip(word, last, strict=False)) if one != other), None)
            self._close(path, last, min(len(word), len(last)) if same is None else same)
            path.extend(({}, [False]) for _ in range(len(word) - len(path) + 1))
            path[-1][1][0] = True
            last = word
        self._close(path, last, 0)
        self.start = self._state(*path[0])

    def _close(self, path: list, word: str, upto: int) -> None:
        while len(path) > upto + 1:
            state = self._state(*path.pop())
            path[-1][0][word[len(path) - 1]] = state

    def _state(self, arcs: dict[str, int], final: list[bool]) -> int:
        key = (final[0], *sorted(arcs.items()))
        if key not in self._known:
            self._known[key] = len(self.arcs)
            self.arcs.append(arcs)
            self.final.append(final[0])
            rests = [0] if final[0] else []
            self.least.append(min(rests + [1 + self.least[at] for at in arcs.values()], default=0))
            self.most.append(max(rests + [1 + self.most[at] for at in arcs.values()], default=-1))
        return self._known[key]

    def shared(self, one: int, other: int) -> Iterator[str]:
        """The words accepted from both states."""
        stack = [(one, other, 0, "")]
        path: list[str] = []
        while stack:
            one, other, depth, letter = stack.pop()
            del path[max(depth - 1, 0) :]
            path.append(letter)
            if self.final[one] and self.final[other]:
                yield "".join(path)
            for letter, at in self.arcs[one].items():
                to = self.arcs[other].get(letter)
                if to is not None and self.least[at] <= self.most[to] and self.least[to] <= self.most[at]:
                    stack.append((at, to, depth + 1, letter))

    def edits(self, state: int, before: str) -> Iterator[tuple[str, str]]:
        """Pairs accepted from a state, the edit being their first step: the shorter or lesser word first.

        In a run of equal letters, deleting any gives the same word; only the
        first counts. ``before`` is the letter the state was reached by.
        """
        arcs = sorted(self.arcs[state].items())
        for at, (letter, to) in enumerate(arcs):
            if letter != before and self.least[to] <= self.most[state] and self.least[state] <= self.most[to]:
                yield from ((rest, letter + rest) for rest in self.shared(state, to))
            for other, there in arcs[at + 1 :]:
                if self.least[to] <= self.most[there] and self.least[there] <= self.most[to]:
                    yield from ((letter + rest, other + rest) for rest in self.shared(to, there))

    def pairs(self, before: str = "") -> Iterator[tuple[str, str]]:
        """All pairs of words one edit apart, each once; ``before`` is the letter ahead of all words."""
        found: dict[tuple[int, str], list[tuple[str, str]]] = {}
        path: list[str] = []
        stack = [(self.start, 0, before)]
        while stack:
            state, depth, letter = stack.pop()
            if depth:
                del path[depth - 1 :]
                path.append(letter)
            key = (state, letter if letter in self.arcs[state] else "")
            if key not in found:
                found[key] = list(self.edits(*key))
            if found[key]:
                prefix = "".join(path)
                yield from ((prefix + one, prefix + other) for one, other in found[key])
            stack.extend((to, depth + 1, at) for at, to in self.arcs[state].items())


def word_counts(
    docs: DataFrame,
    *,
    least_letters: int = LEAST_LETTERS,
    least_count: int = LEAST_COUNT,
    change_one_in: int | None = CHANGE_ONE_IN,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``word, n`` of the words with at least so many letters and occurrences in all texts.

    Words are the longest runs of Latin letters, A to Z as small ones. Of each
    run a document has, one in ``change_one_in``, by a CRC-32 of id and run,
    loses a letter, which plants misspellings; ``None`` leaves all as they are.
    """
    texts = id_and_text(docs, id_column, text_column)
    run = re.compile(f"{LETTERS}{{{least_letters},}}")

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counted: Counter[str] = Counter()
        for part in slices(batches):
            for doc_id, text in zip(part.column(0).to_pylist(), utf8(part.column(1)), strict=True):
                # The bytes' own lower() knows A to Z alone.
                found = Counter(run.findall(text.lower().decode()))
                if change_one_in is None:
                    counted.update(found)
                    continue
                start = zlib.crc32(b"%s:" % (b"" if doc_id is None else b"%d" % doc_id))
                for word, times in found.items():
                    mark = zlib.crc32(word.encode(), start)
                    if mark % change_one_in == 0:
                        place = mark % len(word)
                        word = word[:place] + word[place + 1 :]
                    counted[word] += times
            if len(counted) >= WORDS_HELD:
                yield _counts(counted)
                counted.clear()
        yield _counts(counted)

    counted = texts.mapInArrow(partial, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where((F.length("word") >= least_letters) & (F.col("n") >= least_count))


def _counts(counted: Counter[str]) -> pa.RecordBatch:
    columns = [pa.array(list(counted), pa.string()), pa.array(list(counted.values()), pa.int64())]
    return pa.RecordBatch.from_arrays(columns, names=["word", "n"])


def _without(text: str, place: Column) -> Column:
    """A text without its letter at a place counted from one."""
    return F.concat(F.substr(F.col(text), F.lit(1), place - 1), F.substr(F.col(text), place + 1))


def _letter(text: str, place: Column) -> Column:
    return F.substr(F.col(text), place, F.lit(1))


def near_words(words: DataFrame, *, group_words: int = GROUP_WORDS) -> DataFrame:
    """``word, near``: each pair of words one insertion, deletion or replacement apart, once, the shorter or lesser first.

    ``words`` has distinct strings ``word`` and should be a stored table, since
    it is read several times. A prefix is hot if more than ``group_words`` words
    begin with it. Hot prefixes of a word are its shortest ones, so their number
    is the depth up to which its edits are joined on.
    """
    size = F.length("word")
    starts = words.select("word", F.explode(F.sequence(F.lit(0), F.least(size, F.lit(LONGEST_PREFIX)))).alias("k"))
    starts = starts.select(
        "word", F.substr("word", F.lit(1), F.col("k")).alias("prefix"), F.pmod(F.hash("word"), F.lit(SALTS)).alias("salt")
    )
    # A hot prefix stands for more than ``group_words`` words, so there are few. A short one is met by a
    # large part of all words, so these are spread over copies of it.
    hot = starts.groupBy("prefix").agg(F.count("*").alias("words")).where(F.col("words") > group_words)
    hot = hot.select("*", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    depth = F.count("words").cast("int")
    deep = starts.join(hot, ["prefix", "salt"], "left").groupBy("word").agg(depth.alias("depth"))
    deep = deep.withColumn("depth", F.when(F.col("depth") > LONGEST_PREFIX, F.length("word") + 1).otherwise(F.col("depth")))
    deep = stored(deep, "spelling-depths")

    cut = deep.where("depth > 0").select(
        "word", F.explode(F.sequence(F.lit(1), F.least("depth", size))).alias("place")
    )
    cut = cut.select("word", "place", _without("word", F.col("place")).alias("rest"))
    # At most one word for each letter of the alphabet has the same rest at the same place.
    other = cut.withColumnRenamed("word", "near")
    replaced = cut.join(other, ["rest", "place"]).where("word < near").select("word", "near")
    first = (F.col("place") == 1) | (_letter("word", F.col("place")) != _letter("word", F.col("place") - 1))
    deleted = cut.where(first).select(F.col("word").alias("near"), F.col("rest").alias("word"))
    deleted = deleted.join(words.select("word"), "word").select("word", "near")

    groups = deep.where(F.col("depth") <= size).select(F.substr("word", F.lit(1), F.col("depth")).alias("prefix"), "word")
    later = groups.groupBy("prefix").applyInArrow(_compose, "word string, near string")
    return later.unionByName(replaced).unionByName(deleted)


def _compose(table: pa.Table) -> pa.Table:
    prefix = table["prefix"][0].as_py()
    machine = Acceptor(sorted(word[len(prefix) :] for word in table["word"].to_pylist()))
    found = list(machine.pairs(prefix[-1:]))
    columns = [[prefix + pair[side] for pair in found] for side in (0, 1)]
    return pa.table([pa.array(column, pa.string()) for column in columns], names=["word", "near"])


def variants(words: DataFrame, *, times: int = TIMES, group_words: int = GROUP_WORDS) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of a stored table ``word, n`` of distinct words.

    ``n_near`` counts the words one edit apart. The most frequent of them (of
    equals the first by code point) is the word's ``form`` if it is at least
    ``times`` as frequent. ``root`` is where the forms end. A form is more frequent by that factor, so a
    chain of forms is short and is followed in few doublings.
    """
    pairs = near_words(words.select("word"), group_words=group_words)
    both = pairs.unionByName(pairs.select(F.col("near").alias("word"), F.col("word").alias("near")))
    sizes = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    best = F.min(F.struct((-F.col("near_n")).alias("least"), "near")).alias("best")
    seen = both.join(sizes, "near").groupBy("word").agg(F.count("*").alias("n_near"), best)
    strong = -F.col("best.least") >= times * F.col("n")
    formed = stored(
        words.join(seen, "word", "left").select(
            "word",
            F.when(strong, F.col("best.near")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(strong, -F.col("best.least")).alias("form_n"),
        ),
        "spelling-forms",
    )
    links = formed.where("form is not null").select("word", F.col("form").alias("root"))
    most = formed.agg(F.max("form_n")).first()[0] or 1
    for _ in range(math.ceil(math.log2(1 + math.log(most, times))) if times > 1 else 0):
        ahead = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        links = links.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"))
    root = F.coalesce("root", "word").alias("root")
    return formed.join(links, "word", "left").select("word", "form", root, "n", "n_near", "form_n")


def spelling_variants(
    docs: DataFrame,
    *,
    least_letters: int = LEAST_LETTERS,
    least_count: int = LEAST_COUNT,
    change_one_in: int | None = CHANGE_ONE_IN,
    times: int = TIMES,
    group_words: int = GROUP_WORDS,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Group the spellings of all whole texts: :func:`word_counts`, then :func:`variants`.

    A null or empty text has no words. A null id counts as one without digits;
    rows that repeat an id or a text count each. Other columns are ignored,
    whatever their names; no documents give no rows. Words of any length are
    compared whole.
    """
    if times < 2:
        raise ValueError("a form has to be at least twice as frequent")
    counted = word_counts(
        docs,
        least_letters=least_letters,
        least_count=least_count,
        change_one_in=change_one_in,
        id_column=id_column,
        text_column=text_column,
    )
    return variants(stored(counted, "spelling-words"), times=times, group_words=group_words)
