"""Token counts by byte-pair merging of many pre-tokens at once in ragged arrays."""

from __future__ import annotations

import json
import re

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import id_and_text, per_batch, texts

# Fixed value: the pattern that byte-level vocabularies of this kind were made with.
PRE_TOKENS = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)

# Where one blank stands between two other characters a pre-token always starts.
_UNITS = re.compile(r"(?<=\S) (?=\S)")
_FREE = np.iinfo(np.int32).max
_CACHED_UNITS = 400_000


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary."""
    plain = {*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    letters, spare = [], 256
    for byte in range(256):
        letters.append(chr(byte if byte in plain else spare))
        spare += byte not in plain
    return letters


class MergeTable:
    """Merges of a tokenizer file: rank and product of each pair of symbols."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        ids = spec["model"]["vocab"]
        self.first = np.array([ids[letter] for letter in _byte_letters()], np.int64)
        merges = [pair.split(" ") if isinstance(pair, str) else pair for pair in spec["model"]["merges"]]
        keys = np.array([ids[a] << 32 | ids[b] for a, b in merges], np.int64)
        made = np.array([ids[a + b] for a, b in merges], np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int32), made[order]
        self.special = [token["content"] for token in spec.get("added_tokens", ())]

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each pair, or a rank above all, and its place among the keys."""
        wanted = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.ranks[at], _FREE), at

    def count(self, sequences: list[bytes]) -> np.ndarray:
        """Symbols left of each non-empty sequence when no pair can be merged.

        All sequences lie in one array. In each round every sequence that still
        has a pair merges all places of its own lowest-ranked one; sequences
        without leave the array.
        """
        left = np.array([len(sequence) for sequence in sequences], np.int64)
        symbols = self.first[np.frombuffer(b"".join(sequences), np.uint8)]
        active = np.arange(len(sequences))
        while len(active):
            owner = np.repeat(np.arange(len(active)), left[active])
            inside = owner[1:] == owner[:-1]
            ranks, at = np.full(len(symbols), _FREE, np.int32), np.zeros(len(symbols), np.int64)
            pairs = np.flatnonzero(inside)
            ranks[pairs], at[pairs] = self.look_up(symbols[pairs], symbols[pairs + 1])
            starts = np.r_[0, np.cumsum(left[active])[:-1]]
            lowest = np.minimum.reduceat(ranks, starts)
            chosen = np.flatnonzero((ranks == lowest[owner]) & (ranks != _FREE))
            # In a run such as "aaaa" every other place is taken, from the left.
            fresh = np.r_[True, np.diff(chosen) > 1]
            run = np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
            chosen = chosen[(np.arange(len(chosen)) - run) % 2 == 0]
            symbols[chosen] = self.made[at[chosen]]
            left[active] -= np.bincount(owner[chosen], minlength=len(active))
            stay = (lowest != _FREE)[owner]
            stay[chosen + 1] = False
            symbols = symbols[stay]
            active = active[lowest != _FREE]
        return left


class Counter:
    """Counts the tokens of texts; remembers the units it has seen."""

    def __init__(self, path: str):
        self.table = MergeTable(path)
        self.pattern = regex.compile(PRE_TOKENS)
        escaped = "|".join(map(re.escape, sorted(self.table.special, key=len, reverse=True)))
        self.special = re.compile(f"({escaped})") if escaped else None
        self.known: dict[str, int] = {}

    def units(self, text: str) -> tuple[list[str], int]:
        """Parts of a text that no pre-token crosses, and its number of special tokens.

        A part that followed a blank starts with it.
        """
        parts = self.special.split(text) if self.special else [text]
        found: list[str] = []
        for piece in parts[::2]:
            if piece:
                first, *rest = _UNITS.split(piece)
                found.append(first)
                found += [" " + unit for unit in rest]
        return found, len(parts) // 2

    def learn(self, units: set[str]) -> None:
        cut = {unit: self.pattern.findall(unit) for unit in units}
        fresh = sorted({token for tokens in cut.values() for token in tokens})
        if fresh:
            counts = dict(zip(fresh, self.table.count([token.encode() for token in fresh]).tolist(), strict=True))
            self.known.update({unit: sum(map(counts.__getitem__, tokens)) for unit, tokens in cut.items()})

    def count(self, batch: list[str]) -> list[int]:
        cut = [self.units(text) for text in batch]
        if len(self.known) > _CACHED_UNITS:
            self.known.clear()
        self.learn(set().union(*(units for units, _ in cut)) - self.known.keys())
        return [special + sum(map(self.known.__getitem__, units)) for units, special in cut]


_counters: dict[str, Counter] = {}


def count_tokens(
    docs: DataFrame, vocabulary: str, *, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens`` of every whole text under a byte-level vocabulary file.

    ``vocabulary`` is the path of a tokenizer file of the merges kind that each
    executor has. Strings of special tokens inside a text count as one token. A
    null text counts as an empty one, with no token; a null id stays null; rows
    that repeat an id are counted each. Other columns are ignored.
    """

    def count(part: pa.RecordBatch) -> pa.RecordBatch:
        if vocabulary not in _counters:
            _counters[vocabulary] = Counter(vocabulary)
        batch = texts(part.column(1))
        counts = _counters[vocabulary].count(batch)
        sizes = [len(text.encode()) for text in batch]
        return pa.RecordBatch.from_arrays(
            [part.column(0), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64())],
            names=["doc_id", "n_bytes", "n_tokens"],
        )

    return id_and_text(docs, id_column, text_column).mapInArrow(
        per_batch(count), "doc_id long, n_bytes long, n_tokens long"
    )


def with_limit(counts: DataFrame, limit: int = 512) -> DataFrame:
    """Mark the documents that have more tokens than a model's window."""
    return counts.withColumn("over_limit", F.col("n_tokens") > limit)
