"""Fill-in-middle transformation of texts, cut by lines or by characters.

Cuts are found as places in UTF-8 bytes or as counts of code points, and each
has to be turned into the other. Instead of a table of all characters, an index
keeps the multibyte ones alone: where each begins and how many bytes more than
one all up to it have. Between two of them bytes and characters run side by
side, so a binary search for the last one before a cut and one subtraction
convert it; a text of ASCII letters has an empty index.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import id_and_text, slices, utf8

UNITS = ("lines", "chars")


class Sentinels(NamedTuple):
    """The strings before the three parts. None may begin as another one, or itself, ends."""

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def checked(self) -> Sentinels:
        for one in self:
            for other in self:
                if one != other and one in other or any(one[:k] == other[-k:] for k in range(1, len(one))):
                    raise ValueError(f"sentinels overlap: {one!r} and {other!r}")
        if len(set(self)) < 3 or not all(self):
            raise ValueError("three different sentinels are needed")
        return self


class Exceptions:
    """The multibyte characters of UTF-8 bytes, which alone keep bytes and code points apart."""

    def __init__(self, letters: np.ndarray):
        self.places = np.flatnonzero(letters >= 0xC0)
        lead = letters[self.places]
        excess = 1 + (lead >= 0xE0).astype(np.int64) + (lead >= 0xF0)
        self.over = np.r_[0, np.cumsum(excess)]
        self.chars = self.places - self.over[:-1]

    def to_chars(self, places: np.ndarray) -> np.ndarray:
        """Code points before places in bytes, each the start of a character or the end."""
        return places - self.over[np.searchsorted(self.places, places)]

    def to_bytes(self, chars: np.ndarray) -> np.ndarray:
        """The places in bytes after so many code points."""
        return chars + self.over[np.searchsorted(self.chars, chars)]


def _draws(ids: list[int | None], seed: int) -> np.ndarray:
    """Four numbers of 32 bits for each id, from the SHA-256 of seed and id."""
    marks = (b"%d:%s" % (seed, b"" if one is None else b"%d" % one) for one in ids)
    digests = b"".join(hashlib.sha256(mark).digest()[:16] for mark in marks)
    return np.frombuffer(digests, ">u4").reshape(-1, 4).astype(np.int64)


def _cuts(letters: np.ndarray, bounds: np.ndarray, draws: np.ndarray, unit: str):
    """Units of each text, and the places in bytes of its two cuts."""
    starts, stops = bounds[:-1], bounds[1:]
    index = Exceptions(letters)
    if unit == "chars":
        first = index.to_chars(starts)
        count = index.to_chars(stops) - first
    else:
        ends = np.union1d(np.flatnonzero(letters == ord("\n")) + 1, stops[stops > starts])
        first = np.searchsorted(ends, starts, "right")
        count = np.searchsorted(ends, stops, "right") - first
    drawn = np.sort(draws[:, :2] % (count + 1)[:, None], axis=1)
    if unit == "chars":
        places = index.to_bytes(first[:, None] + drawn)
    else:
        at = np.minimum(first[:, None] + np.maximum(drawn, 1) - 1, max(len(ends) - 1, 0))
        places = np.where(drawn > 0, ends[at] if len(ends) else 0, starts[:, None])
    chars = index.to_chars(np.column_stack((starts, places)))
    return count, places, np.diff(chars, axis=1)


def fill_in_middle(
    docs: DataFrame,
    *,
    unit: str = "lines",
    seed: int = 7,
    percent: int = 100,
    percent_spm: int = 50,
    sentinels: Sentinels = Sentinels(),
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` of every whole text; no shuffle.

    A text of ``n`` units is cut after two random numbers of them. ``form`` is
    ``psm`` (prefix, suffix, middle) or ``spm`` (suffix, prefix, middle), each
    part after its sentinel; ``percent`` of the texts are transformed, of these
    ``percent_spm`` into the second form. A ``plain`` output is the text itself:
    of empty texts, of those that contain a sentinel, and of the rest by chance;
    the sizes of its parts are null.

    The draws come from seed and id alone, so reruns agree and rows that repeat
    an id are cut after the same draws, each on its own text. A null text is an
    empty one; a null id stays null and is drawn for as if it had no digits.
    Other columns are ignored, whatever their names; no documents give no rows.
    """
    if unit not in UNITS:
        raise ValueError(f"unit is one of {UNITS}")
    marks = [mark.encode() for mark in sentinels.checked()]
    before, after, between = marks

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        ids, texts = part.column(0).to_pylist(), utf8(part.column(1))
        bounds = np.r_[0, np.cumsum([len(text) for text in texts])].astype(np.int64)
        draws = _draws(ids, seed)
        count, places, chars = _cuts(np.frombuffer(b"".join(texts), np.uint8), bounds, draws, unit)
        chance = draws[:, 2:] % 100 < (percent, percent_spm)
        forms, outputs = [], []
        for text, (first, second), (changed, turned) in zip(
            texts, (places - bounds[:-1, None]).tolist(), chance.tolist(), strict=True
        ):
            if not text or not changed or any(mark in text for mark in marks):
                forms.append("plain")
                outputs.append(text)
                continue
            prefix, middle, suffix = text[:first], text[first:second], text[second:]
            forms.append("spm" if turned else "psm")
            parts = (after, suffix, before, prefix) if turned else (before, prefix, after, suffix)
            outputs.append(b"".join((*parts, between, middle)))
        plain = np.array([form == "plain" for form in forms], bool)
        columns = [
            part.column(0),
            pa.array(count, pa.int64()),
            pa.array(forms, pa.string()),
            pa.array(chars[:, 0], pa.int64(), mask=plain),
            pa.array(chars[:, 1], pa.int64(), mask=plain),
            pa.array(outputs, pa.binary()).cast(pa.string()),
        ]
        names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
        return pa.RecordBatch.from_arrays(columns, names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return map(work, slices(batches, 256))

    schema = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"
    return id_and_text(docs, id_column, text_column).mapInArrow(run, schema)


def restored(form: Column | str, output: Column | str, sentinels: Sentinels = Sentinels()) -> Column:
    """The text an output was made of.

    A text with a sentinel in it is never cut, and none begins as another one
    ends, so the first place a sentinel is found at is its own.
    """
    form, output = (F.col(one) if isinstance(one, str) else one for one in (form, output))

    def part(text: Column, mark: str) -> tuple[Column, Column]:
        """What is before the first such sentinel, and after it."""
        head = F.substring_index(text, mark, 1)
        return head, F.substr(text, F.length(head) + 1 + len(mark))

    def body(first: str, second: str) -> tuple[Column, Column, Column]:
        one, rest = part(F.substr(output, F.lit(len(first) + 1)), second)
        return (one, *part(rest, sentinels.middle))

    prefix, suffix, middle = body(sentinels.prefix, sentinels.suffix)
    turned_suffix, turned_prefix, turned_middle = body(sentinels.suffix, sentinels.prefix)
    return (
        F.when(form == "psm", F.concat(prefix, middle, suffix))
        .when(form == "spm", F.concat(turned_prefix, turned_middle, turned_suffix))
        .otherwise(output)
    )
