"""Toxicity by multiple-instance learning: sentences combined by noisy-or."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import id_and_text, labelled_sample, per_batch, slices, texts

SAMPLE_ROWS = 4000
_END = "\x01"
MOST_FEATURES = 200_000
PREFIXES = (4, 5, 6)
LEAST_WEIGHT = 0.3
_SENTENCE = re.compile(r"[^.!?\n]+")
# Sentence ends stand alone, other marks vanish, and so does the sign for an end where a text has it.
_MARKS = str.maketrans({**dict.fromkeys(",;:|*$%&#\"()[]<>" + _END, " "), **dict.fromkeys(".!?\n", f" {_END} ")})


def words_and_ends(text: str) -> list[str]:
    """Small-letter words of a text, with ``_END`` at each sentence end."""
    return text.lower().translate(_MARKS).split()


def features(word: str) -> list[str]:
    """A word and its beginnings, which tell an inflected stem."""
    return [word, *(f"{word[:size]}+" for size in PREFIXES if size < len(word))]


class Model:
    """Weight of each feature of a word, and of a sentence without any."""

    CACHED_WORDS = 300_000

    def __init__(self, weights: dict[str, float], bias: float):
        self.weights, self.bias = weights, bias
        self.known = {_END: np.nan}

    def __reduce__(self):
        return Model, (self.weights, self.bias)

    def values(self, words: list[str]) -> list[float]:
        known = self.known
        if len(known) > self.CACHED_WORDS:
            known.clear()
            known[_END] = np.nan
        for word in set(words).difference(known):
            known[word] = sum(self.weights.get(feature, 0.0) for feature in features(word))
        return list(map(known.__getitem__, words))

    def sentence_logits(self, text: str) -> np.ndarray:
        """One value for each sentence that has a word; a word repeated in it counts once."""
        words = words_and_ends(text)
        if not words:
            return np.zeros(0)
        values = np.array(self.values(words))
        ends = np.isnan(values)
        values[ends] = 0.0
        sentence = np.cumsum(ends)
        counts = np.bincount(sentence[~ends], minlength=sentence[-1] + 1)
        seen: set[tuple[int, str]] = set()
        for at in np.flatnonzero(values).tolist():
            place = (int(sentence[at]), words[at])
            if place in seen:
                values[at] = 0.0
            seen.add(place)
        return np.bincount(sentence, values, sentence[-1] + 1)[counts > 0] + self.bias

    def score(self, text: str) -> float:
        """Noisy-or: the text is toxic if any of its sentences is."""
        return 0.0 - float(np.expm1(_log_clean(self.sentence_logits(text)).sum()))

    def worst_sentence(self, text: str) -> tuple[int, int] | None:
        """Start and stop, in code points, of the sentence that speaks most for toxicity; the first of equal ones."""
        most, found = -np.inf, None
        for match in _SENTENCE.finditer(text):
            logits = self.sentence_logits(match[0])
            if len(logits) and logits[0] > most:
                most, found = logits[0], match.span()
        return found


def _log_clean(logits: np.ndarray) -> np.ndarray:
    """Logarithm of one less the sigmoid."""
    return -np.logaddexp(0.0, logits)


def train(
    samples: list[str],
    labels: list[int],
    *,
    epochs: int = 40,
    rate: float = 0.1,
    decay: float = 0.05,
    batch: int = 256,
    seed: int = 0,
) -> Model:
    """Learn word weights from labels of whole texts (Adam on the noisy-or likelihood).

    Both labels weigh the same in sum, however few texts are toxic.

    The features are those that at least three of the texts have, the most
    frequent ``MOST_FEATURES``. Those whose weight stays small are forgotten.
    """
    cut = [words_and_ends(text) for text in samples]
    spread = Counter(feature for words in cut for feature in {f for word in set(words) for f in features(word)})
    spread.pop(_END, None)
    vocabulary = {feature: k for k, (feature, n) in enumerate(spread.most_common(MOST_FEATURES)) if n > 2}
    bags = []
    for words in cut:
        sentence, seen, ids, owners = 0, set(), [], []
        for word in [*words, _END]:
            if word == _END:
                found = [k for w in seen for f in features(w) if (k := vocabulary.get(f)) is not None]
                ids += found
                owners += [sentence] * len(found)
                sentence += bool(seen)
                seen = set()
            else:
                seen.add(word)
        bags.append((np.array(ids, np.int64), np.array(owners, np.int64), sentence))
    known = np.array(labels, np.float64)
    weights, bias = np.zeros(len(vocabulary)), np.array([-6.0])
    state = [np.zeros_like(v) for v in (weights, weights, bias, bias)]
    heavier = (len(known) - known.sum()) / max(1.0, known.sum())
    rng, step = np.random.default_rng(seed), 0
    for _ in range(epochs if len(set(labels)) > 1 else 0):
        order = rng.permutation(len(bags))
        for start in range(0, len(order), batch):
            picked = order[start : start + batch]
            sizes = np.array([bags[k][2] for k in picked])
            offsets = np.cumsum(sizes) - sizes
            ids = np.concatenate([bags[k][0] for k in picked])
            owners = np.concatenate([bags[k][1] + at for k, at in zip(picked, offsets, strict=True)])
            total = int(sizes.sum())
            text = np.repeat(np.arange(len(picked)), sizes)
            logits = np.bincount(owners, weights[ids], total) + bias
            toxic = 1 / (1 + np.exp(-np.clip(logits, -30, 30)))
            clean = np.bincount(text, _log_clean(logits), len(picked))
            odds = np.exp(clean) / np.maximum(-np.expm1(clean), 1e-9)
            back = np.where(known[picked] > 0, -heavier * odds, 1.0)[text] * toxic / len(picked)
            step += 1
            grads = (np.bincount(ids, back[owners], len(weights)) + decay * weights / len(picked), np.array([back.sum()]))
            for value, grad, m, v in ((weights, grads[0], *state[:2]), (bias, grads[1], *state[2:])):
                m += 0.1 * (grad - m)
                v += 0.001 * (grad * grad - v)
                value -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    kept = {feature: float(weights[k]) for feature, k in vocabulary.items() if abs(weights[k]) >= LEAST_WEIGHT}
    return Model(kept, float(bias[0]))


def learn(docs: DataFrame, labels: DataFrame, *, rows: int = SAMPLE_ROWS, text_column: str = "text", **options) -> Model:
    """Train on at most ``rows`` whole labelled texts, none of them held out.

    The number of rows bounds what comes to the driver. Labels, language and
    source are never inputs. Without labels every text scores the same low value.
    """
    picked = labelled_sample(docs, labels, "toxic", rows, text_column).collect()
    found = sorted((row["text"] or "", row["label"]) for row in picked)
    return train([text for text, _ in found], [label for _, label in found], **options)


def score(
    docs: DataFrame, model: Model, *, threshold: float = 0.5, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``doc_id, score, worst_start, worst_stop, predicted`` of every whole text; no shuffle.

    Of a text predicted to be toxic the worst sentence is told by its code
    points ``worst_start`` to ``worst_stop - 1``, else both are null. A null
    text scores 0 as an empty one does; a null id stays null; rows that repeat
    an id are scored each; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        scores, spans = [], []
        for text in texts(part.column(1)):
            scores.append(shared.value.score(text))
            spans.append((shared.value.worst_sentence(text) if scores[-1] >= threshold else None) or (None, None))
        bounds = [pa.array([span[end] for span in spans], pa.int64()) for end in (0, 1)]
        columns = [part.column(0), pa.array(scores, pa.float64()), *bounds]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "score", "worst_start", "worst_stop"])

    found = id_and_text(docs, id_column, text_column).mapInArrow(
        per_batch(work), "doc_id long, score double, worst_start long, worst_stop long"
    )
    return found.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def offending_sentences(
    docs: DataFrame, model: Model, *, threshold: float = 0.5, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``doc_id, start, stop, sentence, score`` of each sentence that is toxic by itself.

    ``start`` and ``stop`` count code points of the text. A null, empty or
    blank text has no sentence; a null id stays null; rows that repeat an id
    are searched each.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            rows = []
            for doc_id, text in zip(part.column(0).to_pylist(), texts(part.column(1)), strict=True):
                for match in _SENTENCE.finditer(text):
                    value = shared.value.score(match[0])
                    if value >= threshold:
                        rows.append((doc_id, match.start(), match.end(), match[0], value))
            columns = zip(*rows, strict=True) if rows else [[]] * 5
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.float64())
            arrays = [pa.array(column, kind) for column, kind in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "start", "stop", "sentence", "score"])

    return id_and_text(docs, id_column, text_column).mapInArrow(
        find, "doc_id long, start long, stop long, sentence string, score double"
    )
