"""Quality rules: text statistics and decision lists learned from labelled ones.

Everything that touches texts is a DataFrame expression; the learned list
becomes one ordered ``CASE`` expression.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import WORD, labelled_sample

BLANKS = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
BASE_MIN_WORDS = 50
BASE_MAX_REPEATED = 50

# The ratios that the rules are about, from the counted statistics.
FEATURES = {
    "symbols_per_char": lambda: F.col("n_symbols") / F.greatest(F.col("word_chars"), F.lit(1)),
    "upper_per_char": lambda: F.col("n_upper") / F.greatest(F.col("word_chars"), F.lit(1)),
    "marks_per_word": lambda: F.col("n_marks") / F.greatest(F.col("n_words"), F.lit(1)),
    "chars_per_word": lambda: F.col("word_chars") / F.greatest(F.col("n_words"), F.lit(1)),
    "repeated_words": lambda: F.col("n_repeat_words") / F.greatest(F.col("n_words"), F.lit(1)),
    "repeated_lines": lambda: F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
    "words": lambda: F.col("n_words").cast("double"),
}


def _column(frame: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that later expressions read instead of computing it anew.

    The optimizer merges neighbouring projections, and a value named inside a
    lambda would then be computed for each element; it doesn't merge a generator.
    """
    return frame.select("*", F.explode(F.array(value)).alias(name))


def statistics(
    docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", keep: Sequence[str] = ()
) -> DataFrame:
    """Counts about each whole text, in one pass and without a shuffle.

    ``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` and
    the counts of capitals, ``!`` and lines. A null text has no words. For the
    repeated words the hashes of all three-word windows of a text are sorted
    with their places; neighbours with equal hashes tell the places that are
    found again. ``keep`` names columns to carry, which may not clash.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    frame = docs.select(F.col(id_column).alias("doc_id"), *(F.col(f"`{name}`") for name in keep), text.alias("_text"))
    length = F.length("_text")
    hashes = F.transform(F.regexp_extract_all("_text", F.lit(WORD), 0), lambda word: F.xxhash64(word))
    frame = frame.select(
        "*",
        (length - F.length(F.translate("_text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.length(F.translate("_text", BLANKS, "")).cast("long").alias("word_chars"),
        (length - F.length(F.translate("_text", "!", ""))).cast("long").alias("n_marks"),
        F.length(F.regexp_replace("_text", r"[^\p{Lu}]+", "")).cast("long").alias("n_upper"),
        F.filter(F.split("_text", "\n"), lambda line: F.length(F.translate(line, BLANKS, "")) > 0).alias("_lines"),
        hashes.alias("_words"),
    )
    frame = _column(frame.drop("_text"), "_w", F.col("_words")).drop("_words")
    frame = frame.select(
        *(name for name in frame.columns if name not in ("_lines", "_w")),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.size("_w").cast("long").alias("n_words"),
        F.when(
            F.size("_w") > 3,
            F.transform(
                F.slice("_w", 1, F.greatest(F.size("_w") - 2, F.lit(1))),
                lambda word, at: F.struct(
                    F.xxhash64(word, F.get("_w", at + 1), F.get("_w", at + 2)).alias("h"), at.alias("at")
                ),
            ),
        ).alias("_windows"),
    )
    frame = _column(frame, "_sorted", F.array_sort("_windows")).drop("_windows")
    pairs = F.size("_sorted") - 1
    found = F.flatten(
        F.zip_with(
            F.slice("_sorted", 1, pairs),
            F.slice("_sorted", 2, pairs),
            lambda a, b: F.when(a["h"] == b["h"], F.array(a["at"], b["at"])).otherwise(F.array().cast("array<int>")),
        )
    )
    frame = _column(frame, "_places", F.array_sort(F.array_distinct(found))).drop("_sorted")
    steps = F.size("_places") - 1
    covered = F.aggregate(
        F.zip_with(
            F.slice("_places", 1, F.greatest(steps, F.lit(0))),
            F.slice("_places", 2, F.greatest(steps, F.lit(0))),
            lambda a, b: F.least(b - a, F.lit(3)),
        ),
        F.lit(3).cast("long"),
        lambda total, step: total + step,
    )
    repeated = F.when(F.size("_places") > 0, covered).otherwise(F.lit(0)).cast("long")
    return frame.withColumn("n_repeat_words", repeated).drop("_places")


def base_failed() -> Column:
    """Too short, or mostly repeated windows."""
    return (F.col("n_words") < BASE_MIN_WORDS) | (
        100 * F.col("n_repeat_words") > BASE_MAX_REPEATED * F.col("n_words")
    )


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value = FEATURES[self.feature]()
        return value > self.threshold if self.above else value <= self.threshold

    def holds(self, row: dict[str, float]) -> bool:
        return (row[self.feature] > self.threshold) == self.above

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


@dataclass(frozen=True)
class DecisionList:
    """Rules in order; the first whose conditions all hold rejects, else the text is kept."""

    rules: tuple[tuple[Condition, ...], ...]

    def verdict(self) -> Column:
        """True to keep, as one ordered ``CASE`` expression."""
        result = None
        for rule in self.rules:
            holds = F.lit(True)
            for condition in rule:
                holds = holds & condition.column()
            result = F.when(holds, F.lit(False)) if result is None else result.when(holds, F.lit(False))
        return F.lit(True) if result is None else result.otherwise(F.lit(True))

    def keeps(self, row: dict[str, float]) -> bool:
        return not any(all(condition.holds(row) for condition in rule) for rule in self.rules)


class Learner:
    """Sequential covering over labelled rows that have the feature values.

    A rule starts empty and grows by the condition that gains most on two
    thirds of the rows, until it covers no good row there; then conditions are
    dropped from its end as long as that doesn't make it worse on the other
    third. It is added if it is right there more often than ``precision``; the
    rows it covers are set aside and the next rule is sought.
    """

    def __init__(self, thresholds: int = 24, precision: float = 0.8, least: int = 3, most_rules: int = 16):
        self.thresholds, self.precision, self.least, self.most_rules = thresholds, precision, least, most_rules

    def fit(self, rows: list[tuple[dict[str, float], bool]]) -> DecisionList:
        """``rows``: features, and whether the text is bad."""
        candidates = self._candidates([row for row, _ in rows])
        grow = [row for at, row in enumerate(rows) if at % 3]
        prune = [row for at, row in enumerate(rows) if not at % 3]
        rules: list[tuple[Condition, ...]] = []
        while len(rules) < self.most_rules:
            rule = self._pruned(self._grown(grow, candidates), prune)
            good, bad = self._covered(rule, grow + prune)
            if not rule or bad < self.least or bad < self.precision * (good + bad):
                break
            rules.append(rule)
            grow, prune = (
                [row for row in part if not all(condition.holds(row[0]) for condition in rule)] for part in (grow, prune)
            )
        return DecisionList(tuple(rules))

    def _candidates(self, rows: list[dict[str, float]]) -> list[Condition]:
        found = []
        for feature in FEATURES:
            values = sorted({row[feature] for row in rows})
            at = {round(k * (len(values) - 1) / (self.thresholds + 1)) for k in range(1, self.thresholds + 1)}
            cuts = sorted({(values[k] + values[k + 1]) / 2 for k in at if k + 1 < len(values)})
            found += [Condition(feature, above, cut) for cut in cuts for above in (True, False)]
        return found

    @staticmethod
    def _covered(rule: Sequence[Condition], rows) -> tuple[int, int]:
        bad = [is_bad for row, is_bad in rows if all(condition.holds(row) for condition in rule)]
        return len(bad) - sum(bad), sum(bad)

    def _grown(self, rows, candidates: list[Condition]) -> tuple[Condition, ...]:
        rule: list[Condition] = []
        good, bad = self._covered((), rows)
        while good and bad:
            rate = math.log2(bad / (good + bad))
            best = (0.0, None, rows)
            for condition in candidates:
                left = [row for row in rows if condition.holds(row[0])]
                hit = sum(is_bad for _, is_bad in left)
                if hit >= self.least and (gain := hit * (math.log2(hit / len(left)) - rate)) > best[0]:
                    best = (gain, condition, left)
            if best[1] is None:
                break
            rule.append(best[1])
            rows = best[2]
            good, bad = self._covered((), rows)
        return tuple(rule)

    def _pruned(self, rule: tuple[Condition, ...], rows) -> tuple[Condition, ...]:
        def worth(part: tuple[Condition, ...]) -> float:
            good, bad = self._covered(part, rows)
            return (bad - good) / (bad + good) if bad + good else -1.0

        while len(rule) > 1 and worth(rule[:-1]) >= worth(rule):
            rule = rule[:-1]
        return rule


def learn_rules(docs: DataFrame, labels: DataFrame, *, rows: int = 2000, learner: Learner | None = None) -> DecisionList:
    """A decision list from the statistics of at most ``rows`` labelled texts.

    The rows are picked by hash of the id, the same in every run, none of them
    held out, and only their statistics come to the driver. Texts that the base
    rules reject are not learned from: the list is to judge the others.
    Without labels the list is empty and keeps all.
    """
    picked = statistics(labelled_sample(docs, labels, "quality", rows), keep=("label",)).where(~base_failed())
    values = picked.select(*(FEATURES[name]().alias(name) for name in FEATURES), "label", "doc_id")
    found = sorted(values.collect(), key=lambda row: (row["doc_id"] * 2654435761 % 4093, row["doc_id"]))
    return (learner or Learner()).fit([(row.asDict(), row["label"] == 0) for row in found])


def apply_rules(docs: DataFrame, rules: DecisionList, **columns: str) -> DataFrame:
    """The statistics with ``base_failed`` and ``kept``.

    A null or empty text fails the base rules; a null id stays null; rows that
    repeat an id are judged each.
    """
    judged = statistics(docs, **columns).withColumn("base_failed", base_failed())
    return judged.withColumn("kept", F.when(F.col("base_failed"), F.lit(False)).otherwise(rules.verdict()))
