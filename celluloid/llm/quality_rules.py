"""Quality rules: a decision list learned by sequential covering from labelled statistics.

Rules are conjunctions of thresholds on ratios of a text's statistics. One rule is grown on two
thirds of the labelled rows (the condition with the best information gain is added until the rule
covers no clean row), then pruned on the other third (conditions are dropped from the end while its
value does not fall), and the rows it covers are taken away before the next rule is grown. The list
ends when a rule is no longer precise on the pruning rows. The rules are emitted in order as one
Spark CASE expression over the statistics.

Edge cases: a null, empty or blank text has statistics 0 and fails the base rule, as every text of
under 50 words does. A null doc_id keeps its row and has no label. Repeated rows stay repeated.
Labels of one doc_id that disagree count once each. With no labelled row of either class the list is
empty and the base rule decides alone. Other columns pass through ``judge``; only columns named like
those it adds (stats, base_failed, rule, kept) are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from celluloid.llm.common import bounded_sample, ship, spread
from celluloid.llm.text_stats import FIELDS, text_stats

LABELLED_ROWS = 30_000  # bound on the labelled rows that the list is learned from
MIN_PRECISION = 0.9  # of a rule, on the pruning rows
MIN_COVER = 8  # rejected rows a rule has to cover
MAX_RULES = 16
MAX_CONDITIONS = 4
CUTS = 48  # candidate thresholds of a ratio

# ratio -> (numerator, denominator) among the statistics
RATIOS = {
    "symbols_per_word": ("n_symbols", "n_words"),
    "chars_per_word": ("word_chars", "n_words"),
    "dup_line_share": ("n_dup_lines", "n_lines"),
    "repeat_share": ("n_repeat_words", "n_words"),
    "distinct_share": ("n_distinct_words", "n_words"),
    "upper_share": ("n_upper", "n_letters"),
    "digits_per_word": ("n_digits", "n_words"),
    "marks_per_word": ("n_marks", "n_words"),
    "ends_per_word": ("n_sentence_ends", "n_words"),
    "words_per_line": ("n_words", "n_lines"),
}


@dataclass(frozen=True)
class Condition:
    ratio: str
    above: bool
    cut: float

    def column(self) -> Column:
        value = ratio(self.ratio)
        return value > self.cut if self.above else value <= self.cut

    def mask(self, values: dict[str, np.ndarray]) -> np.ndarray:
        return values[self.ratio] > self.cut if self.above else values[self.ratio] <= self.cut


Rule = tuple[Condition, ...]


def stat(name: str) -> Column:
    return F.col("stats")[name]


def ratio(name: str) -> Column:
    over, under = RATIOS[name]
    return F.when(stat(under) > 0, stat(over) / stat(under)).otherwise(0.0)


def statistics(docs: DataFrame) -> DataFrame:
    """The document rows with a struct ``stats`` (``FIELDS``) of the whole text."""
    ship(docs.sparkSession)
    schema = T.StructType([T.StructField(f, T.LongType()) for f in FIELDS])

    def count(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([text_stats(t) for t in texts], columns=list(FIELDS), dtype="int64")

    # not deterministic: so that a filter on the statistics does not count them a second time
    counted = F.pandas_udf(count, schema).asNondeterministic()
    return docs.withColumn("stats", counted("text"))


def base_failed() -> Column:
    return (stat("n_words") < 50) | (100 * stat("n_repeat_words") > 50 * stat("n_words"))


def _gain(covered_bad: np.ndarray, covered_good: np.ndarray, bad: int, good: int) -> np.ndarray:
    """FOIL's information gain of narrowing a rule to the covered rows."""
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = covered_bad * (np.log2(covered_bad / (covered_bad + covered_good)) - np.log2(bad / (bad + good)))
    return np.where(covered_bad > 0, gain, -np.inf)


def _midway(condition: Condition, column: np.ndarray) -> Condition:
    """The cut moved into the middle of the gap it lies in."""
    below, above = column[column <= condition.cut], column[column > condition.cut]
    if not len(below) or not len(above):
        return condition
    return Condition(condition.ratio, condition.above, float((below.max() + above.min()) / 2))


def _grow(values: dict[str, np.ndarray], bad: np.ndarray, alive: np.ndarray) -> Rule:
    rule: list[Condition] = []
    inside = alive.copy()
    while len(rule) < MAX_CONDITIONS and (inside & ~bad).any():
        n_bad, n_good = int((inside & bad).sum()), int((inside & ~bad).sum())
        best, choice = 1e-9, None
        for name, column in values.items():
            cuts = np.unique(np.quantile(column[inside & bad], np.linspace(0, 1, CUTS)))
            cuts = np.unique(np.concatenate([cuts, np.quantile(column[inside & ~bad], np.linspace(0, 1, CUTS))]))
            below_bad = np.searchsorted(np.sort(column[inside & bad]), cuts, side="right")
            below_good = np.searchsorted(np.sort(column[inside & ~bad]), cuts, side="right")
            for above in (True, False):
                b = n_bad - below_bad if above else below_bad
                g = n_good - below_good if above else below_good
                gains = _gain(b.astype(float), g.astype(float), n_bad, n_good)
                k = int(np.argmax(gains))
                if gains[k] > best:
                    best, choice = gains[k], Condition(name, above, float(cuts[k]))
        if choice is None:
            break
        choice = _midway(choice, values[choice.ratio][inside])
        rule.append(choice)
        inside &= choice.mask(values)
    return tuple(rule)


def _covers(rule: Rule, values: dict[str, np.ndarray], rows: np.ndarray) -> np.ndarray:
    return reduce(lambda m, c: m & c.mask(values), rule, rows.copy())


def _prune(rule: Rule, values: dict[str, np.ndarray], bad: np.ndarray, rows: np.ndarray) -> Rule:
    def worth(r: Rule) -> float:
        hit = _covers(r, values, rows)
        b, g = int((hit & bad).sum()), int((hit & ~bad).sum())
        return (b - g) / (b + g) if b + g else -1.0

    while len(rule) > 1 and worth(rule[:-1]) >= worth(rule):
        rule = rule[:-1]
    return rule


def learn(sample: pd.DataFrame) -> list[Rule]:
    """Ordered reject rules from rows with ``FIELDS`` and ``quality`` (0 or 1)."""
    sample = sample.sort_values(["spread", *FIELDS]).reset_index(drop=True)
    bad = sample["quality"].to_numpy() == 0
    values = {}
    for name, (over, under) in RATIOS.items():
        den = sample[under].to_numpy(dtype=float)
        values[name] = np.divide(sample[over].to_numpy(dtype=float), den, out=np.zeros(len(den)), where=den > 0)
    pruning = np.arange(len(sample)) % 3 == 2
    alive = np.ones(len(sample), dtype=bool)
    rules: list[Rule] = []
    while len(rules) < MAX_RULES and (alive & bad & ~pruning).sum() >= MIN_COVER and (~bad).any():
        rule = _grow(values, bad, alive & ~pruning)
        if not rule:
            break
        rule = _prune(rule, values, bad, alive & pruning)
        hit = _covers(rule, values, alive)
        held = hit & pruning
        right, wrong = int((held & bad).sum()), int((held & ~bad).sum())
        if (hit & bad).sum() < MIN_COVER or not right or right / (right + wrong) < MIN_PRECISION:
            break
        rules.append(rule)
        alive &= ~hit
    return rules


def verdict(rules: list[Rule]) -> Column:
    """Ordered conditional expression: number of the first rule that rejects the row, else null."""
    case = None
    for number, rule in enumerate(rules):
        condition = reduce(lambda a, b: a & b, (c.column() for c in rule))
        case = F.when(condition, number) if case is None else case.when(condition, number)
    return F.lit(None).cast("int") if case is None else case.otherwise(F.lit(None).cast("int"))


def labelled(docs: DataFrame, labels: DataFrame, rows: int = LABELLED_ROWS) -> pd.DataFrame:
    """Statistics of a bounded sample of labelled texts; those that the base rule rejects teach nothing."""
    known = labels.where(F.col("quality").isin(0, 1)).select(F.col("doc_id").alias("label_id"), "quality")
    known = F.broadcast(bounded_sample(known, rows, "label_id", "quality"))  # two narrow columns of at most ``rows`` rows
    texts = docs.select("doc_id", "text").join(known, F.col("doc_id") == F.col("label_id"))
    counted = statistics(texts).where(~base_failed())
    return counted.select(spread("doc_id").alias("spread"), "quality", "stats.*").toPandas()


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The document rows with stats, base_failed, rule (number of the first rule that rejects) and kept."""
    rules = learn(labelled(docs, labels))
    return (
        statistics(docs)
        .withColumn("base_failed", base_failed())
        .withColumn("rule", verdict(rules))
        .withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())
    )
