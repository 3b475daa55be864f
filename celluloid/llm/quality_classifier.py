"""Quality classifier: learning from positive and unlabelled texts.

Positives are texts labelled 1, the unlabelled set is web text without its labels. A linear model
over binned text statistics is fitted by minimising the non-negative unbiased risk
``prior * R+(positives) + max(0, R-(unlabelled) - prior * R-(positives))`` with the sigmoid loss: in
a batch whose second part falls below zero, the step goes up that part's slope instead. The class
prior is the share of label 1 among the labelled learning rows; without a 0 among them, it is the
Elkan-Noto estimate of a first fit. A logistic curve fitted to the labelled learning rows turns the
model's margin into a probability; only margin and label enter it.

The model is fitted on bounded samples (``POSITIVES``, ``UNLABELLED``, ``CALIBRATION`` rows, fixed
pseudo-random choices); every text is scored whole.

Edge cases: null, empty and blank texts have statistics 0 and are scored like any other. Rows with a
null id or label teach nothing; without positives every score is the prior (0.5 if unknown).
Repeated rows stay; other columns pass through unless named stats or score.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from celluloid.llm.common import bounded_sample, ship
from celluloid.llm.quality_rules import RATIOS, statistics
from celluloid.llm.text_stats import FIELDS

POSITIVES, UNLABELLED, CALIBRATION = 12_000, 24_000, 12_000
BINS = 12
EPOCHS = 30
BATCH = 512
RATE = 0.05
DECAY = 1e-4


def features(stats: pd.DataFrame) -> np.ndarray:
    """Ratios of a text's statistics, and the logarithm of its words."""
    columns = [np.log1p(stats["n_words"].to_numpy(dtype=float))]
    for over, under in RATIOS.values():
        den = stats[under].to_numpy(dtype=float)
        columns.append(np.divide(stats[over].to_numpy(dtype=float), den, out=np.zeros(len(den)), where=den > 0))
    return np.column_stack(columns)


@dataclass
class Model:
    edges: list[np.ndarray]
    weights: np.ndarray
    slope: float = 1.0
    offset: float = 0.0

    def cells(self, values: np.ndarray) -> np.ndarray:
        """Index of each feature's bin in the weights; the last weight is the bias."""
        start, found = 0, []
        for column, edges in zip(values.T, self.edges):
            found.append(start + np.searchsorted(edges, column, side="left"))
            start += len(edges) + 1
        return np.column_stack(found)

    def margin(self, values: np.ndarray) -> np.ndarray:
        return self.weights[self.cells(values)].sum(axis=1) + self.weights[-1]

    def score(self, values: np.ndarray) -> np.ndarray:
        return _sigmoid(self.slope * self.margin(values) + self.offset)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -50, 50)))


def bin_edges(values: np.ndarray) -> list[np.ndarray]:
    """Cuts between distinct values, near the quantiles; also one behind a frequent lowest value."""
    made = []
    for column in values.T:
        distinct = np.unique(column)
        cuts = np.unique(np.quantile(distinct, np.linspace(0, 1, BINS + 1)[1:-1])) if len(distinct) > 1 else distinct
        common = np.unique(np.quantile(column, np.linspace(0, 1, BINS + 1)[1:-1]))
        made.append(np.unique(np.concatenate([cuts, common, distinct[:1]])))
    return made


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float, seed: int = 7) -> Model:
    """Minimises the non-negative risk by Adam over batches."""
    both = np.concatenate([positive, unlabelled])
    model = Model(bin_edges(both), np.zeros(0))
    model.weights = np.zeros(sum(len(e) + 1 for e in model.edges) + 1)
    cells_p, cells_u = model.cells(positive), model.cells(unlabelled)
    random = np.random.default_rng(seed)
    first, second, step = np.zeros_like(model.weights), np.zeros_like(model.weights), 0
    parts = max(1, len(cells_u) // BATCH)
    for _ in range(EPOCHS):
        order_p, order_u = random.permutation(len(cells_p)), random.permutation(len(cells_u))
        for part in range(parts):
            rows_u = cells_u[order_u[part::parts]]
            rows_p = cells_p[order_p[part % min(parts, len(order_p)) :: parts]]
            p = _sigmoid(model.weights[rows_p].sum(axis=1) + model.weights[-1])
            u = _sigmoid(model.weights[rows_u].sum(axis=1) + model.weights[-1])
            slope_p, slope_u = p * (1 - p) / len(p), u * (1 - u) / len(u)
            negative_risk = u.mean() - prior * p.mean()  # the sigmoid loss of calling a text negative is its score
            if negative_risk >= 0:
                grad_p, grad_u = -2 * prior * slope_p, slope_u
            else:
                grad_p, grad_u = prior * slope_p, -slope_u
            slope = np.zeros_like(model.weights)
            for rows, grads in ((rows_p, grad_p), (rows_u, grad_u)):
                np.add.at(slope, rows, grads[:, None])
                slope[-1] += grads.sum()
            slope += DECAY * model.weights
            step += 1
            first = 0.9 * first + 0.1 * slope
            second = 0.999 * second + 0.001 * slope**2
            model.weights -= RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return model


def calibrate(model: Model, values: np.ndarray, labels: np.ndarray) -> None:
    """Logistic curve over the margin, by Newton steps with a weak pull to slope 1."""
    margin = model.margin(values)
    design = np.column_stack([margin, np.ones_like(margin)])
    at = np.array([1.0, 0.0])
    for _ in range(50):
        p = _sigmoid(design @ at)
        slope = design.T @ (p - labels) + 1e-2 * (at - [1.0, 0.0])
        curve = (design * (p * (1 - p))[:, None]).T @ design + 1e-2 * np.eye(2)
        move = np.linalg.solve(curve, slope)
        at = at - np.clip(move, -5, 5)
        if np.abs(move).max() < 1e-6:
            break
    model.slope, model.offset = max(float(at[0]), 1e-3), float(at[1])


def learn(stats: DataFrame, labels: DataFrame, learning: Column) -> Model | float:
    """stats: rows with doc_id and stats. learning: condition on doc_id for rows to learn from."""
    names = ["stats." + f for f in FIELDS]
    known = labels.where(F.col("quality").isin(0, 1)).select(F.col("doc_id").alias("label_id"), "quality")
    open_rows = stats.where(learning).select("doc_id", "stats")
    joined = open_rows.join(known, F.col("doc_id") == F.col("label_id"))
    shares = joined.agg(F.sum("quality").alias("ones"), F.count("*").alias("rows")).first()
    if not shares["ones"]:
        return 0.5 if not shares["rows"] else 0.0
    positive = bounded_sample(joined.where("quality = 1"), POSITIVES, "doc_id").select(*names).toPandas()
    web = bounded_sample(open_rows, UNLABELLED, "doc_id").select(*names).toPandas()
    prior = shares["ones"] / shares["rows"]
    if shares["ones"] == shares["rows"]:
        trial = fit(features(positive), features(web), 0.5)
        odds = _sigmoid(trial.margin(features(positive))).mean()
        prior = float(np.clip(_sigmoid(trial.margin(features(web))).mean() / max(odds, 1e-6), 0.05, 0.95))
    model = fit(features(positive), features(web), prior)
    if shares["ones"] < shares["rows"]:
        checked = bounded_sample(joined, CALIBRATION, "doc_id").select("quality", *names).toPandas()
        calibrate(model, features(checked), checked["quality"].to_numpy(dtype=float))
    return model


def score(stats: DataFrame, model: Model | float) -> DataFrame:
    """The rows with score, the probability of label 1."""
    if isinstance(model, float):
        return stats.withColumn("score", F.lit(model))
    ship(stats.sparkSession)

    def rate(batch: pd.DataFrame) -> pd.Series:
        return pd.Series(model.score(features(batch)))

    rate.__annotations__ = {"batch": pd.DataFrame, "return": pd.Series}
    return stats.withColumn("score", F.pandas_udf(rate, "double")("stats"))


__all__ = ["features", "fit", "learn", "score", "statistics"]
