"""Toxicity: a convolutional text classifier in numpy.

A word's embedding is the sum of two hashed rows, one for the word and one for its first letters, so
that unseen endings of a known stem still count. Filters of ``WIDTHS`` words run over the whole
text, are rectified and max-pooled, and one linear layer turns the pooled values into a logit. Only
the pooled maxima carry a gradient, so training costs little more than the forward pass; it uses
Adagrad. The logit's threshold is calibrated by language on learning rows kept out of training: the
language is guessed from the text's own function words, and its threshold is subtracted, so that a
score of 0.5 is the threshold in every language.

The model learns from every labelled row. Their texts are staged as word numbers and dealt out to
shards, at most ``SHARDS`` tasks. In each of ``ROUNDS`` rounds a task goes through its shard from the
common network, block by block, and the networks are averaged by a shuffle: an embedding row over
the shards that met it, everything else over all of them. The driver holds one network and counts.
Thresholds come from counts of all calibration rows by their logits, in bins of ``1 / BINS``.
Every text is scored whole.

Edge cases: a null or empty text has no words, its pooled values are 0 and it gets the bias' score.
Rows whose id or label is null teach nothing; without both labels every score is 0 (or 1 when only
label 1 is known). Repeated rows stay; other columns pass through unless named score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from celluloid.llm.common import ship, spread, staged, words
from celluloid.llm.stopwords import BY_WORD, STOP_WORDS

WORD_ROWS, STEM_ROWS = 1 << 15, 1 << 14
STEM = 5  # letters of a stem
DIMENSIONS, FILTERS, WIDTHS = 12, 10, (1, 2, 3)
UPDATES, BATCH, RATE = 1500, 32, 0.1  # updates of a shard, at least
ROUNDS, SHARDS, SHARD_ROWS = 3, 64, 8_000
BLOCK_ROWS, BLOCK_BYTES, PIECE = 4_096, 1 << 25, 1 << 14  # rows a task trains on at a time, words of a text it looks at at a time
PARTS = 8  # of the embedding, which are averaged apart
BINS = 64
MIN_CALIBRATION = 20  # toxic rows a language needs for a threshold of its own
MARKS = " .,;:!?\"'()[]{}*_-–—…«»“”„#$%&|<>"
LANGUAGES = (*sorted(STOP_WORDS), "other")


def numbers(word: bytes) -> tuple[int, int, int]:
    """Embedding rows of a word and its stem, and the languages it is a function word of, as bits."""
    plain = word.decode().lower().strip(MARKS)
    row = xxhash.xxh3_64_intdigest(plain) % WORD_ROWS
    stem = WORD_ROWS + xxhash.xxh3_64_intdigest("stem " + plain[:STEM]) % STEM_ROWS
    return row, stem, sum(1 << LANGUAGES.index(c) for c in BY_WORD.get(plain, ()))


class Lexicon(dict):
    """Numbers the words of texts; begun anew when ``LIMIT`` words are known."""

    LIMIT = 120_000

    def __init__(self):
        super().__init__()
        self.rows: list[tuple[int, int, int]] = []

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self.rows)
        self.rows.append(numbers(word))
        return number

    def of(self, text: str | None) -> np.ndarray:
        found = words(text)
        return np.fromiter(map(self.__getitem__, found), dtype=np.int64, count=len(found))


@dataclass
class Network:
    embedding: np.ndarray
    filters: dict[int, np.ndarray]  # width -> (width, dimensions, filters)
    biases: dict[int, np.ndarray]
    output: np.ndarray
    bias: float = 0.0
    thresholds: dict[str, float] = field(default_factory=dict)

    @staticmethod
    def new(seed: int = 11) -> Network:
        random = np.random.default_rng(seed)
        draw = lambda *shape, scale: (random.standard_normal(shape) * scale).astype(np.float32)
        return Network(
            draw(WORD_ROWS + STEM_ROWS, DIMENSIONS, scale=0.1),
            {w: draw(w, DIMENSIONS, FILTERS, scale=0.5) for w in WIDTHS},
            {w: np.zeros(FILTERS, dtype=np.float32) for w in WIDTHS},
            draw(len(WIDTHS) * FILTERS, scale=0.3),
        )

    def pooled(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Maxima over the text, and where they stand, by width and filter; rectified."""
        values = np.zeros((len(WIDTHS), FILTERS), dtype=np.float32)
        places = np.zeros((len(WIDTHS), FILTERS), dtype=np.int64)
        if len(vectors):
            padded = np.concatenate([vectors, np.zeros((max(WIDTHS) - 1, DIMENSIONS), dtype=np.float32)])
            for k, width in enumerate(WIDTHS):
                run = self.biases[width] + sum(padded[o : o + len(vectors)] @ self.filters[width][o] for o in range(width))
                places[k] = run.argmax(axis=0)
                values[k] = run[places[k], np.arange(FILTERS)]
        return np.maximum(values, 0), places

    def logit(self, pooled: np.ndarray) -> float:
        return float(pooled.reshape(-1) @ self.output + self.bias)


class Trainer:
    """Adagrad steps over batches of a network; ``rows_seen`` and ``squares`` are its sums of squared slopes."""

    def __init__(self, net: Network, weights: tuple[float, float], rows_seen: np.ndarray | None = None, squares: np.ndarray | None = None):
        self.net, self.weights = net, weights  # weights of labels 0 and 1
        self.rows_seen = np.full(net.embedding.shape, 1e-3, dtype=np.float32) if rows_seen is None else rows_seen
        self.squares = np.full(len(flat(net)), 1e-3, dtype=np.float32) if squares is None else squares
        self.met = np.zeros(len(net.embedding), dtype=bool)
        self.wide = np.concatenate([np.full(FILTERS, w) for w in WIDTHS])  # width of each pooled value

    def kernels(self) -> tuple[np.ndarray, np.ndarray]:
        """What a window's word o adds to every pooled value (0 for narrower filters), and the biases."""
        blank = np.zeros((DIMENSIONS, FILTERS), dtype=np.float32)
        made = [np.hstack([self.net.filters[w][o] if o < w else blank for w in WIDTHS]) for o in range(max(WIDTHS))]
        return np.stack(made), np.concatenate([self.net.biases[w] for w in WIDTHS])

    def peaks(self, text: np.ndarray, kernels: np.ndarray, biases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Maxima over a text and where they stand, by width and filter; not rectified."""
        best, places = np.full(len(biases), -np.inf, dtype=np.float32), np.zeros(len(biases), dtype=np.int64)
        reach = max(WIDTHS) - 1
        for at in range(0, len(text), PIECE):
            piece = text[at : at + PIECE + reach]
            size = min(PIECE, len(text) - at)
            vectors = np.zeros((size + reach, DIMENSIONS), dtype=np.float32)
            vectors[: len(piece)] = self.net.embedding[piece[:, 0]] + self.net.embedding[piece[:, 1]]
            run = vectors[:size] @ kernels[0] + biases
            for o in range(1, max(WIDTHS)):
                run += vectors[o : o + size] @ kernels[o]
            found = run.argmax(axis=0)
            values = run[found, np.arange(len(biases))]
            better = values > best
            best[better], places[better] = values[better], found[better] + at
        return best, places

    def step(self, texts: list[np.ndarray], labels: np.ndarray) -> None:
        net, size = self.net, len(texts)
        kernels, biases = self.kernels()
        met = [self.peaks(t, kernels, biases) for t in texts]
        lengths = np.array([len(t) for t in texts])
        pooled = np.maximum(np.stack([v for v, _ in met]), 0) * (lengths > 0)[:, None]
        places = np.stack([p for _, p in met])
        logits = pooled @ net.output + net.bias
        error = (1 / (1 + np.exp(-np.clip(logits, -30, 30))) - labels) * np.where(labels == 1, self.weights[1], self.weights[0]) / size
        passed = (error[:, None] * net.output * (pooled > 0)).astype(np.float32)
        slope_kernels = np.zeros_like(kernels)
        rows, pulls = [], []
        for o in range(max(WIDTHS)):
            number, column = np.nonzero((places + o < lengths[:, None]) & (o < self.wide) & (passed != 0))
            if not len(number):
                continue
            found = np.array([texts[n][p] for n, p in zip(number, places[number, column] + o)], dtype=np.int64)
            strength = passed[number, column][:, None]
            vectors = net.embedding[found[:, 0]] + net.embedding[found[:, 1]]
            np.add.at(slope_kernels[o].T, column, vectors * strength)
            pull = kernels[o].T[column] * strength
            rows += [found[:, 0], found[:, 1]]
            pulls += [pull, pull]
        slopes = Network(net.embedding, {}, {}, error @ pooled, float(error.sum()))
        totals = passed.sum(axis=0)
        for k, w in enumerate(WIDTHS):
            own = slice(k * FILTERS, (k + 1) * FILTERS)
            slopes.filters[w], slopes.biases[w] = slope_kernels[:w, :, own], totals[own]
        slope = flat(slopes)
        self.squares += slope**2
        unfold(net, flat(net) - RATE * slope / np.sqrt(self.squares))
        if rows:
            touches, pulled = np.concatenate(rows), np.concatenate(pulls)
            order = np.argsort(touches, kind="stable")
            touched, first = np.unique(touches[order], return_index=True)
            slope = np.add.reduceat(pulled[order], first)
            self.rows_seen[touched] += slope**2
            net.embedding[touched] -= RATE * slope / np.sqrt(self.rows_seen[touched])
            self.met[touched] = True

    def passes(self, texts: list[np.ndarray], labels: np.ndarray, count: int, random: np.random.Generator) -> None:
        for _ in range(count):
            order = random.permutation(len(texts))
            for at in range(0, len(order), BATCH):
                batch = order[at : at + BATCH]
                self.step([texts[i] for i in batch], labels[batch])


def flat(net: Network) -> np.ndarray:
    """Everything but the embedding, as one array."""
    pieces = [net.output, [net.bias], *(net.filters[w].reshape(-1) for w in WIDTHS), *(net.biases[w] for w in WIDTHS)]
    return np.concatenate(pieces).astype(np.float32)


def unfold(net: Network, values: np.ndarray) -> None:
    """The reverse of ``flat``, into the network."""
    at = len(net.output) + 1
    net.output, net.bias = values[: at - 1], float(values[at - 1])
    for w in WIDTHS:
        size = w * DIMENSIONS * FILTERS
        net.filters[w], at = values[at : at + size].reshape(w, DIMENSIONS, FILTERS), at + size
    for w in WIDTHS:
        net.biases[w], at = values[at : at + FILTERS], at + FILTERS


def class_weights(clean: float, toxic: float) -> tuple[float, float]:
    """Both classes weigh the same."""
    return 2 * toxic / (clean + toxic), 2 * clean / (clean + toxic)


def train(texts: list[np.ndarray], labels: np.ndarray, seed: int = 11) -> Network:
    """texts: (words, 2) arrays of embedding rows, all in this process."""
    trainer = Trainer(Network.new(seed), class_weights((labels == 0).sum(), (labels == 1).sum()))
    trainer.passes(texts, labels, -(-UPDATES * BATCH // len(texts)), np.random.default_rng(seed))
    return trainer.net


def train_rounds(rows: DataFrame, clean: int, toxic: int) -> Network:
    """rows: (label, rows) of all training texts, staged. Networks of the shards are averaged after each round."""
    weights, net, seen, squares = class_weights(clean, toxic), Network.new(), None, None
    shards = min(max((clean + toxic) // SHARD_ROWS, 1), SHARDS)
    count = max(1, -(-UPDATES * BATCH * shards // ((clean + toxic) * ROUNDS)))
    cut = -(-len(net.embedding) // PARTS)
    context = rows.sparkSession.sparkContext

    for turn in range(ROUNDS):
        held = context.broadcast((net, seen, squares))

        def go(batches: Iterator[pa.RecordBatch], held=held, turn=turn) -> Iterator[pa.RecordBatch]:
            start, seen, squares = held.value
            own = Network(start.embedding.copy(), dict(start.filters), dict(start.biases), start.output, start.bias)
            trainer = Trainer(own, weights, None if seen is None else seen.copy(), None if squares is None else squares.copy())
            shard = TaskContext.get().partitionId()
            random = np.random.default_rng((turn, shard))
            texts, labels, size, total = [], [], 0, 0

            def learned() -> int:
                trainer.passes(texts, np.array(labels, dtype=float), count, random)
                done = len(texts)
                texts.clear(), labels.clear()
                return done

            for batch in batches:
                for label, data in zip(batch.column("label").to_pylist(), batch.column("rows")):
                    texts.append(np.frombuffer(data.as_buffer(), dtype=np.uint16).reshape(-1, 2))
                    labels.append(label)
                    size += len(texts[-1]) * 4
                    if len(texts) == BLOCK_ROWS or size > BLOCK_BYTES:
                        total, size = total + learned(), 0
            total += learned()
            if not total:
                return
            made = [(-1, b"", np.stack([flat(own), trainer.squares]).tobytes())]
            for part in range(PARTS):
                met = np.flatnonzero(trainer.met[part * cut : (part + 1) * cut]) + part * cut
                made.append((part, met.astype(np.int32).tobytes(), np.hstack([own.embedding[met], trainer.rows_seen[met]]).tobytes()))
            parts, places, values = zip(*made)
            columns = [pa.array(c, t) for c, t in zip(([shard] * len(made), parts, [total] * len(made), places, values), (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary()))]
            yield pa.RecordBatch.from_arrays(columns, names=["shard", "part", "size", "places", "values"])

        def mean(table: pa.Table) -> pa.Table:
            met = sorted(table.to_pylist(), key=lambda r: r["shard"])
            part = met[0]["part"]
            if part < 0:
                sizes = np.array([r["size"] for r in met], dtype=np.float64)
                values = np.stack([np.frombuffer(r["values"], dtype=np.float32) for r in met])
                places, mixed = b"", (sizes @ values / sizes.sum()).astype(np.float32)
            else:
                sums, sizes = np.zeros((cut, 2 * DIMENSIONS)), np.zeros(cut)
                for r in met:
                    at = np.frombuffer(r["places"], dtype=np.int32) - part * cut
                    sums[at] += np.frombuffer(r["values"], dtype=np.float32).reshape(len(at), 2 * DIMENSIONS) * float(r["size"])
                    sizes[at] += r["size"]
                at = np.flatnonzero(sizes)
                places, mixed = (at + part * cut).astype(np.int32).tobytes(), (sums[at] / sizes[at, None]).astype(np.float32)
            return pa.table({"part": pa.array([part], pa.int32()), "places": pa.array([places], pa.binary()), "values": pa.array([mixed.tobytes()], pa.binary())})

        trained = rows.select("label", "rows").coalesce(shards).mapInArrow(go, "shard int, part int, size long, places binary, values binary")
        # PARTS + 1 rows, together one network
        averaged = trained.groupBy("part").applyInArrow(mean, "part int, places binary, values binary").collect()
        held.destroy()
        net = Network(net.embedding.copy(), dict(net.filters), dict(net.biases), net.output, net.bias)
        seen = np.full(net.embedding.shape, 1e-3, dtype=np.float32) if seen is None else seen.copy()
        for r in averaged:
            if r["part"] < 0:
                values, squares = np.frombuffer(bytes(r["values"]), dtype=np.float32).reshape(2, -1)
                unfold(net, values)
            else:
                at = np.frombuffer(bytes(r["places"]), dtype=np.int32)
                both = np.frombuffer(bytes(r["values"]), dtype=np.float32).reshape(len(at), 2 * DIMENSIONS)
                net.embedding[at], seen[at] = both[:, :DIMENSIONS], both[:, DIMENSIONS:]
    return net


def threshold(logits: np.ndarray, labels: np.ndarray) -> float:
    """Cut with the best F1, in the middle of the gap it lies in."""
    values, back = np.unique(-logits, return_inverse=True)  # ties are not parted
    return best_cut(np.bincount(back), np.bincount(back, labels), -values, -values)


def best_cut(counts: np.ndarray, hits: np.ndarray, low: np.ndarray, high: np.ndarray) -> float:
    """The same for rows counted in bins, highest first: rows, rows of label 1, least and greatest logit of a bin."""
    f1 = 2 * np.cumsum(hits) / (np.cumsum(counts) + hits.sum())
    best = int(np.argmax(f1))
    following = high[best + 1] if best + 1 < len(high) else low[best] - 2
    return float((low[best] + following) / 2)


class Scorer:
    """Scores texts with the filters' responses laid in once for each known word."""

    def __init__(self, net: Network):
        self.net = net
        self.turns = [(w, o) for w in WIDTHS for o in range(w)]
        self.lexicon = Lexicon()
        self._begin()

    def _begin(self) -> None:
        self.lexicon.clear()
        self.lexicon.rows.clear()
        self.responses = np.zeros((1 << 12, len(self.turns) * FILTERS), dtype=np.float32)
        self.bits = np.zeros(1 << 12, dtype=np.int64)
        self.laid = 0

    def _lay(self) -> None:
        fresh = np.array(self.lexicon.rows[self.laid :], dtype=np.int64).reshape(-1, 3)
        size = self.laid + len(fresh)
        while size > len(self.responses):
            self.responses = np.concatenate([self.responses, np.zeros_like(self.responses)])
            self.bits = np.concatenate([self.bits, np.zeros_like(self.bits)])
        vectors = self.net.embedding[fresh[:, 0]] + self.net.embedding[fresh[:, 1]]
        self.responses[self.laid : size] = np.hstack([vectors @ self.net.filters[w][o] for w, o in self.turns])
        self.bits[self.laid : size] = fresh[:, 2]
        self.laid = size

    def logit(self, text: str | None) -> tuple[float, str]:
        """Logit of the whole text, and the guessed language."""
        if len(self.lexicon.rows) > Lexicon.LIMIT:
            self._begin()
        found = self.lexicon.of(text)
        if len(self.lexicon.rows) > self.laid:
            self._lay()
        best = np.full((len(WIDTHS), FILTERS), -np.inf, dtype=np.float32)
        step = 1 << 14
        for at in range(0, len(found), step):  # bounded pieces, each with the words its last windows reach into
            size = min(step, len(found) - at)
            block = self.responses[found[at : at + size + max(WIDTHS) - 1]]
            if len(block) < size + max(WIDTHS) - 1:
                block = np.concatenate([block, np.zeros((size + max(WIDTHS) - 1 - len(block), block.shape[1]), dtype=np.float32)])
            column = 0
            for k, width in enumerate(WIDTHS):
                run = block[:size, column : column + FILTERS]
                for o in range(1, width):
                    column += FILTERS
                    run = run + block[o : o + size, column : column + FILTERS]
                column += FILTERS
                best[k] = np.maximum(best[k], run.max(axis=0) + self.net.biases[width])
        counts = np.bincount(self.bits[found], minlength=1)
        return self.net.logit(np.maximum(best, 0)), guess(counts)

    def score(self, text: str | None) -> float:
        logit, language = self.logit(text)
        cut = self.net.thresholds.get(language, self.net.thresholds.get("", 0.0))
        return float(1 / (1 + np.exp(-np.clip(logit - cut, -500, 500))))


def guess(counts: np.ndarray) -> str:
    """Language with most function words; counts: by the bits of the languages."""
    totals = [sum(int(counts[b]) for b in np.flatnonzero(counts) if b >> k & 1) for k in range(len(LANGUAGES) - 1)]
    return LANGUAGES[int(np.argmax(totals))] if max(totals) else "other"


def encoded(docs: DataFrame) -> DataFrame:
    """(label, calibrating, rows, language): a text's embedding rows as uint16 bytes."""
    ship(docs.sparkSession)
    schema = T.StructType().add("rows", "binary").add("language", "string")

    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        lexicon, laid = Lexicon(), np.zeros((0, 3), dtype=np.int64)
        for texts in batches:
            made = []
            for text in texts:
                if len(lexicon.rows) > Lexicon.LIMIT:
                    lexicon.clear()
                    lexicon.rows.clear()
                    laid = laid[:0]
                found = lexicon.of(text)
                if len(found) and found.max() >= len(laid):
                    fresh = np.array(lexicon.rows[len(laid) :], dtype=np.int64).reshape(-1, 3)
                    laid = np.concatenate([laid, fresh])
                known = laid[found]
                made.append((known[:, :2].astype(np.uint16).tobytes(), guess(np.bincount(known[:, 2], minlength=1))))
            yield pd.DataFrame(made, columns=["rows", "language"])

    return docs.select("doc_id", "label", "calibrating", F.pandas_udf(encode, schema)("text").alias("_e")).select("doc_id", "label", "calibrating", "_e.*")


def logit_counts(rows: DataFrame, net: Network) -> list:
    """Rows and rows of label 1 by language and bin of the logit, with the bin's least and greatest logit."""
    held = rows.sparkSession.sparkContext.broadcast(net)

    def rate(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        trainer = Trainer(held.value, (1.0, 1.0))
        kernels, biases = trainer.kernels()
        for texts in batches:
            met = [np.frombuffer(t, dtype=np.uint16).reshape(-1, 2) for t in texts]
            yield pd.Series([held.value.logit(np.maximum(trainer.peaks(t, kernels, biases)[0], 0)) for t in met], dtype="float64")

    rated = rows.select("language", "label", F.pandas_udf(rate, "double").asNondeterministic()("rows").alias("logit"))
    # bins end at +-2,000 / BINS, so that they are of a bounded number
    bins = F.greatest(F.lit(-2_000), F.least(F.lit(2_000), F.floor(F.col("logit") * BINS))).alias("bin")
    counted = rated.groupBy("language", bins).agg(F.count("*").alias("n"), F.sum("label").alias("hits"), F.min("logit").alias("low"), F.max("logit").alias("high"))
    return counted.collect()


def thresholds(counted: list) -> dict[str, float]:
    """Cuts of the languages with enough rows of both labels; of all rows under the empty name."""
    told = pd.DataFrame([r.asDict() for r in counted])
    both = told.groupby("bin", as_index=False).agg({"n": "sum", "hits": "sum", "low": "min", "high": "max"}).assign(language="")
    cuts = {}
    for language, own in [("", both), *told.groupby("language")]:
        own = own.sort_values("bin", ascending=False)
        toxic = own["hits"].sum()
        if language == "" or (toxic >= MIN_CALIBRATION and own["n"].sum() - toxic >= MIN_CALIBRATION):
            cuts[language] = best_cut(*(own[c].to_numpy(dtype=float) for c in ("n", "hits", "low", "high")))
    return cuts


def learn(docs: DataFrame, labels: DataFrame, learning: Column, calibrating: Column) -> Network | float:
    """learning, calibrating: conditions on doc_id; rows of both choose the thresholds only."""
    known = labels.where(learning & F.col("toxic").isin(0, 1)).select(
        F.col("doc_id").alias("label_id"), F.col("toxic").cast("int").alias("label"), F.coalesce(calibrating, F.lit(False)).alias("calibrating")
    )
    # labels are a few bytes a row; the texts are not sorted for the join
    texts = docs.where(learning).select("doc_id", "text").join(known.hint("shuffle_hash"), F.col("doc_id") == F.col("label_id"))
    order = ("calibrating", spread("doc_id"), "rows", "label")  # files do not depend on the order rows arrive in
    rows = staged(encoded(texts).sortWithinPartitions(*order).drop("doc_id"), "toxicity-rows")
    counts = {(r["calibrating"], r["label"]): r["count"] for r in rows.groupBy("calibrating", "label").count().collect()}
    found = {label for _, label in counts}
    if len(found) < 2:
        return float(max(found, default=0))
    training, held = rows.where(~F.col("calibrating")), rows.where("calibrating")
    if not all((False, label) in counts for label in (0, 1)):
        training, held = rows, rows.limit(0)
        counts = {(False, label): sum(n for (_, l), n in counts.items() if l == label) for label in (0, 1)}
    net = train_rounds(training, counts[False, 0], counts[False, 1])
    checked = held if all((True, label) in counts for label in (0, 1)) else training
    net.thresholds = thresholds(logit_counts(checked, net))
    return net


def score(docs: DataFrame, net: Network | float) -> DataFrame:
    """The rows with score, from 0 to 1; 0.5 is the threshold of the text's language."""
    if isinstance(net, float):
        return docs.withColumn("score", F.lit(net))
    ship(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(net)  # a model of fixed size

    def rate(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(held.value)
        for texts in batches:
            yield pd.Series([scorer.score(t) for t in texts], dtype="float64")

    return docs.withColumn("score", F.pandas_udf(rate, "double").asNondeterministic()("text"))
