"""Quality classifier: naive Bayes support vectors over n-gram indicators.

Features are indicators: which n-grams of 1 to 3 bytes occur anywhere in the whole text, hashed to ``2**BITS`` columns.
Each indicator is scaled by its log-count ratio between the classes, ``r = log((p / |p|) / (q / |q|))`` with smoothed counts ``p`` and ``q``; a linear model with
hinge loss is then fitted by dual coordinate descent.  Margins become probabilities by a logistic curve fitted to
margins of held-back folds of the fitting rows.

Fitting uses a bounded sample of labelled rows: at most ``FIT_ROWS`` ids by smallest hash of the id, from rows whose
``crc32(doc_id as text) mod 4`` is not 2, one text each, and of these as many as have ``FIT_VALUES`` features together;
so the driver holds 256 MB of them at most.  Only labels and texts are used.  Scoring reads every whole text, row by
row, without a shuffle; the model that goes to the tasks has ``2**BITS`` numbers, whatever the input.

Defined results: a null text is empty, an empty text has no features and gets the score of the bias; rows with equal
ids are scored each for itself; a null id counts as not held out and is never fitted on; null labels are left out;
with fewer than two classes among the fitting rows, every score is the share of label 1 (1 if there are no labels).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caseweave.llm import _bytes as kernel
from caseweave.llm._spark import checkpointed

BITS = 18
FIT_ROWS = 8_000
#: Features of all fitting rows together: 8 bytes each on the driver (column and scaled value), 256 MB in all.
FIT_VALUES = 32_000_000
SMOOTHING = 1.0
COST = 1.0
EPOCHS = 12
FOLDS = 3
KEEP_SCORE = 0.7
#: Bytes of text that features are made of at once.
AT_ONCE = 300_000
U = np.uint64


class Grams:
    """Distinct hashed n-grams of each text of a batch."""

    def __init__(self, bits: int = BITS):
        self.bits, self.rolling = bits, kernel.Rolling(41)

    def __call__(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Sorted columns of all rows together, and the number of each row's."""
        buf, offsets = kernel.flat(column)
        n_rows, sums, codes = len(offsets) - 1, self.rolling.prefix(buf), []
        text = np.repeat(np.arange(n_rows, dtype=np.int32), np.diff(offsets))
        for n in (1, 2, 3):  # each size is made distinct before the next, which bounds a task's memory
            m = len(buf) - n + 1
            if m > 0:
                code = (kernel.mixed(self.rolling.windows(sums, n) + U(n)) >> U(64 - self.bits)).view(np.int64)
                code |= text[:m].astype(np.int64) << self.bits
                codes.append(np.unique(code[text[:m] == text[n - 1 :]]))
        codes = np.unique(np.concatenate(codes)) if codes else np.zeros(0, np.int64)
        return (codes & ((1 << self.bits) - 1)).astype(np.int32), np.bincount(codes >> self.bits, minlength=n_rows)


class Model:
    """Fitted weights: score = logistic(slope * (sum of the weights of the text's n-grams / norm + bias) + shift)."""

    def __init__(self, columns: np.ndarray, counts: np.ndarray, labels: np.ndarray, bits: int = BITS, seed: int = 5):
        """``columns`` holds the rows' columns one after the other, ``counts`` how many each row has."""
        self.bits, self.weights, self.bias, self.slope, self.shift = bits, np.zeros(1 << bits), 0.0, 0.0, 0.0
        share = float(labels.mean()) if len(labels) else 1.0
        self.constant = share if len(np.unique(labels)) < 2 else None
        if self.constant is not None:
            return
        edges = np.r_[0, np.cumsum(counts)]
        fold = np.random.default_rng(seed).permutation(len(labels)) % FOLDS
        margins = np.zeros(len(labels))
        for k in range(FOLDS):
            inside = np.flatnonzero(fold != k)
            if len(np.unique(labels[inside])) < 2:
                continue
            weights, bias = self._fit(columns, edges, labels, inside, seed)
            for i in np.flatnonzero(fold == k).tolist():
                margins[i] = weights[columns[edges[i] : edges[i + 1]]].sum() / np.sqrt(max(1, counts[i])) + bias
        self.weights, self.bias = self._fit(columns, edges, labels, np.arange(len(labels)), seed)
        self.slope, self.shift = self._logistic(margins, labels)

    def _fit(self, columns: np.ndarray, edges: np.ndarray, labels: np.ndarray, inside: np.ndarray, seed: int) -> tuple[np.ndarray, float]:
        # Row by row throughout: no copy of the sample but one, the scaled indicators.
        width = 1 << self.bits
        counted = np.full((2, width), SMOOTHING)
        for i in inside.tolist():
            counted[labels[i], columns[edges[i] : edges[i + 1]]] += 1
        ratio = np.log(counted[1] / counted[1].sum()) - np.log(counted[0] / counted[0].sum())
        # Dual coordinate descent for min |w|^2 / 2 + cost * sum of hinge losses; rows have unit length before scaling.
        side = np.where(labels == 1, 1.0, -1.0)
        scaled, square = np.empty(len(columns), np.float32), np.ones(len(labels))
        for i in inside.tolist():
            own = slice(edges[i], edges[i + 1])
            scaled[own] = ratio[columns[own]] / np.sqrt(max(1, edges[i + 1] - edges[i]))
            square[i] += float(scaled[own] @ scaled[own])
        w, bias, alpha = np.zeros(width), 0.0, np.zeros(len(labels))
        rng = np.random.default_rng(seed)
        for _ in range(EPOCHS):
            moved = 0.0
            for i in rng.permutation(inside).tolist():
                own, x = columns[edges[i] : edges[i + 1]], scaled[edges[i] : edges[i + 1]]
                gradient = side[i] * (float(w[own] @ x) + bias) - 1.0
                after = min(max(alpha[i] - gradient / square[i], 0.0), COST)
                step = (after - alpha[i]) * side[i]
                if step:
                    alpha[i] = after
                    w[own] += step * x
                    bias += step
                    moved = max(moved, abs(step))
            if moved < 1e-4:
                break
        return w * ratio, bias

    @staticmethod
    def _logistic(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
        """Newton's steps for the logistic curve through margins and labels, with smoothed targets."""
        ones = float((labels == 1).sum())
        target = np.where(labels == 1, (ones + 1) / (ones + 2), 1 / (len(labels) - ones + 2))
        a, b = 1.0, 0.0
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(a * margins + b, -30, 30)))
            g, h = p - target, p * (1 - p) + 1e-9
            gradient = np.array([g @ margins, g.sum()]) + 1e-3 * np.array([a, 0])
            hessian = np.array([[h @ margins**2 + 1e-3, h @ margins], [h @ margins, h.sum()]])
            step = np.linalg.solve(hessian, gradient)
            a, b = a - step[0], b - step[1]
            if np.abs(step).max() < 1e-9:
                break
        return float(a), float(b)

    def scores(self, columns: np.ndarray, counts: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(counts), self.constant)
        sums = np.r_[0.0, np.cumsum(self.weights[columns])]
        ends = np.cumsum(counts)
        margin = (sums[ends] - sums[ends - counts]) / np.sqrt(np.maximum(1, counts)) + self.bias
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -30, 30)))


def remainder(key: Column) -> Column:
    """crc32 of the id as text, modulo 4."""
    return F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(4))


def _features(batches, bits: int):
    grams = Grams(bits)
    for batch in kernel.chunks(batches, "text", AT_ONCE):
        columns, counts = grams(batch.column(2))
        arrays = [*batch.columns[:2], pa.array(counts, pa.int64()), kernel.lists(columns, counts, pa.int32())]
        yield pa.RecordBatch.from_arrays(arrays, ["place", "label", "size", "columns"])


def sample(docs: DataFrame, labels: DataFrame, text: str, key: str, label: str, rows: int, values: int) -> DataFrame:
    """The fitting rows: ``place`` (their order), ``label``, ``size`` and ``columns``, one row for each chosen id.

    Ids are chosen by smallest hash.  Of an id's documents the text with the smallest hash counts, so neither repeated
    rows nor their order matter.  If all features together are more than ``values``, ids are taken in the order of
    their hash while they fit.
    """
    judged = labels.where(F.col(label).isNotNull() & (remainder(F.col(key)) != 2))
    judged = judged.groupBy(F.col(key).alias("__key")).agg(F.max(label).cast("int").alias("__label"))
    order = (F.xxhash64(F.lit("fit"), F.col("__key")), F.col("__key"))
    chosen = judged.orderBy(*order).limit(rows)
    ranks = chosen.withColumn("__place", F.row_number().over(Window.orderBy(*order)))  # at most ``rows`` rows
    content = F.coalesce(F.col(text), F.lit(""))
    met = docs.select(F.col(key).alias("__id"), content.alias("text")).join(F.broadcast(ranks), F.col("__id") == F.col("__key"))
    each = met.groupBy("__place", "__label").agg(F.min(F.struct(F.xxhash64("text"), F.col("text"))).alias("least"))
    each = each.select(F.col("__place").alias("place"), F.col("__label").alias("label"), F.col("least.text").alias("text"))
    found = checkpointed(each.mapInArrow(lambda b: _features(b, BITS), "place int, label int, size long, columns array<int>"))
    so_far = F.sum("size").over(Window.orderBy("place").rowsBetween(Window.unboundedPreceding, 0))  # sizes of at most ``rows`` rows
    fitting = found.select("place", so_far.alias("so_far")).where(F.col("so_far") <= values).select("place")
    return found.join(F.broadcast(fitting), "place")


def fit(
    docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "quality", rows: int = FIT_ROWS, values: int = FIT_VALUES
) -> Model:
    """Model from at most ``rows`` labelled ids and ``values`` features: the same, bit for bit, for the same documents in any order."""
    found = sample(docs, labels, text, key, label, rows, values).select("place", "label", "columns").toArrow()
    found = found.take(pc.sort_indices(found.column("place")))
    columns, counts = kernel.flat_lists(found.column("columns"))
    return Model(columns, counts, found.column("label").to_numpy().astype(np.int64))


def _score(batches, shared, text: str):
    grams, model = Grams(shared.value.bits), shared.value
    for batch in kernel.chunks(batches, text, AT_ONCE):
        columns, counts = grams(batch.column(batch.schema.get_field_index(text)))
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(model.scores(columns, counts))], [*batch.schema.names, "__score"])


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` and ``predicted`` (replacing columns of these names)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = {c: f"__{k}" for k, c in enumerate(docs.columns) if c not in ("score", "predicted")}
    source = docs.select(*(F.col(c).alias(n) for c, n in kept.items()))
    schema = ", ".join(f"`{kept[f.name]}` {f.dataType.simpleString()}" for f in docs.schema.fields if f.name in kept)
    read = kept[text]
    out = source.mapInArrow(lambda b: _score(b, shared, read), f"{schema}, `__score` double")
    predicted = (F.col("__score") >= KEEP_SCORE).cast("int").alias("predicted")
    return out.select(*(F.col(n).alias(c) for c, n in kept.items()), F.col("__score").alias("score"), predicted)


def quality_classifier_query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    out = score(docs.select("doc_id", "text"), fit(docs, labels)).drop("text")
    held_out = F.coalesce(remainder(F.col("doc_id")) == 2, F.lit(False)).alias("held_out")
    return out.select("doc_id", held_out, "score", "predicted")
