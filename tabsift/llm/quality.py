"""Quality scores by positive-unlabelled learning with a non-negative risk.

Trusted positives and unlabelled web text train a small network on shape features of the text. With the class
prior ``pi`` the risk of the negatives is that of the unlabelled texts less ``pi`` times that of the positives; it
can't be below 0, and where an estimate falls below, the step goes back on it (the non-negative estimator). The
features of every document are made once, in tasks; only a bounded sample of feature rows reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tabsift.llm.common import chunks, small_batches, staged

#: Rows the fit may see: trusted positives and unlabelled texts, the least by a hash of their id.
POSITIVES, UNLABELLED = 20_000, 40_000
CHUNK_BYTES = 4_000_000
HIDDEN, EPOCHS, BATCH = 24, 60, 2_000

BYTE_GROUPS = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "lower": b"abcdefghijklmnopqrstuvwxyz", "digit": b"0123456789",
    "space": b" ", "line": b"\n", "other_white": b"\t\r\x0b\x0c", "stop": b".,;:", "ask": b"!?", "quote": b"'\"()",
    "bar": b"|", "sign": b"*#%&$@+=<>{}[]\\/^~`_-", "control": bytes([*range(9), *range(14, 32), 127]),
    "high": bytes(range(128, 256)),
}
FEATURES = [*BYTE_GROUPS, "log_bytes", "log_words", "word_length", "long_words", "distinct_words", "repeats",
            "top_word", "distinct_lines", "line_length", "top_byte", "byte_entropy", "lone_signs", "capitals"]


def _features(text: str) -> list[float]:
    """Shares and logs that describe the shape of a whole text; all 0 for an empty one."""
    raw = text.encode()
    words = raw.split()
    if not words:
        return [0.0] * len(FEATURES)
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256).astype(float)
    n, w = len(raw), len(words)
    shares = counts / n
    groups = [float(shares[list(g)].sum()) for g in BYTE_GROUPS.values()]
    lengths = np.fromiter(map(len, words), np.int64, w)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    seen: dict[bytes, int] = {}
    for word in words:
        seen[word] = seen.get(word, 0) + 1
    letters = counts[65:91].sum() + counts[97:123].sum()
    some = shares[shares > 0]
    return groups + [
        float(np.log1p(n)), float(np.log1p(w)), float(lengths.mean()), float((lengths > 15).mean()),
        len(seen) / w, sum(map(bytes.__eq__, words, words[1:])) / w, max(seen.values()) / w,
        len(set(lines)) / len(lines), float(np.log1p(n / len(lines))), float(shares.max()),
        float(-(some * np.log2(some)).sum()), float((lengths == 1).mean()),
        float(counts[65:91].sum() / letters) if letters else 0.0,
    ]


def text_features(docs: DataFrame, *, text: str = "text", name: str = "features") -> DataFrame:
    """The columns of ``docs`` but ``text``, and an array of features. Nothing but the text goes into them."""
    small_batches(docs.sparkSession)
    kept = [c for c in docs.columns if c not in (text, name)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, text, CHUNK_BYTES):
            rows = [_features(t or "") for t in batch.column(batch.schema.get_field_index(text)).to_pylist()]
            made = pa.array(rows, pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in kept] + [made], names=[*kept, name])

    schema = docs.select(*kept, F.array(F.lit(0.0).cast("float")).alias(name)).schema
    return docs.select(*kept, F.col(text)).mapInArrow(run, schema)


@dataclass
class Scorer:
    """A network of one hidden layer on standardised features."""

    mean: np.ndarray
    scale: np.ndarray
    weights: list[np.ndarray]

    def logits(self, rows: np.ndarray) -> np.ndarray:
        first, bias, last, shift = self.weights
        shaped = np.clip((rows - self.mean) / self.scale, -8, 8)
        return np.tanh(shaped @ first + bias) @ last + shift

    def scores(self, rows: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.logits(rows), -40, 40)))


def fit_positive_unlabelled(
    positives: np.ndarray, unlabelled: np.ndarray, prior: float, *, seed: int = 5, epochs: int = EPOCHS,
    hidden: int = HIDDEN, rate: float = 0.01, decay: float = 1e-4, beta: float = 0.0,
) -> Scorer:
    """Minimise the non-negative unbiased risk with the logistic loss, by Adam steps on mixed batches."""
    draw = np.random.default_rng(seed)
    both = np.concatenate([positives, unlabelled])
    mean, scale = both.mean(0), both.std(0)
    scale = np.where(scale > 1e-6, scale, 1.0)
    x_p, x_u = (np.clip((x - mean) / scale, -8, 8) for x in (positives, unlabelled))
    k = both.shape[1]
    weights = [draw.normal(0, k**-0.5, (k, hidden)), np.zeros(hidden), draw.normal(0, hidden**-0.5, hidden), np.zeros(())]
    first, second, step = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
    sigmoid = lambda z: 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))
    softplus = lambda z: np.logaddexp(0.0, z)
    parts = max(1, len(x_u) // BATCH)
    for epoch in range(epochs):
        pace = rate * 0.5 * (1 + np.cos(np.pi * epoch / epochs))
        orders = np.array_split(draw.permutation(len(x_p)), parts), np.array_split(draw.permutation(len(x_u)), parts)
        for at_p, at_u in zip(*orders):
            if not len(at_p) or not len(at_u):
                continue
            x = np.concatenate([x_p[at_p], x_u[at_u]])
            n_p, n_u = len(at_p), len(at_u)
            inner = np.tanh(x @ weights[0] + weights[1])
            z = inner @ weights[2] + weights[3]
            negative = softplus(z[n_p:]).mean() - prior * softplus(z[:n_p]).mean()
            slope = np.empty_like(z)
            if negative >= -beta:
                # pi R_p(+) + R_u(-) - pi R_p(-); the positive parts join to a constant slope of -pi.
                slope[:n_p], slope[n_p:] = -prior / n_p, sigmoid(z[n_p:]) / n_u
            else:  # go back on what made the risk of negatives fall below 0
                slope[:n_p], slope[n_p:] = prior * sigmoid(z[:n_p]) / n_p, -sigmoid(z[n_p:]) / n_u
            back = np.outer(slope, weights[2]) * (1 - inner**2)
            grads = [x.T @ back, back.sum(0), inner.T @ slope, slope.sum()]
            step += 1
            for i, grad in enumerate(grads):
                grad = grad + decay * weights[i]
                first[i] = 0.9 * first[i] + 0.1 * grad
                second[i] = 0.999 * second[i] + 0.001 * grad**2
                weights[i] = weights[i] - pace * (first[i] / (1 - 0.9**step)) / (
                    np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    return Scorer(mean, scale, weights)


def held_out(doc_id: Column) -> Column:
    """Whether a document is left out of learning: crc32 of its id as text leaves no remainder by 5."""
    text = F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")
    return (F.crc32(text) % 5) == 0


def score_quality(
    docs: DataFrame, labels: DataFrame, *, threshold: float = 0.3, prior: float | None = None,
    positives: int = POSITIVES, unlabelled: int = UNLABELLED, keep: tuple[str, ...] = (),
) -> DataFrame:
    """doc_id, held_out, score and predicted of every document, and the columns named in ``keep``.

    Labels (doc_id, quality) are used only where ``held_out`` is false. The positives are documents with no label
    but 1; the unlabelled texts are those that no label trusts. The class prior is the share of positives among the
    labelled, unless given, as the labelled are drawn from the same text. Null labels count as none. Without
    positives or other texts every score is the prior (1 if there are no labels either). Null and empty texts get
    the score of features that are all 0. Repeated rows stay; an empty table gives no rows.
    """
    label = labels.where("quality is not null and doc_id is not null").groupBy(F.col("doc_id").alias("label_id")).agg(
        F.min("quality").cast("int").alias("label"))
    rows = docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out"), *keep)
    features = staged(text_features(rows), "quality-features")
    learn = label.where(~held_out(F.col("label_id")))
    known = features.where(~F.col("held_out")).select("doc_id", "features").join(
        learn, F.col("doc_id") == F.col("label_id"), "left").select("doc_id", "features", "label")
    place = F.xxhash64(F.lit(3), "doc_id", "features")

    def sample(which: Column, most: int) -> np.ndarray:
        got = known.where(which).select(place.alias("place"), "features").orderBy("place").limit(most).toPandas()
        return np.array(got["features"].tolist(), float).reshape(len(got), len(FEATURES))

    if prior is None:
        good, all_labels = learn.agg(F.sum(F.col("label")), F.count("label")).first()
        prior = good / all_labels if all_labels else 1.0
    # Unlabelled web text is any text of the learning folds, whatever its label: the prior holds for it.
    x_p, x_u = sample(F.col("label") == 1, positives), sample(F.lit(True), unlabelled)
    scorer = fit_positive_unlabelled(x_p, x_u, prior) if len(x_p) and len(x_u) else None
    constant = float(prior)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("features").flatten().to_numpy(zero_copy_only=False).astype(float)
            shaped = lists.reshape(batch.num_rows, len(FEATURES))
            score = scorer.scores(shaped) if scorer and batch.num_rows else np.full(batch.num_rows, constant)
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in out] + [pa.array(score, pa.float64())], names=[*out, "score"])

    out = ["doc_id", "held_out", *keep]
    schema = features.select(*out, F.lit(0.0).alias("score")).schema
    scored = features.select(*out, "features").mapInArrow(run, schema)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"), *keep)
