"""Operator 4: toxicity by subword-bag embeddings averaged into a linear softmax.

A text's features are the character n-grams of its words, word borders included,
hashed into buckets. Each bucket has an embedding; a text is the mean of its
n-grams' embeddings, and a linear softmax over that mean gives the class. Both
are trained jointly in numpy, so a misspelling that was never seen scores by the
n-grams it shares with words that were.

Training reads whole texts of at most ``max_positive`` and ``max_negative``
labelled documents, chosen by a hash of the id: a documented bound on what
reaches the driver. Scoring reads every text whole, in place in Arrow's buffers;
as the model is linear, each n-gram adds one number.

Nulls and ties: a null or empty text scores as the mean of nothing (the bias
alone); rows without a label, or with a null id, are not learned from; repeated
rows score alike. With fewer than two classes to learn from every score is 0.
Other columns are not read. Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cleargrain.llm.common import cuts, let_go, narrow, ship, slices

BUCKET_BITS = 17
SIZES = (3, 4, 5, 6)
_SPACE = 0x20
#: N-grams of no meaning that every mean includes, so a few words decide little.
PRIOR = 200
_TABLE = np.array(
    [b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else _SPACE for b in range(256)], np.uint8
)


def ngrams(data: np.ndarray, starts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each n-gram size: buckets by first place, and which places begin an n-gram of one word of one text."""
    chars = _TABLE[data]
    space = chars == _SPACE
    begins = np.zeros(len(chars) + 1, bool)
    begins[starts] = True
    hashes = chars.astype(np.uint32)
    inside = np.zeros(len(chars), bool)  # a border inside the n-gram
    again = np.append(_again(chars, space, begins[:-1]), False)
    for size in range(2, SIZES[-1] + 1):
        count = len(chars) - size + 1
        if count <= 0:
            return
        hashes = hashes[:count] * np.uint32(0x01000193) + chars[size - 1 :]
        inside = inside[:count] | begins[size - 1 : size - 1 + count]
        if size > 2:
            inside |= space[size - 2 : size - 2 + count]
        if size in SIZES:
            mixed = (hashes ^ (hashes >> np.uint32(15))) * np.uint32(0x85EBCA6B)
            yield mixed >> np.uint32(32 - BUCKET_BITS), ~(inside | again[1 : count + 1])


def _again(chars: np.ndarray, space: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Places of words that repeat the word just before them in the same text; such a run counts once."""
    first = np.flatnonzero(~space & (begins | np.concatenate([[True], space[:-1]])))
    if not len(first):
        return np.zeros(len(chars), bool)
    word = np.cumsum(np.bincount(first, minlength=len(chars))) - 1
    place = np.arange(len(chars)) - first[np.maximum(word, 0)]
    value = (chars + (place.astype(np.uint64) << np.uint64(8))) * np.uint64(0x9E3779B97F4A7C15)
    sums = np.add.reduceat(np.where(space, np.uint64(0), value ^ (value >> np.uint64(29))), first)
    text = np.cumsum(begins)[first]
    same = np.concatenate([[False], (sums[1:] == sums[:-1]) & (text[1:] == text[:-1])])
    return same[np.maximum(word, 0)] & (word >= 0)


def _buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and each text's first place, with the end of the last."""
    texts = texts.cast(pa.string())
    offsets = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, texts.offset * 4).astype(np.int64)
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw else np.empty(0, np.uint8)
    return data, offsets - offsets[0]


@dataclass(frozen=True)
class Model:
    """``gain``: what an n-gram of each bucket adds to the toxic class over the other, before the mean."""

    gain: np.ndarray
    bias: float

    def score(self, texts: pa.Array) -> np.ndarray:
        """Probability of the toxic class for each text."""
        data, offsets = _buffers(texts)
        sums, counts = np.zeros(len(data) + 1), np.zeros(len(data) + 1, np.int64)
        for buckets, valid in ngrams(data, offsets[:-1]):
            sums[1 : len(buckets) + 1] += np.where(valid, self.gain[buckets], 0.0)
            counts[1 : len(buckets) + 1] += valid
        total, many = (np.cumsum(x)[offsets] for x in (sums, counts))
        logit = self.bias + np.diff(total) / (np.diff(many) + PRIOR)
        return 1 / (1 + np.exp(-np.clip(logit, -60, 60)))


NEVER = Model(np.zeros(1 << BUCKET_BITS), -60.0)


def bags(texts: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """Each text's distinct buckets with their shares of its n-grams."""
    data, offsets = _buffers(texts)
    each = list(ngrams(data, offsets[:-1]))
    out = []
    for first, last in zip(offsets[:-1], offsets[1:], strict=True):
        own = [b[first:last][v[first:last]] for b, v in each]
        buckets, counts = np.unique(np.concatenate(own) if own else np.empty(0, np.uint32), return_counts=True)
        out.append((buckets.astype(np.int32), (counts / (counts.sum() + PRIOR)).astype(np.float32)))
    return out


def train(
    examples: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, *, width: int = 4, epochs: int = 14, batch: int = 64, rate: float = 0.5, spread: float = 0.01, seed: int = 7
) -> Model:
    """Embeddings and softmax weights by AdaGrad on the cross-entropy."""
    labels = np.asarray(labels, np.int64)
    if len(set(labels.tolist())) < 2:
        return NEVER
    rng, size = np.random.default_rng(seed), 1 << BUCKET_BITS
    vectors = rng.uniform(-spread, spread, (size, width))
    weights, bias = rng.normal(0, 0.5, (width, 2)), np.zeros(2)
    state = [np.full_like(x, 1e-6) for x in (vectors, weights, bias)]
    for _ in range(epochs):
        order = rng.permutation(len(labels))
        for at in range(0, len(order), batch):
            rows = order[at : at + batch]
            buckets = np.concatenate([examples[i][0] for i in rows])
            shares = np.concatenate([examples[i][1] for i in rows]).astype(np.float64)
            doc = np.repeat(np.arange(len(rows)), [len(examples[i][0]) for i in rows])
            held = vectors[buckets]
            mean = np.stack([np.bincount(doc, shares * held[:, j], len(rows)) for j in range(width)], 1)
            logits = mean @ weights + bias
            logits -= logits.max(1, keepdims=True)
            error = np.exp(logits)
            error /= error.sum(1, keepdims=True)
            error[np.arange(len(rows)), labels[rows]] -= 1
            error /= len(rows)
            back = error @ weights.T
            slope = np.stack([np.bincount(buckets, shares * back[doc, j], size) for j in range(width)], 1)
            for value, gradient, seen in zip((vectors, weights, bias), (slope, mean.T @ error, error.sum(0)), state, strict=True):
                seen += gradient * gradient
                value -= rate * gradient / np.sqrt(seen)
    return Model(vectors @ (weights[:, 1] - weights[:, 0]), float(bias[1] - bias[0]))


def held_out(id_column: Column) -> Column:
    """Rows never learned from: crc32 of the id as text leaves 1 modulo 3."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(
    docs: DataFrame, labels: DataFrame, *, max_positive: int = 1500, max_negative: int = 3000,
    id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", **training,
) -> Model:
    """A model from a bounded sample of the labelled rows that are not held out."""
    usable = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("label")).where(
        "id is not null and label in (0, 1)"
    )
    usable = usable.where(~held_out(F.col("id"))).dropDuplicates(["id"])
    order = [F.xxhash64("id"), F.col("id")]
    sample = [usable.where(F.col("label") == k).orderBy(*order).limit(n) for k, n in ((1, max_positive), (0, max_negative))]
    chosen = sample[0].unionByName(sample[1])

    def bag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = bags(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("label"), pa.array([x[0] for x in found], pa.list_(pa.int32())), pa.array([x[1] for x in found], pa.list_(pa.float32()))],
                names=["id", "label", "buckets", "shares"],
            )

    rows = narrow(docs, id_col, text_col).join(F.broadcast(chosen), "id").mapInArrow(
        bag, "id long, label int, buckets array<int>, shares array<float>"
    ).toArrow().sort_by("id")
    examples = list(zip(*(map(lambda x: x.values.to_numpy(), rows.column(c)) for c in ("buckets", "shares")), strict=True))
    return train(examples, rows.column("label").to_numpy(), **training)


def score(model: Model, docs: DataFrame, text_col: str = "text") -> Column:
    """The score of every whole text as a column."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def toxic(texts: pa.Array) -> pa.Array:
        let_go()
        parts = [shared.value.score(texts[first:last]) for first, last in cuts(texts)]
        return pa.array(np.concatenate(parts) if parts else np.empty(0))

    return toxic(F.coalesce(F.col(text_col), F.lit("")))


def drop_toxic(docs: DataFrame, labels: DataFrame, *, threshold: float = 0.7, **settings) -> DataFrame:
    """The documents that score under the threshold, their columns as they were."""
    return docs.where(score(fit(docs, labels, **settings), docs, settings.get("text_col", "text")) < threshold)
