"""Quality classifier: supervised subword embeddings.

Words, word pairs and character n-grams are hashed to learned vectors; a document is their
average, and a linear layer with softmax gives the class.  The fit is plain stochastic
gradient descent in numpy on a bounded, documented sample of labelled rows
(``FIT_ROWS``); scoring reads every row in place, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickscore.llm import tokens as T
from clickscore.llm.frames import small_batches

BUCKETS = 1 << 15
DIMENSIONS = 12
GRAMS = (2, 3, 5)
#: Bound of the sample of labelled rows that the fit reads.
FIT_ROWS = 3000
STEPS = 1200
BATCH = 32
RATE = 8.0
THRESHOLD = 0.7
SEED = 5


def held_out(doc_id: Column) -> Column:
    """Rows that the fit never sees."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(4)) == 2


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every feature of all texts, and the text each belongs to."""
    w = T.words(data, offsets, T.PLAIN)
    shift = np.uint64(64 - BUCKETS.bit_length() + 1)
    parts, rows = [w.hash], [w.row]
    pair, at = T.shingles(w, 2)
    if len(at):
        # A pair of equal words is one feature of its own, whatever the word.
        again = w.hash[at] == w.hash[at + 1]
        parts.append(np.where(again, T.mix(np.full(1, 17, np.uint64))[0], pair))
        rows.append(w.row[at])
    inside = T.PLAIN[data]
    row_of = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    coded = T.BYTE_MIX[data]
    for n in GRAMS:
        if len(data) < n:
            continue
        ok = row_of[: len(data) - n + 1] == row_of[n - 1 :]
        value = np.zeros(len(data) - n + 1, np.uint64)
        step = np.uint64(n)
        for i in range(n):
            value += coded[i : len(data) - n + 1 + i] * T.WORD_MIX[20 + i]
            if 0 < i < n - 1:
                ok &= inside[i : len(data) - n + 1 + i]
        value = (value[ok] + step) * T.STEP
        parts.append(value ^ (value >> np.uint64(29)))
        rows.append(row_of[: len(data) - n + 1][ok])
    hashed = np.concatenate(parts) * T.STEP
    return (hashed >> shift).astype(np.int32), np.concatenate(rows)


@dataclass
class Model:
    vectors: np.ndarray  # bucket x dimension
    weights: np.ndarray  # dimension x class
    bias: np.ndarray

    def logits(self) -> np.ndarray:
        """Per bucket, what it adds to the classes' logits (the layer is linear)."""
        return (self.vectors @ self.weights).astype(np.float64)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit(ids: list[np.ndarray], shares: list[np.ndarray], labels: np.ndarray) -> Model:
    """Stochastic gradient descent over documents given as bucket shares."""
    rng = np.random.default_rng(SEED)
    model = Model(
        rng.uniform(-1, 1, (BUCKETS, DIMENSIONS)) / DIMENSIONS,
        rng.uniform(-1, 1, (DIMENSIONS, 2)) / DIMENSIONS,
        np.zeros(2),
    )
    count = np.bincount(labels, minlength=2) + 1.0
    model.bias = np.log(count / count.sum())
    if len(labels) == 0 or len(np.unique(labels)) < 2:
        model.weights[:] = 0
        return model
    done = 0
    while done < STEPS:
        order = rng.permutation(len(labels))
        for start in range(0, len(order), BATCH):
            rate = RATE * max(0.0, 1 - done / STEPS) + 0.02
            done += 1
            batch = order[start : start + BATCH]
            sizes = [len(ids[i]) for i in batch]
            flat, share = np.concatenate([ids[i] for i in batch]), np.concatenate([shares[i] for i in batch])
            row = np.repeat(np.arange(len(batch)), sizes)
            hidden = np.stack(
                [np.bincount(row, share * model.vectors[flat, d], minlength=len(batch)) for d in range(DIMENSIONS)], 1
            )
            error = softmax(hidden @ model.weights + model.bias)
            error[np.arange(len(batch)), labels[batch]] -= 1
            error /= len(batch)
            back = error @ model.weights.T
            model.weights -= 0.25 * rate * hidden.T @ error
            model.bias -= 0.05 * rate * error.sum(axis=0)
            used, place = np.unique(flat, return_inverse=True)
            for d in range(DIMENSIONS):
                model.vectors[used, d] -= rate * np.bincount(place, share * back[row, d], minlength=len(used))
    return model


def feature_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, data, offsets in T.chunked(batches):
        bucket, row = features(data, offsets)
        keys, count = np.unique(row.astype(np.int64) * BUCKETS + bucket, return_counts=True)
        of = keys // BUCKETS
        per_row = np.bincount(of, minlength=batch.num_rows)
        total = np.bincount(of, count, minlength=batch.num_rows)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                batch.column(2),
                T.ragged((keys % BUCKETS).astype(np.int32), per_row, pa.int32()),
                T.ragged((count / total[of]).astype(np.float32), per_row, pa.float32()),
            ],
            names=["quality", "place", "ids", "shares"],
        )


def train(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Model:
    """Fit on at most ``fit_rows`` labelled documents that are not held out.

    The sample is the lowest hashes of the ids, so it does not depend on partitioning.
    Rows with a NULL label or id are left out; other labels than 1 count as 0.
    """
    small_batches(docs.sparkSession)
    chosen = (
        labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .select("doc_id", (F.col("quality") == 1).cast("int").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(fit_rows)
    )
    rows = docs.select("doc_id", "text").join(chosen, "doc_id").select(
        "quality", "text", F.xxhash64("doc_id", "text").alias("place")
    )
    found = rows.mapInArrow(feature_batches, "quality int, place bigint, ids array<int>, shares array<float>")
    # An id or label may repeat, so the bound holds behind the join too.
    sample = found.orderBy("place", "quality").limit(fit_rows).toArrow()
    ids = [np.asarray(x.values) for x in sample.column("ids")]
    shares = [np.asarray(x.values, dtype=np.float64) for x in sample.column("shares")]
    labelled = np.asarray(sample.column("quality"), dtype=np.int64)
    order = sorted(range(len(ids)), key=lambda i: (len(ids[i]), ids[i].tobytes(), labelled[i]))
    return fit([ids[i] for i in order], [shares[i] for i in order], labelled[order])


def score_batches(batches: Iterator[pa.RecordBatch], per_bucket: np.ndarray, bias: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch, data, offsets in T.chunked(batches):
        bucket, row = features(data, offsets)
        n = np.maximum(np.bincount(row, minlength=batch.num_rows), 1)
        z = np.stack(
            [np.bincount(row, per_bucket[bucket, c], minlength=batch.num_rows) / n for c in range(2)], 1
        ) + bias
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(softmax(z)[:, 1])], names=["doc_id", "score"]
        )


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id`` and ``score`` (probability of label 1) of every row.

    NULL and empty texts have no features and get the score of the bias alone.  Repeated
    rows get equal scores; texts of any length are read whole; an empty table gives an empty
    result.  Only ``doc_id`` and ``text`` are read, so labels, languages and sources cannot
    enter a score.
    """
    small_batches(docs.sparkSession)
    per_bucket, bias = model.logits(), model.bias
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        lambda it: score_batches(it, per_bucket, bias), f"doc_id {kind}, score double"
    )


def op8(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, train(docs, labels)).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
