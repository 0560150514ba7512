"""Quality scores from supervised subword embeddings, trained by numpy SGD.

Words and character n-grams (over UTF-8 bytes) are hashed into one table of learned vectors. A
document is the mean of its vectors; a softmax over two classes follows. The output is linear in
the mean, so scoring needs one number per table entry: the difference of its two class scores.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsync.llm.common import encoded, noise, steps, word_hashes

BITS = 17
DIM = 8
GRAMS = (3, 5)
EPOCHS = 8
RATE = 2.0
#: Most labelled documents the model is fitted on: those with the smallest hash of their id.
TRAIN_ROWS = 3000
CUT = 0.7
_GRAM = [noise(256, 100 + i).astype(np.uint32) for i in range(max(GRAMS))]


def _gram_buckets(data: np.ndarray, n: int) -> np.ndarray:
    many = max(0, len(data) - n + 1)
    h = _GRAM[0][data[:many]]
    for j in range(1, n):
        h = h + _GRAM[j][data[j:j + many]]
    h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D + 2 * n)
    return h >> np.uint32(32 - BITS)


def features(texts: list[bytes]) -> Iterator[list[np.ndarray]]:
    """Table entries of each text's words and n-grams, with repeats. Entry 0 marks every text, and
    entry 1 each word that repeats the one before it, whatever the word is."""
    for a, b in steps(texts):
        part = texts[a:b]
        hashes, first = word_hashes(part, lower=False)
        words = (hashes >> np.uint64(64 - BITS)).astype(np.uint32)
        again = np.concatenate(([False], hashes[1:] == hashes[:-1]))[:len(hashes)]
        data = np.frombuffer(b"".join(part), np.uint8)
        grams = [_gram_buckets(data, n) for n in GRAMS]
        at = 0
        for i, text in enumerate(part):
            own = slice(first[i], first[i + 1])
            yield [np.zeros(1, np.uint32), np.ones(int(again[own][1:].sum()), np.uint32),
                   words[own]] + [
                g[at:max(at, at + len(text) - n + 1)] for g, n in zip(grams, GRAMS)]
            at += len(text)


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = [np.unique(np.concatenate(f), return_counts=True)
               for f in features(encoded(batch["text"]))]
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], batch["label"],
             pa.array([b.astype("<u4").tobytes() for b, _ in out], pa.binary()),
             pa.array([c.astype("<f4").tobytes() for _, c in out], pa.binary())],
            ["doc_id", "label", "entries", "counts"])


def train(bags: list[tuple[np.ndarray, np.ndarray, int]], seed: int = 7) -> np.ndarray:
    """Score difference of each table entry, from documents as (entries, counts, label).

    Without documents, or with one class only, all differences are 0 (scores of 0.5).
    """
    labels = {y for _, _, y in bags}
    if len(labels) < 2:
        return np.zeros(1 << BITS, np.float32)
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / DIM, 1 / DIM, (1 << BITS, DIM))
    out = np.zeros((2, DIM))
    shares = [(e, c / c.sum(), y) for e, c, y in bags]
    step, steps_ = 0, EPOCHS * len(shares)
    for _ in range(EPOCHS):
        for i in rng.permutation(len(shares)):
            entries, share, y = shares[i]
            rate = RATE * (1 - step / steps_)
            step += 1
            mean = share @ vectors[entries]
            scores = out @ mean
            scores = np.exp(scores - scores.max())
            error = scores / scores.sum()
            error[y] -= 1
            back = out.T @ error
            out -= rate * np.outer(error, mean)
            vectors[entries] -= rate * share[:, None] * back * 16
    return (vectors @ (out[1] - out[0])).astype(np.float32)


def scorer(values: np.ndarray):
    """A ``mapInArrow`` function: rows (doc_id, held_out, text) to scores."""
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for parts in features(encoded(batch["text"])):
                total = sum(float(values[p].sum(dtype=np.float64)) for p in parts)
                found.append(total / sum(map(len, parts)))
            scores = 1 / (1 + np.exp(-np.array(found, np.float64)))
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["held_out"], pa.array(scores, pa.float64()),
                 pa.array((scores >= CUT).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"])
    return score


def held_out(doc_id):
    """Rows whose labels are never learned from: crc32 of the id as text leaves 2 modulo 4."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "utf-8")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> np.ndarray:
    """Trains on at most ``rows`` labelled documents; the driver gets their hashed counts only.

    Labels without a value are left out; of several labels of one document the largest counts.
    """
    chosen = (labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()
                            & ~held_out(F.col("doc_id")))
              .groupBy("doc_id").agg(F.max("quality").alias("label"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # ``rows`` at most
    found = sample.select("doc_id", F.col("label").cast("int").alias("label"), "text").mapInArrow(
        _bags, "doc_id long, label int, entries binary, counts binary").collect()
    found.sort(key=lambda r: (r.doc_id, bytes(r.entries)))
    return train([(np.frombuffer(r.entries, "<u4"), np.frombuffer(r.counts, "<f4"), r.label)
                  for r in found])


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted for every document.

    A null text is empty; a text without words or n-grams has the score of the common entry.
    A null doc_id is not held out. Every row is scored by itself, so repeated rows get equal
    scores. An empty table gives no rows.
    """
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    values = fit(ids, labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality"))
    return ids.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text").mapInArrow(
        scorer(values), "doc_id long, held_out boolean, score double, predicted int")
