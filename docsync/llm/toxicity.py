"""Toxicity scores by votes of the nearest labelled examples.

Terms are words and the beginnings of words (so that inflected forms of one stem share terms). Of
all terms of the labelled sample those count whose presence goes with the toxic label, by a
likelihood-ratio test that allows for the number of terms tested. Vectors are TF-IDF over these
terms, with document frequencies over all documents.

Examples with any such term form an inverted index whose postings are cut into blocks of ``BLOCK``
examples, each with the largest weight of every term in it. A document takes the blocks by their
bound on the cosine, scores their examples exactly, and stops when no other block can reach its
``NEAREST`` best: the result is that of comparing with every example. Neighbours vote with their
cosine; documents without any term get the share of toxic ones among such examples. A logistic curve
fitted on the examples' votes, each without itself, makes the votes probabilities.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsync.llm.common import stage

WORD = re.compile(r"[^\W\d_]+")
#: Lengths of the beginnings of words that are terms; a whole word is a term with an end mark.
PREFIXES = range(3, 8)
END = "$"
#: Words longer than this have no whole-word term, so terms are short.
LONGEST = 40
#: Labelled documents that are learned from: those with the smallest hash of their id.
TRAIN_ROWS = 12_000
#: Terms kept, by the strength of their test.
MAX_TERMS = 4096
#: With a term the toxic share is at least so many times that of all examples. Terms that are just a
#: little more frequent in toxic documents tell little, and would put most documents into the index.
LIFT = 2.0
#: A term is kept if chance would keep less than this many of all terms tested.
CHANCE = 0.01
BLOCK = 64
NEAREST = 15
#: Votes that the rate of documents without terms counts as much as.
PRIOR = 1.0
EVIDENCE = 3
CUT = 0.5
#: Documents that are scored in one task, about.
TASK_ROWS = 20_000
#: Words whose terms, and vectors of up to SHORT terms whose scores a task remembers.
REMEMBERED = 1 << 18
SHORT = 8


def words(text: str) -> Iterator[str]:
    """Lower-cased words; a long text is not made into one list."""
    if len(text) < 1 << 20:
        return iter(WORD.findall(text.lower()))
    return (m.group().lower() for m in WORD.finditer(text))


def terms(word: str) -> list[str]:
    out = [word[:n] for n in PREFIXES if n <= len(word)]
    return out + [word + END] if len(word) <= LONGEST else out


def _tested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per term the sample's documents that have it, and the toxic ones of them."""
    for batch in batches:
        held, toxic = Counter(), Counter()
        for text, label in zip(batch["text"].to_pylist(), batch["label"].to_pylist()):
            own = {t for w in set(words(text or "")) for t in terms(w)}
            held.update(own)
            if label:
                toxic.update(own)
        names = list(held)
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array([held[t] for t in names], pa.int64()),
             pa.array([toxic[t] for t in names], pa.int64())], ["term", "seen", "toxic"])


def _counter(index: dict[str, int]):
    """A ``mapInArrow`` function: documents to (doc_id, held_out, terms, counts)."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, list[int]] = {}
        for batch in batches:
            out = []
            for text in batch["text"].to_pylist():
                found: Counter = Counter()
                for w in words(text or ""):
                    own = known.get(w)
                    if own is None:
                        own = [index[t] for t in terms(w) if t in index]
                        if len(known) >= REMEMBERED:
                            known.clear()
                        if len(w) <= LONGEST:
                            known[w] = own
                    for t in own:
                        found[t] += 1
                out.append(sorted(found.items()))
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["held_out"],
                 pa.array([[t for t, _ in x] for x in out], pa.list_(pa.int32())),
                 pa.array([[c for _, c in x] for x in out], pa.list_(pa.int64()))],
                ["doc_id", "held_out", "terms", "counts"])
    return count


def weights(ids: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF of unit length, with 1 + log(count)."""
    w = (1 + np.log(counts)) * idf[ids]
    return w / math.sqrt(float(w @ w)) if len(w) else w


@dataclass
class Index:
    """A block-max inverted index of unit vectors, in blocks of ``BLOCK`` rows."""

    idf: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    most: np.ndarray  # (term, block): largest weight
    starts: np.ndarray  # (block, term): first posting; postings of a pair lie together
    rows: np.ndarray  # posting: row within its block
    values: np.ndarray
    base: float = 0.5
    curve: tuple[float, float] | None = None
    documents: int = 0
    scored: list[int] = field(default_factory=lambda: [0, 0])

    @classmethod
    def over(cls, examples, idf: np.ndarray) -> Index:
        """``examples``: (doc_id, label, terms, counts). Rows with alike terms share blocks, so that
        the blocks' bounds are tight."""
        vectors = [(i, y, t, weights(t, c, idf)) for i, y, t, c in examples]
        vectors.sort(key=lambda v: (int(v[2][np.argmax(v[3])]), v[1], v[0], v[2].tobytes()))
        n, blocks = len(idf), -(-len(vectors) // BLOCK)
        term = np.concatenate([v[2] for v in vectors] or [np.zeros(0, np.int64)]).astype(np.int64)
        value = np.concatenate([v[3] for v in vectors] or [np.zeros(0)])
        row = np.repeat(np.arange(len(vectors)), [len(v[2]) for v in vectors])
        most = np.zeros((n, blocks))
        np.maximum.at(most, (term, row // BLOCK), value)
        cell = row // BLOCK * n + term
        order = np.argsort(cell, kind="stable")
        starts = np.searchsorted(cell[order], np.arange(blocks * n + 1))
        return cls(idf, np.array([v[0] for v in vectors], np.int64), np.array([v[1] for v in vectors], np.int64),
                   most, starts, (row % BLOCK)[order], value[order])

    def nearest(self, ids: np.ndarray, vector: np.ndarray, without: int | None = None):
        """(rows, cosines) of the NEAREST rows with a cosine above 0, best first; of equal ones the
        first rows. ``without``: an example id that is left out."""
        n, blocks = self.most.shape
        bounds = vector @ self.most[ids]
        best = np.zeros(0, np.int64), np.zeros(0)
        for b in np.argsort(-bounds, kind="stable"):
            if bounds[b] <= 0 or len(best[0]) == NEAREST and bounds[b] < best[1][-1] - 1e-9:
                break
            first, end = self.starts[b * n + ids], self.starts[b * n + ids + 1]
            many = end - first
            at = np.repeat(first - np.cumsum(many) + many, many) + np.arange(many.sum())
            cosines = np.bincount(self.rows[at], np.repeat(vector, many) * self.values[at], BLOCK)
            self.scored[0] += 1
            found = np.flatnonzero(cosines > 0)
            rows, near = found + b * BLOCK, np.round(cosines[found], 12)
            if without is not None:
                other = self.ids[rows] != without
                rows, near = rows[other], near[other]
            rows, near = np.concatenate((best[0], rows)), np.concatenate((best[1], near))
            order = np.lexsort((rows, -near))[:NEAREST]
            best = rows[order], near[order]
        self.scored[1] += blocks
        return best

    def vote(self, ids: np.ndarray, counts: np.ndarray, without: int | None = None):
        """(share of toxic votes, rows, cosines)."""
        rows, near = self.nearest(ids, weights(ids, counts, self.idf), without) \
            if len(ids) and len(self.ids) else (np.zeros(0, np.int64), np.zeros(0))
        return (float(near @ self.labels[rows]) + PRIOR * self.base) / (near.sum() + PRIOR), rows, near

    def score(self, vote: float) -> float:
        if self.curve is None:
            return vote
        a, b = self.curve
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, a * _logit(vote) + b))))


def _logit(p: float) -> float:
    p = min(max(p, 1e-6), 1 - 1e-6)
    return math.log(p / (1 - p))


def fitted_curve(votes: np.ndarray, labels: np.ndarray) -> tuple[float, float] | None:
    """Slope and shift of a logistic curve over the votes' log odds, by Newton steps with a small
    penalty towards the identity. None if the labels or the slope say that votes tell nothing."""
    if len(set(labels.tolist())) < 2:
        return None
    x = np.array([_logit(v) for v in votes])
    c = np.array([1.0, 0.0])
    design = np.stack((x, np.ones(len(x))), 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ c, -30, 30)))
        slope = design.T @ (labels - p) - (c - [1.0, 0.0])
        bend = (design * (p * (1 - p))[:, None]).T @ design + np.eye(2)
        step = np.linalg.solve(bend, slope)
        c = c + step
        if np.abs(step).max() < 1e-10:
            break
    return (float(c[0]), float(c[1])) if c[0] > 0 else None


def held_out(doc_id):
    """Rows whose labels are never learned from: 5 divides crc32 of the id as text."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "utf-8")) % 5 == 0, F.lit(False))


def chosen_terms(sample: DataFrame) -> list[str]:
    """Terms that go with the toxic label in ``sample`` (text, label)."""
    total, toxic = sample.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    if not toxic or toxic == total:
        return []
    counts = stage(sample.select("text", "label").mapInArrow(
        _tested, "term string, seen long, toxic long").groupBy("term").agg(
        F.sum("seen").alias("seen"), F.sum("toxic").alias("toxic")), "terms")
    tested = counts.count()
    # Twice the log likelihood ratio of presence by label; chance exceeds 2 log(x) once in about x.
    a, b = F.col("toxic"), F.col("seen") - F.col("toxic")

    def part(observed, row, column):
        expected = column * row / float(total)
        return F.when(observed > 0, observed * F.log(observed / expected)).otherwise(0.0)
    rest = total - F.col("seen")
    ratio = 2 * (part(a, toxic, F.col("seen")) + part(b, total - toxic, F.col("seen"))
                 + part(toxic - a, toxic, rest) + part(total - toxic - b, total - toxic, rest))
    kept = counts.withColumn("ratio", ratio).filter(
        (F.col("ratio") >= 2 * math.log(max(1, tested) / CHANCE))
        & (a * float(total) >= LIFT * float(toxic) * F.col("seen")))
    return [r.term for r in kept.orderBy(F.desc("ratio"), "term").limit(MAX_TERMS).collect()]


def fit(vectors: DataFrame, chosen: DataFrame, n_terms: int) -> Index:
    """The index over the chosen examples. The driver gets one number per term, and the vectors of
    TRAIN_ROWS documents at most."""
    n = vectors.count()
    df = np.zeros(n_terms)
    for r in vectors.select(F.explode("terms").alias("t")).groupBy("t").count().collect():
        df[r.t] = r["count"]
    idf = np.log((1 + n) / (1 + df)) + 1
    # One row per id, should rows repeat an id.
    found = vectors.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label").agg(
        F.max(F.struct("terms", "counts")).alias("v")).select("doc_id", "label", "v.*").collect()
    found = [(r.doc_id, int(r.label), np.array(r.terms, np.int64), np.array(r.counts, np.float64))
             for r in sorted(found, key=lambda r: r.doc_id)]
    index = Index.over([x for x in found if len(x[2])], idf)
    index.documents = n
    empty = [y for _, y, t, _ in found if not len(t)]
    index.base = (sum(empty) + 0.5) / (len(empty) + 1) if found else 0.5
    votes = np.array([index.vote(t, c, without=i)[0] for i, _, t, c in found if len(t)])
    index.curve = fitted_curve(votes, np.array([y for _, y, t, _ in found if len(t)]))
    index.scored = [0, 0]
    return index


def _scorer(index: Index):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[tuple, tuple] = {((), ()): (index.base, [])}  # short vectors often repeat
        for batch in batches:
            out = []
            for ids, counts in zip(batch["terms"].to_pylist(), batch["counts"].to_pylist()):
                key = (tuple(ids), tuple(counts))
                found = known.get(key)
                if found is None:
                    vote, rows, near = index.vote(np.array(ids, np.int64), np.array(counts, np.float64))
                    found = (index.score(vote) if len(rows) else index.base, [
                        {"doc_id": int(index.ids[r]), "similarity": float(s), "toxic": int(index.labels[r])}
                        for r, s in zip(rows[:EVIDENCE].tolist(), near[:EVIDENCE])])
                    if len(ids) <= SHORT and len(known) < REMEMBERED:
                        known[key] = found
                out.append(found)
            scores = np.array([x[0] for x in out], np.float64)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["held_out"], pa.array(scores, pa.float64()),
                 pa.array((scores >= CUT).astype(np.int32)),
                 pa.array([x[1] for x in out], pa.list_(pa.struct(
                     [("doc_id", pa.int64()), ("similarity", pa.float64()), ("toxic", pa.int32())])))],
                ["doc_id", "held_out", "score", "predicted", "evidence"])
    return score


def labelled(labels: DataFrame, rows: int) -> DataFrame:
    """(doc_id, label) of at most ``rows`` labelled ids that are not held out. Of several labels of
    one id the largest counts."""
    return labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int")
                         .alias("toxic")).filter(
        F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))) \
        .groupBy("doc_id").agg(F.greatest(F.lit(0), F.least(F.lit(1), F.max("toxic"))).alias("label")) \
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)


def toxicity(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted and evidence (the nearest examples) for every document.

    A null text is empty; a text without a term that tells has the share of toxic ones among such
    examples. A null id is not held out. Rows are scored one by one, so repeated rows have equal
    scores. Without labels, or with one class only, no term tells anything. No rows give no rows.
    """
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    chosen = stage(labelled(labels, rows), "chosen")  # ``rows`` ids at most
    sample = ids.join(F.broadcast(chosen), "doc_id").select("text", "label")
    found = chosen_terms(sample)
    vectors = stage(ids.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text").mapInArrow(
        _counter({t: i for i, t in enumerate(found)}),
        "doc_id long, held_out boolean, terms array<int>, counts array<long>"), "vectors")
    index = fit(vectors, chosen, len(found))
    # Vectors are small files; scoring them is worth more tasks than reading them.
    tasks = max(1, -(-index.documents // TASK_ROWS))
    return vectors.repartition(tasks).mapInArrow(
        _scorer(index),
        "doc_id long, held_out boolean, score double, predicted int, "
        "evidence array<struct<doc_id: long, similarity: double, toxic: int>>")
