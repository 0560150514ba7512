"""Order MinHash fingerprints, which follow edit distance: they know the order of what they pick.

Of each text the k-mers (of UTF-8 bytes) are numbered by occurrence. Each of ``HASHES`` functions
picks the ``PICKED`` smallest numbered k-mers, keeps them in text order, and hashes that tuple to
one entry of the signature. The likeness of two texts is their share of equal entries.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsync.llm.common import mix64, noise, prefix_hashes, span_hash

K = 12
HASHES = 32
PICKED = 2
#: K-mers hashed by all functions at once.
BLOCK = 8192
_ODD = (noise(HASHES, 21) | np.uint64(1))[:, None]
_LAST = np.uint64(0xFFFFFFFFFFFFFFFF)


def numbered(text: bytes) -> np.ndarray:
    """Hash of each k-mer with its occurrence number; a shorter text is one k-mer."""
    if not text:
        return np.zeros(0, np.uint64)
    data = np.frombuffer(text, np.uint8)
    at = np.arange(max(1, len(text) - K + 1))
    grams = span_hash(prefix_hashes(data), at, np.minimum(at + K, len(text)))
    bits = np.uint64(max(20, int(len(at)).bit_length()))
    # Sorted by gram, then place. Grams that agree in the upper bits only shift the numbers, and
    # do so in the same way for equal texts.
    rows = np.sort((grams >> bits << bits) | at.astype(np.uint64))
    new = np.concatenate(([True], (rows[1:] >> bits) != (rows[:-1] >> bits)))
    if not new.all():
        place = (rows & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
        run = np.flatnonzero(new)
        number = np.arange(len(rows)) - np.repeat(run, np.diff(np.append(run, len(rows))))
        again = number > 0
        place, number = place[again], number[again].astype(np.uint64)
        grams[place] = mix64(grams[place] + number)
    return grams


def picked(grams: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """(value, place) of the PICKED smallest k-mers in [low, high) for each function."""
    values, places = [], []
    for a in range(low, high, BLOCK):
        hashed = grams[a:min(a + BLOCK, high)] * _ODD
        for _ in range(min(PICKED, hashed.shape[1])):
            at = hashed.argmin(1)
            values.append(hashed[np.arange(HASHES), at])
            places.append(a + at)
            hashed[np.arange(HASHES), at] = _LAST
    if not values:
        return np.zeros((HASHES, 0), np.uint64), np.zeros((HASHES, 0), np.int64)
    return np.stack(values, 1), np.stack(places, 1)


def signature(grams: np.ndarray, *parts: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Signature of a text from what was picked in its parts."""
    if not len(grams):
        return np.zeros(0, np.uint32)
    values = np.concatenate([p[0] for p in parts], 1)
    places = np.concatenate([p[1] for p in parts], 1)
    least = np.lexsort((places, values), axis=1)[:, :PICKED]
    places = np.sort(np.take_along_axis(places, least, 1), 1)
    total = np.zeros(HASHES, np.uint64)
    for j in range(places.shape[1]):
        total = mix64(total + grams[places[:, j]])
    return (total >> np.uint64(32)).astype(np.uint32)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of equal entries; empty texts are like each other and like nothing else."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    return float((a == b).mean())


def as_text(entries: np.ndarray) -> str:
    return entries.astype(">u4").tobytes().hex()


class Fingerprints:
    """Fingerprint of a text and of its edited text; the k-mers before the edit count for both."""

    def __init__(self, text: str):
        self.text = text
        self.raw = text.encode("utf-8")
        self.grams = numbered(self.raw)
        kept = len(text) - len(text) // 4
        self.head = text[:kept].encode("utf-8")
        # A k-mer is the same in both texts if it ends in the kept part and is a full one.
        self.same = max(0, min(len(self.head), len(self.raw)) - K + 1)
        self.first = picked(self.grams, 0, self.same)
        self.own = signature(self.grams, self.first,
                             picked(self.grams, self.same, len(self.grams)))

    def edited(self, after: str) -> tuple[bytes, np.ndarray]:
        raw = self.head + after[:len(self.text) // 4].encode("utf-8")
        grams = numbered(raw)
        return raw, signature(grams, self.first, picked(grams, self.same, len(grams)))


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (bucket, guest, doc_id); each row but guests with the row after it."""
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
             "near_edited", "near_next"]
    held = None
    for batch in batches:
        out = []
        for bucket, guest, doc_id, text in zip(*(batch[c].to_pylist() for c in (
                "bucket", "guest", "doc_id", "text"))):
            now = (bucket, guest, doc_id, Fingerprints(text or ""))
            if held is not None and held[0] == bucket and not held[1]:
                mine, other = held[3], now[3]
                raw, edited = mine.edited(other.text)
                out.append((held[2], len(mine.text), hashlib.sha256(raw).hexdigest(),
                            as_text(mine.own), as_text(edited),
                            likeness(mine.own, edited), likeness(mine.own, other.own)))
            held = now
        columns = list(zip(*out)) or [[]] * len(names)
        kinds = [pa.int64()] * 2 + [pa.string()] * 3 + [pa.float64()] * 2
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, kinds)], names)


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text, of its edited text, and likeness to that and the next text.

    The edited text has its last quarter replaced by the start of the next document in ascending
    doc_id (nulls first, repeated ids in order of text; after the last comes the first, for a single
    document itself). A null text is empty: its fingerprint is the empty string.

    Documents are dealt by ranges of doc_id, with explicit splitters, in one shuffle; the first
    row of each range also goes to the range before it, as the guest that follows its last row.
    """
    spark = docs.sparkSession
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    many = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = sorted(set(map(int, ids.approxQuantile(
        "doc_id", [i / many for i in range(1, many)], 0.1 / many))))

    @F.pandas_udf("int")
    def bucket_of(doc_id: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(np.array(cuts, np.int64), doc_id, side="right"))

    known = F.coalesce("doc_id", F.lit(0).cast("long"))
    rows = ids.withColumn("bucket", F.when(F.col("doc_id").isNull(), -1).otherwise(
        bucket_of(known)))
    # One row per range goes to the driver; their number was chosen above.
    firsts = rows.select("bucket", "doc_id").groupBy("bucket").agg(F.min("doc_id").alias("first")) \
        .orderBy("bucket").collect()
    if not firsts:
        return spark.createDataFrame([], "doc_id long, n_chars long, edited_sha256 string, "
                                         "fingerprint string, edited_fingerprint string, "
                                         "near_edited double, near_next double")
    before = [firsts[i - 1].bucket for i in range(len(firsts))]
    guests = spark.createDataFrame([(f.first, b) for f, b in zip(firsts, before)],
                                   "first long, bucket int")
    guests = ids.join(F.broadcast(guests), F.col("doc_id").eqNullSafe(F.col("first"))).select(
        "doc_id", "text", "bucket", F.lit(1).alias("guest"))
    both = rows.withColumn("guest", F.lit(0)).unionByName(guests)
    return both.repartition("bucket").sortWithinPartitions("bucket", "guest", "doc_id", "text") \
        .mapInArrow(_compared, "doc_id long, n_chars long, edited_sha256 string, "
                               "fingerprint string, edited_fingerprint string, "
                               "near_edited double, near_next double")
