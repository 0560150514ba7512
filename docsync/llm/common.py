"""What the operators share: input columns, staged tables, word patterns, row payloads."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from hashlib import blake2b
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docsync.storage import delete, new_folder

#: White space of the word rule ``[^\x20\x09-\x0D]+``.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"

#: Bytes of text that one vectorised step works on; a longer document is a step of its own.
STEP_BYTES = 1 << 20


#: Bytes of one Arrow batch, so that what a task and its Python worker hold does not grow with the
#: length of the texts. A session's own setting stays.
BATCH_BYTES = "4m"
BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once per application. Without it they
    find it only if it is installed there or lies on their path. Also bounds the bytes of a batch."""
    context = spark.sparkContext
    if spark.conf.get(BATCH, None) is None:
        spark.conf.set(BATCH, BATCH_BYTES)
    if context.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parents[2]
    archive = Path(tempfile.mkdtemp(prefix="docsync-")) / "docsync.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for source in sorted((root / "docsync").rglob("*.py")):
            z.write(source, source.relative_to(root))
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a written table in the cluster's shared folder.

    What follows reads the files: nothing before them runs again, their size is known to the
    optimizer, and a lost executor costs a file read. The folder stays until ``drop``.
    """
    path = new_folder(df.sparkSession, label)
    df.write.mode("overwrite").parquet(path)
    staged = df.sparkSession.read.schema(df.schema).parquet(path)
    staged._staged_at = path
    for made in _SCOPES[-1:]:
        made.append(path)
    return staged


_SCOPES: list[list[str]] = []


@contextmanager
def scratch():
    """The folders of tables that are staged within the block, as a list. Who knows that nothing
    reads them any more can delete them."""
    made: list[str] = []
    _SCOPES.append(made)
    try:
        yield made
    finally:
        _SCOPES.remove(made)


def drop(staged: DataFrame) -> None:
    """Delete the files behind a staged table that nothing reads any more."""
    delete(staged.sparkSession, staged._staged_at)


def packed(df: DataFrame) -> Column:
    """All columns of ``df`` as one struct, so that names of an operator cannot clash with them."""
    return F.struct(*[df[f"`{c}`"] for c in df.columns])


def unpacked(df: DataFrame, row: str, names: list[str], *more: Column) -> DataFrame:
    return df.select(*[F.col(row).getField(c).alias(c) for c in names], *more)


def words(text: Column) -> Column:
    """Words of a text as an array; none for a null or blank text."""
    parts = F.split(F.coalesce(text, F.lit("")), GAP)
    return F.filter(parts, lambda w: w != "")


def encoded(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    """The texts of an Arrow column as UTF-8 (null: empty), without making str objects."""
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


def steps(texts: list[bytes], limit: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of at most ``limit`` bytes together, or of one text."""
    start = total = 0
    for i, t in enumerate(texts):
        if i > start and total + len(t) > limit:
            yield start, i
            start, total = i, 0
        total += len(t) + 1
    if start < len(texts):
        yield start, len(texts)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the splitmix finalizer)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def noise(n: int, seed: int) -> np.ndarray:
    """``n`` fixed 64-bit values that look random."""
    with np.errstate(over="ignore"):
        return mix64(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                     + np.uint64(seed))


class Powers:
    """Powers of an odd base modulo 2**64 and of its inverse, as far as they were needed."""

    def __init__(self, base: int = 0x5851F42D4C957F2D):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up), 1 << 16)
            self.up, self.down = (np.cumprod(np.append(
                np.ones(1, np.uint64), np.full(size - 1, b, np.uint64)), dtype=np.uint64)
                for b in (self.base, self.inverse))
            if len(self.up) > 1 << 23:  # a giant document: do not keep its tables
                up, down = self.up, self.down
                self.up = self.down = np.ones(1, np.uint64)
                return up, down
        return self.up, self.down


_POWERS = Powers()
_BYTE = noise(256, 11)
_LOWER = _BYTE.copy()
_LOWER[65:91] = _BYTE[97:123]


def prefix_hashes(data: np.ndarray, values: np.ndarray = _BYTE):
    """Running hash of bytes; ``span_hash`` takes the hash of any span from it in O(1)."""
    up, down = _POWERS.upto(len(data) + 1)
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(values[data] * up[:len(data)], out=out[1:])
    return out, down


def span_hash(prefix, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    sums, down = prefix
    return mix64((sums[ends] - sums[starts]) * down[starts]
                 + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


def word_spans(texts: list[bytes]):
    """(bytes of all texts, word starts, word ends, first word of each text and the end)."""
    data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    space = _SPACE[data]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    if len(data) and not space[0]:
        edge = np.concatenate(([0], edge))
    starts, ends = edge[0::2], edge[1::2]
    lengths = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    bounds = np.concatenate(([0], np.cumsum(lengths)))
    return data, starts, ends, np.searchsorted(starts, bounds)


def word_hashes(texts: list[bytes], lower: bool = True):
    """(64-bit hash of every word, first word of each text and the end)."""
    data, starts, ends, first = word_spans(texts)
    prefix = prefix_hashes(data, _LOWER if lower else _BYTE)
    return span_hash(prefix, starts, ends), first


#: Words of more bytes than this are told apart by a digest of their bytes.
LANES = 64
_LOWER_BYTE = np.arange(256, dtype=np.uint8)
_LOWER_BYTE[65:91] += 32


def word_keys(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit keys of spans of bytes. Eight bytes after the other are mixed into the key of a word,
    so that no pattern of letters makes two words meet, as it does with powers modulo 2 ** 64."""
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    eights = np.ndarray((len(padded) - 7,), "<u8", padded, strides=(1,))
    lengths = ends - starts
    keys = mix64(lengths.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    rest = np.flatnonzero(lengths <= LANES)
    for lane in range(0, LANES, 8):
        rest = rest[lengths[rest] > lane]
        if not len(rest):
            break
        part = eights[starts[rest] + lane]
        short = np.minimum(lengths[rest] - lane, 8).astype(np.uint64)
        part = part & (np.uint64(0xFFFFFFFFFFFFFFFF) >> (np.uint64(64) - np.uint64(8) * short))
        keys[rest] = mix64((keys[rest] ^ part) + np.uint64(0xD6E8FEB86659FD93))
    for i in np.flatnonzero(lengths > LANES).tolist():
        digest = blake2b(data[starts[i]:ends[i]].tobytes(), digest_size=8).digest()
        keys[i] = np.uint64(int.from_bytes(digest, "little"))
    return keys


def told_words(texts: list[bytes]):
    """(key of every word in lower case, first word of each text and the end)."""
    data, starts, ends, first = word_spans(texts)
    return word_keys(_LOWER_BYTE[data], starts, ends), first
