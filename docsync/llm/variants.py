"""Spelling variants: words that differ by one edit, and the frequent form each belongs to.

Two words that differ by one inserted, deleted or replaced code point agree before the edit and
after it: they share the first half of the one or the rest of it behind that half. So the vocabulary
is sorted twice, by words and by reversed words, and a word looks for near words in the part of
either list that begins with its own beginning.

The lists are range-partitioned by sampled splitters into ranges of about ``RANGE`` words. A word
goes to the ranges that its beginning reaches, but for those whose shared prefix is more than one
edit from it. Within a range the sorted list is scanned once for all its queries: a row of the edit
matrix (a band of three cells a query) depends on the prefix read so far only, so the rows of the
prefix that two neighbours share (their LCP) are kept, and where no query is within one edit any
more the whole range of words with that prefix is skipped.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from os.path import commonprefix

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsync.llm.common import drop, encoded, stage

RUN = re.compile("[A-Za-zÀ-ÿ]+")
#: One run in so many loses a code point.
SPOIL = 97
LEAST_LENGTH = 5
LEAST_COUNT = 3
RATIO = 2
#: Words of a list in one range, and queries that scan it together; more queries scan a copy.
RANGE = 4000
QUERIES = 16000
#: Distinct words that a task counts before it sends them on.
HELD = 300_000
#: Beyond this depth up to FEW queries that are left are compared directly, so that words of any
#: length need no more rows than that.
DEPTH = 64
FEW = 8


def counted(texts: list[tuple[int | None, bytes]], held: Counter) -> None:
    """Add the runs of (doc_id, text) to ``held``, some of them spoiled."""
    for doc_id, raw in texts:
        text = raw.lower().decode("utf-8", "replace")  # bytes: A-Z only
        # A long text is not made into one list of runs.
        runs = RUN.findall(text) if len(text) < 1 << 20 else (m.group() for m in RUN.finditer(text))
        start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
        for run, n in Counter(runs).items():
            h = zlib.crc32(run.encode(), start)
            if h % SPOIL == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            if len(run) >= LEAST_LENGTH:
                held[run] += n


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: Counter = Counter()

    def out():
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()),
                                           pa.array(list(held.values()), pa.int64())], ["word", "n"])
    for batch in batches:
        counted(list(zip(batch["doc_id"].to_pylist(), encoded(batch["text"]))), held)
        if len(held) > HELD:
            yield out()
            held.clear()
    yield out()


def vocabulary(docs: DataFrame) -> DataFrame:
    """(word, n) of all words in question."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text") \
        .mapInArrow(_counts, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")) \
        .filter(F.col("n") >= LEAST_COUNT)


def one_edit(a: bytes, b: bytes) -> bool:
    """Whether exactly one insertion, deletion or replacement lies between two words."""
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    i = len(commonprefix([a, b]))
    return a[i + (len(a) >= len(b)):] == b[i + (len(b) >= len(a)):]


def next_rows(band: np.ndarray, depth: int, char: int, around: np.ndarray, lengths: np.ndarray,
              halves: np.ndarray) -> np.ndarray:
    """Rows of the edit matrix at ``depth`` + 1, of the list's prefix one ``char`` longer.

    ``band[i]`` are the cells before, on and after the diagonal of query ``i``, each at most 2;
    ``around[i]`` the query's characters at depth - 1, depth and depth + 1. In its first half a
    query must agree exactly.
    """
    miss = around != char
    new = np.empty_like(band)
    new[:, 0] = np.minimum(band[:, 0] + miss[:, 0], band[:, 1] + 1)
    exact = depth + 1 <= halves
    new[exact, 0] = 2
    new[depth > lengths, 0] = 2
    new[:, 1] = np.minimum(np.minimum(band[:, 1] + miss[:, 1], band[:, 2] + 1), new[:, 0] + 1)
    new[:, 2] = np.minimum(band[:, 2] + miss[:, 2], new[:, 1] + 1)
    wrong = exact & (new[:, 1] > 0)
    new[wrong, 1:] = 2
    new[depth + 1 < halves, 2] = 2
    new[depth + 1 > lengths, 1] = 2
    new[depth + 2 > lengths, 2] = 2
    return np.minimum(new, 2)


def scan(words: list[bytes], queries: list[bytes], halves: list[int]) -> Iterator[tuple[int, int]]:
    """(query, word) pairs that are one edit apart and share the first ``halves[query]``
    characters. ``words`` are sorted."""
    lengths = np.array([len(q) for q in queries], np.int64)
    starts = np.concatenate(([0], np.cumsum(lengths + 1)))[:-1] + 1
    flat = np.frombuffer(b"\0" + b"\0".join(queries) + b"\0\0\0", np.uint8)
    half = np.array(halves, np.int64)
    # Rows of the prefix read so far, by its length: (queries within one edit, their bands).
    # Before any character a query may not begin with an edit: halves are at least 1.
    rows = [(np.arange(len(queries)), np.tile(np.array([2, 0, 2], np.int8), (len(queries), 1)))]
    before, i = b"", 0
    while i < len(words):
        word = words[i]
        keep = min(len(commonprefix([before, word])), len(rows) - 1)
        del rows[keep + 1:]
        before = word
        alive, band = rows[-1]
        while len(rows) <= len(word) and len(alive) and not (
                len(rows) > DEPTH and len(alive) <= FEW):
            depth = len(rows) - 1
            at = starts[alive] + depth
            around = np.stack((flat[at - 1], flat[at], flat[np.minimum(at + 1, len(flat) - 1)]), 1)
            band = next_rows(band, depth, word[depth], around, lengths[alive], half[alive])
            near = band.min(axis=1) <= 1
            alive, band = alive[near], band[near]
            rows.append((alive, band))
        if not len(alive):
            # Nothing is near this prefix: skip all words that have it.
            prefix = word[:len(rows) - 1]
            i += 1
            while i < len(words) and words[i].startswith(prefix):
                i += 1
            continue
        if len(rows) > len(word):
            off = lengths[alive] - len(word) + 1
            inside = (off >= 0) & (off <= 2)
            last = band[np.arange(len(alive)), np.clip(off, 0, 2)]
            for q in alive[inside & (last == 1)].tolist():
                yield q, i
        else:
            for q in alive.tolist():
                if one_edit(queries[q], word) and word[:halves[q]] == queries[q][:halves[q]]:
                    yield q, i
        i += 1


def _half(length: int, reverse: int) -> int:
    """So many characters at the beginning of a (reversed) word are shared in its list."""
    return length - length // 2 if reverse else length // 2


def _routes(bounds: list[tuple[int, int, str, str]]):
    """A ``mapInArrow`` function: words to the ranges (reverse, part, first, last) that can have
    near words of theirs."""
    lists = {r: sorted((x for x in bounds if x[0] == r), key=lambda x: x[2]) for r in (0, 1)}
    firsts = {r: [x[2] for x in lists[r]] for r in lists}
    lasts = {r: [x[3] for x in lists[r]] for r in lists}
    shared = {r: [commonprefix([x[2], x[3]]) for x in lists[r]] for r in lists}

    def near(prefix: str, key: str) -> bool:
        """Whether some continuation of ``prefix`` may be one edit from ``key``."""
        i = len(commonprefix([prefix, key]))
        rest = prefix[i + 1:]  # what follows the edit: a replacement, a deletion, an insertion
        return i >= len(prefix) or key.startswith(rest, i + 1) \
            or key.startswith(prefix[i:], i + 1) or key.startswith(rest, i)

    def routes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for word in batch["word"].to_pylist():
                for r in (0, 1):
                    key = word[::-1] if r else word
                    head = key[:_half(len(key), r)]
                    low = bisect_left(lasts[r], head)
                    high = bisect_right(firsts[r], head + chr(0x10FFFF))
                    out += [(r, lists[r][i][1], key) for i in range(low, high)
                            if near(shared[r][i], key)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in out], pa.int32()), pa.array([x[1] for x in out], pa.int32()),
                 pa.array([x[2] for x in out], pa.string())], ["reverse", "part", "key"])
    return routes


def _found(listed: pa.Table, asked: pa.Table) -> pa.Table:
    """Per query of one range: how many near words it has there, and the best of them."""
    listed = listed.sort_by("key")
    names = listed["key"].to_pylist()
    counts = listed["n"].to_pylist()
    words = [w.encode("latin-1") for w in names]
    reverse = bool(len(listed) and listed["reverse"][0].as_py())
    keys = asked["key"].to_pylist()
    queries = [k.encode("latin-1") for k in keys]
    halves = [_half(len(k), reverse) for k in keys]
    best: dict[int, tuple[int, int, str]] = {}
    for q, w in scan(words, queries, halves) if words and queries else ():
        name = names[w]
        if reverse:
            key, name = keys[q][::-1], name[::-1]
            if name.startswith(key[:len(key) // 2]):
                continue  # the list of words has this pair
        many, low, other = best.get(q, (0, 0, ""))
        rank = min((low, other), (-counts[w], name)) if many else (-counts[w], name)
        best[q] = (many + 1, *rank)
    told = [(keys[q][::-1] if reverse else keys[q], *v) for q, v in best.items()]
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
    return pa.table([pa.array([t[i] for t in told], k) for i, k in enumerate(kinds)],
                    names=["word", "many", "low", "other"])


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, best_n, best) of every word of ``words`` (word, n; written) that has near
    words. Ranges are told to the driver: one row for every RANGE words."""
    ranges = max(1, -(-2 * words.count() // RANGE))
    lists = words.select(F.lit(0).alias("reverse"), F.col("word").alias("key"), "n").unionByName(
        words.select(F.lit(1).alias("reverse"), F.reverse("word").alias("key"), "n"))
    lists = stage(lists.repartitionByRange(ranges, "reverse", "key").withColumn(
        "part", F.spark_partition_id()), "lists")
    bounds = [tuple(b) for b in lists.groupBy("reverse", "part").agg(
        F.min("key").alias("first"), F.max("key").alias("last")).collect()]
    asked = stage(words.select("word").mapInArrow(
        _routes(bounds), "reverse int, part int, key string"), "asked")
    copies = asked.groupBy("reverse", "part").agg(
        F.ceil(F.count("*") / QUERIES).cast("int").alias("copies"))
    keys = ["reverse", "part", "copy"]
    one = asked.join(copies, ["reverse", "part"]).select(
        "key", "reverse", "part", F.pmod(F.hash("key"), "copies").alias("copy"))
    many = lists.join(copies, ["reverse", "part"]).select(
        "key", "n", "reverse", "part", F.explode(F.expr("sequence(0, copies - 1)")).alias("copy"))
    found = many.groupBy(*keys).cogroup(one.groupBy(*keys)).applyInArrow(
        _found, "word string, many long, low long, other string")
    return found.groupBy("word").agg(
        F.sum("many").alias("n_near"), F.min(F.struct("low", "other")).alias("best")).select(
        "word", "n_near", (-F.col("best.low")).alias("best_n"), F.col("best.other").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of all words that have a form, from (word, form): every round doubles the
    steps taken. A form is at least RATIO times as frequent, so a chain is a logarithm long."""
    now = stage(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        new = stage(now.join(ahead, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")),
            "roots")
        drop(now)
        now = new.select("word", "root")
        now._staged_at = new._staged_at
        if new.filter("moved").isEmpty():
            return now


def variants(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word of the texts.

    A null text has no words. A null id counts as an empty one where runs are spoiled. Rows that
    repeat count again. Of near words that are equally frequent the first in code-point order is
    the form. No rows give no rows. Columns besides doc_id and text take no part.
    """
    words = stage(vocabulary(docs), "words")
    near = near_words(words)
    told = stage(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(F.col("best_n") >= RATIO * F.col("n"), F.col("best")).alias("form"),
        F.when(F.col("best_n") >= RATIO * F.col("n"), F.col("best_n")).alias("form_n")), "told")
    ends = roots(told.filter(F.col("form").isNotNull()))
    return told.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
