"""Removal of byte strings that occur more than once, by a sparse suffix array.

A string of ``LENGTH`` bytes always contains the start of a chosen suffix with its first ``GRAM``
bytes: in every ``LENGTH`` bytes the gram with the smallest hash is chosen, by content alone, so two
equal strings choose the same place. Only chosen suffixes (about one in 70) are compared.

1. Suffixes go by sampled splitters of (gram, surrounding bytes), as hashes, into ranges; sorted
   neighbours show which grams occur once (dropped) and which occur with equal surroundings
   (covered as far as one suffix can tell). The ends of a range have neighbours in another one;
   they are passed on undecided.
2. What is left are suffixes at the edges of repeats. They are range-partitioned by their leading
   bytes, sorted in each range by multikey quicksort, and compared with the others that begin with
   the same gram, to the left and right at once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsync.llm.common import (drop, encoded, packed, prefix_hashes, span_hash, stage, steps,
                                unpacked)

LENGTH = 200
GRAM = 64
SIDE = LENGTH - GRAM
#: A gram with more different surroundings than this is counted by string, over all tasks,
#: instead of being compared in one. The result is the same.
HOT_GRAM = 20000


def chosen(texts: list[bytes]):
    """Chosen suffixes of each text: (index of the text, start, gram hash, surroundings' hash)."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(sizes)
    begins = ends - sizes
    data = np.frombuffer(b"".join(texts), np.uint8)
    if len(data) < LENGTH:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),) * 2
    prefix = prefix_hashes(data)
    at = np.arange(len(data) - GRAM + 1)
    grams = span_hash(prefix, at, at + GRAM)
    width = SIDE + 1
    blocks = -(-len(grams) // width) + 1
    keys = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    # Hash above, place below: of equal hashes the leftmost is the smallest.
    keys[:len(grams)] = (grams & np.uint64(0xFFFFFFFF00000000)) | at.astype(np.uint64)
    rows = keys.reshape(blocks, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    windows = len(data) - LENGTH + 1
    least = np.minimum(back[:windows], ahead[width - 1:width - 1 + windows])
    place = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    inside = np.ones(windows, bool)
    for e in ends[:-1]:  # windows that reach over the end of a text
        inside[max(0, e - LENGTH + 1):e] = False
    place = place[inside]
    place = place[np.concatenate(([True], place[1:] != place[:-1]))] if len(place) else place
    text = np.searchsorted(ends, place, side="right")
    low = np.maximum(place - SIDE, begins[text])
    high = np.minimum(place + LENGTH, ends[text])
    return text, place - begins[text], grams[place], span_hash(prefix, low, high)


def _suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, ids = encoded(batch["text"]), np.asarray(batch["uid"])
        for a, b in steps(texts):
            text, start, gram, around = chosen(texts[a:b])
            yield pa.RecordBatch.from_arrays(
                [pa.array(gram.view(np.int64)), pa.array(around.view(np.int64)),
                 pa.array(ids[a:b][text]), pa.array(start)], ["gram", "around", "uid", "start"])


def _kinds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Kinds of sorted suffixes: 1 covered; 2 covered, and its gram has other surroundings;
    3 undecided. Suffixes whose gram no neighbour has are dropped."""
    def told(held, before, after):
        gram, around = held["gram"], held["around"]
        gram = np.concatenate(([before[0]], gram, [after[0]]))
        around = np.concatenate(([before[1]], around, [after[1]]))
        g, s = gram[1:] == gram[:-1], (gram[1:] == gram[:-1]) & (around[1:] == around[:-1])
        # Beyond the ends of the range anything may follow: the gram, but not its surroundings.
        if before[2]:
            g[0], s[0] = True, False
        if after[2]:
            g[-1], s[-1] = True, False
        covered = s[:-1] | s[1:]
        other = (g[:-1] & ~s[:-1]) | (g[1:] & ~s[1:])
        kind = np.where(covered, np.where(other, 2, 1), 3)
        keep = covered | other
        return pa.RecordBatch.from_arrays(
            [pa.array(held["uid"][keep]), pa.array(held["start"][keep] * 4 + kind[keep])],
            ["uid", "code"])

    held, before = None, (0, 0, True)
    for batch in batches:
        if not batch.num_rows:
            continue
        new = {n: np.asarray(batch[n]) for n in ("gram", "around", "uid", "start")}
        if held is not None:
            yield told(held, before, (new["gram"][0], new["around"][0], False))
            before = (held["gram"][-1], held["around"][-1], False)
        held = new
    if held is not None:
        yield told(held, before, (0, 0, True))


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bytes around the suffixes of kinds 2 and 3, with the bytes before them reversed."""
    names = ["gram", "lead", "back", "uid", "start", "kind"]
    for batch in batches:
        out = [[] for _ in names]
        texts = encoded(batch["text"])
        for text, uid, codes in zip(texts, batch["uid"].to_pylist(), batch["codes"].to_pylist()):
            for code in codes:
                p, kind = code >> 2, code & 3
                if kind == 1:
                    continue
                lead = text[p:p + LENGTH]
                digest = hashlib.blake2b(lead[:GRAM], digest_size=8).digest()
                row = (int.from_bytes(digest, "big", signed=True), lead,
                       text[max(0, p - SIDE):p][::-1], uid, p, kind)
                for column, value in zip(out, row):
                    column.append(value)
            if len(out[0]) > 20000:
                yield pa.RecordBatch.from_arrays(_typed(out), names)
                out = [[] for _ in names]
        yield pa.RecordBatch.from_arrays(_typed(out), names)


def _typed(out):
    kinds = (pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int32())
    return [pa.array(c, t) for c, t in zip(out, kinds)]


def as_words(strings: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Strings as rows of big-endian 8-byte words, padded with zeros; and as bytes."""
    wide = -(-width // 8) * 8
    raw = np.frombuffer(b"".join(s.ljust(wide, b"\0") for s in strings), np.uint8)
    raw = raw.reshape(len(strings), wide)
    return raw.view(">u8").astype(np.uint64), raw


def multikey_order(rows: np.ndarray, small: int = 64) -> np.ndarray:
    """Order of the rows by multikey quicksort: three-way partitions on one word at a time;
    rows equal to the pivot go on with the next word, and few rows are sorted directly."""
    order = np.arange(len(rows))
    todo = [(0, len(rows), 0)]
    while todo:
        a, b, depth = todo.pop()
        if b - a < 2 or depth == rows.shape[1]:
            continue
        part = order[a:b]
        if b - a <= small:
            order[a:b] = part[np.lexsort(rows[part, depth:].T[::-1])]
            continue
        key = rows[part, depth]
        pivot = np.partition(key[:: max(1, len(key) // 63)], 1)
        pivot = pivot[len(pivot) // 2] if len(pivot) > 2 else pivot[0]
        less, more = key < pivot, key > pivot
        same = ~(less | more)
        order[a:b] = np.concatenate((part[less], part[same], part[more]))
        x, y = a + int(less.sum()), b - int(more.sum())
        todo += [(a, x, depth), (x, y, depth + 1), (y, b, depth)]
    return order


def _common(raw: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Common leading bytes of each row with the one before it in the order; 0 for the first."""
    out = np.zeros(len(order), np.int64)
    for a in range(1, len(order), 4096):
        b = min(a + 4096, len(order))
        differ = raw[order[a:b]] != raw[order[a - 1:b - 1]]
        first = differ.argmax(1)
        out[a:b] = np.where(differ.any(1), first, raw.shape[1])
    return out


def longest(leads: list[bytes], backs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """For each suffix, how far a repeated string of LENGTH bytes around its gram reaches left of
    the suffix and right of the gram, at most; -1 where there is none."""
    n = len(leads)
    words, raw = as_words(leads, LENGTH)
    order = multikey_order(words)
    right = _common(raw, order)
    group = np.empty(n, np.int64)
    group[order] = np.cumsum(right < GRAM)
    size = np.bincount(group)
    left_len = np.fromiter(map(len, backs), np.int64, n)
    right_len = np.fromiter(map(len, leads), np.int64, n) - GRAM
    backward, back_raw = as_words(backs, SIDE)
    by_back = multikey_order(np.concatenate((group.astype(np.uint64)[:, None], backward), axis=1))
    left = _common(back_raw, by_back)
    left[np.concatenate(([True], group[by_back][1:] != group[by_back][:-1]))] = -1
    best_left, best_right = np.full(n, -1), np.full(n, -1)
    shared = size[group] > 1
    right_class, left_class = np.empty(n, np.int64), np.empty(n, np.int64)
    for d in range(SIDE + 1):
        fit = np.flatnonzero(shared & (left_len >= d) & (right_len >= SIDE - d))
        if not len(fit):
            continue
        right_class[order] = np.cumsum(right < LENGTH - d)
        left_class[by_back] = np.cumsum(left < d)
        key = right_class[fit] * (n + 1) + left_class[fit]
        _, where, count = np.unique(key, return_inverse=True, return_counts=True)
        found = fit[count[where] > 1]
        best_left[found] = d
        best_right[found] = np.maximum(best_right[found], SIDE - d)
    return best_left, best_right


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = [b for b in batches if b.num_rows]
    if not held:
        return
    table = pa.Table.from_batches(held)
    left, right = longest(table["lead"].to_pylist(), table["back"].to_pylist())
    keep = (left >= 0) & (np.asarray(table["kind"]) == 3)
    start = np.asarray(table["start"])[keep]
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.asarray(table["uid"])[keep]), pa.array(start - left[keep]),
         pa.array(start + GRAM + right[keep])], ["uid", "low", "high"])


def _strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes of all strings of LENGTH bytes around the grams, for grams too frequent to compare."""
    for batch in batches:
        for lead, back, uid, start, kind in zip(*(batch[c].to_pylist() for c in (
                "lead", "back", "uid", "start", "kind"))):
            text, p = back[::-1] + lead, len(back)
            d = np.arange(max(0, LENGTH - len(lead)), min(p, SIDE) + 1)
            data = np.frombuffer(text, np.uint8)
            hashes = span_hash(prefix_hashes(data), p - d, p - d + LENGTH)
            check = span_hash(prefix_hashes(data[::-1]), len(data) - (p - d + LENGTH),
                              len(data) - (p - d))
            many = len(d)
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashes.view(np.int64)), pa.array(check.view(np.int64)),
                 pa.array(np.full(many, uid)), pa.array(start - d),
                 pa.array(np.full(many, kind, np.int32))],
                ["string", "check", "uid", "low", "kind"])


def removed_spans(docs: DataFrame) -> DataFrame:
    """(uid, spans) of staged documents (uid, text): covered [low, high) spans, unmerged."""
    anchors = docs.select("uid", "text").mapInArrow(
        _suffixes, "gram long, around long, uid long, start long")
    marks = stage(
        anchors.repartitionByRange("gram", "around", "uid").sortWithinPartitions("gram", "around")
        .mapInArrow(_kinds, "uid long, code long")
        .groupBy("uid").agg(F.collect_list("code").alias("codes")), "marks")
    edges = marks.filter(F.exists("codes", lambda c: c.bitwiseAND(F.lit(3)) != 1))
    contexts = stage(docs.select("uid", "text").join(edges, "uid").select("uid", "text", "codes")
                     .mapInArrow(_contexts, "gram long, lead binary, back binary, uid long, "
                                            "start long, kind int"), "edges")
    hot = stage(contexts.groupBy("gram").count().filter(F.col("count") > HOT_GRAM)
                .select("gram"), "hot")
    found = (contexts.join(hot, "gram", "left_anti")
             .repartitionByRange(F.substring("lead", 1, GRAM))
             .mapInArrow(_edges, "uid long, low long, high long"))
    if hot.count():
        strings = contexts.join(hot, "gram", "left_semi").mapInArrow(
            _strings, "string long, check long, uid long, low long, kind int")
        twice = strings.groupBy("string", "check").agg(
            F.min(F.struct("uid", "low")).alias("a"), F.max(F.struct("uid", "low")).alias("b")) \
            .filter("a <> b").select("string", "check")
        found = found.unionByName(strings.filter("kind = 3").join(twice, ["string", "check"])
                                  .select("uid", "low", (F.col("low") + LENGTH).alias("high")))
    found = stage(found.groupBy("uid").agg(F.collect_list(F.struct("low", "high")).alias("spans")),
                  "spans")
    drop(contexts)
    return marks.join(found, "uid", "full").select("uid", "codes", "spans")


def merged(size: int, codes: list[int] | None, spans: list[dict] | None) -> list[tuple[int, int]]:
    """Maximal covered runs of a text of ``size`` bytes."""
    pairs = [(max(0, (c >> 2) - SIDE), min(size, (c >> 2) + LENGTH))
             for c in codes or () if c & 3 != 3]
    pairs += [(s["low"], s["high"]) for s in spans or ()]
    out: list[tuple[int, int]] = []
    for low, high in sorted(pairs):
        if out and low <= out[-1][1]:
            if high > out[-1][1]:
                out[-1] = (out[-1][0], high)
        else:
            out.append((low, high))
    return out


def _rests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n, removed, runs, digests = [], [], [], []
        for text, codes, spans in zip(encoded(batch["text"]), batch["codes"].to_pylist(),
                                      batch["spans"].to_pylist()):
            cuts, at, digest = merged(len(text), codes, spans), 0, hashlib.sha256()
            for low, high in cuts:
                digest.update(text[at:low])
                at = high
            digest.update(text[at:])
            n.append(len(text))
            removed.append(sum(b - a for a, b in cuts))
            runs.append(len(cuts))
            digests.append(digest.hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch["row"], pa.array(n, pa.int64()), pa.array(removed, pa.int64()),
             pa.array(runs, pa.int64()), pa.array(digests, pa.string())],
            ["row", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for text, codes, spans in zip(encoded(batch["text"]), batch["codes"].to_pylist(),
                                      batch["spans"].to_pylist()):
            at, kept = 0, []
            for low, high in merged(len(text), codes, spans):
                kept.append(text[at:low])
                at = high
            kept.append(text[at:])
            # A cut may fall inside a character: its remaining bytes are dropped.
            out.append(b"".join(kept).decode("utf-8", "ignore"))
        cut = [t if v else None for t, v in zip(out, batch["text"].is_valid().to_pylist())]
        yield pa.RecordBatch.from_arrays([batch["row"], pa.array(cut, pa.string())],
                                         ["row", "text"])


def _joined(docs: DataFrame, carry: list[str]) -> DataFrame:
    """Every row: struct ``row`` of the columns ``carry``, ``text`` and what covers it.

    Rows get a number of their own, so null and repeated ids are documents like any other;
    numbers are written down, because Spark would number anew when a stage is repeated.
    """
    slim = docs.select(*carry)
    rows = stage(docs.select(F.monotonically_increasing_id().alias("uid"),
                             packed(slim).alias("row"), docs["text"].alias("text")), "documents")
    return rows.join(removed_spans(rows), "uid", "left").select("row", "text", "codes", "spans")


def dedup(docs: DataFrame) -> DataFrame:
    """Digest per document of what stays when repeated strings of LENGTH bytes are removed.

    A null text is empty; texts shorter than LENGTH bytes keep everything. Equal rows repeat each
    other. Strings are judged on the input: of all occurrences none stays.
    """
    out = _joined(docs, ["doc_id"])
    kind = out.schema["row"].dataType.simpleString()
    out = out.mapInArrow(_rests, f"row {kind}, n_bytes long, n_removed long, n_spans long, "
                                 "kept_sha256 string")
    return unpacked(out, "row", ["doc_id"],
                    *[F.col(c) for c in ("n_bytes", "n_removed", "n_spans", "kept_sha256")])


def cut_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with the repeated strings cut out of ``text`` and ``n_chars``, where there is such
    a column, counted anew. A document that consists of repeats stays, with an empty text."""
    others = [c for c in docs.columns if c != "text"]
    out = _joined(docs, others)
    kind = out.schema["row"].dataType.simpleString()
    out = out.mapInArrow(_cut, f"row {kind}, text string")
    columns = [F.col("text") if c == "text" else F.length("text").cast(docs.schema[c].dataType)
               .alias(c) if c == "n_chars" else F.col("row").getField(c).alias(c)
               for c in docs.columns]
    return out.select(*columns)
