import re
from collections import Counter, defaultdict

import pytest

from docsync.llm import mixing
from docsync.llm.mixing import mix, take

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def targets(sizes):
    """By rounds: share what is left by weight among the sources that are not full."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    left, open_, out = 1.5 * sum(sizes.values()), set(order), {}
    while open_:
        total = sum(weight[s] for s in open_)
        full = {s for s in open_ if left * weight[s] / total >= 2 * sizes[s]}
        if not full:
            return out | {s: left * weight[s] / total for s in open_}
        for s in full:
            out[s] = 2.0 * sizes[s]
        left -= sum(out[s] for s in full)
        open_ -= full
    return out


def check(frame, rows):
    size = {r[0]: len(WORD.findall(r[1] or "")) for r in rows}
    source = {r[0]: r[3] for r in rows}
    sizes, largest = defaultdict(int), defaultdict(int)
    for i, s in source.items():
        sizes[s] += size[i]
        largest[s] = max(largest[s], size[i])
    want, taken = targets(sizes), Counter()
    for r in frame.collect():
        s = source[r.doc_id]
        assert r.size == size[r.doc_id] and r.source_size == sizes[s]
        assert abs(r.target - want[s]) < 1e-6 * max(1, want[s])
        assert r.taken in (0, r.size, 2 * r.size)
        taken[s] += r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest[s] + 1e-6
    return taken


def test_against_rounds(docs, rows):
    check(mix(docs), rows)


@pytest.mark.parametrize("block", [3, 16])
def test_deep_trees(spark, monkeypatch, block):
    monkeypatch.setattr(mixing, "BLOCK", block)
    rows = [(i, "w " * (1 + i % 17), "en", "abcd"[i % 4 if i % 5 else 0]) for i in range(900)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    check(mix(frame), rows)


def test_reruns_and_partitions_agree(docs):
    one = sorted(map(tuple, mix(docs).collect()))
    assert one == sorted(map(tuple, mix(docs.repartition(3)).collect()))


def test_probabilities_are_kept(spark):
    """Over seeds, each document is taken about as often as its fraction says."""
    rows = [(i, "w " * (5 + 3 * (i % 4)), "b" if i < 40 else "a") for i in range(60)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string").cache()
    share, mean = Counter(), 0.0
    for seed in range(12):
        out = mixing.mixed(frame, ["doc_id"], seed).filter("source_size > 0").collect()
        for r in out:
            if r.row.doc_id < 40:
                share[r.row.doc_id] += r.copies
                mean = r.target / r.source_size
    assert abs(sum(share.values()) / 40 / 12 - mean) < 0.15


def test_take_repeats_rows(docs, odd_docs, no_docs):
    copies = {r.row.doc_id: r.copies for r in mixing.mixed(docs).collect()}
    got = Counter(r.doc_id for r in take(docs).collect())
    assert got == Counter({i: c for i, c in copies.items() if c})
    assert take(docs).columns == docs.columns
    assert mix(odd_docs).count() == odd_docs.count()
    assert mix(no_docs).collect() == [] and take(no_docs).collect() == []


def test_no_python_in_the_plan(docs, plan):
    assert "Python" not in plan(mix(docs)) and "Arrow" not in plan(mix(docs))
