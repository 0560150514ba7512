import random
import re
import zlib
from collections import Counter

import pytest

from docsync.llm import variants as v


def by_hand(rows):
    """Every pair of words, by the definition of one edit."""
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                i = h % len(run)
                run = run[:i] + run[i + 1:]
            n[run] += 1
    n = {w: k for w, k in n.items() if len(w) >= 5 and k >= 3}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        if len(a) > len(b):
            a, b = b, a
        return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))
    out, form = [], {}
    for w in n:
        others = sorted((-n[x], x) for x in n if near(w, x))
        form[w] = others[0][1] if others and -others[0][0] >= 2 * n[w] else None
        out.append([w, form[w], w, n[w], len(others), n.get(form[w])])
    for row in out:
        while form[row[2]]:
            row[2] = form[row[2]]
    return sorted(map(tuple, out))


def some_rows(seed, many=40):
    rng = random.Random(seed)
    stems = ["".join(rng.choice("abé") for _ in range(rng.randrange(5, 9))) for _ in range(60)]
    stems += ["aaaaa" + "b" * k for k in range(6)] + ["x" * 300 + c for c in "abcd"] + ["x" * 299]
    rows = []
    for i in range(many):
        words = []
        for _ in range(80):
            w = rng.choice(stems[:20] if rng.random() < .5 else stems)
            if rng.random() < .3:
                j = rng.randrange(len(w))
                w = rng.choice([w[:j] + w[j + 1:], w[:j] + rng.choice("abéÿ") + w[j:],
                                w[:j] + rng.choice("abÉ") + w[j + 1:]])
            words.append(w.upper() if rng.random() < .1 else w)
        rows.append((i, rng.choice([" ", ", ", "1", "×"]).join(words)))
    return rows + [(None, rows[0][1]), (5, None), (6, "")]


@pytest.mark.parametrize("limit", [None, 7])
def test_against_all_pairs(spark, monkeypatch, limit):
    if limit:  # many ranges, and more queries of a range than scan it at once
        monkeypatch.setattr(v, "RANGE", 40)
        monkeypatch.setattr(v, "QUERIES", limit)
        monkeypatch.setattr(v, "HELD", 50)
    rows = some_rows(1)
    frame = spark.createDataFrame([(*r, "n", 1) for r in rows],
                                  "doc_id long, text string, word string, part int").repartition(3)
    found = sorted(map(tuple, v.variants(frame).collect()))
    assert len(found) > 100 and any(r[1] and r[1] != r[2] for r in found)
    assert found == by_hand(rows)


def test_odd_documents(odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert sorted(map(tuple, v.variants(odd_docs).collect())) == by_hand(rows)
    assert v.variants(no_docs).collect() == []


def test_scan_of_random_lists():
    rng = random.Random(2)
    for few, depth in ((8, 64), (1, 1), (0, 0)):
        for _ in range(30):
            words = sorted({bytes(rng.choice(b"ab") for _ in range(rng.randrange(5, 9)))
                            for _ in range(40)})
            queries = words[::2] + [b"aaaaaaab", b"bbbbb"]
            halves = [len(q) // 2 for q in queries]
            v.FEW, v.DEPTH = few, depth
            found = sorted(v.scan(words, queries, halves))
            assert found == sorted(
                (i, j) for i, q in enumerate(queries) for j, w in enumerate(words)
                if v.one_edit(q, w) and q[:halves[i]] == w[:halves[i]])
    v.FEW, v.DEPTH = 8, 64


def test_skips_ranges_and_keeps_rows(monkeypatch):
    """A list of words that share a prefix with nobody costs one row, not one per word."""
    steps = []
    real = v.next_rows
    monkeypatch.setattr(v, "next_rows", lambda *a: steps.append(1) or real(*a))
    words = sorted([b"zz" + bytes(rng) + b"tail" for rng in __import__("itertools").product(b"abc", repeat=6)])
    assert list(v.scan(words, [b"hello"], [2])) == []
    assert len(steps) == 1
    steps.clear()
    words = [b"prefixa" + bytes([c]) for c in b"abcdefgh"]
    assert len(list(v.scan(words, [b"prefixaa"], [4]))) == 7
    assert len(steps) == 7 + 8  # the shared prefix once, then a row for each word


def test_a_very_long_word_needs_few_rows():
    word = b"x" * 200_000
    others = [word + b"a", word[:-1], word[:100] + b"y" + word[101:]]
    words = sorted([word, *others])
    found = {words[j] for _, j in v.scan(words, [word], [100])}
    assert found == set(others)
