import random
import re

import numpy as np
import pytest

from docsync.llm import jaccard
from docsync.llm.components import components
from docsync.llm.jaccard import guaranteed, one_per_group, prefixes, similar, window_size


def sets(rows):
    out = {}
    for i, text in rows:
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        w = re.findall(r"[^\x20\x09-\x0D]+", text)
        out[i] = {tuple(w[j:j + 5]) for j in range(max(1, len(w) - 4))} if w else set()
    return out


def roots(ids, links):
    parent = {i: i for i in ids}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a
    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def expected(rows):
    s = sets(rows)
    ids = sorted(s)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1:]
             if s[a] and s[b] and 100 * len(s[a] & s[b]) >= 75 * len(s[a] | s[b])]
    return {i: (len(s[i]), r) for i, r in roots(ids, links).items()}


def found(frame):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in similar(frame).collect()}


def test_against_all_pairs(docs, rows):
    assert found(docs) == expected([r[:2] for r in rows])


@pytest.mark.parametrize("seed,words,vocabulary", [(1, 40, 8), (2, 300, 50), (3, 12, 3)])
def test_random_edits(spark, monkeypatch, seed, words, vocabulary):
    """Families around the threshold, larger and smaller than the sets that are sent whole."""
    monkeypatch.setattr(jaccard, "FREQUENT", 20)
    rng = random.Random(seed)
    texts = []
    for _ in range(12):
        base = [f"v{rng.randrange(vocabulary)}" for _ in range(words)]
        for _ in range(8):
            w = list(base)
            for _ in range(rng.randrange(1 + words // 25)):
                w[rng.randrange(len(w))] = f"v{rng.randrange(vocabulary * 9)}"
            cut = rng.randrange(1 + words // 4)
            texts.append(" ".join(w[cut:] if rng.random() < .5 else w[:len(w) - cut]))
    rows = list(enumerate(texts))
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert found(frame) == expected(rows)


def test_odd_rows(odd_docs, docs, no_docs):
    out = similar(odd_docs).collect()
    assert len(out) == odd_docs.count()
    assert all(r.component_id is None for r in out if r.doc_id is None)
    with_id = {r.doc_id: (r.n_shingles, r.component_id) for r in out if r.doc_id is not None}
    assert with_id == found(docs)
    assert similar(no_docs).collect() == [] and one_per_group(no_docs).collect() == []


def test_one_of_each_group_stays(odd_docs, docs):
    kept = one_per_group(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = sorted(r.doc_id for r in kept.collect() if r.doc_id is not None)
    assert ids == sorted({c for _, c in found(docs).values()})
    assert kept.filter("doc_id is null").count() == 2


def test_rows_of_one_id_go_only_by_their_own_text(spark):
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(40)) for x in "abcd")
    rows = [(1, a, "x"), (2, b, "x"), (2, a, "y"), (3, c, "x"), (3, d, "y"), (None, d, "z"),
            (None, "e " + b, "z"), (None, "only null ids " * 9, "x"), (None, "only null ids " * 9, "y")]
    out = one_per_group(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    kept = [tuple(r) for r in out.repartition(2).collect()]
    assert sorted(r for r in kept if r[0]) == [rows[0], rows[1], rows[3], rows[4]]
    assert [r[:2] for r in kept if not r[0]] == [(None, "only null ids " * 9)]


def test_bounds_hold_for_all_sizes():
    n = np.arange(1, 3000)
    w, sure = window_size(n), guaranteed(n)
    assert (sure >= 1).all() and (sure <= w).all() and (np.diff(w) >= 0).all()
    for a in range(1, 700, 7):  # the j-th shared hash has at most rank n - shared + j
        for b in range(a, (4 * a) // 3 + 1, 5):
            shared = -(-3 * (a + b) // 7)
            both = min(w[a - 1] - (a - shared), w[b - 1] - (b - shared))
            assert both >= max(sure[a - 1], sure[b - 1])


def test_longer_prefixes_ask_for_more_matches():
    n = 80
    h = np.arange(n)
    df = np.full(n, 2)
    _, least, place, m = prefixes(n, df, h)
    assert list(least[:len(least) - 3]) == [1] * (len(least) - 3) and list(least[-3:]) == [2, 3, 4]
    assert list(place) == list(range(1, len(place) + 1)) and m > 1
    df[:len(least) - 3] = 1000  # costly postings anyway: more matches pay even more
    assert prefixes(n, df, h)[3] >= 1
    assert prefixes(n, df[:2], h[:2]) is None  # 78 hashes of its own: no partner is possible


def test_components(spark):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(200, 260)] \
        + [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(60)]
    out = {r.id: r.component for r in components(
        spark.createDataFrame(links, "a long, b long")).collect()}
    ids = {x for e in links if e[0] != e[1] for x in e}
    assert out == {i: r for i, r in roots(ids, links).items()}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def thue_morse(a, b, n):
    return "".join(b if bin(i).count("1") % 2 else a for i in range(n))


def test_words_of_one_pattern_are_different_words(spark):
    """Swapped twins meet under any hash that is a polynomial modulo 2 ** 64."""
    one, two = thue_morse("a", "b", 1024), thue_morse("b", "a", 1024)
    rows = [(1, one), (2, two), (3, one.upper()), (4, f"{one} {two} x y z"), (5, f"{two} {one} x y z")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(frame) == expected(rows) == {1: (1, 1), 2: (1, 2), 3: (1, 1), 4: (1, 4), 5: (1, 5)}


def test_word_keys():
    from docsync.llm.common import told_words
    rng = random.Random(4)
    words = list({"".join(rng.choice("abé") for _ in range(rng.randrange(1, 90))) for _ in range(3000)})
    keys, first = told_words([" ".join(words).encode(), b"", b" A\tb ", b"a B"])
    assert len(set(keys[:len(words)].tolist())) == len(words) == first[1]
    assert keys[-4:].tolist() == [keys[-4], keys[-3]] * 2
    assert len(told_words([b"\0", b"\0\0", b"a\0", b"a"])[0]) == 4 == len(
        set(told_words([b"\0", b"\0\0", b"a\0", b"a"])[0].tolist()))


def test_passages_that_many_share_make_no_pairs(spark, monkeypatch):
    """Documents that consist of a common passage and as much of their own meet nowhere; the pairs
    that are tested grow with the links, not with the square of the group."""
    rng = random.Random(9)

    def some(n):
        return [f"w{rng.randrange(10**6)}" for _ in range(n)]
    passage, tested = some(400), []
    monkeypatch.setattr(jaccard, "_links", lambda pairs, sets, real=jaccard._links:
                        tested.append(pairs.count()) or real(pairs, sets))
    rows = [(i, " ".join(passage + some(260 + i % 40))) for i in range(60)]
    near = passage + some(100)
    rows += [(100 + i, " ".join(near[i:] + some(2))) for i in range(4)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert found(frame) == expected(rows)
    assert tested[1] <= 60


def test_whole_prefixes_keep_every_link(spark):
    """Random sets around the threshold, all pairs: a pair that links is among those that meet."""
    rng = np.random.default_rng(5)
    sets_ = []
    for _ in range(12):
        base = rng.integers(0, 400, rng.integers(5, 90))
        for _ in range(6):
            keep = base[rng.random(len(base)) < rng.uniform(.85, 1)]
            sets_.append(np.unique(np.concatenate((keep, rng.integers(0, 3000, rng.integers(0, 9))))))
    rows = [(i, bytearray(s.astype("<u8").tobytes()), i) for i, s in enumerate(sets_) if len(s)]
    pairs = {tuple(r) for r in jaccard.across(
        spark.createDataFrame(rows, "sid long, items binary, part long")).collect()}
    links = {(i, j) for i, a in enumerate(sets_) for j, b in enumerate(sets_) if i < j and len(a) and len(b)
             and 100 * len(np.intersect1d(a, b)) >= 75 * len(np.union1d(a, b))}
    assert links and links <= pairs and len(pairs) < 20 * len(links)


def test_near_copies_that_do_not_link_hardly_meet(spark):
    """A large group of copies with a fifth of other hashes: the join makes no rows for its pairs, but
    those for the few links."""
    rng = np.random.default_rng(8)

    def some(n):
        return rng.integers(-2**63, 2**63 - 1, n)
    base = some(200)
    sets_ = [np.concatenate((rng.permutation(base)[:160], some(40))) for _ in range(80)]
    sets_ += [np.concatenate((s[3:], some(3))) for s in sets_[:6]]
    rows = [(i, bytearray(np.sort(s.view(np.uint64)).tobytes()), i) for i, s in enumerate(sets_)]
    frame = spark.createDataFrame(rows, "sid long, items binary, part long")
    links = {(i, 80 + i) for i in range(6)}
    met = [tuple(r) for r in jaccard.meetings(frame).select("s", "t").collect()]
    assert links <= {tuple(sorted(m)) for m in met} and len(set(met)) < 2 * len(sets_)
    assert links <= {tuple(r) for r in jaccard.across(frame).collect()}


def test_sketches_differ_no_more_than_their_sets():
    rng = np.random.default_rng(4)
    for n in (1, 30, 700, 20000):
        a, b = (rng.integers(-2**63, 2**63 - 1, n) for _ in range(2))
        b[:n // 2] = a[:n // 2]
        differ = sum(((x ^ y) & (2**64 - 1)).bit_count()
                     for x, y in zip(jaccard.sketch(a), jaccard.sketch(b)))
        assert differ <= len(np.setxor1d(a, b)) and jaccard.sketch(a) == jaccard.sketch(rng.permutation(a))


def test_a_costly_prefix_asks_for_any_number_of_matches():
    df = np.concatenate((np.full(60, 3), np.full(40, 50000)))
    assert jaccard.whole_prefix(100, df, np.arange(100))[1] > 4
    order, m, cost = jaccard.whole_prefix(100, np.array([9, 2]), np.array([1, 2]))
    assert order.tolist() == [2, 1] and m == 2 and cost == 0
    assert jaccard.whole_prefix(1, np.array([5]), np.array([7]))[1] == 1
