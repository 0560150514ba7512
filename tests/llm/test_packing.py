import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from docsync.llm import tokens
from docsync.llm.packing import (CapacityTree, best_configuration, best_fit_plan,
                                 configuration_plan, matrices, pack, placed)

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def encode():
    t = Tokenizer.from_file(PATH)
    return lambda text: np.array(t.encode(text or "", add_special_tokens=False).ids + [0], "<u4")


def test_pieces_and_places(docs, rows, encode):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in pack(docs, PATH).collect():
        by_doc[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for i, text in ((r[0], r[1]) for r in rows):
        ids = encode(text)
        assert sorted(by_doc[i]) == [
            (k, a, len(ids[a:a + 2048]), zlib.crc32(ids[a:a + 2048].tobytes()))
            for k, a in enumerate(range(0, len(ids), 2048))]
    for spots in by_sequence.values():
        at = 0
        for offset, length in sorted(spots):
            assert offset == at
            at += length
        assert at <= 2048
    total = sum(x for spots in by_sequence.values() for _, x in spots)
    assert len(by_sequence) <= -(-total // 2048) + 1


def test_odd_rows(odd_docs, no_docs):
    out = placed(odd_docs, PATH)
    assert out.count() >= odd_docs.count()
    assert set(out.select("row.*").columns) == set(odd_docs.columns) - {"text"}
    assert pack(no_docs, PATH).collect() == [] and matrices(no_docs, PATH).collect() == []


def test_matrices_give_back_every_document(docs, rows, encode):
    found = {}
    for r in matrices(docs, PATH, 256).collect():
        ids, places = np.frombuffer(r.ids, "<u2"), np.frombuffer(r.position_ids, "<u2")
        assert len(ids) == len(places) == 256 and r.cu_seqlens[-1] == r.n_tokens
        assert not ids[r.n_tokens:].any()
        for d, a, b in zip(r.doc_ids, r.cu_seqlens, r.cu_seqlens[1:]):
            found[d.doc_id, d.piece] = ids[a:b]
            assert list(places[a:b]) == list(range(b - a))
    for i, text in ((r[0], r[1]) for r in rows):
        own = [found[k] for k in sorted(k for k in found if k[0] == i)]
        assert (np.concatenate(own) == encode(text)).all()


def test_words_are_remembered_and_forgotten(monkeypatch, encode):
    monkeypatch.setattr(tokens, "SLOTS", 64)
    monkeypatch.setattr(tokens, "POOL", 500)
    monkeypatch.setattr(tokens, "PARTS", 50)
    t = tokens.WordTokens(PATH)
    rng = random.Random(1)
    odd = ["", " ", "\n\n", "a\tb\x0bc d e", "<|endoftext|> x<|startoftext|>y", "don't 12,345",
           "é ́x ΑΣ İ", "日本語 text", "x" * 3000, "\x1c\x1d a\x85b"]
    for _ in range(30):
        texts = [" ".join(f"k{rng.randrange(300)}" for _ in range(rng.randrange(40)))
                 for _ in range(5)] + [rng.choice(odd), *odd]
        ids, first = t.ids([x.encode() for x in texts])
        for i, x in enumerate(texts):
            assert list(ids[first[i]:first[i + 1]]) == list(encode(x)[:-1])


def test_easy_words(encode):
    """Words that skip the library's splitting have the same ids: every letter, pair and mark."""
    t = tokens.WordTokens(PATH)
    assert t.easy
    rng = random.Random(2)
    letters = [chr(c) for c in (*range(0x21, 0x7f), *range(0xc0, 0x100))]
    words = letters + [f"keit{c}en" for c in letters] + [f"{c}{c}A{c}" for c in letters] + [
        "".join(rng.choice(letters) for _ in range(rng.randrange(1, 12))) for _ in range(4000)]
    words += ["don't", "DON'T", "it's'll", "'re've", "x'd", "a1b22", "<|endoftext|>", "ß", "\x7f", "\xad"]
    assert [t._word(w) for w in words] == [list(encode(w)[:-1]) for w in words]


def sequences(plan):
    return sum(g.count for g in plan)


def content(plan):
    out = Counter()
    for g in plan:
        used = sum(length * k for length, k in g.content)
        assert used + g.free == 100 and g.free >= 0
        for length, k in g.content:
            out[length] += k * g.count
    return out


def one_by_one(counts, capacity):
    """Best-fit decreasing over a list of sequences."""
    room = []
    for length in sorted(Counter(counts).elements(), reverse=True):
        fit = [r for r in room if r >= length]
        if fit:
            room.remove(min(fit))
            room.append(min(fit) - length)
        else:
            room.append(capacity - length)
    return sorted(room)


@pytest.mark.parametrize("seed", range(6))
def test_plans(seed):
    rng = random.Random(seed)
    counts = {rng.randrange(1, 100): rng.randrange(1, 40) for _ in range(rng.randrange(1, 40))}
    fit, lp = best_fit_plan(counts, 100), configuration_plan(counts, 100)
    assert content(fit) == content(lp) == Counter(counts)
    assert sorted(r for g in fit for r in [g.free] * g.count) == one_by_one(counts, 100)
    assert sequences(lp) <= sequences(fit) + 1
    assert configuration_plan({}, 100) == []


def test_knapsack():
    value = np.zeros(11)
    value[[3, 4, 5]] = 3.0, 4.5, 5.0
    assert best_configuration(value, 10) == {3: 2, 4: 1}


def test_capacity_tree():
    tree = CapacityTree(100)
    assert tree.least(1) is None
    for free in (7, 40, 100):
        tree.set(free, True)
    assert [tree.least(x) for x in (1, 7, 8, 41, 100)] == [7, 7, 40, 100, 100]
    tree.set(7, False)
    assert tree.least(1) == 40


def test_wide_ids_are_kept_or_refused():
    import pyarrow as pa

    from docsync.llm.packing import _rows
    part = [{"offset": 0, "length": 2, "ids": np.array([70000, 5], "<u4").tobytes()},
            {"offset": 2, "length": 1, "ids": np.array([9], "<u2").tobytes()}]
    batch = pa.RecordBatch.from_arrays(
        [pa.array([1]), pa.array([part]), pa.array([[{"doc_id": 1, "piece": 0}]])],
        ["sequence_id", "parts", "doc_ids"])
    row = next(_rows(4, "<u4")(iter([batch]))).to_pylist()[0]
    assert np.frombuffer(row["ids"], "<u4").tolist() == [70000, 5, 9, 0] and row["n_tokens"] == 3
    with pytest.raises(ValueError, match="70000"):
        list(_rows(4)(iter([batch])))
    far = {"offset": 0, "length": 70001, "ids": bytes(2 * 70001)}
    batch = pa.RecordBatch.from_arrays(
        [pa.array([1]), pa.array([[far]]), pa.array([[{"doc_id": 1, "piece": 0}]])],
        ["sequence_id", "parts", "doc_ids"])
    row = next(_rows(70001)(iter([batch]))).to_pylist()[0]
    assert np.frombuffer(row["position_ids"], "<u4")[-1] == 70000


def test_words_of_one_pattern_have_their_own_ids():
    """Swapped twins of 1024 letters meet under a hash that is a polynomial modulo 2 ** 64."""
    from docsync.llm.queries import tokenizer
    from docsync.llm.tokens import WordTokens
    words = ["".join(b if bin(i).count("1") % 2 else a for i in range(1024))
             for a, b in (("a", "b"), ("b", "a"))]
    tokens = WordTokens(tokenizer())
    flat, bounds = tokens.ids([w.encode() for w in words])
    for i, w in enumerate(words):
        assert flat[bounds[i]:bounds[i + 1]].tolist() == \
            tokens.tokenizer.encode(w, add_special_tokens=False).ids
