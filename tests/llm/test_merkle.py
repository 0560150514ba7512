import hashlib
import zlib

import pytest

from docsync.llm import merkle
from docsync.llm.merkle import Parent, manifest, tampered_text


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(doc_id, source, lang, n_chars, text):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}"
               for v in (doc_id, source, lang, n_chars, text)])


def by_hand(rows):
    """(doc_id, leaf, subroot, root, proof, folded root, verified) of (doc_id, text, lang, source,
    n_chars): trees as nested lists, every fold from scratch."""
    def grow(nodes):
        levels = [nodes]
        while len(levels[-1]) > 1:
            last = levels[-1]
            levels.append([h(*last[i:i + 16]) for i in range(0, len(last), 16)])
        return levels

    def climb(levels, i, now, proof):
        for nodes in levels[:-1]:
            run = nodes[i // 16 * 16:i // 16 * 16 + 16]
            at = i % 16
            proof += run[:at] + run[at + 1:]
            now = h(*run[:at], now, *run[at + 1:])
            i //= 16
        return now
    trees, out = {}, []
    for r in rows:
        trees.setdefault(r[3], []).append((r[0], leaf(r[0], r[3], r[2], r[4], r[1]), r))
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    for s in order:
        trees[s].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    grown = {s: grow([x[1] for x in trees[s]]) for s in order}
    top = grow([grown[s][-1][0] for s in order]) if order else None
    for k, s in enumerate(order):
        for i, (doc_id, own, r) in enumerate(trees[s]):
            text = r[1]
            if text is not None and doc_id is not None and not zlib.crc32(str(doc_id).encode()) % 5:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            proof = []
            now = climb(grown[s], i, leaf(doc_id, s, r[2], r[4], text), proof)
            now = climb(top, k, now, proof)
            root = top[-1][0]
            out.append((doc_id, own, grown[s][-1][0], root, h(*proof), now, now == root))
    return out


def found(frame):
    return sorted(map(repr, map(tuple, manifest(frame, tampered_text()).collect())))


def expected(frame):
    rows = [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in frame.collect()]
    return sorted(map(repr, by_hand(rows)))


def test_against_nested_lists(docs):
    assert found(docs) == expected(docs)


def test_null_ids_and_repeated_rows(odd_docs, no_docs):
    assert found(odd_docs) == expected(odd_docs)
    assert manifest(no_docs, tampered_text()).collect() == []


@pytest.mark.parametrize("n", [1, 2, 16, 17, 256, 257, 300])
def test_one_source(spark, n):
    frame = spark.createDataFrame([(i, f"Text {i}", "en", "s", i) for i in range(n)],
                                  "doc_id long, text string, lang string, source string, n_chars long")
    assert found(frame) == expected(frame)


def test_several_tiers_and_many_sources(spark):
    """Sources of every size around the borders of runs and blocks, more of them than a block has."""
    sizes = [1, 15, 16, 17, 255, 256, 257, 4096, 4097, 4113] + [1] * 280
    rows, i = [], 0
    for k, size in enumerate(sizes):
        for _ in range(size):
            rows.append((i * 7, f"T{i}", None if i % 3 else "en", f"é{k}" if k else None, i))
            i += 1
    frame = spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(6)
    assert found(frame) == expected(frame)


def test_fold_resumes_the_state_of_the_slot(monkeypatch):
    children = [h(str(i)).encode() for i in range(16)]
    parent = Parent(children)
    seen = []

    class Watched:
        def __init__(self, state):
            self.state = state

        def copy(self):
            return Watched(self.state.copy())

        def update(self, part):
            seen.append(part)
            self.state.update(part)

        def hexdigest(self):
            return self.state.hexdigest()
    parent.states = [Watched(s) for s in parent.states]
    for slot in range(16):
        seen.clear()
        new = h("new").encode()
        changed = children[:slot] + [new] + children[slot + 1:]
        assert parent.folded(slot, new) == Parent(changed).digest
        assert seen == [new] + children[slot + 1:]
    assert merkle.Parent(children).digest == parent.digest


def test_without_tampering_everything_verifies(docs):
    assert all(r.verified for r in manifest(docs).collect())
