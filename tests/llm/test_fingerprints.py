import hashlib
import random

import numpy as np

from docsync.llm import fingerprints as fp
from docsync.llm.fingerprints import (Fingerprints, as_text, fingerprints, likeness, numbered,
                                      picked, signature)


def plain(text):
    """Signature without sharing anything, in the order of the definition."""
    raw = text.encode()
    if not raw:
        return np.zeros(0, np.uint32)
    grams, seen, out = numbered(raw), {}, []
    for i in range(len(grams)):  # equal k-mers differ by occurrence number, others do not
        k = raw[i:i + fp.K]
        seen.setdefault(k, []).append(int(grams[i]))
    assert all(len(set(v)) == len(v) for v in seen.values())
    for odd in fp._ODD[:, 0]:
        hashed = [(int(g * odd), i) for i, g in enumerate(grams)]
        places = sorted(i for _, i in sorted(hashed)[:fp.PICKED])
        total = np.zeros(1, np.uint64)
        for i in places:
            total = fp.mix64(total + grams[i])
        out.append(int(total[0] >> np.uint64(32)))
    return np.array(out, np.uint32)


def test_against_definition(docs, rows):
    found = {r.doc_id: r for r in fingerprints(docs).collect()}
    texts = {r[0]: r[1] or "" for r in rows}
    ids = sorted(texts)
    assert sorted(found) == ids
    for k, i in enumerate(ids):
        text, after, r = texts[i], texts[ids[(k + 1) % len(ids)]], found[i]
        quarter = len(text) // 4
        edited = text[:len(text) - quarter] + after[:quarter]
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        if len(text) < 5000:
            own, other, following = map(plain, (text, edited, after[:5000]))
            assert (r.fingerprint, r.edited_fingerprint) == (as_text(own), as_text(other))
            assert r.near_edited == likeness(own, other)
            if len(after) < 5000:
                assert r.near_next == likeness(own, following)


def test_order_counts():
    rng = random.Random(1)
    parts = ["".join(rng.choice("abcdefghij") for _ in range(40)) for _ in range(12)]
    text, turned = "".join(parts), "".join(parts[::-1])
    small = text[:200] + "#" + text[201:]
    own = [Fingerprints(t).own for t in (text, turned, small, text)]
    assert likeness(own[0], own[3]) == 1
    assert likeness(own[0], own[2]) > 0.8 > 0.7 > likeness(own[0], own[1])


def test_blocks_of_long_texts(monkeypatch):
    grams = numbered(("abc def ghi " * 900).encode())
    whole = signature(grams, picked(grams, 0, len(grams)))
    monkeypatch.setattr(fp, "BLOCK", 100)
    assert (signature(grams, picked(grams, 0, len(grams))) == whole).all()
    assert (signature(grams, picked(grams, 0, 77), picked(grams, 77, len(grams))) == whole).all()


def test_odd_rows(spark, odd_docs, no_docs):
    out = fingerprints(odd_docs).collect()
    assert len(out) == odd_docs.count()
    by_text = {}
    for r in odd_docs.select("doc_id", "text").collect():
        by_text.setdefault((r.doc_id, len(r.text or "")), 0)
    assert {(r.doc_id, r.n_chars) for r in out} == set(by_text)
    assert fingerprints(no_docs).collect() == []
    one = fingerprints(spark.createDataFrame([(5, "abcd" * 20)], "doc_id long, text string")).collect()
    assert one[0].near_next == 1.0
