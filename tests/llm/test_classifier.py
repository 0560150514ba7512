import random
import zlib

import pytest

from docsync.llm import classifier
from docsync.llm.classifier import held_out, scored


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(4)

    def text(good):
        words = ["river", "stone", "green", "window", "quiet"] if good else \
            ["BUY!!", "CLICK##", "win$$$", "FREE!!", "now%%"]
        return " ".join(rng.choice(words) + str(rng.randrange(30)) for _ in range(30))
    rows = [(i, text(i % 2), i % 2) for i in range(400)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y, 0) for i, _, y in rows],
                                   "doc_id long, quality int, toxic int")
    return docs, labels, {i: y for i, _, y in rows}


def test_held_out_accuracy(labelled):
    docs, labels, truth = labelled
    out = scored(docs, labels).collect()
    test = [r for r in out if r.held_out]
    assert {r.doc_id for r in test} == {i for i in truth if zlib.crc32(str(i).encode()) % 4 == 2}
    assert sum(r.predicted == truth[r.doc_id] for r in test) >= 0.97 * len(test)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in out)


def test_held_out_labels_are_not_learned(labelled, spark):
    docs, labels, _ = labelled
    turned = labels.selectExpr("doc_id", "CASE WHEN crc32(encode(string(doc_id), 'utf-8')) % 4 = 2 "
                               "THEN 1 - quality ELSE quality END AS quality")
    assert sorted(scored(docs, labels).collect()) == sorted(scored(docs, turned).collect())


def test_bound_of_the_sample(labelled, monkeypatch):
    docs, labels, _ = labelled
    seen = []
    monkeypatch.setattr(classifier, "train", lambda bags: seen.append(len(bags)) or
                        classifier.np.zeros(1 << classifier.BITS, "f4"))
    classifier.fit(docs, labels, 50)
    assert seen == [50]


def test_odd_rows(odd_docs, no_docs, labelled, spark):
    _, labels, _ = labelled
    out = scored(odd_docs, labels).collect()
    assert len(out) == odd_docs.count()
    assert not any(r.held_out for r in out if r.doc_id is None)
    texts = {}
    for r in out:
        texts.setdefault(r.doc_id, set()).add(r.score)
    assert all(len(s) == 1 for i, s in texts.items() if i is not None)
    assert scored(no_docs, labels).collect() == []
    none = labels.limit(0)
    assert {r.score for r in scored(odd_docs, none).collect()} == {0.5}
    awkward = spark.createDataFrame([(1, None, 0), (None, 1, 0), (5, 1, 1), (5, 0, 0)],
                                    "doc_id long, quality int, toxic int")
    assert len(scored(odd_docs, awkward).collect()) == len(out)
    assert held_out is not None
