import re
from collections import Counter

from docsync.llm.quality import host_rates, judged, keep_good, quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def expected(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    counts = Counter(windows)
    covered = {j for i, w in enumerate(windows) if counts[w] > 1 for j in (i, i + 1, i + 2)}
    lines = [s for s in text.split("\n") if WORD.search(s)]
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), len(covered), failed)


def test_measures(docs, rows):
    found = {r.doc_id: tuple(r)[1:7] for r in quality(docs).collect()}
    assert found == {r[0]: expected(r[1]) for r in rows}


def test_a_bad_host_goes_and_a_null_host_stays(spark):
    good, bad = " ".join(f"w{i}" for i in range(80)), "bad"
    rows = ([(i, good, f"h{i % 5}") for i in range(50)] + [(100 + i, bad, "spam") for i in range(30)]
            + [(200, good, "spam"), (201, good, None), (202, bad, None)])
    out = {r.doc_id: r.kept for r in quality(
        spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert sorted(i for i, kept in out.items() if kept) == [*range(50), 201]


def test_rates_shrink_to_the_prior(spark):
    rows = [("a", i < 1) for i in range(2)] + [("b", i < 10) for i in range(100)] + [(None, True)]
    out = {r.host: r for r in host_rates(spark.createDataFrame(
        rows, "host string, failed boolean"), "host", "failed").collect()}
    mean, var = 0.3, 0.08
    strength = max(1, mean * (1 - mean) / var - 1)
    assert set(out) == {"a", "b"}
    for host, n, f in (("a", 2, 1), ("b", 100, 10)):
        assert abs(out[host].rate - (f + mean * strength) / (n + strength)) < 1e-9


def test_odd_rows_and_columns(odd_docs, no_docs):
    assert quality(odd_docs).count() == odd_docs.count()
    kept = keep_good(odd_docs)
    assert kept.columns == odd_docs.columns
    assert kept.count() == judged(odd_docs).filter("kept").count()
    assert quality(no_docs).collect() == [] and keep_good(no_docs).collect() == []


def test_no_python_in_the_plan(docs, plan):
    assert "Python" not in plan(quality(docs)) and "Arrow" not in plan(quality(docs))


def test_symbols_repeated_lines_and_their_hosts_go(spark):
    good = "\n".join(" ".join(f"w{10 * k + i}" for i in range(10)) for k in range(10))
    cases = {"clean": good, "few": good + " #" * 10, "symbols": good + " w" + "#" * 11,
             "lines": good + "\nw0 again x" * 6, "few lines": good + "\nw0 again x" * 3}
    rows = [(n, t, "mixed") for n, t in cases.items()] + [(f"m{i}", good, "mixed") for i in range(40)]
    rows += [(f"a{i}", good, "a") for i in range(40)] + [("null", good + " #####" * 9, None)]
    rows += [(f"b{i}", good + (" $$$" * 20 if i % 5 else ""), "b") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id string, text string, source string")
    kept = {r.doc_id for r in keep_good(docs).collect()}
    assert kept == {"clean", "few", "few lines", *(f"{h}{i}" for h in "ma" for i in range(40))}
    # The contract of op8 stays the base rules' verdict.
    assert quality(docs).filter("base_failed or not kept").count() == 0
