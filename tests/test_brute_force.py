"""Random small inputs against plain Python."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docsync.operators import concat
from docsync.operators import enrich as en
from docsync.operators import ids
from docsync.operators import relational as rel

FEW = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
VALUES = st.one_of(st.none(), st.sampled_from(["x", "y", "", "ä b"]))
EXT = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 4)), st.sampled_from("aAbBc"), VALUES,
                         st.integers(0, 3)), max_size=40)


def by_parent(ext):
    groups = {}
    for parent, key, value, seq in ext:
        if parent is not None:
            # nulls sort first
            groups.setdefault(parent, []).append((seq, key.lower(), value is not None, value or ""))
    return {p: [(k, v if has else None) for _, k, has, v in sorted(items)]
            for p, items in groups.items()}


@FEW
@given(EXT, st.sampled_from([0, 3, 10**6]))
def test_custom_fields(spark, monkeypatch, ext, hot_rows):
    monkeypatch.setattr(concat, "HOT_ROWS", hot_rows)
    rows = spark.createDataFrame(ext, "p int, k string, v string, n int").repartition(3)
    docs = spark.range(6).select(F.col("id").cast("string").alias("doc_id"), "id")
    expected = by_parent(ext)
    one = {r.id: r.custom_fields for r in en.custom_in_one(docs, rows, "id", ("n",)).collect()}
    assert one == {i: "".join(f"{k} {'null' if v is None else v} " for k, v in expected[i])
                   if i in expected else None for i in range(6)}
    last = {i: dict(expected[i]) if i in expected else None for i in range(6)}
    opened = {r.id: r.custom for r in en.flatten(docs, rows, "id", None, ("n",)).collect()}
    assert opened == last
    wide = en.flatten(docs, rows, "id", ("a", "b", "c"), ("n",)).collect()
    assert {r.id: (r.a, r.b, r.c) for r in wide} == {
        i: tuple((d or {}).get(k) for k in "abc") for i, d in last.items()}


@FEW
@given(st.lists(st.tuples(st.one_of(st.none(), st.sampled_from("abcd")), st.integers(0, 2),
                          st.sampled_from("xy")), max_size=40), st.sets(st.sampled_from("abcd")))
def test_outcomes(spark, batch, present):
    docs = spark.createDataFrame(batch, "doc_id string, n int, t string").repartition(3)
    existing = spark.createDataFrame([(i,) for i in present], "doc_id string")
    got = ids.outcomes(docs, existing, ("n",))
    first = {}
    for row in sorted(r for r in batch if r[0] is not None):
        first.setdefault(row[0], row)
    created = sorted(r for i, r in first.items() if i not in present)
    assert sorted(tuple(r) for r in got.created.collect()) == created
    assert got.rejected.count() == sum(r[0] is None for r in batch)
    refused = sorted(r for r in batch if r[0] is not None)
    for row in created:
        refused.remove(row)
    seen = [tuple(r)[:3] for r in got.conflicts.collect() for _ in range(r.refused)]
    assert sorted(seen) == refused
    counts = {r.outcome: r.n for r in ids.tally(docs, existing).collect()}
    assert counts.get("created", 0) == len(created)
    assert counts.get("conflict", 0) == len(refused)


@FEW
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 12), st.integers(0, 1),
                          st.integers(0, 9)), max_size=40), st.sampled_from([0, 10**6]))
def test_members(spark, monkeypatch, members, hot_rows):
    """Two objects share a team; one team has another class."""
    monkeypatch.setattr(concat, "HOT_ROWS", hot_rows)
    links = [(10, 0, 1000000), (11, 0, 1000000), (12, 1, 1000000), (12, 2, 1000000), (13, 3, 5)]
    objects = spark.createDataFrame(links, "object_id int, team_id int, class_id int")
    people = (spark.createDataFrame(members, "team_id int, user_id int, current_record int, d int")
              .withColumn("mod_date", F.expr("timestamp_seconds(d)")).repartition(3))
    lists, fanned, changed = {}, {}, set()
    for obj, team, kind in links:
        hits = sum(t == team and 2 < d < 6 for t, _, _, d in members)
        users = [u for t, u, c, _ in members if t == team and c == 1]
        if kind == 1000000 and users:
            lists.setdefault(obj, []).extend(users)
            if hits:
                fanned.setdefault(obj, []).extend(users * hits)
        if kind == 1000000 and hits:
            changed.add(obj)
    text = lambda groups: {o: ",".join(map(str, sorted(us))) for o, us in groups.items()}  # noqa
    lo, hi = "1970-01-01 00:00:02", "1970-01-01 00:00:06"
    assert {r[0]: r[1] for r in rel.member_lists(people, objects).collect()} == text(lists)
    repeated = rel.repeated_lists(people, objects, lo, hi, ("mod_date", None))
    assert {r[0]: r[1] for r in repeated.collect()} == text(fanned)
    parents = spark.range(10, 14).select(
        F.col("id").alias("pid"), F.timestamp_seconds(F.lit(0)).alias("create_date"),
        F.lit(None).cast("timestamp").alias("mod_date"))
    ids_ = rel.changed_parents(parents, "pid", people, objects, lo, hi,
                               member_times=("mod_date", None))
    assert {r.pid for r in ids_.collect()} == changed
