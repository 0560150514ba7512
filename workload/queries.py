"""The registered queries.  Each reads its whole tables and returns a DataFrame."""

from __future__ import annotations

from datetime import timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docsync import Specs, SyncSpec, storage
from docsync.functions.times import second_date_time, strict_date_time, window_start
from docsync.operators import enrich as en
from docsync.operators import ids as doc_ids
from docsync.operators import reconcile as rec
from docsync.operators import relational as rel
from docsync.operators import target as targets
from docsync.operators.document import (apply_mapping, export_bulk, parse_analyzers,
                                        to_ndjson)
from docsync.operators.ids import DOC_ID, with_doc_id
from docsync.operators.state import latest_state
from docsync.plans import (Home, delete_once, documents, fix, init, repair_differences, repair_missing,
                           report_frame, run_all, sync_once, verify)
from docsync.sources import changed_between, extension_rows, full, window
from docsync.streaming import (LateRows, RunHistory, changed_parent_ids, distinct_feed, fold_history,
                               follow, follow_changes, follow_feed, readmit, run_summary, write_feed)
from workload.adapters import (LO, T0, T1, T2, T3, attr, event_eav, param, proj, table,
                               team_member, team_object)

EVENT_KEYS = ("click", "view", "purchase", "signup", "error")
LINE_KEYS = tuple(f"line_{i}" for i in range(1, 8))
LINE_ORDER = ("l_shipdate", "l_partkey", "l_suppkey")
DATES = {"create_date": {"type": "date", "format": "strict_date_time"},
         "mod_date": {"type": "date", "format": "strict_date_time"}}


def _dates_as_text(rows: DataFrame, *names) -> DataFrame:
    return rows.withColumns({n: strict_date_time(F.col(n)) for n in names})


def proj_spec(spark: SparkSession, sf: str, **more) -> SyncSpec:
    """Parents by SQL text with placeholders, as a user writes it."""
    proj(spark, sf).createOrReplaceTempView("proj")
    return SyncSpec(**({
        "name": "proj", "id_columns": "pid", "mapping": DATES, "time_type": "timestamp_ntz",
        "created_first": True,
        "init_sql": "SELECT * FROM proj WHERE coalesce(mod_date, create_date) < ?",
        "sync_sql": "SELECT * FROM proj WHERE coalesce(mod_date, create_date) > ? "
                    "AND coalesce(mod_date, create_date) < ?"} | more))


def _home(spark: SparkSession, label: str) -> Home:
    return Home(spark, storage.new_folder(spark, label))


# -- scans ---------------------------------------------------------------------------------------

def q01_full_scan_bound(spark, sf):
    return _dates_as_text(full(spark, proj_spec(spark, sf), T0), "create_date", "mod_date")


def q02_window_scan(spark, sf):
    return _dates_as_text(window(spark, proj_spec(spark, sf), LO, T1), "create_date", "mod_date")


def q28_pushed_window(spark, sf):
    """A window on stored columns, which the parquet scan evaluates."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey",
                                                "l_shipdate")
    return _dates_as_text(changed_between(lines, LO, T1, None, "l_shipdate"), "l_shipdate")


# -- documents -----------------------------------------------------------------------------------

def q03_doc_id_composite(spark, sf):
    return with_doc_id(table(spark, sf, "conversations"), ("conv_id", "turn")).select(
        DOC_ID, "conv_id", "turn", "role", "text")


def _lines(spark, sf):
    return with_doc_id(table(spark, sf, "lineitem"), ("l_orderkey", "l_linenumber")).select(
        DOC_ID, "l_partkey", "l_suppkey", "l_quantity", "l_shipdate")


def q04_create_if_absent(spark, sf):
    """Two loads into one target: first what shipped before T0, then everything."""
    target = targets.Target(spark, storage.new_folder(spark, "q04"), "lines")
    lines = _lines(spark, sf)
    early = changed_between(lines, None, T0, None, "l_shipdate")
    targets.create_if_absent(target, early, order=LINE_ORDER)
    targets.create_if_absent(target, lines, order=LINE_ORDER)
    return _dates_as_text(target.read(), "l_shipdate")


def q05_outcomes(spark, sf):
    return doc_ids.tally(_lines(spark, sf))


def q05_refused_rows(spark, sf):
    return _dates_as_text(doc_ids.outcomes(_lines(spark, sf), order=LINE_ORDER).conflicts,
                          "l_shipdate")


def q15_mapping(spark, sf):
    lists = rel.member_lists(team_member(spark, sf), team_object(spark, sf))
    docs = with_doc_id(proj(spark, sf).join(lists, F.col("pid") == F.col("object_id")), ("pid",))
    mapping = DATES | {"user_ids": {"type": "text", "analyzer": "comma"},
                       "pid": {"type": "text"}, "absent_field": {"type": "text"}}
    docs = apply_mapping(docs, mapping, analyzers={"comma": ","})
    return docs.select(DOC_ID, "pid", "create_date", "mod_date",
                       F.explode("user_ids").alias("token"))


def q16_bulk_export(spark, sf):
    """Bulk files of at most 12000 documents, read back line by line."""
    path = storage.new_folder(spark, "q16")
    docs = with_doc_id(table(spark, sf, "documents"), ("doc_id",))
    docs = docs.select(DOC_ID, F.col("lang"), F.col("n_chars"), F.col("text"))
    export_bulk(docs, "documents", path)
    return spark.read.text(path)


def q16_bulk_payload(spark, sf):
    docs = with_doc_id(table(spark, sf, "conversations"), ("conv_id", "turn"))
    return to_ndjson(docs, "conversations")


# -- custom fields -------------------------------------------------------------------------------

def _customers(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")


def q06_ext_flatten(spark, sf):
    return en.flatten(_customers(spark, sf), event_eav(spark, sf), "c_custkey", EVENT_KEYS,
                      ("ts", "event_id"), ("c_custkey",))


def q06_ext_flatten_open(spark, sf):
    """Keys not declared: one map per document, here one row per entry."""
    docs = en.flatten(_customers(spark, sf), event_eav(spark, sf), "c_custkey", None,
                      ("ts", "event_id"), ("c_custkey",))
    return docs.select("c_custkey", F.explode("custom").alias("key", "value"))


def q07_ext_custom_in_one(spark, sf):
    return en.custom_in_one(_customers(spark, sf), event_eav(spark, sf), "c_custkey",
                            ("ts", "event_id"))


def q08_ext_custom_in_one_repeat(spark, sf):
    return en.custom_in_one(_customers(spark, sf), event_eav(spark, sf), "c_custkey",
                            ("ts", "event_id"), repeat=3)


def q09_ext_typed_values(spark, sf):
    return rel.typed_attributes(attr(spark, sf), param(spark))


def q10_ext_batch_scan(spark, sf):
    event_eav(spark, sf).createOrReplaceTempView("event_eav")
    spec = proj_spec(spark, sf, extension_column="cust", ext_sql=(
        "SELECT user_id, event_type, value, event_id FROM event_eav WHERE user_id IN (?)"))
    batch = window(spark, spec, LO, T1)
    rows = extension_rows(spark, spec, en.extension_ids(batch, "cust"))
    return rows.select("event_id", "user_id", "event_type", "value")


def q26_all_in_one(spark, sf):
    docs = en.custom_in_one(table(spark, sf, "customer"), event_eav(spark, sf), "c_custkey",
                            ("ts", "event_id"))
    return en.all_in_one(docs).select("c_custkey", en.ALL_FIELDS)


def q29_protected_ids(spark, sf):
    """Custom fields called like the id column, per id column."""
    events = table(spark, sf, "events")
    ext = events.select("user_id", F.when(F.col("event_type") == "error", "C_CUSTKEY")
                        .otherwise(F.col("event_type")).alias("k"), "value")
    return en.protected_keys(_customers(spark, sf), ext, "c_custkey", ("c_custkey",))


# -- relational patterns -------------------------------------------------------------------------

def q11_member_list(spark, sf):
    return rel.member_lists(team_member(spark, sf), team_object(spark, sf))


def _full_documents(spark, sf, parents, lists):
    detail = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    joined = parents.join(detail, F.col("cust") == F.col("c_custkey")).join(
        lists, F.col("pid") == F.col("object_id"))
    return joined.select(
        "pid", "cust", "prio", second_date_time("mod_date").alias("mod_date"),
        second_date_time("create_date").alias("create_date"), F.col("c_name").alias("description"),
        F.col("c_mktsegment").alias("comments"), "user_ids")


def q12_full_document(spark, sf):
    parents = changed_between(proj(spark, sf), None, T2)
    return _full_documents(spark, sf, parents,
                           rel.member_lists(team_member(spark, sf), team_object(spark, sf)))


def _changed_documents(spark, sf, lo, hi):
    parents, members, teams = proj(spark, sf), team_member(spark, sf), team_object(spark, sf)
    ids = rel.changed_parents(parents, "pid", members, teams, lo, hi,
                              member_times=("mod_date", None))
    return _full_documents(spark, sf, parents.join(ids, "pid", "left_semi"),
                           rel.lists_for(ids, "pid", members, teams))


def q13_changed_union(spark, sf):
    return _changed_documents(spark, sf, LO, T1)


def q14_changed_union_fanout(spark, sf):
    """The union as two branches with repeated lists in the second."""
    parents, members, teams = proj(spark, sf), team_member(spark, sf), team_object(spark, sf)
    changed = changed_between(parents, LO, T1)
    own = _full_documents(spark, sf, changed, rel.lists_for(changed, "pid", members, teams))
    lists = rel.repeated_lists(members, teams, LO, T1, ("mod_date", None))
    by_member = _full_documents(spark, sf, parents, lists)
    return own.unionByName(by_member).distinct()


# -- targets and flows ---------------------------------------------------------------------------

def q17_recreate_target(spark, sf):
    target = targets.Target(spark, storage.new_folder(spark, "q17"), "customer")
    docs = with_doc_id(table(spark, sf, "customer"), ("c_custkey",))
    targets.recreate(target, docs.where(F.col("c_acctbal") > 0))
    targets.recreate(target, docs)
    return target.read().select(DOC_ID, "c_name", "c_nationkey", "c_mktsegment")


def q18_latest_state(spark, sf):
    """Events as a state log: users are targets, an error removes the state."""
    log = table(spark, sf, "events").select(
        F.concat(F.lit("index_"), F.col("user_id").cast("string")).alias("index_name"),
        F.col("ts").alias("last_refresh_time"), (F.col("event_type") == "error").alias("deleted"),
        F.col("event_id").alias("saved_at"))
    return _dates_as_text(latest_state(log), "last_refresh_time")


def _init_and_sync(spark, home, spec):
    return [init(spark, home, spec, T0), sync_once(spark, home, spec, T1),
            sync_once(spark, home, spec, T3)]


def q19_init_then_sync(spark, sf):
    home, spec = _home(spark, "q19"), proj_spec(spark, sf)
    _init_and_sync(spark, home, spec)
    return home.target("proj").read()


def q20_fix_by_key(spark, sf):
    home, spec = _home(spark, "q20"), proj_spec(spark, sf)
    for key in ("1", "7", "42"):
        fix(spark, home, spec, {"pid": key}, "2030-01-01")
    return home.target("proj").read()


def q20_fix_many_keys(spark, sf):
    """Keys as a table: every order with status P."""
    home, spec = _home(spark, "q20m"), proj_spec(spark, sf)
    keys = table(spark, sf, "orders").where("o_orderstatus = 'P'").select(
        F.col("o_orderkey").alias("pid"))
    fix(spark, home, spec, keys, T3)
    return home.target("proj").read()


def q21_run_report(spark, sf):
    home = _home(spark, "q21")
    specs = Specs([proj_spec(spark, sf), proj_spec(spark, sf, name="wide",
                                                   lookback=timedelta(days=30))])
    reports = [sync_once(spark, home, specs.get("proj"), T0)]
    for flow, now in ((init, T0), (sync_once, T1), (sync_once, T3)):
        reports += run_all(spark, home, specs, flow, now, parallel=2)
    frame = report_frame(spark, reports)
    return frame.select("index_name", "flow", "status", strict_date_time("lo").alias("lo"),
                        strict_date_time("hi").alias("hi"), "created", "conflicts", "rejected")


def q22_stream_ticks(spark, sf):
    """Two bounded runs on one checkpoint after the first load."""
    home, spec = _home(spark, "q22"), proj_spec(spark, sf)
    init(spark, home, spec, T0)
    for until in (T1, T3):
        follow(spark, home, spec, f"{home.root}/checkpoint", T0, until).awaitTermination()
    return home.target("proj").read()


def q23_stream_feed(spark, sf):
    """Events delivered three times, overlapping; the overlap is a day, the lookback two."""
    root = storage.new_folder(spark, "q23")
    events = table(spark, sf, "events")
    cuts = ("2024-01-10 00:00:00", "2024-01-20 00:00:00")
    day = timedelta(days=1)
    deliveries = [(None, cuts[0]), (window_start(cuts[0], day), cuts[1]),
                  (window_start(cuts[1], day), None)]
    for i, (lo, hi) in enumerate(deliveries):  # one run per delivery, on one checkpoint
        changed_between(events, lo, hi, None, "ts").write.parquet(f"{root}/feed/delivery={i}")
        feed = spark.readStream.schema(events.schema).parquet(f"{root}/feed/delivery=*")
        docs = distinct_feed(feed, ("event_id",), "ts", "2 days")
        write_feed(docs, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    out = spark.read.schema(docs.schema).parquet(f"{root}/out")
    return _dates_as_text(out.select(DOC_ID, "ts", "user_id", "event_type"), "ts")


# -- reconciliation and extensions ---------------------------------------------------------------

def _document_and_label_ids(spark, sf):
    return [with_doc_id(table(spark, sf, t).select("doc_id"), ("doc_id",))
            for t in ("documents", "labels")]


def q24_reconcile(spark, sf):
    docs, labels = _document_and_label_ids(spark, sf)
    gone = rec.missing(docs, labels).select(F.lit("missing").alias("side"), DOC_ID)
    extra = rec.orphans(docs, labels).select(F.lit("orphan").alias("side"), DOC_ID)
    return gone.unionByName(extra)


def q24_table_counts(spark, sf):
    """Total rows of source tables."""
    counts = [rec.count_rows(table(spark, sf, t)).select(F.lit(t).alias("table_name"), "total")
              for t in ("customer", "orders", "lineitem", "events")]
    return reduce(DataFrame.unionByName, counts)


def q24_counts(spark, sf):
    docs, labels = _document_and_label_ids(spark, sf)
    return rec.compare_counts(docs, labels)


def q24_repair(spark, sf):
    """A target that holds only the labelled documents gets the rest."""
    home = _home(spark, "q24")
    docs = table(spark, sf, "documents")
    spec = SyncSpec(name="documents", id_columns="doc_id", unique_ids=True,
                    source=lambda s: docs.withColumn("create_date", F.lit(T0).cast("timestamp_ntz"))
                    .withColumn("mod_date", F.col("create_date")))
    labelled = docs.join(table(spark, sf, "labels").select("doc_id"), "doc_id", "left_semi")
    targets.recreate(home.target("documents"), with_doc_id(labelled, ("doc_id",)), unique=True)
    repair_missing(spark, home, spec, T1)
    return home.target("documents").read().select(DOC_ID, "lang", "source", "n_chars", "text")


def q25_delete(spark, sf):
    home = _home(spark, "q25")
    table(spark, sf, "orders").createOrReplaceTempView("orders_src")
    spec = SyncSpec(name="orders", id_columns="o_orderkey", init_sql="SELECT * FROM orders_src",
                    delete_sql="SELECT o_orderkey FROM orders_src WHERE o_orderstatus = 'F'")
    init(spark, home, spec, T3)
    delete_once(spark, home, spec)
    return home.target("orders").read().select(DOC_ID, "o_custkey", "o_orderstatus")


def q27_upsert(spark, sf):
    target = targets.Target(spark, storage.new_folder(spark, "q27"), "lines")
    lines = _lines(spark, sf)
    targets.upsert(target, changed_between(lines, None, T0, None, "l_shipdate"), order=LINE_ORDER)
    targets.upsert(target, lines, order=LINE_ORDER)
    return _dates_as_text(target.read(), "l_shipdate")


def q30_follow_members(spark, sf):
    """Full documents loaded window by window, where a member change re-reads its parent."""
    home = _home(spark, "q30")

    def loads(session, now):
        lists = rel.member_lists(team_member(session, sf), team_object(session, sf))
        return _full_documents(session, sf, changed_between(proj(session, sf), None, now), lists)

    def changes(session, lo, hi):
        return _changed_documents(session, sf, lo, hi)

    spec = SyncSpec(name="full", id_columns="pid", op="upsert", loads=loads, changes=changes)
    init(spark, home, spec, T0)
    sync_once(spark, home, spec, T1)
    return home.target("full").read()


def _line_attributes(spark, sf):
    return rel.typed_attributes(attr(spark, sf), param(spark))


def q31_full_load_enriched(spark, sf):
    """All parents with their attributes as one text, through the whole load."""
    home = _home(spark, "q31")
    spec = proj_spec(spark, sf, extension_column="pid", unique_ids=True,
                     ext_source=lambda s: _line_attributes(s, sf))
    init(spark, home, spec, "2030-01-01")
    return home.target("proj").read()


def q32_windows_enriched(spark, sf):
    """Full load and two windows with attributes as fields, stored sorted by id."""
    home = _home(spark, "q32")
    spec = proj_spec(spark, sf, extension_column="pid", fields_mode="flatten", sorted_ids=True,
                     ext_keys=LINE_KEYS, ext_source=lambda s: _line_attributes(s, sf))
    _init_and_sync(spark, home, spec)
    return home.target("proj").read()


def _gaps_spec(spark: SparkSession, sf: str, **more) -> SyncSpec:
    """Orders of which every fifth has no id and every third no extension id."""
    proj(spark, sf).createOrReplaceTempView("proj")
    event_eav(spark, sf).createOrReplaceTempView("event_eav")
    rows = ("(SELECT CASE WHEN pid % 5 <> 0 THEN pid END AS pid, "
            "CASE WHEN pid % 3 <> 0 THEN cust END AS cust, prio, create_date, mod_date FROM proj)")
    return SyncSpec(**({
        "name": "gaps", "id_columns": "pid", "time_type": "timestamp_ntz", "mapping": DATES,
        "extension_column": "cust", "fields_mode": "flatten", "ext_keys": EVENT_KEYS,
        "ext_order": ("ts", "event_id"),
        "ext_sql": "SELECT user_id, event_type, value, ts, event_id FROM event_eav "
                   "WHERE user_id in (?)",
        "init_sql": f"SELECT * FROM {rows} WHERE coalesce(mod_date, create_date) < ?",
        "sync_sql": f"SELECT * FROM {rows} WHERE coalesce(mod_date, create_date) > ? "
                    "AND coalesce(mod_date, create_date) < ?"} | more))


def q33_rows_without_ids(spark, sf):
    """Rows without an id are counted as rejected by the full load and by each window."""
    home, spec = _home(spark, "q33"), _gaps_spec(spark, sf)
    frame = report_frame(spark, _init_and_sync(spark, home, spec))
    return frame.select("flow", strict_date_time("hi").alias("hi"), "created", "conflicts",
                        "rejected")


def q34_null_extension_ids(spark, sf):
    """An extension SQL with an id list, in a full load and two windows; documents without an
    extension id stay, without custom fields."""
    home, spec = _home(spark, "q34"), _gaps_spec(spark, sf)
    _init_and_sync(spark, home, spec)
    return home.target("gaps").read()


def q35_mapped_types(spark, sf):
    """Numbers, keywords, other dates, and two declared analyzers beside an undeclared one."""
    analyzers = parse_analyzers("""{"settings": {"analysis": {
        "analyzer": {"dash": {"type": "custom", "tokenizer": "dash_tokenizer"},
                     "blank": {"type": "custom", "tokenizer": "blank_tokenizer"},
                     "plain": {"type": "custom", "tokenizer": "standard"}},
        "tokenizer": {"dash_tokenizer": {"type": "pattern", "pattern": "-"},
                      "blank_tokenizer": {"type": "pattern", "pattern": " +"}}}}}""")
    orders = table(spark, sf, "orders").withColumns({
        "code": F.col("o_orderkey").cast("string"), "words": F.col("o_orderpriority"),
        "whole": F.col("o_orderpriority"), "urgent": F.col("o_orderpriority").startswith("1")
        .cast("string"), "day": F.col("o_orderdate")})
    mapping = {"o_custkey": {"type": "keyword"}, "code": {"type": "integer"},
               "o_totalprice": {"type": "double"}, "urgent": {"type": "boolean"},
               "o_orderpriority": {"type": "text", "analyzer": "dash"},
               "words": {"type": "text", "analyzer": "blank"},
               "whole": {"type": "text", "analyzer": "plain"},
               "o_orderdate": {"type": "date", "format": "epoch_millis"},
               "day": {"type": "date", "format": "yyyy-MM-dd||epoch_millis"}}
    docs = apply_mapping(with_doc_id(orders, ("o_orderkey",)), mapping, analyzers=analyzers)
    return docs.select(DOC_ID, "o_custkey", "code", "o_totalprice", "urgent", "o_orderdate", "day",
                       "whole", F.element_at("o_orderpriority", -1).alias("last_token"),
                       F.size("words").alias("n_words"))


def q36_single_documents(spark, sf):
    """Documents by key beside a full load: new ones, known ones, ones without an id; the new ones
    bring a field of their own."""
    target = _home(spark, "q36").target("orders")
    docs = with_doc_id(table(spark, sf, "orders"), ("o_orderkey",)).drop("o_orderdate")
    targets.recreate(target, docs.where("o_orderkey % 3 <> 0"))
    keyed = docs.where("o_orderstatus = 'F'").withColumns({
        DOC_ID: F.when(F.col("o_custkey") % 10 != 0, F.col(DOC_ID)),
        "note": F.concat(F.lit("by key "), F.col(DOC_ID))})
    counts = targets.create_if_absent(target, keyed)
    return target.read().agg(
        F.count("*").alias("documents"), F.count("note").alias("notes"),
        F.lit(counts.created).cast("bigint").alias("created"),
        F.lit(counts.conflicts).cast("bigint").alias("conflicts"),
        F.lit(counts.rejected).cast("bigint").alias("rejected"))


UNFIT = {"code": {"type": "short"}, "price": {"type": "long"}, "urgent": {"type": "boolean"},
         "day": {"type": "date", "format": "yyyy-MM-dd"}, "label": {"type": "keyword"}}


def _unfit_load(spark, sf):
    """Orders with numbers out of range, words for numbers and days that are none, by a full load
    and two windows. Repeated ids and rows without one occur too."""
    proj(spark, sf).createOrReplaceTempView("proj")
    rows = ("(SELECT CASE WHEN pid % 11 <> 0 THEN pid % 9973 END AS key, "
            "CAST(pid * 3 AS STRING) AS code, CASE WHEN pid % 5 = 0 THEN 'unknown' "
            "ELSE CAST(cust AS STRING) END AS price, CASE pid % 4 WHEN 0 THEN 'yes' WHEN 1 THEN 'true' "
            "WHEN 2 THEN 'maybe' END AS urgent, CASE WHEN pid % 6 = 0 THEN '1999-02-30' "
            "WHEN pid % 6 = 1 THEN 'soon' ELSE '1999-03-01' END AS day, prio AS label, pid, "
            "create_date, mod_date FROM proj)")
    spec = SyncSpec(
        name="unfit", id_columns="key", time_type="timestamp_ntz", mapping=UNFIT | DATES, order="pid",
        init_sql=f"SELECT * FROM {rows} WHERE coalesce(mod_date, create_date) < ?",
        sync_sql=f"SELECT * FROM {rows} WHERE coalesce(mod_date, create_date) > ? "
                 "AND coalesce(mod_date, create_date) < ?")
    home = _home(spark, "q37")
    return home.target(spec), _init_and_sync(spark, home, spec)


def q37_unfit_counts(spark, sf):
    """A value that does not fit its mapping keeps one document out; the load goes on."""
    _, reports = _unfit_load(spark, sf)
    return report_frame(spark, reports).select(
        "flow", strict_date_time("hi").alias("hi"), "created", "conflicts", "rejected", "errors")


def q37_unfit_rows(spark, sf):
    """Why documents were kept out, by field."""
    return _unfit_load(spark, sf)[0].errors()


def q37_fit_documents(spark, sf):
    """The other documents."""
    return _unfit_load(spark, sf)[0].read()


def q38_pushed_sql_window(spark, sf):
    """A window by SQL text over a stored table with both change times, which its scan evaluates."""
    path = storage.new_folder(spark, "q38")
    proj(spark, sf).write.parquet(path)
    spec = proj_spec(spark, sf)
    spark.read.parquet(path).createOrReplaceTempView("proj")
    return _dates_as_text(window(spark, spec, LO, T1), "create_date", "mod_date")


def _stale_target(spark, sf):
    """A target of documents that lacks some, has some too many, and holds old versions of some."""
    docs = table(spark, sf, "documents").withColumn("create_date", F.lit(T0).cast("timestamp_ntz")) \
        .withColumn("mod_date", F.col("create_date"))
    spec = SyncSpec(name="documents", id_columns="doc_id", unique_ids=True, source=lambda s: docs)
    home, i = _home(spark, "q39"), F.col("doc_id")
    old = docs.where(i % 13 != 0).withColumns({
        "lang": F.when(i % 17 == 0, F.lit(None)).otherwise(F.col("lang")),
        "n_chars": F.when(i % 19 == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars")),
        "doc_id": F.when(i % 23 == 0, -i - 1).otherwise(i)})
    targets.recreate(home.target(spec), documents(old, spec), unique=True)
    return home, spec


def q39_range_differences(spark, sf):
    """Ids that are missing, too many or of other content, found by sums of ranges."""
    home, spec = _stale_target(spark, sf)
    return verify(spark, home, spec, T1)


def q39_repair_differences(spark, sf):
    home, spec = _stale_target(spark, sf)
    repair_differences(spark, home, spec, T1)
    return home.target(spec).read().select(DOC_ID, "lang", "source", "n_chars", "text")


def _late_feed(spark, sf):
    """Events delivered three times, overlapping by a day; every tenth is delivered one time too
    late, behind a lookback of two days."""
    root = storage.new_folder(spark, "q40")
    events, late = table(spark, sf, "events"), F.col("event_id") % 10 == 0
    cuts, day = ("2024-01-10 00:00:00", "2024-01-20 00:00:00"), timedelta(days=1)
    spans = [(None, cuts[0]), (window_start(cuts[0], day), cuts[1]), (window_start(cuts[1], day), None)]
    target, side, reports = targets.Target(spark, root, "events"), LateRows(spark, f"{root}/late"), []
    for i, (lo, hi) in enumerate(spans):
        part = changed_between(events, lo, hi, None, "ts").where(~late)
        if i:
            part = part.unionByName(changed_between(events, *spans[i - 1], None, "ts").where(late))
        part.write.parquet(f"{root}/feed/delivery={i}")
        feed = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 10000).parquet(
            f"{root}/feed/delivery=*")
        follow_feed(feed, target, side, ("event_id",), "ts", timedelta(days=2), f"{root}/checkpoint",
                    on_report=reports.append).awaitTermination()
    return target, side, reports, with_doc_id(events, ("event_id",)).schema


def q40_late_rows(spark, sf):
    """Late rows, in a table of their own."""
    _, side, _, schema = _late_feed(spark, sf)
    return _dates_as_text(side.read(schema).select(DOC_ID, "ts", "event_type", "late_in_batch"), "ts")


def q40_late_counts(spark, sf):
    """Of each micro-batch: what was kept, known and late."""
    reports = _late_feed(spark, sf)[2]
    return spark.createDataFrame([(r.batch, r.kept, r.repeats, r.late) for r in reports],
                                 "batch long, kept long, repeats long, late long")


def q40_late_readmitted(spark, sf):
    """The target after its late rows were let in."""
    target, side, _, schema = _late_feed(spark, sf)
    readmit(target, side, schema)
    return _dates_as_text(target.read().select(DOC_ID, "ts", "event_type"), "ts")


def q41_run_history(spark, sf):
    """What two bounded runs of a polling query did, after they have ended."""
    home, spec = _home(spark, "q41"), proj_spec(spark, sf)
    history = RunHistory(spark, f"{home.root}/history")
    spark.streams.addListener(history)
    try:
        init(spark, home, spec, T0)
        for until in (T1, T3):
            query = follow(spark, home, spec, f"{home.root}/checkpoint", T0, until)
            query.awaitTermination()
            history.await_end(query)
    finally:
        spark.streams.removeListener(history)
    fold_history(spark, history.path)
    return run_summary(history.read()).select("query", "batches", "input_rows", "dropped_rows",
                                              "last_batch", "state", "error")


def _typed_events(spark, sf):
    """Events as custom fields of three kinds: a number, an object, a text."""
    events = table(spark, sf, "events")
    return events.select("user_id", F.explode(F.array(
        F.struct(F.col("event_type").alias("k"), F.col("value").cast("variant").alias("v")),
        F.struct(F.concat(F.lit("props_"), "event_type").alias("k"), F.parse_json("props").alias("v")),
        F.struct(F.concat(F.lit("at_"), "event_type").alias("k"),
                 strict_date_time("ts").cast("variant").alias("v")))).alias("e"), "ts", "event_id") \
        .select("user_id", "e.*", "ts", "event_id")


def q42_typed_custom_fields(spark, sf):
    """Undeclared custom fields keep their types; one row per field."""
    docs = en.flatten(_customers(spark, sf), _typed_events(spark, sf), "c_custkey", None,
                      ("ts", "event_id"), ("c_custkey",), typed=True)
    fields = docs.select("c_custkey", F.explode("custom").alias("key", "value"))
    return fields.select("c_custkey", "key", F.schema_of_variant("value").alias("kind"),
                         F.to_json("value").alias("json"))


def q42_typed_documents(spark, sf):
    """The same through a full load, stored and written as bulk text."""
    home = _home(spark, "q42")
    _customers(spark, sf).createOrReplaceTempView("customers_src")
    spec = SyncSpec(name="customers", id_columns="c_custkey", unique_ids=True,
                    init_sql="SELECT * FROM customers_src", extension_column="c_custkey",
                    fields_mode="flatten", ext_order=("ts", "event_id"), ext_typed=True,
                    ext_source=lambda s: _typed_events(s, sf))
    init(spark, home, spec, T3)
    return to_ndjson(home.target(spec).read(), "customers")


def q43_captured_changes(spark, sf):
    """q13 by streams: parents, links and member changes arrive in three deliveries, each on its own
    run of one query, and changed documents are loaded as they become known."""
    root = storage.new_folder(spark, "q43")
    parents, members, teams = proj(spark, sf), team_member(spark, sf), team_object(spark, sf)
    changed = F.coalesce("mod_date", "create_date")
    feeds = {"parents": changed_between(parents, LO, T1).withColumn("at", changed),
             "members": changed_between(members, LO, T1, None, "mod_date").withColumn("at", F.col("mod_date")),
             "links": teams.join(parents.select(F.col("pid").alias("object_id"),
                                                F.col("create_date").alias("at")), "object_id")}
    target = targets.Target(spark, root, "full")

    def load(ids):
        rows = _full_documents(spark, sf, parents.join(ids, "pid", "left_semi"),
                               rel.lists_for(ids, "pid", members, teams))
        targets.upsert(target, with_doc_id(rows, ("pid",)))
    cuts = [None, "1998-03-01 00:00:00", "1998-05-01 00:00:00", None]
    for i in range(3):
        for name, rows in feeds.items():
            slot = F.when(F.col("at") < F.lit(cuts[1]).cast("timestamp_ntz"), 0).when(
                F.col("at") < F.lit(cuts[2]).cast("timestamp_ntz"), 1).otherwise(2)
            rows.where(slot == i).write.parquet(f"{root}/feed/{name}/delivery={i}")
        streams = {name: spark.readStream.schema(rows.schema).parquet(f"{root}/feed/{name}/delivery=*")
                   for name, rows in feeds.items()}
        ids = changed_parent_ids(streams["parents"], "pid", "at", streams["links"], streams["members"],
                                 "7300 DAYS", link_time="at", member_time="at")
        follow_changes(ids, load, f"{root}/checkpoint").awaitTermination()
    return target.read().drop(DOC_ID)


QUERIES = {f.__name__: f for f in (
    q01_full_scan_bound, q02_window_scan, q03_doc_id_composite, q04_create_if_absent,
    q05_outcomes, q05_refused_rows, q06_ext_flatten, q06_ext_flatten_open, q07_ext_custom_in_one,
    q08_ext_custom_in_one_repeat, q09_ext_typed_values, q10_ext_batch_scan, q11_member_list,
    q12_full_document, q13_changed_union, q14_changed_union_fanout, q15_mapping,
    q16_bulk_payload, q16_bulk_export, q17_recreate_target, q18_latest_state, q19_init_then_sync, q20_fix_by_key,
    q20_fix_many_keys, q21_run_report, q22_stream_ticks, q23_stream_feed, q24_reconcile,
    q24_counts, q24_table_counts, q24_repair, q25_delete, q26_all_in_one, q27_upsert, q28_pushed_window,
    q29_protected_ids, q30_follow_members, q31_full_load_enriched, q32_windows_enriched,
    q33_rows_without_ids, q34_null_extension_ids, q35_mapped_types, q36_single_documents,
    q37_unfit_counts, q37_unfit_rows, q37_fit_documents, q38_pushed_sql_window,
    q39_range_differences, q39_repair_differences, q40_late_rows, q40_late_counts,
    q40_late_readmitted, q41_run_history, q42_typed_custom_fields, q42_typed_documents,
    q43_captured_changes)}
