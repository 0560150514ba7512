"""Custom fields: entity-attribute-value rows attached to their documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsync.functions.text import column_text, join_keys, pair_text
from docsync.functions.times import iso_date
from docsync.operators.concat import ordered_concat
from docsync.operators.ids import DOC_ID, ERRORS, WRITES
from docsync.spec import SyncSpec

CUSTOM_FIELDS = "custom_fields"
ALL_FIELDS = "all_fields"
CUSTOM_MAP = "custom"
# Ids written into the filter of an extension scan.
PUSH_IDS = 1000
# Up to this many declared keys are picked in one aggregate; more go through the map, which costs
# a second shuffle but keeps the rows narrow.
WIDE_KEYS = 64


def _lower(ext: DataFrame) -> DataFrame:
    return ext.toDF(*[c.lower() for c in ext.columns])


def eav(docs: DataFrame, extension_column: str, ext: DataFrame, order=(), typed=None):
    """The key column of the documents, and (parent_id, item) of the extension rows.

    The first three columns of the rows are parent id, key and value, by position; keys become
    lower case, values text.  ``item`` holds key and value after the columns the rows are ordered
    by, so comparing items is a total order up to equal rows. ``typed`` adds a column of that name.
    """
    ext = _lower(ext)
    parent, key, value = ext.columns[:3]
    doc_key, ext_key = join_keys(docs, extension_column, ext, parent)
    by = [F.col(f"`{c}`").alias(f"by{i}") for i, c in enumerate(order)]
    item = F.struct(*by, F.lower(F.col(f"`{key}`")).alias("key"),
                    column_text(ext, value).alias("value"))
    rows = ext.where(F.col(f"`{parent}`").isNotNull() & F.col(f"`{key}`").isNotNull())
    more = [] if typed is None else [typed.alias("typed")]
    return doc_key, rows.select(ext_key.alias("parent_id"), item.alias("item"), *more)


def batch_rows(ext: DataFrame, docs: DataFrame, extension_column: str) -> DataFrame:
    """The extension rows of the documents of a batch.

    The ids of a small batch become an IN list that the extension's own scan evaluates (a database
    then looks them up in its index); above PUSH_IDS the rows are found by a semi join.
    """
    ext = _lower(ext)
    parent = ext.schema.fields[0]
    doc_key, ext_key = join_keys(docs, extension_column, ext, parent.name)
    ids = docs.select(doc_key.alias("_id")).where("_id IS NOT NULL").distinct()
    few = [r["_id"] for r in ids.limit(PUSH_IDS + 1).collect()]
    if len(few) <= PUSH_IDS:
        typed = [F.lit(i).try_cast(parent.dataType) for i in few]
        return ext.where(F.col(f"`{parent.name}`").isin(typed))
    return ext.join(ids, ext_key == ids["_id"], "left_semi")


def extension_ids(docs: DataFrame, extension_column: str) -> DataFrame:
    """The ids to look up, as they are typed in the documents."""
    return docs.select(extension_column).where(F.col(extension_column).isNotNull())


def _attach(docs: DataFrame, key: Column, grouped: DataFrame) -> DataFrame:
    """Left join: every document stays, null ids match nothing.

    A field of the documents with the name of an attached one is replaced where there is an
    attached value, and kept elsewhere.
    """
    names = [c for c in grouped.columns if c != "parent_id"]
    grouped = grouped.select(F.col("parent_id").alias("_ext_parent"),
                             *[F.col(c).alias(f"_ext_{c}") for c in names])
    joined = docs.join(grouped, key == F.col("_ext_parent"), "left")
    out = []
    for c in docs.columns:
        own = F.col(f"`{c}`")
        if c in names:
            kind = grouped.schema[f"_ext_{c}"].dataType
            same = docs.schema[c].dataType == kind
            own = F.coalesce(F.col(f"_ext_{c}"), own if same else (
                own.cast("string") if kind.simpleString() == "string" else F.lit(None)))
        out.append(own.alias(c))
    return joined.select(*out, *[F.col(f"_ext_{c}").alias(c) for c in names if c not in docs.columns])


def _latest(rows: DataFrame) -> DataFrame:
    """(parent_id, custom): the last value of every key, repeats dropped before the shuffle."""
    last = rows.groupBy("parent_id", "item.key").agg(F.max("item").alias("item"))
    entries = F.collect_list(F.struct("item.key", "item.value"))
    return last.groupBy("parent_id").agg(F.map_from_entries(entries).alias(CUSTOM_MAP))


def as_variant(c: Column, kind: T.DataType) -> Column:
    """A value of any type with its type: numbers stay numbers, nested values stay nested."""
    if isinstance(kind, T.VariantType):
        return c
    if isinstance(kind, (T.StructType, T.MapType, T.ArrayType)):
        return F.to_variant_object(c)
    return c.cast("variant")


def typed_variant(rows: DataFrame, string: str = "string_value", date: str = "date_value",
                  number: str = "number_value") -> Column:
    """The one of three typed columns that has a value, dates as text."""
    kinds = rows.schema
    return F.coalesce(as_variant(F.col(string), kinds[string].dataType),
                      as_variant(iso_date(F.col(date)), T.StringType()),
                      as_variant(F.col(number), kinds[number].dataType))


def _latest_typed(docs: DataFrame, ext: DataFrame, extension_column: str, order, protected):
    """As _latest, with values as variants, and keys in order."""
    ext = _lower(ext)
    value = ext.schema.fields[2]
    doc_key, rows = eav(docs, extension_column, ext, order, as_variant(F.col(f"`{value.name}`"), value.dataType))
    rows = rows.where(~F.col("item.key").isin(*protected))
    last = rows.groupBy("parent_id", "item.key").agg(F.max_by("typed", "item").alias("value"))
    entries = F.array_sort(
        F.collect_list(F.struct("key", "value")),
        lambda a, b: F.when(a["key"] < b["key"], -1).when(a["key"] > b["key"], 1).otherwise(0))
    return doc_key, last.groupBy("parent_id").agg(F.map_from_entries(entries).alias(CUSTOM_MAP))


def flatten(docs: DataFrame, ext: DataFrame, extension_column: str, keys=None, order=(),
            id_columns=(), typed: bool = False) -> DataFrame:
    """Custom fields as fields of their own; the last row of a repeated key counts.

    With ``keys`` declared each becomes a column.  Without, all keys go to one map column
    ``custom`` (their number has no limit, so they are not columns).  A custom field replaces an ordinary field of the same name; an id column is never replaced.

    ``typed`` (for undeclared keys) makes the map's values variants, each of the type its value has
    in the extension rows: a number, text, an object. Otherwise they are text.
    """
    protected = {DOC_ID, WRITES, ERRORS, *id_columns}
    if typed and keys is not None:
        raise ValueError("declared custom fields have one type each; typed is for undeclared ones")
    if typed:
        return _attach(docs, *_latest_typed(docs, ext, extension_column, order, protected))
    doc_key, rows = eav(docs, extension_column, ext, order)
    if keys is None:
        return _attach(docs, doc_key, _latest(rows.where(~F.col("item.key").isin(*protected))))
    keys = [k.lower() for k in keys if k.lower() not in protected]
    rows = rows.where(F.col("item.key").isin(*keys))
    if len(keys) > WIDE_KEYS:
        grouped = _latest(rows).withColumnRenamed(CUSTOM_MAP, "_custom_map")
        custom = {k: F.try_element_at("_custom_map", F.lit(k)) for k in keys}
        present = {k: F.coalesce(F.map_contains_key("_custom_map", k), F.lit(False)) for k in keys}
    else:
        grouped = rows.groupBy("parent_id").agg(*[
            F.max(F.when(F.col("item.key") == k, F.col("item"))).alias(f"_c{i}")
            for i, k in enumerate(keys)])
        custom = {k: F.col(f"_c{i}.value") for i, k in enumerate(keys)}
        present = {k: F.col(f"_c{i}").isNotNull() for i, k in enumerate(keys)}
    joined = _attach(docs, doc_key, grouped)
    out = []
    for c in docs.columns:
        own = F.col(f"`{c}`")
        if c in custom:
            own = F.when(present[c], custom[c]).otherwise(own.cast("string"))
        out.append(own.alias(c))
    out += [custom[k].alias(k) for k in keys if k not in docs.columns]
    return joined.select(*out)


def protected_keys(docs: DataFrame, ext: DataFrame, extension_column: str,
                   id_columns) -> DataFrame:
    """(key, n): how many documents have a custom field named like an id column (it is ignored)."""
    doc_key, rows = eav(docs, extension_column, ext)
    hits = (rows.select(F.col("parent_id").alias("_parent_id"), F.col("item.key").alias("_key"))
            .where(F.col("_key").isin(*id_columns)).distinct())
    return (docs.join(hits, doc_key == F.col("_parent_id"))
            .groupBy(F.col("_key").alias("key")).agg(F.count(F.lit(1)).alias("n")))


def custom_in_one(docs: DataFrame, ext: DataFrame, extension_column: str, order=(),
                  repeat: int = 1) -> DataFrame:
    """All custom fields as one text ``custom_fields``: ``key value `` per row, in order.

    ``repeat`` writes every pair that many times.  Documents without rows get null.
    """
    doc_key, rows = eav(docs, extension_column, ext, order)
    grouped = ordered_concat(
        rows, "parent_id", F.col("item"),
        lambda item: F.repeat(pair_text(item["key"], item["value"]), repeat), name=CUSTOM_FIELDS)
    return _attach(docs, doc_key, grouped)


def all_in_one(docs: DataFrame) -> DataFrame:
    """Standard and custom fields as one text ``all_fields``, in the form of ``custom_fields``."""
    standard = [c for c in docs.columns if c not in (DOC_ID, WRITES, ERRORS, CUSTOM_FIELDS)]
    parts = [pair_text(F.lit(c), column_text(docs, c)) for c in standard]
    if CUSTOM_FIELDS in docs.columns:
        parts.append(F.coalesce(F.col(CUSTOM_FIELDS), F.lit("")))
    return docs.withColumn(ALL_FIELDS, F.concat(*parts))


def enrich(docs: DataFrame, ext: DataFrame | None, spec: SyncSpec) -> DataFrame:
    """Apply the fields mode of a spec; without extension rows documents stay as they are."""
    if ext is not None:
        if spec.fields_mode == "flatten":
            docs = flatten(docs, ext, spec.extension_column, spec.ext_keys, spec.ext_order,
                           spec.id_columns, spec.ext_typed)
        else:
            docs = custom_in_one(docs, ext, spec.extension_column, spec.ext_order,
                                 spec.ext_repeat)
    return all_in_one(docs) if spec.fields_mode == "all_in_one" else docs
