"""Documents as declared by a mapping, and as bulk text."""

from __future__ import annotations

import json
import re
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsync.functions.text import column_text, pattern_tokens
from docsync.functions.times import iso_date, strict_date_time, utc_text
from docsync.operators.enrich import CUSTOM_MAP
from docsync.operators.ids import DOC_ID, ERROR_TYPE, ERRORS, WRITES

# Documents per exported file (one bulk request).
BULK_SIZE = 12000

_TIMES = (T.TimestampType, T.TimestampNTZType, T.DateType)


# Field types by the Spark type of their values, and types whose values stay as
# they are for the store to read.
_CASTS = {"long": "bigint", "integer": "int", "short": "smallint", "byte": "tinyint",
          "unsigned_long": "decimal(20,0)", "double": "double", "float": "float",
          "half_float": "float", "boolean": "boolean"}
_TEXTS = ("text", "keyword", "constant_keyword", "wildcard", "match_only_text")
_AS_IS = ("object", "nested", "flattened", "ip", "geo_point", "geo_shape", "binary", "alias",
          "completion", "scaled_float", "version")
# Named date formats.
_DATES = {"strict_date_time": strict_date_time, "date_time": strict_date_time,
          "strict_date_optional_time": strict_date_time, "date_optional_time": strict_date_time,
          "strict_date": iso_date, "date": iso_date, "yyyy-MM-dd": iso_date,
          "epoch_millis": lambda c: F.unix_millis(c.cast("timestamp")),
          "epoch_second": lambda c: F.unix_seconds(c.cast("timestamp"))}
_PATTERN = re.compile(r"[yMdHmsS'TZ:./ -]+")


def parse_mapping(text: str) -> dict:
    """The field declarations of a mapping text."""
    return json.loads(text).get("properties", {})


def parse_analyzers(text: str) -> dict[str, str]:
    """Analyzer names with the pattern of their tokenizer, from a settings text.

    Analyzers with another kind of tokenizer are left to the store.
    """
    settings = json.loads(text)
    settings = settings.get("settings", settings)
    analysis = settings.get("analysis") or settings.get("index", {}).get("analysis") or {}
    tokenizers, found = analysis.get("tokenizer", {}), {}
    for name, analyzer in analysis.get("analyzer", {}).items():
        tokenizer = tokenizers.get(analyzer.get("tokenizer"), {})
        if tokenizer.get("type") == "pattern" and int(tokenizer.get("group", -1)) == -1:
            flags = "(?i)" * ("CASE_INSENSITIVE" in tokenizer.get("flags", ""))
            found[name] = flags + tokenizer.get("pattern", r"\W+")
        elif analyzer.get("type") == "pattern":
            found[name] = analyzer.get("pattern", r"\W+")
    return found


def _strict_cast(c: Column, name: str, kind: str) -> Column:
    """A cast that fails on a value that does not fit, also without ANSI mode."""
    fit = c.try_cast(kind)
    bad = F.raise_error(F.concat(F.lit(f"field {name} is declared {kind}, got: "), c.cast("string")))
    return F.when(c.isNotNull() & fit.isNull(), bad.cast(kind)).otherwise(fit)


def _forms(f: T.StructField, declared: str) -> list[str]:
    """The date formats of a field, first the one that times are written in."""
    forms = [form.strip() for form in declared.split("||")]
    for form in forms:
        if form not in _DATES and not (_PATTERN.fullmatch(form) and "y" in form):
            raise ValueError(f"field {f.name}: unknown date format {form}")
    return forms


def _date(c: Column, f: T.StructField, form: str) -> Column:
    """Dates as declared. Text is taken to be in a declared format already."""
    if not isinstance(f.dataType, _TIMES):
        return c
    if form in _DATES:
        if form.startswith("epoch") and not isinstance(f.dataType, T.TimestampType):
            c = F.to_timestamp_ltz(F.concat(utc_text(c), F.lit("+00:00")))
        return _DATES[form](c)
    return F.date_format(utc_text(c).cast("timestamp_ntz"), form)


def _reads_as(text: Column, form: str) -> Column:
    """Whether a text is a date of a declared format."""
    if form.startswith("epoch"):
        return text.rlike(r"^-?\d+$")
    if form not in _DATES:
        return F.try_to_timestamp(text, F.lit(form)).isNotNull()
    day = r"^\d{4}-\d{2}-\d{2}"
    time = r"T\d{2}:\d{2}:\d{2}\.\d{1,9}(Z|[+-]\d{2}:?\d{2})$"
    if form.endswith("optional_time"):
        time = r"(T\d{2}(:\d{2}(:\d{2}([.,]\d{1,9})?)?)?(Z|[+-]\d{2}:?\d{2})?)?$"
    elif not form.endswith("date_time"):
        time = "$"
    # The clock part is told by the pattern and by its numbers, whatever zone notation follows.
    clock = F.regexp_extract(text, r"T(\d{2}:\d{2}:\d{2})", 1)
    return text.rlike(day + time) & text.substr(1, 10).try_cast("date").isNotNull() & (
        (clock == "") | F.concat(F.lit("1970-01-01 "), clock).try_cast("timestamp_ntz").isNotNull())


def _unfit(c: Column, f: T.StructField, rule: Mapping) -> Column | None:
    """Why a value does not fit its declaration, null where it does; None if it always fits."""
    kind = rule.get("type", "object")
    text, where = c.cast("string"), None
    if kind in _CASTS and f.dataType.simpleString() != _CASTS[kind]:
        where, reason = c.isNotNull() & c.try_cast(_CASTS[kind]).isNull(), f"not {kind}"
    elif kind == "date" and not isinstance(f.dataType, _TIMES):
        forms = _forms(f, rule.get("format", "strict_date_time"))
        fits = [_reads_as(text, form) for form in forms]
        where, reason = c.isNotNull() & ~reduce(lambda a, b: a | b, fits), f"not {'||'.join(forms)}"
    if where is None:
        return None
    return F.when(where, F.struct(F.lit(f.name).alias("field"), text.alias("value"),
                                  F.lit(reason).alias("reason")))


def apply_mapping(docs: DataFrame, mapping, tokenize: bool = True,
                  analyzers: Mapping[str, str] | None = None, fields=None,
                  errors: bool = False) -> DataFrame:
    """Cast the declared fields; undeclared ones stay, declared but missing ones are skipped.

    Text and keyword become strings; numbers and booleans are cast, and a value that does not fit
    is an error; dates become text (or a count) in the first declared format. A text field whose
    analyzer is among ``analyzers`` (name, pattern between tokens) becomes its tokens unless
    ``tokenize`` is off; with any other analyzer it stays whole. Objects, addresses and the like
    stay as they are. ``fields`` restricts the work to some columns.

    With ``errors`` no value stops the run: a value that does not fit becomes null and an entry
    (field, value, reason) of the row's ERRORS, which dates given as text can have too. Entries
    that a row has already stay.
    """
    declared = {name.lower(): rule for name, rule in mapping.get("properties", mapping).items()}
    out, bad = [], []
    for f in docs.schema.fields:
        c, rule = F.col(f"`{f.name}`"), declared.get(f.name)
        if rule is not None and f.name not in (WRITES, ERRORS) and (fields is None or f.name in fields):
            kind = rule.get("type", "object")
            why = _unfit(c, f, rule) if errors else None
            if kind in _TEXTS:
                c = column_text(docs, f.name)
                pattern = (analyzers or {}).get(rule.get("analyzer"))
                if pattern is not None and tokenize:
                    c = pattern_tokens(c, pattern)
            elif kind == "date":
                c = _date(c, f, _forms(f, rule.get("format", "strict_date_time"))[0])
            elif kind in _CASTS:
                c = c.try_cast(_CASTS[kind]) if errors else _strict_cast(c, f.name, _CASTS[kind])
            elif kind not in _AS_IS:
                raise ValueError(f"field {f.name}: unknown type {kind}")
            if why is not None:
                bad.append(why)
                c = F.when(why.isNull(), c)
        if f.name != ERRORS:
            out.append(c.alias(f.name))
    if bad or ERRORS in docs.columns:
        found = F.filter(F.array(*bad), lambda e: e.isNotNull()).cast(ERROR_TYPE) if bad else None
        had = F.col(ERRORS) if ERRORS in docs.columns else None
        both = [x for x in (had, found) if x is not None]
        out.append((F.concat(*both) if len(both) > 1 else both[0]).alias(ERRORS))
    return docs.select(*out)


def split_errors(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(documents without errors, one row (doc_id, field, value, reason) per error)."""
    if ERRORS not in docs.columns:
        none = docs.select(DOC_ID, F.lit(None).cast(ERROR_TYPE).alias(ERRORS)).limit(0)
        return docs, none.select(DOC_ID, F.explode(ERRORS).alias("e")).select(DOC_ID, "e.*")
    return (docs.where(F.size(ERRORS) == 0).drop(ERRORS),
            docs.select(DOC_ID, F.explode(ERRORS).alias("e")).select(DOC_ID, "e.*"))


def _json(c: Column, ignore_nulls: bool) -> Column:
    return F.to_json(c, {"ignoreNullFields": str(ignore_nulls).lower()})


def to_ndjson(docs: DataFrame, index: str, ignore_nulls: bool = False) -> DataFrame:
    """One text ``value`` per document: the create action, a line break, the document.

    A map column ``custom`` (flatten without declared keys) is written as fields of the document
    itself, in place of standard fields of the same name.
    """
    action = F.to_json(F.struct(F.struct(
        F.lit(index).alias("_index"), F.col(DOC_ID).alias("_id")).alias("create")))
    fields = [c for c in docs.columns if c not in (DOC_ID, WRITES, ERRORS, CUSTOM_MAP)]
    if CUSTOM_MAP in docs.columns:
        body = _merged_body(fields, ignore_nulls)
    else:
        body = _json(F.struct(*[F.col(f"`{c}`") for c in fields]), ignore_nulls)
    return docs.select(F.concat(action, F.lit("\n"), body).alias("value"))


def _inner(c: Column) -> Column:
    """JSON object text without its braces, null when it has no field."""
    return F.nullif(c.substr(F.lit(2), F.length(c) - 2), F.lit(""))


def _merged_body(fields, ignore_nulls: bool) -> Column:
    parts = []
    for c in fields:
        own = _inner(_json(F.struct(F.col(f"`{c}`")), ignore_nulls))
        replaced = F.coalesce(F.map_contains_key(F.col(CUSTOM_MAP), c), F.lit(False))
        parts.append(F.when(~replaced, own))
    parts.append(_inner(_json(F.col(CUSTOM_MAP), ignore_nulls)))
    return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))


def export_bulk(docs: DataFrame, index: str, path: str, bulk_size: int = BULK_SIZE,
                ignore_nulls: bool = False) -> None:
    """Write bulk requests as text files of at most ``bulk_size`` documents, in parallel."""
    (to_ndjson(docs, index, ignore_nulls).write.mode("overwrite")
     .option("maxRecordsPerFile", bulk_size).text(path))
