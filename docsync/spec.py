"""The description of one document set: where its rows come from and how they become documents."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession

FIELD_MODES = ("flatten", "custom_in_one", "all_in_one")
WRITE_OPS = ("create", "upsert")
UNFIT = ("record", "stop")


def _names(value) -> tuple[str, ...]:
    """Column names from a comma list or a sequence: trimmed, lower case, no blanks."""
    parts = value.split(",") if isinstance(value, str) else list(value or ())
    return tuple(p.strip().lower() for p in parts if p.strip())


@dataclass(frozen=True)
class SyncSpec:
    """One target and the SQL that feeds it.  Only ``name``, ``id_columns`` and ``init_sql`` (or
    ``source`` or ``loads``) are required.

    ``init_sql`` has one ``?`` (the upper time bound), ``sync_sql`` has pairs of ``?``
    (lower, upper).  ``source`` may be given instead: a function that returns the rows, which are
    then filtered on ``change_columns`` with a predicate the scan can push down.
    """

    name: str
    id_columns: tuple[str, ...] | str
    init_sql: str | None = None
    sync_sql: str | None = None
    ext_sql: str | None = None
    delete_sql: str | None = None
    source: Callable[[SparkSession], DataFrame] | None = None
    # (modified, created): the change time is the first one that is not null
    change_columns: tuple[str, str] = ("mod_date", "create_date")
    # No row is modified before it is created: an upper bound of the change time then bounds the
    # creation time too, which scans can use where the modification comes from another table
    created_first: bool = False
    # (spark, now) -> rows and (spark, lo, hi) -> rows: scans that place the time bounds themselves,
    # as windows over several tables have to
    loads: Callable[..., DataFrame] | None = None
    changes: Callable[..., DataFrame] | None = None
    # (parent id, key, value, ...) rows, in place of ext_sql
    ext_source: Callable[[SparkSession], DataFrame] | None = None
    extension_column: str | None = None
    ext_order: tuple[str, ...] | str = ()
    ext_keys: tuple[str, ...] | None = None
    ext_repeat: int = 1
    # Undeclared custom fields (flatten without ext_keys) keep the types of their values
    ext_typed: bool = False
    mapping: Mapping | None = None
    # Pattern between tokens by analyzer name; text with another analyzer stays whole
    analyzers: Mapping[str, str] = field(default_factory=dict)
    fields_mode: str = "custom_in_one"
    op: str = "create"
    lookback: timedelta = timedelta(seconds=1)
    # Which row is "first" when an id occurs twice in one load
    order: tuple[str, ...] | str = ()
    # The id columns are the source's primary key: skips the shuffle that looks for repeats
    unique_ids: bool = False
    id_separator: str = "-"
    # Store documents sorted by id, so that windows whose ids lie close together (rising numbers,
    # time-ordered ids) read little of a large target.  Costs a shuffle in the full load
    sorted_ids: bool = False
    # Folders, by a hash of the id, that a full load makes; a window reads those of its ids only
    buckets: int = 16
    # Files of a bucket beyond which sync writes it anew
    max_parts: int = 16
    # What a value does that does not fit its mapping: record keeps the document out, counts it and
    # says why (Target.errors); stop ends the load
    unfit: str = "record"
    # Type that ``?`` is bound as; timestamp_ntz matches parquet files without a time zone
    time_type: str = "timestamp"
    # Connection options; when set, SQL text runs in that database, in its own dialect
    jdbc: Mapping[str, str] | None = field(default=None, repr=False)

    def __post_init__(self):
        def put(name, value):
            object.__setattr__(self, name, value)

        put("id_columns", _names(self.id_columns))
        put("order", _names(self.order))
        put("ext_order", _names(self.ext_order))
        put("fields_mode", self.fields_mode.strip().lower())
        put("op", self.op.strip().lower())
        if self.extension_column is not None:
            put("extension_column", self.extension_column.strip().lower() or None)
        if self.ext_keys is not None:
            put("ext_keys", _names(self.ext_keys))
        if not self.name:
            raise ValueError("a spec needs a name")
        if not self.id_columns:
            raise ValueError(f"{self.name}: id_columns is empty")
        if self.init_sql is None and self.source is None and self.loads is None:
            raise ValueError(f"{self.name}: give init_sql, source or loads")
        if self.fields_mode not in FIELD_MODES:
            raise ValueError(f"{self.name}: fields_mode must be one of {FIELD_MODES}")
        if self.op not in WRITE_OPS:
            raise ValueError(f"{self.name}: op must be one of {WRITE_OPS}")
        if self.ext_typed and self.ext_keys is not None:
            raise ValueError(f"{self.name}: ext_typed is for undeclared custom fields")
        put("unfit", self.unfit.strip().lower())
        if self.unfit not in UNFIT:
            raise ValueError(f"{self.name}: unfit must be one of {UNFIT}")
        if self.buckets < 1:
            raise ValueError(f"{self.name}: buckets must be at least 1")
        if self.time_type not in ("timestamp", "timestamp_ntz"):
            raise ValueError(f"{self.name}: time_type must be timestamp or timestamp_ntz")


class Specs:
    """Specs by name; an unknown name is an error."""

    def __init__(self, specs=()):
        self._by_name = {}
        for spec in specs:
            self.add(spec)

    def add(self, spec: SyncSpec) -> None:
        if spec.name in self._by_name:
            raise ValueError(f"spec {spec.name} is registered twice")
        self._by_name[spec.name] = spec

    def get(self, name: str) -> SyncSpec:
        try:
            return self._by_name[name]
        except KeyError:
            raise KeyError(f"no spec named {name!r}; known: {sorted(self._by_name)}") from None

    def __iter__(self):
        return iter(self._by_name.values())

    def __len__(self):
        return len(self._by_name)
