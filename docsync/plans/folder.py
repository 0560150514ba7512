"""Specs from a folder of text files, one sub-folder per target."""

from __future__ import annotations

from pathlib import Path

from docsync.operators.document import parse_analyzers, parse_mapping
from docsync.spec import Specs, SyncSpec


def _text(path: Path) -> str | None:
    return path.read_text("utf-8").strip() or None if path.is_file() else None


def _properties(text: str | None) -> dict[str, str]:
    pairs = {}
    for line in (text or "").splitlines():
        line = line.strip()
        if line and not line.startswith(("#", "!")):
            name, _, value = line.partition("=")
            pairs[name.strip()] = value.strip()
    return pairs


def load_spec(folder: str | Path, **overrides) -> SyncSpec:
    """The spec of one target.

    ``sql/init.sql``, ``sync.sql``, ``extension.sql`` and ``delete.sql`` hold the SQL, of which
    only init is required; ``sql/sql.properties`` has ``id_columns`` and ``extension_column``;
    ``mapping.json`` declares fields, ``settings.json`` analyzers.  Keyword arguments set the other fields of the spec.
    """
    folder = Path(folder)
    sql = folder / "sql"
    properties = _properties(_text(sql / "sql.properties"))
    mapping, settings = _text(folder / "mapping.json"), _text(folder / "settings.json")
    parts = {
        "name": folder.name, "init_sql": _text(sql / "init.sql"),
        "sync_sql": _text(sql / "sync.sql"), "ext_sql": _text(sql / "extension.sql"),
        "delete_sql": _text(sql / "delete.sql"), "id_columns": properties.get("id_columns", ""),
        "extension_column": properties.get("extension_column"),
        "mapping": parse_mapping(mapping) if mapping else None,
        "analyzers": parse_analyzers(settings) if settings else {},
    }
    return SyncSpec(**(parts | overrides))


def load_specs(folder: str | Path, **overrides) -> Specs:
    folders = sorted(p for p in Path(folder).iterdir() if (p / "sql").is_dir())
    return Specs(load_spec(p, **overrides) for p in folders)
