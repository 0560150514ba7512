"""The ``?`` placeholders of a SQL text; those inside quotes or comments do not count."""

from __future__ import annotations

import re

# Quoted text and comments
SKIPPED = r"'(?:[^']|'')*'|\"[^\"]*\"|`[^`]*`|--[^\n]*|/\*.*?\*/"
_SKIP_OR_MARK = re.compile(SKIPPED + r"|(\?)", re.S)


def count(sql: str) -> int:
    return sum(1 for m in _SKIP_OR_MARK.finditer(sql) if m.group(1))


_ID_LIST = re.compile(_SKIP_OR_MARK.pattern.replace(
    r"(\?)", r"(?P<no>\bnot\s+)?\bin\s*\(\s*(?P<mark>\?)\s*\)"), re.S | re.I)


def without_id_list(sql: str) -> str:
    """``<expr> in (?)`` becomes ``<expr> is not null``: the rows are then chosen around the text,
    by a filter that the scan or the database evaluates."""
    def put(m):
        if not m["mark"]:
            return m[0]
        if m["no"]:
            raise ValueError("an id list cannot be negated")
        return "is not null"
    return _ID_LIST.sub(put, sql)


def fill(sql: str, texts) -> str:
    """Replace the placeholders, in order, by the given SQL texts."""
    texts = list(texts)
    if count(sql) != len(texts):
        raise ValueError(f"the SQL has {count(sql)} placeholders, {len(texts)} values were given")
    remaining = iter(texts)
    return _SKIP_OR_MARK.sub(lambda m: next(remaining) if m.group(1) else m.group(0), sql)


def window_values(sql: str, lo, hi) -> list:
    """lo, hi for every pair of placeholders."""
    n = count(sql)
    if n == 0 or n % 2:
        raise ValueError(f"a sync SQL needs pairs of placeholders (start, end); it has {n}")
    return [lo, hi] * (n // 2)
