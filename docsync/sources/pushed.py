"""Change-time conditions in a SQL text, written so that the scan can evaluate them.

``coalesce(mod, create) > ?`` is never pushed to a scan. The same condition per column,
``mod is not null and mod > ? or mod is null and create > ?``, is: it is true, false and unknown for
the same rows, so it may stand anywhere in the text, also under a ``not``.
"""

from __future__ import annotations

import re

from docsync.sources.params import SKIPPED

_PART = r"(?:[A-Za-z_][\w$]*|`[^`]+`)"
_NAME = rf"{_PART}(?:\s*\.\s*{_PART})*"
_CHANGE = rf"\b(?:coalesce|nvl|ifnull)\s*\(\s*(?P<{{0}}m>{_NAME})\s*,\s*(?P<{{0}}c>{_NAME})\s*\)"
_OP = r"(?P<{0}op><=|>=|<|>|=(?!=))"
_TOKEN = re.compile("|".join((
    SKIPPED,
    (_CHANGE + r"\s+between\s+\?\s+and\s+\?").format("b"),
    (_CHANGE + r"\s*" + _OP + r"\s*\?").format("l"),
    (r"\?\s*" + _OP + r"\s*" + _CHANGE).format("r"),
    r"(?P<mark>\?)")), re.S | re.I)
_TURNED = {"<": ">", ">": "<", "<=": ">=", ">=": "<=", "=": "="}


def _last_name(name: str) -> str:
    return name.rpartition(".")[2].strip().strip("`").lower()


def per_column(sql: str, values, created_first: str | None = None) -> tuple[str, list]:
    """The text with every such condition per column, and the values of its ``?`` in order.

    ``created_first`` names a creation column that is known never to lie after the modification.
    An upper bound of the change time is then one of the creation time too, which a scan can use
    even where the modification time comes from another table.
    """
    values, out = list(values), []
    taken = 0

    def condition(m: str, c: str, op: str, value) -> str:
        out.extend((value, value))
        text = f"(({m} is not null and {m} {op} ?) or ({m} is null and {c} {op} ?))"
        if created_first and op in ("<", "<=") and _last_name(c) == created_first.lower():
            out.append(value)
            text = f"({text} and ({c} is null or {c} {op} ?))"
        return text

    def put(found: re.Match) -> str:
        nonlocal taken
        if found["bm"]:
            low, high = values[taken:taken + 2]
            taken += 2
            return (f"({condition(found['bm'], found['bc'], '>=', low)} and "
                    f"{condition(found['bm'], found['bc'], '<=', high)})")
        for side in ("l", "r"):
            if found[f"{side}m"]:
                op = found[f"{side}op"]
                taken += 1
                return condition(found[f"{side}m"], found[f"{side}c"],
                                 op if side == "l" else _TURNED[op], values[taken - 1])
        if found["mark"]:
            out.append(values[taken])
            taken += 1
        return found[0]
    text = _TOKEN.sub(put, sql)
    return text, out
