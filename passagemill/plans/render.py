"""Plain-text display of reports: a line for each plain value, a table for rows of plain values, deeper things two blanks further in."""

from __future__ import annotations

import json
from collections.abc import Iterator
from typing import Any

#: What is shown where there is nothing. Fixed values.
NO_FIELDS, NO_RECORDS = "No fields.", "No records."
#: The key of a list of changed settings, which have lines of their own.
OVERRIDES = "overrides"

Line = tuple[int, str]


def label(key: str) -> str:
    return key.replace("_", " ").strip().capitalize()


def plain(value: Any) -> str:
    """Texts as they are, all else as JSON."""
    return value if isinstance(value, str) else json.dumps(value, ensure_ascii=False, sort_keys=True, default=str)


def nested(value: Any) -> bool:
    return isinstance(value, (dict, list, tuple))


def table(rows: list[dict[str, Any]]) -> list[str]:
    """Rows of plain values under their labels and a rule, columns in the order in which they first occur."""
    names = list(dict.fromkeys(k for row in rows for k in row))
    cells = [[label(str(n)) for n in names], *([plain(row.get(n)) for n in names] for row in rows)]
    widths = [max(map(len, column)) for column in zip(*cells)]
    cells.insert(1, ["-" * w for w in widths])
    return ["  ".join(cell.ljust(w) for cell, w in zip(row, widths)) for row in cells]


def _override(item: Any) -> str:
    if not isinstance(item, dict):
        return f"- {plain(item)}"
    key, previous, effective, source = (plain(item.get(k)) for k in ("key", "previous", "effective", "source"))
    return f"{key}: {previous} -> {effective} ({source})"


def _listed(items: list | tuple, depth: int) -> Iterator[Line]:
    if not items:
        yield depth, NO_RECORDS
    elif all(isinstance(x, dict) for x in items) and any(items) and not any(nested(v) for x in items for v in x.values()):
        yield from ((depth, line) for line in table(list(items)))
    else:
        for n, item in enumerate(items, 1):
            if nested(item):
                yield depth, f"Record {n}:"
                yield from _lines(item, depth + 1)
            else:
                yield depth, f"- {plain(item)}"


def _lines(value: Any, depth: int) -> Iterator[Line]:
    if isinstance(value, dict):
        for key, inner in value.items():
            if not nested(inner):
                yield depth, f"{label(str(key))}: {plain(inner)}"
                continue
            yield depth, f"{label(str(key))}:"
            if key == OVERRIDES and inner and isinstance(inner, list):
                yield from ((depth + 1, _override(x)) for x in inner)
            else:
                yield from _lines(inner, depth + 1)
        if not value:
            yield depth, NO_FIELDS
    elif nested(value):
        yield from _listed(value, depth)
    else:
        yield depth, plain(value)


def human(value: Any) -> str:
    return "\n".join("  " * depth + text for depth, text in _lines(value, 0))
