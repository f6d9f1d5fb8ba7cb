"""DuckDB statements for the registered queries, written from the rules alone.

A statement is a final SELECT plus the named sub-queries it mentions, directly or
through others.  They are plain joins and groupings over the rules' own values, and
import nothing from the library.
"""

from __future__ import annotations

import re

from oracle.entities import ENTITIES
from oracle.finals import finals
from oracle.tables import TABLES

_PARTS = TABLES | ENTITIES


def _mentioned(sql: str) -> list[str]:
    words = set(re.findall(r"[a-z_][a-z0-9_]*", sql))
    return [name for name in _PARTS if name in words]


def _closure(sql: str) -> list[str]:
    wanted: set[str] = set()
    queue = _mentioned(sql)
    while queue:
        name = queue.pop()
        if name not in wanted:
            wanted.add(name)
            queue += [n for n in _mentioned(_PARTS[name]) if n != name]
    return [name for name in _PARTS if name in wanted]


def with_parts(final: str) -> str:
    names = _closure(final)
    if not names:
        return final
    return "WITH " + ",\n".join(f"{n} AS ({_PARTS[n].strip()})" for n in names) + "\n" + final


def statements() -> dict[str, str]:
    return {name: with_parts(sql.strip()) for name, sql in finals().items()}
