"""Named SQL building blocks and the function that strings them together."""

from __future__ import annotations

import re

from oracles import bout_sql, revenue_sql

BLOCKS: dict[str, str] = {**revenue_sql.BLOCKS, **bout_sql.BLOCKS}


def _words(sql: str) -> set[str]:
    return set(re.findall(r"[a-z_0-9]+", sql))


def assemble(final: str) -> str:
    """``final`` preceded by the blocks it names, directly or through other blocks."""
    needed: list[str] = []

    def visit(sql: str) -> None:
        for name in BLOCKS:
            if name in _words(sql) and name not in needed:
                visit(BLOCKS[name])
                needed.append(name)

    visit(final)
    if not needed:
        return final
    blocks = ",\n".join(f"{name} AS ({BLOCKS[name]})" for name in needed)
    return f"WITH {blocks}\n{final}"
