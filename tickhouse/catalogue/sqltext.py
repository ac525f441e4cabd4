"""Assembles SQL texts from named common table expressions."""

from __future__ import annotations

import re


class Ctes:
    """Named CTE bodies; a query pulls in the ones it mentions, in definition order."""

    def __init__(self) -> None:
        self._bodies: dict[str, str] = {}

    def add(self, name: str, body: str) -> None:
        self._bodies[name] = body.strip()

    def _needs(self, text: str) -> set[str]:
        words = set(re.findall(r"[a-z_][a-z0-9_]*", text))
        return words & self._bodies.keys()

    def query(self, body: str) -> str:
        wanted: set[str] = set()
        frontier = self._needs(body)
        while frontier:
            name = frontier.pop()
            if name not in wanted:
                wanted.add(name)
                frontier |= self._needs(self._bodies[name]) - wanted
        used = [f"{n} AS (\n{b}\n)" for n, b in self._bodies.items() if n in wanted]
        prefix = "WITH " + ",\n".join(used) + "\n" if used else ""
        return prefix + body.strip()


def r6(expr: str) -> str:
    """Half-up at six digits. DuckDB rounds doubles in binary, so go through a decimal."""
    return f"CAST(round(CAST({expr} AS DECIMAL(38,12)), 6) AS DOUBLE)"


def dbl(expr: str, alias: str) -> str:
    """A rounded double, as the registered queries present numbers."""
    return f"{r6(expr)} AS {alias}"


def dbls(*columns: str) -> str:
    return ", ".join(dbl(c, c) for c in columns)


def mean(expr: str, scale: int = 6) -> str:
    """Average at ``scale`` digits, half up, in integer arithmetic."""
    unit = 10**scale
    units = f"CAST(CAST({expr} AS DECIMAL(26,{scale})) * {unit} AS HUGEINT)"
    total, n = f"sum({units})", f"count({expr})"
    return f"CAST(sign({total}) * ((2 * abs({total}) + {n}) // (2 * {n})) AS DOUBLE) / {unit}"
