"""Pieces of SQL that the checks share."""

from __future__ import annotations


def rounded(num: str, den: str, digits: int, times: int = 1) -> str:
    """num * times / den rounded half away from zero, from whole numbers only."""
    n, d = f"CAST({num} AS HUGEINT)", f"CAST({den} AS HUGEINT)"
    scaled = f"(2 * abs({n}) * {times * 10**digits} + {d}) // (2 * {d})"
    value = f"sign({n}) * ({scaled}) / {10**digits}"
    return f"CASE WHEN ({den}) <> 0 THEN CAST({value} AS DECIMAL(18,{digits})) END"


def cut(num: str, den: str, times: int = 1) -> str:
    """num / den cut to six digits, then times a whole number."""
    value = f"((CAST({num} AS HUGEINT) * 1000000) // ({den})) * {times} / 1000000"
    return f"CASE WHEN ({den}) <> 0 THEN CAST({value} AS DECIMAL(18,6)) END"


def us_week(day: str) -> str:
    return (
        f"CAST((dayofyear({day}) + dayofweek(date_trunc('year', {day})) - 1) // 7 + 1 AS INTEGER)"
    )


def values(name: str, columns: str, rows: list[tuple]) -> str:
    def cell(value):
        if value is None:
            return "NULL"
        return f"'{value}'" if isinstance(value, str) else str(value)

    body = ", ".join(f"({', '.join(cell(v) for v in row)})" for row in rows)
    return f"{name}({columns}) AS (VALUES {body})"


def with_inputs(inputs: dict[str, str], body: str) -> str:
    """The body behind the input definitions."""
    ctes = [text if "(" in name else f"{name} AS ({text})" for name, text in inputs.items()]
    return "WITH RECURSIVE " + ",\n".join(ctes) + "\n" + body.strip()
