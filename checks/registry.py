"""Registered queries, each with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def check(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(query: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = query
        if sql is not None:
            ORACLES[name] = sql
        return query

    return register


def pivot_sql(
    cte: str,
    source: str,
    keys: Sequence[str],
    cells: dict[str, str],
    month: str | None = None,
    months: Sequence[str] = (),
    total: str | None = "Total",
    fill: bool = True,
    number_keys: Sequence[str] = (),
) -> str:
    """Pivot report in SQL. ``cells`` maps a measure to its aggregate, with ``{}`` around the counted expression,
    which becomes a CASE on the month in a month column."""
    first = keys[0]
    top = f"GROUPING({first}) = 1"
    out = []
    for key in keys:
        if not total:
            out.append(key)
        elif key == first:
            out.append(f"CASE WHEN {top} THEN '{total}' ELSE CAST({key} AS VARCHAR) END AS {key}")
        else:
            blank = "NULL" if key in number_keys else "''"
            out.append(f"CASE WHEN {top} THEN {blank} ELSE {key} END AS {key}")
    if total:
        out.append(f"{top} AS is_total")
    for name, aggregate in cells.items():
        columns = {}
        if month:
            columns = {f"{name}_{m}": (f"CASE WHEN {month} = '{m}' THEN ", " END") for m in months}
        if not month or total:
            columns[f"{name}_Total" if month else name] = ("", "")
        for column, (before, after) in columns.items():
            value = aggregate.replace("[", before).replace("]", after)
            out.append(f'coalesce({value}, 0) AS "{column}"' if fill else f'{value} AS "{column}"')
    present = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    grouping = f"GROUPING SETS (({', '.join(keys)}), ())" if total else ", ".join(keys)
    return (
        f"WITH {cte}\nSELECT {', '.join(out)}\nFROM (SELECT * FROM ({source}) AS s WHERE {present}) AS rows_in\n"
        f"GROUP BY {grouping}"
    )
