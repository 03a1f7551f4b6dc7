"""Run registered queries beside their SQL and compare all rows.

    python -m tests.compare [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

import __spark_entry__ as spark_entry


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for file in Path(sf_dir).glob("*.parquet"):
        source = file / "*.parquet" if file.is_dir() else file
        con.execute(f"create view {file.stem} as select * from read_parquet('{source}')")
    return con


def _plain(value):
    """One spelling per value: whole numbers stay whole, doubles stay doubles."""
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return repr(value + 0.0) if isinstance(value, float) else repr(value)


def _table(names: list[str], rows: list[tuple]) -> tuple[list[str], list[str]]:
    order = sorted(range(len(names)), key=names.__getitem__)
    texts = sorted(" | ".join(_plain(row[place]) for place in order) for row in rows)
    return [names[place] for place in order], texts


def difference(ours, theirs) -> str | None:
    """What differs between two (names, rows) results, whatever their order; None if nothing."""
    (names, rows), (other_names, other_rows) = _table(*ours), _table(*theirs)
    if names != other_names:
        return f"columns {names} / {other_names}"
    if len(rows) != len(other_rows):
        return f"{len(rows)} / {len(other_rows)} rows"
    pairs = [(a, b) for a, b in zip(rows, other_rows) if a != b]
    return f"{len(pairs)} rows differ, first: {pairs[0]}" if pairs else None


# Column types that must agree, by the names the two engines give them.
TYPES = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def check(spark, con, name: str, sf_dir: str) -> str | None:
    ours = spark_entry.queries()[name](spark, sf_dir)
    theirs = con.execute(spark_entry.oracle_sql()[name])
    types = {column[0]: str(column[1]) for column in theirs.description}
    wrong = {
        column: (kind, types.get(column))
        for column, kind in ours.dtypes
        if TYPES[kind] != types.get(column)
    }
    if wrong:
        return f"types {wrong}"
    return difference(
        (ours.columns, [tuple(row) for row in ours.collect()]), (list(types), theirs.fetchall())
    )


def main() -> int:
    from tests.conftest import open_test_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(spark_entry.queries())
    spark, con = open_test_session(), database(sf_dir)
    failed = 0
    for name in names:
        start = time.time()
        try:
            found = check(spark, con, name, sf_dir)
        except Exception as error:  # noqa: BLE001
            found = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += found is not None
        print(f"{name:26} {time.time() - start:6.2f} s  {found or 'equal'}", flush=True)
    print(f"{len(names) - failed} of {len(names)} equal")
    return failed


if __name__ == "__main__":
    sys.exit(main())
