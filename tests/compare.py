"""Run a registered query and its oracle and compare them as bags of rows."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb


def oracle_rows(sql: str, sf_dir: str) -> tuple[list[str], Counter]:
    connection = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    result = connection.execute(sql)
    names = [column[0] for column in result.description]
    return _bag(names, result.fetchall())


def spark_rows(frame) -> tuple[list[str], Counter]:
    return _bag(frame.columns, [tuple(row) for row in frame.collect()])


def _bag(names: list[str], rows: list[tuple]) -> tuple[list[str], Counter]:
    order = sorted(range(len(names)), key=names.__getitem__)
    return [names[i] for i in order], Counter(tuple(row[i] for i in order) for row in rows)
