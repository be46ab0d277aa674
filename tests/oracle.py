"""Row-by-row comparison of registered queries with their SQL equivalents."""

import math
from pathlib import Path

import duckdb


def connect(folder):
    connection = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def sql_rows(connection, sql):
    result = connection.execute(sql)
    names = [column[0] for column in result.description]
    return names, result.fetchall()


def spark_rows(df):
    return df.columns, [tuple(row) for row in df.collect()]


def ordered(names, rows):
    """Rows with columns by name, sorted by their exact values."""
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = [tuple(row[i] for i in order) for row in rows]
    return sorted(names), sorted(rows, key=lambda row: tuple((x is None, str(type(x)), x) for x in row))


def same(a, b, tolerance=0.0):
    if isinstance(a, float) and isinstance(b, float):
        return a == b or math.isclose(a, b, rel_tol=0.0, abs_tol=tolerance)
    return a == b and type(a) is type(b)


def difference(spark_result, sql_result, tolerance=0.0):
    """None if equal, else a short description of the first difference."""
    (names, rows), (other_names, other_rows) = ordered(*spark_result), ordered(*sql_result)
    if names != other_names:
        return f"columns {names} against {other_names}"
    if len(rows) != len(other_rows):
        return f"{len(rows)} rows against {len(other_rows)}"
    wrong = [
        (row, other)
        for row, other in zip(rows, other_rows)
        if not all(same(a, b, tolerance) for a, b in zip(row, other))
    ]
    return f"{len(wrong)} of {len(rows)} rows differ, first {wrong[0]}" if wrong else None
