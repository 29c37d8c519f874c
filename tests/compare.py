"""Row-set comparison between a Spark DataFrame and a DuckDB relation."""

from __future__ import annotations

from collections import Counter


def spark_rows(df):
    names = sorted(df.columns)
    return names, Counter(tuple(row[n] for n in names) for row in df.collect())


def duck_rows(con, sql):
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = Counter(tuple(row[i] for i in order) for row in cursor.fetchall())
    return sorted(names), rows


def assert_same(df, con, sql):
    names, rows = spark_rows(df)
    oracle_names, oracle_rows = duck_rows(con, sql)
    assert names == oracle_names
    assert rows == oracle_rows, (
        f"only in Spark {list((rows - oracle_rows).items())[:5]}, "
        f"only in the oracle {list((oracle_rows - rows).items())[:5]}"
    )
    return sum(rows.values())
