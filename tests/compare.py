"""Row-by-row comparison of a registered query with its SQL, on whole tables."""

import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"create view {name} as select * from '{path}'")
    return con


def normal(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(None if row[i] is None else f"{row[i]:.9g}" if isinstance(row[i], float) else str(row[i])
               for i in order) for row in rows),
        key=repr,
    )


def differences(df, con, sql):
    """Rows only on one side, and the two column lists."""
    got = normal([tuple(r) for r in df.collect()], df.columns)
    res = con.execute(sql)
    columns = [d[0] for d in res.description]
    want = normal(res.fetchall(), columns)
    types = dict(zip(columns, [str(d[1]) for d in res.description]))
    from collections import Counter

    a, b = Counter(got), Counter(want)
    return {
        "columns": (sorted(df.columns), sorted(columns)),
        "types": (dict(df.dtypes), types),
        "rows": (len(got), len(want)),
        "only_spark": list((a - b).elements())[:3],
        "only_sql": list((b - a).elements())[:3],
    }
