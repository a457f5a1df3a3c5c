"""Rows of a Spark frame against rows of a DuckDB query."""

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return None if v != v else round(v, 6)
    if hasattr(v, "isoformat"):
        return str(v)
    return v


def rows(names, records):
    at = sorted(range(len(names)), key=lambda k: names[k])
    return sorted((tuple(plain(r[k]) for k in at) for r in records), key=lambda r: tuple((x is None, str(x)) for x in r))


def same(df, con, sql):
    found = con.sql(sql)
    assert sorted(df.columns) == sorted(found.columns)
    assert rows(df.columns, df.collect()) == rows(found.columns, found.fetchall())
