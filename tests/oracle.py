"""Runs a query and its SQL twin on the same tables."""

import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def cell(x):
    if isinstance(x, float):
        return "nan" if math.isnan(x) else f"{x:.9g}"
    return str(x)


def compared(spark, query, sql, sf_dir):
    """(rows of the query, rows of the SQL), sorted, columns by name."""
    df = query(spark, sf_dir)
    names = sorted(df.columns)
    mine = sorted(tuple(cell(r[n]) for n in names) for r in df.collect())
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    rows = con.execute(f"SELECT {', '.join(names)} FROM ({sql})").fetchall()
    return mine, sorted(tuple(map(cell, r)) for r in rows)
