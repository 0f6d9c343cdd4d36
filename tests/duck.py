"""Compares a query's rows with its DuckDB SQL."""

import os

import duckdb


def norm(v):
    if isinstance(v, float):
        return None if v != v else round(v, 6) + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(map(norm, v))
    return v


def ordered(columns, rows):
    at = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(norm(r[i]) for i in at) for r in rows), key=repr)


def oracle(sql, sf_dir):
    con = duckdb.connect()
    for f in os.listdir(sf_dir):
        path = os.path.join(sf_dir, f)
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{path if os.path.isfile(path) else path + '/*.parquet'}'")
    got = con.execute(sql)
    return [d[0] for d in got.description], got.fetchall()


def same(df, sql, sf_dir):
    columns, rows = oracle(sql, sf_dir)
    assert sorted(columns) == sorted(df.columns)
    assert ordered(df.columns, df.collect()) == ordered(columns, rows)
