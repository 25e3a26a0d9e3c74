"""Compare a named query with its SQL on a folder of tables."""

import glob
import math
import os

import duckdb


def connect(folder):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        source = f"{path}/*.parquet" if os.path.isdir(path) else path
        con.execute(f"create view {name} as select * from read_parquet('{source}')")
    return con


def canonical(table):
    names = sorted(table.column_names)
    cells = [table.column(n).to_pylist() for n in names]
    return names, sorted(zip(*cells), key=repr)


def close(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return a == b or math.isclose(a, b, rel_tol=1e-9, abs_tol=1.1e-6)
    return a == b


def check(spark, con, folder, fn, sql):
    names, got = canonical(fn(spark, folder).toArrow())
    sql_names, want = canonical(con.sql(sql).to_arrow_table())
    assert names == sql_names
    assert len(got) == len(want)
    differing = [
        (g, w) for g, w in zip(got, want) if not all(close(a, b) for a, b in zip(g, w))
    ]
    assert not differing, (names, differing[:3])
