"""Run a registered Spark query and its DuckDB oracle side by side and compare
(row count, column names, order-insensitive values), like the driver."""

from __future__ import annotations

import math
import sys

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


# DuckDB type names -> Spark simple strings, for the schema part of the compare
DUCK_TYPES = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
              "BOOLEAN": "boolean", "FLOAT": "float", "TIMESTAMP": "timestamp_ntz", "SMALLINT": "smallint"}


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 9)
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def compare(spark, sf_dir: str, name: str, fn, sql: str, con=None):
    con = con or duck(sf_dir)
    sdf = fn(spark, sf_dir)
    s_cols = sorted(sdf.columns)
    s_rows = [tuple(_norm(r[c]) for c in s_cols) for r in sdf.collect()]
    rel = con.execute(sql)
    d_cols = [d[0] for d in rel.description]
    d_types = {d[0]: DUCK_TYPES.get(str(d[1]).split("(")[0], str(d[1])) for d in rel.description}
    s_types = {f.name: f.dataType.simpleString() for f in sdf.schema.fields}
    d_raw = rel.fetchall()
    order = sorted(range(len(d_cols)), key=lambda i: d_cols[i])
    d_rows = [tuple(_norm(r[i]) for i in order) for r in d_raw]
    d_cols = sorted(d_cols)
    key = lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t)
    res = {"name": name, "spark_rows": len(s_rows), "oracle_rows": len(d_rows),
           "cols_match": s_cols == d_cols}
    if not res["cols_match"]:
        res["spark_cols"], res["oracle_cols"] = s_cols, d_cols
        res["match"] = False
        return res
    try:
        a, b = sorted(s_rows, key=key), sorted(d_rows, key=key)
    except TypeError:
        a, b = sorted(s_rows, key=str), sorted(d_rows, key=str)
    diff = [(x, y) for x, y in zip(a, b) if x != y]
    tdiff = {k: (s_types.get(k), d_types.get(k)) for k in s_types if s_types.get(k) != d_types.get(k)}
    res["match"] = len(a) == len(b) and not diff and not tdiff
    if tdiff:
        res["type_diff"] = tdiff
    if diff:
        res["n_diff"] = len(diff)
        res["first_diff"] = diff[:2]
    return res


if __name__ == "__main__":
    sys.path.insert(0, "/root/repo")
    import time
    import __spark_entry__ as E
    from tabflow.session import get_spark
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:] 
    spark = get_spark("local[8]", 8)
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf)
    bad = 0
    for n, fn in qs.items():
        if only and n not in only:
            continue
        t = time.time()
        if n not in sqls:
            try:
                rows = fn(spark, sf).count()
                print(f"ROWS  {n}: {rows} rows  {time.time()-t:.1f}s", flush=True)
            except Exception as e:  # noqa: BLE001
                bad += 1
                print(f"FAIL  {n} {repr(e)[:600]}", flush=True)
            continue
        try:
            r = compare(spark, sf, n, fn, sqls[n], con)
        except Exception as e:  # noqa: BLE001
            r = {"name": n, "match": False, "error": repr(e)[:600]}
        bad += not r["match"]
        print(("OK    " if r["match"] else "FAIL  ") + f"{n} {time.time()-t:.1f}s " +
              ("" if r["match"] else str(r)), flush=True)
    print("failures:", bad)
