"""Spark result vs DuckDB oracle: row count, column names/types, values.

Run standalone: ``python -m tests.harness [sf_dir] [name ...]``.
Values are compared order-insensitively with columns sorted by name, doubles
rounded to 6 decimals — the same shape of check the driver makes.
"""

from __future__ import annotations

import datetime as dt
import decimal
import sys
import time

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

_SPARK_TO_DUCK = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP", "boolean": "BOOLEAN",
    "array<string>": "VARCHAR[]", "float": "FLOAT", "smallint": "SMALLINT", "tinyint": "TINYINT",
    "array<bigint>": "BIGINT[]", "array<int>": "INTEGER[]",
}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "asDict"):
        return tuple(_norm(x) for x in v)
    return v


def _rows(rows, order):
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def compare(spark, name: str, sf_dir: str, con=None) -> dict:
    from __spark_entry__ import oracle_sql, queries

    con = con or duck(sf_dir)
    t0 = time.time()
    sdf = queries()[name](spark, sf_dir)
    srows = sdf.collect()
    t1 = time.time()
    scols = [f.name for f in sdf.schema.fields]
    stypes = [f.dataType.simpleString() for f in sdf.schema.fields]
    res = {"name": name, "spark_rows": len(srows), "spark_sec": round(t1 - t0, 2)}
    sql = oracle_sql().get(name)
    if sql is None:
        res["oracle"] = "none"
        return res
    rel = con.sql(sql)
    dcols = list(rel.columns)
    dtypes = [str(t) for t in rel.types]
    drows = rel.fetchall()
    res["oracle_rows"] = len(drows)
    res["names_ok"] = sorted(scols) == sorted(dcols)
    if not res["names_ok"]:
        res["names"] = (scols, dcols)
        res["ok"] = False
        return res
    smap = dict(zip(scols, stypes))
    dmap = dict(zip(dcols, dtypes))
    bad_types = {c: (smap[c], dmap[c]) for c in scols if _SPARK_TO_DUCK.get(smap[c], smap[c]) != dmap[c]}
    res["types_ok"] = not bad_types
    if bad_types:
        res["types"] = bad_types
    names = sorted(scols)
    a = _rows(srows, [scols.index(c) for c in names])
    b = _rows(drows, [dcols.index(c) for c in names])
    res["values_ok"] = a == b
    if not res["values_ok"]:
        sa, sb = set(a), set(b)
        res["only_spark"] = sorted(sa - sb, key=str)[:3]
        res["only_oracle"] = sorted(sb - sa, key=str)[:3]
    res["ok"] = res["values_ok"] and res["types_ok"] and len(srows) == len(drows)
    return res


def main(argv: list[str]) -> int:
    from stratum.session import build_local
    from __spark_entry__ import queries

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(queries())
    spark = build_local()
    con = duck(sf_dir)
    bad = 0
    for n in names:
        try:
            r = compare(spark, n, sf_dir, con)
        except Exception as exc:  # report and go on
            r = {"name": n, "ok": False, "error": repr(exc)[:400]}
        if r.get("ok") is False:
            bad += 1
        print(r, flush=True)
    print(f"FAILED {bad} of {len(names)}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
