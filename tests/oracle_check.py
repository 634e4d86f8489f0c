"""Compare registered queries with their DuckDB oracle (row count, columns, values)."""

from __future__ import annotations

import hashlib
import os
import sys

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return "\x00"
    if isinstance(v, float):
        return repr(round(v, 9))
    return str(v)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("\x1f".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, name, query, sql, sf_dir, con=None):
    con = con or duck(sf_dir)
    df = query(spark, sf_dir)
    cols = df.columns
    rows = [tuple(r) for r in df.collect()]
    rel = con.sql(sql)
    ocols = rel.columns
    orows = rel.fetchall()
    res = {"name": name, "rows": len(rows), "oracle_rows": len(orows),
           "cols_match": sorted(cols) == sorted(ocols)}
    if res["cols_match"]:
        res["values_match"] = _digest(cols, rows) == _digest(ocols, orows)
    else:
        res["values_match"] = False
        res["col_diff"] = (sorted(set(cols) - set(ocols))[:5], sorted(set(ocols) - set(cols))[:5])
    res["ok"] = res["cols_match"] and res["values_match"] and len(rows) == len(orows)
    if not res["ok"] and res["cols_match"]:
        order = sorted(range(len(cols)), key=lambda i: cols[i])
        oorder = sorted(range(len(ocols)), key=lambda i: ocols[i])
        a = {tuple(_norm(r[i]) for i in order) for r in rows}
        b = {tuple(_norm(r[i]) for i in oorder) for r in orows}
        names = [cols[i] for i in order]
        only_a, only_b = sorted(a - b)[:1], sorted(b - a)[:1]
        if only_a and only_b:
            res["first_diff"] = [(n, x, y) for n, x, y in zip(names, only_a[0], only_b[0]) if x != y][:6]
        else:
            res["first_diff"] = (only_a, only_b)
    return res


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as E
    from unfurl.session import get_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    only = sys.argv[2:] or None
    spark = get_session("oracle-check", master="local[8]", shuffle_partitions=8)
    con = duck(sf)
    qs, ors = E.queries(), E.oracle_sql()
    for name in qs:
        if only and name not in only:
            continue
        try:
            r = compare(spark, name, qs[name], ors[name], sf, con) if name in ors else {"name": name, "ok": None}
        except Exception as e:  # report and go on
            r = {"name": name, "ok": False, "error": str(e).split("\n")[0][:300]}
        print(r, flush=True)
