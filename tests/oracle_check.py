"""Compare every registered query with its DuckDB oracle (as the driver does).

Usage: python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import hashlib
import json
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
import pandas as pd  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()

SPARK_TO_DUCK = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "float": "FLOAT", "string": "VARCHAR",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "date": "DATE", "smallint": "SMALLINT",
}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float):
        return round(v, 6)
    if hasattr(v, "isoformat"):
        return pd.Timestamp(v).isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def digest(rows: list[tuple], cols: list[str]) -> str:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted(json.dumps([_norm(r[i]) for i in order], default=str, ensure_ascii=False) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


def compare(spark, sf_dir: str, names: list[str] | None = None) -> dict:
    import __spark_entry__ as E

    qs, sql = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    out = {}
    for name, fn in qs.items():
        if names and name not in names:
            continue
        rec = {}
        t0 = time.time()
        try:
            df = fn(spark, sf_dir)
            srows = [tuple(r) for r in df.collect()]
            scols = df.columns
            stypes = {f.name: f.dataType.simpleString() for f in df.schema.fields}
            rec["spark_rows"] = len(srows)
            rec["spark_sec"] = round(time.time() - t0, 2)
            if name in sql:
                res = con.sql(sql[name])
                drows = res.fetchall()
                dcols = res.columns
                dtypes = {c: str(t) for c, t in zip(res.columns, res.types)}
                rec["duck_rows"] = len(drows)
                rec["cols_match"] = sorted(scols) == sorted(dcols)
                mism = {c: (stypes.get(c), dtypes.get(c)) for c in scols
                        if SPARK_TO_DUCK.get(stypes.get(c), stypes.get(c)) != dtypes.get(c)}
                rec["type_mismatch"] = mism
                rec["hash_match"] = digest(srows, scols) == digest(drows, dcols) if rec["cols_match"] else False
                rec["ok"] = rec["cols_match"] and not mism and rec["hash_match"] and len(srows) == len(drows)
            else:
                rec["ok"] = None
        except Exception as e:  # report and go on
            rec["error"] = f"{type(e).__name__}: {str(e)[:400]}"
            rec["ok"] = False
        out[name] = rec
        print(name, json.dumps(rec, ensure_ascii=False), flush=True)
    return out


if __name__ == "__main__":
    from obsgrid.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(int(os.environ.get("CORES", "8")))
    res = compare(spark, sf, sys.argv[2:] or None)
    bad = [k for k, v in res.items() if v.get("ok") is False]
    print("FAILED:", bad)
    print(f"{sum(1 for v in res.values() if v.get('ok'))} ok / {len(res)}")
