"""Runs a registered query on Spark and its oracle on DuckDB and compares the two results."""

from __future__ import annotations

import datetime
import decimal
import math
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def oracle_connection(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    if isinstance(value, decimal.Decimal):
        return round(float(value), 6)
    if isinstance(value, (list, tuple)) and not hasattr(value, "asDict"):
        return tuple(_plain(v) for v in value)
    if hasattr(value, "asDict"):
        return tuple(sorted((k, _plain(v)) for k, v in value.asDict().items()))
    if isinstance(value, dict):
        return tuple(sorted((k, _plain(v)) for k, v in value.items()))
    if isinstance(value, (datetime.datetime, datetime.date)):
        return value.isoformat()
    if isinstance(value, bytearray):
        return bytes(value)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, sf_dir, name, query, sql):
    """A report dict; ``ok`` is true when names, row count and values agree."""
    began = time.time()
    df = query(spark, sf_dir)
    mine = rows_of(df.columns, df.collect())
    spark_sec = time.time() - began
    report = {"name": name, "rows": len(mine), "sec": round(spark_sec, 2), "ok": True, "why": ""}
    if sql is None:
        return report
    began = time.time()
    cur = con.execute(sql)
    columns = [d[0] for d in cur.description]
    theirs = rows_of(columns, cur.fetchall())
    report["oracle_sec"] = round(time.time() - began, 2)
    types = {d[0]: str(d[1]) for d in cur.description}
    for field in df.schema.fields:
        if types.get(field.name, "").upper() == "HUGEINT":
            report["why"] += f"[{field.name} is HUGEINT in the oracle] "
    if sorted(columns) != sorted(df.columns):
        report.update(ok=False, why=f"columns {sorted(df.columns)} vs {sorted(columns)}")
    elif len(mine) != len(theirs):
        report.update(ok=False, why=f"rows {len(mine)} vs {len(theirs)}")
    elif mine != theirs:
        left, right = set(mine) - set(theirs), set(theirs) - set(mine)
        show = "\n".join(f"   spark  {a}\n   oracle {b}" for a, b in list(zip(sorted(left, key=repr), sorted(right, key=repr)))[:3])
        report.update(ok=False, why=f"{len(left)} rows differ, e.g. {sorted(columns)}\n{show}")
    return report
