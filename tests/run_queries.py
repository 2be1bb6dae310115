"""Compare registered queries with their oracles: ``python tests/run_queries.py [sf or folder] [name ...]``."""

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

import __spark_entry__ as entry
from compare import compare, oracle_connection

from ledgerlens.session import build_session


def main(sf: str, names: list[str]) -> int:
    sf_dir = sf if "/" in sf else f"/root/testdata/sf{sf}"
    spark = build_session(
        "compare", "local[8]", spark__ui__enabled="false", spark__sql__shuffle__partitions="8",
        spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle_connection(sf_dir)
    queries, oracles, failed = entry.queries(), entry.oracle_sql(), 0
    for name in names or sorted(queries):
        try:
            r = compare(spark, con, sf_dir, name, queries[name], oracles.get(name))
        except Exception as error:  # noqa: BLE001 - reported per query
            r = {"name": name, "ok": False, "why": f"{type(error).__name__}: {str(error)[:1200]}", "rows": -1, "sec": -1}
        failed += not r["ok"]
        print("ok  " if r["ok"] else "FAIL", name, r["rows"], "rows", r["sec"], "s", r.get("oracle_sec", "no oracle"), r["why"], flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    raise SystemExit(main(sf, sys.argv[2:]))
