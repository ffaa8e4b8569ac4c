"""Run every registered query against its DuckDB oracle (like the driver).

usage: python tests/run_oracle.py [sf_dir] [key-substring ...]
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oracle_compare import compare, duck_connect  # noqa: E402

import __spark_entry__ as E  # noqa: E402
from sessionlens.session import get_spark  # noqa: E402


def main():
    args = sys.argv[1:]
    sf_dir = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    pats = [a for a in args if not a.startswith("/")]
    spark = get_spark(master="local[8]", shuffle_partitions=8,
                      extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="ckpt-", dir="/tmp")})
    spark.sparkContext.setLogLevel("ERROR")
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck_connect(sf_dir)
    results, bad = {}, []
    for k in qs:
        if pats and not any(p in k for p in pats):
            continue
        t0 = time.time()
        try:
            df = qs[k](spark, sf_dir)
            if k in sqls:
                r = compare(df, sqls[k], con)
            else:
                r = {"rows_only": df.count(), "ok": True}
        except Exception as e:  # noqa: BLE001
            r = {"ok": False, "error": f"{type(e).__name__}: {str(e)[:400]}"}
            if os.environ.get("TRACE"):
                traceback.print_exc()
        r["sec"] = round(time.time() - t0, 2)
        results[k] = r
        flag = "OK " if r.get("ok") else "BAD"
        extra = ""
        if r.get("type_diffs"):
            extra += f" types={r['type_diffs']}"
        if r.get("ok") and r.get("exact_match") is False:
            extra += " (float-inexact)"
        print(f"{flag} {k:45s} {r.get('spark_rows', r.get('rows_only'))}/{r.get('oracle_rows')} "
              f"{r['sec']}s{extra}", flush=True)
        if not r.get("ok"):
            bad.append(k)
            print("    ", json.dumps({x: r[x] for x in r if x not in ("ok",)}, default=str)[:1500])
    print(f"\n{len(results) - len(bad)}/{len(results)} ok; bad: {bad}")
    spark.stop()


if __name__ == "__main__":
    main()
