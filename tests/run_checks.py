"""Run queries against their SQL: python tests/run_checks.py FOLDER [name ...]."""

import os
import sys
import tempfile
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import __spark_entry__ as entry  # noqa: E402
import oracle  # noqa: E402

from millrace.session import build_session  # noqa: E402


def main():
    folder, names = sys.argv[1], sys.argv[2:]
    spark = build_session(
        "checks",
        "local[8]",
        {
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
            "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="millrace-warehouse-"),
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="millrace-work-"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries, sqls = entry.queries(), entry.oracle_sql()
    con = oracle.connect(folder)
    bad = 0
    for name in queries:
        if names and not any(name == n or (n.endswith("*") and name.startswith(n[:-1])) for n in names):
            continue
        start = time.time()
        try:
            got = oracle.spark_rows(queries[name](spark, folder))
            took = time.time() - start
            if name not in sqls:
                verdict = f"rows-only {len(got[1])}"
            else:
                diff = oracle.same(got, oracle.sql_rows(con, sqls[name]))
                verdict = f"ok {len(got[1])}" if diff is None else f"DIFF {diff[:600]}"
                bad += diff is not None
        except Exception as e:  # report and go on with the next query
            took = time.time() - start
            verdict = "ERROR " + (str(e)[:900] or traceback.format_exc()[-900:])
            bad += 1
        print(f"{name:28s} {took:6.2f}s {verdict}", flush=True)
    print("bad:", bad)


main()
