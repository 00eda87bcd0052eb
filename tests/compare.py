"""python tests/compare.py [sf_dir] [key ...]: compare registered queries with their SQL."""

import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from oracle import connect, difference  # noqa: E402
from pricelift.checks.registry import all_checks  # noqa: E402
from pricelift.session import build_session  # noqa: E402

if __name__ == "__main__":
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    checks = all_checks()
    keys = sys.argv[2:] or list(checks)
    spark = build_session("compare", "local[8]", **{
        "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for key in keys:
        start = time.time()
        try:
            df = checks[key].run(spark, sf_dir)
            sql = checks[key].oracle()
            problem = difference(df, con, sql) if sql else (f"rows only: {df.count()}" if df.count() else "no rows")
        except Exception as error:  # report and go on
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        ok = problem is None or problem.startswith("rows only")
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {key} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{len(keys) - bad} of {len(keys)} ok")
