"""python -m tests.check_queries [sf] [query ...]: compare registered queries with their SQL."""

import sys
import time

from tableward import session
from tableward.registry import registered
from tests.compare import TESTDATA, compare, connection


def main() -> int:
    sf = sys.argv[1] if len(sys.argv) > 1 else "sf0.01"
    only = sys.argv[2:]
    spark = session.build(
        master="local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "10g"},
    )
    spark.sparkContext.setLogLevel("OFF")
    sf_dir = f"{TESTDATA}/{sf}"
    con = connection(sf_dir)
    bad = 0
    for name, (run, sql) in registered().items():
        if only and not any(name.startswith(o) for o in only):
            continue
        begun = time.time()
        try:
            if sql is None:
                problems, n = [], run(spark, sf_dir).count()
            else:
                problems, n = compare(spark, sf_dir, run, sql, con)
        except Exception as e:  # report and go on with the next query
            problems, n = [f"{type(e).__name__}: {str(e)[:600]}"], -1
        bad += bool(problems)
        state = "FAIL" if problems else ("rows" if sql is None else "ok")
        print(f"{state:5} {name:32} {n:7} rows {time.time() - begun:6.2f}s {'; '.join(problems)[:900]}", flush=True)
    print("failed:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main())
