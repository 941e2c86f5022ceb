"""Run registered queries against their SQL: python -m tests.run_queries [folder] [name ...]"""

from __future__ import annotations

import sys
import time

from __spark_entry__ import oracle_sql, queries
from strandline.session import build_session
from tests.oracle import connect, differences


def main(sf_dir: str = "/root/testdata/sf0.01", *names: str) -> int:
    spark = build_session("queries", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, bad = connect(sf_dir), oracle_sql(), 0
    for name, fn in queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            out = differences(fn(spark, sf_dir), con, sql[name]) if name in sql else ["no SQL"]
        except Exception as err:
            out = [f"{type(err).__name__}: {str(err)[:600]}"]
        bad += bool(out)
        print(f"{'BAD ' if out else 'ok  '} {name:32s} {time.time() - start:6.2f}s  {' | '.join(out)}", flush=True)
    print(f"{bad} of {len(names) or len(queries())} differ")
    return bad


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
