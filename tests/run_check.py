"""Command-line comparison: python tests/run_check.py SF_DIR [name prefix ...]"""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
import __spark_entry__ as entry  # noqa: E402
from shelfline.session import build_session  # noqa: E402
from tests.compare import connect, difference  # noqa: E402

sf, prefixes = sys.argv[1], tuple(sys.argv[2:])
spark = build_session("check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g", "spark.ui.showConsoleProgress": "false"})
spark.sparkContext.setLogLevel("ERROR")
con, oracle, failed = connect(sf), entry.oracle_sql(), []
for name, fn in entry.queries().items():
    if prefixes and not name.startswith(prefixes):
        continue
    t = time.time()
    try:
        df = fn(spark, sf)
        if name in oracle:
            bad = difference(df, con, oracle[name])
        else:
            rows = df.count()
            bad = None if rows else "no rows"
            name += f" (rows only: {rows})"
    except Exception as e:  # noqa: BLE001
        bad = f"{type(e).__name__}: {str(e)[:700]}"
    print(f"{'ok  ' if bad is None else 'FAIL'} {time.time() - t:6.2f}s {name}" + (f"\n     {bad[:1800]}" if bad else ""), flush=True)
    if bad:
        failed.append(name)
print(f"{len(failed)} failed: {failed}")
