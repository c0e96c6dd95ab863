"""Run queries against their SQL: python tests/check.py [folder] [name ...]."""

import sys
import time
import traceback

sys.path[:0] = ["/root/repo", "/root/repo/tests"]

import compare

import __spark_entry__ as entry
from hirelake.session import local_session

folder, names = sys.argv[1], sys.argv[2:]
spark = local_session()
spark.sparkContext.setLogLevel("ERROR")
con = compare.connect(folder)
queries, oracles = entry.queries(), entry.oracle_sql()
failed = []
for name in names or queries:
    started = time.time()
    try:
        df = queries[name](spark, folder)
        if name in oracles:
            diff = compare.differences(df, con, oracles[name])
            result = "ok" if diff is None else "DIFF " + diff
        else:
            result = f"rows {df.count()}"
            if names:
                df.show(8, False)
    except Exception as e:
        result = "ERROR " + str(e)[:1500]
        if names:
            traceback.print_exc(limit=4)
    if not result.startswith(("ok", "rows")):
        failed.append(name)
    print(f"{name:24s} {time.time() - started:6.1f}s {result}", flush=True)
print("failed:", failed)
