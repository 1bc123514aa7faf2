"""Time each oracle SQL in DuckDB (single process) at an sf dir."""
import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from tests.oracle import duck  # noqa: E402
from driftline.plans import suite  # noqa: E402

sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
con = duck(sf)
out = {}
for name, sql in suite.ORACLE_SQL.items():
    t = time.perf_counter()
    con.execute(sql).fetchall()
    out[name] = round(time.perf_counter() - t, 3)
print(json.dumps(out))
