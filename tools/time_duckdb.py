"""Time the DuckDB oracle statements (single node, all cores) as a reference
point for bench.py: one warm-up, median of three, result fully fetched.

    python tools/time_duckdb.py [sf_dir]
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from quarry.plans.oracle import ORACLE_SQL  # noqa: E402
from tools.check_oracle import TABLES  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    out = {}
    for name, sql in ORACLE_SQL.items():
        runs = []
        for i in range(4):
            t0 = time.perf_counter()
            con.execute(sql).fetchall()
            if i:
                runs.append(time.perf_counter() - t0)
        out[name] = round(statistics.median(runs), 3)
    print(json.dumps({"duckdb": duckdb.__version__, "sf_dir": sf_dir, "total": round(sum(out.values()), 3), "queries": out}))


if __name__ == "__main__":
    main()
