"""Run registered queries against their DuckDB oracle.

usage: python scripts/oracle_check.py [sf_dir] [name ...]
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shiplens.plans.check import compare, duck_connect  # noqa: E402
from shiplens.plans.registry import QUERIES  # noqa: E402
from shiplens.session import get_session  # noqa: E402


def main():
    args = sys.argv[1:]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    names = args[1:] or list(QUERIES)
    spark = get_session("local[8]", 8)
    con = duck_connect(sf_dir)
    bad = 0
    for n in names:
        t0 = time.time()
        try:
            res = compare(spark, n, sf_dir, con)
        except Exception as e:  # report and continue
            res = {"name": n, "status": "ERROR", "error": str(e)[:400]}
        res["sec"] = round(time.time() - t0, 2)
        bad += res["status"] not in ("ok", "rows-only")
        print(json.dumps(res, default=str), flush=True)
    print(f"# {len(names) - bad}/{len(names)} ok")


if __name__ == "__main__":
    main()
