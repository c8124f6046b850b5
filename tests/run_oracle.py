"""Run every registered query against its oracle: python tests/run_oracle.py [sf_dir] [name ...]"""

import sys
import time

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])
sys.path.insert(0, __file__.rsplit("/", 1)[0])

from oracle_harness import compare, duck  # noqa: E402

from feedledger.plans.registry import load_all  # noqa: E402
from feedledger.session import local_session  # noqa: E402

sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
only = set(sys.argv[2:])
spark = local_session()
con = duck(sf_dir)
bad = 0
for name, q in load_all().items():
    if only and name not in only:
        continue
    t0 = time.time()
    try:
        df = q.build(spark, sf_dir)
        if q.oracle is None:
            n = df.count()
            print(f"ROWS  {name:40s} rows={n} {time.time() - t0:.1f}s")
            continue
        problems, ns, nd = compare(df, con, q.oracle)
    except Exception as e:  # noqa: BLE001
        bad += 1
        print(f"ERROR {name:40s} {type(e).__name__}: {str(e)[:400]}")
        continue
    if problems:
        bad += 1
        print(f"FAIL  {name:40s} {problems}")
    else:
        print(f"OK    {name:40s} rows={ns} {time.time() - t0:.1f}s")
print("failures:", bad)
