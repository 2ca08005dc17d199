"""Standalone: python tests/run_oracle.py [sf_dir] [key ...]"""

import sys
import time

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])

from oracle_compare import compare, duck  # noqa: E402

from sparkcivic.session import build_session  # noqa: E402
import __spark_entry__ as entry  # noqa: E402

sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
keys = sys.argv[2:]
spark = build_session(master="local[8]", shuffle_partitions=8)
qs, sqls = entry.queries(), entry.oracle_sql()
con = duck(sf)
bad = 0
for k in (keys or list(qs)):
    t = time.time()
    try:
        if k not in sqls:
            n = qs[k](spark, sf).count()
            print(f"{k:32s} rows-only {n} ({time.time()-t:.1f}s)", flush=True)
            continue
        probs, ns, nd = compare(spark, sf, k, qs[k], sqls[k], con)
        status = "OK" if not probs else "FAIL " + "; ".join(probs)
        bad += bool(probs)
        print(f"{k:32s} {status} rows={ns}/{nd} ({time.time()-t:.1f}s)", flush=True)
    except Exception as e:  # noqa: BLE001
        bad += 1
        print(f"{k:32s} ERROR {type(e).__name__}: {str(e)[:400]}", flush=True)
print("failures:", bad)
