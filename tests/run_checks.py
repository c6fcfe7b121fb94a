"""Usage: python tests/run_checks.py [name prefix ...] (SF_DIR names the tables)."""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry
from tests.compare import compare, connect
from voxlens.session import build_session

sf_dir = os.environ.get("SF_DIR", "/root/testdata/sf0.001")
spark = build_session("checks", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g", "spark.voxlens.text.partitions": "8"})
spark.sparkContext.setLogLevel("ERROR")
con = connect(sf_dir)
wanted, bad = sys.argv[1:], 0
for name, fn in entry.queries().items():
    if wanted and not any(name.startswith(w) for w in wanted):
        continue
    started = time.time()
    try:
        sql = entry.oracle_sql().get(name)
        note = compare(spark, con, fn, sql, sf_dir) if sql else f"rows only: {len(fn(spark, sf_dir).collect())}"
    except Exception as e:
        note = f"{type(e).__name__}: {str(e)[:700]}"
    good = note is None or note.startswith("rows only")
    bad += not good
    print(f"{'ok ' if good else 'BAD'} {time.time() - started:6.2f}s {name} {note or ''}", flush=True)
print(f"{bad} differ")
