"""Workers that cannot import this repository: functions travel by value, broadcasts hold plain data only."""

from __future__ import annotations

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SCRIPT = f"""
import sys
sys.path.insert(0, {ROOT!r})
import __spark_entry__
from winnowmill.session import local_session
spark = local_session(4, memory="3g", name="elsewhere")
def known(batches):
    import importlib.util
    import pyarrow as pa
    for _ in batches:
        yield pa.RecordBatch.from_arrays([pa.array([importlib.util.find_spec("winnowmill") is not None])], names=["known"])
assert not any(r["known"] for r in spark.range(4).mapInArrow(known, "known boolean").collect())
queries = __spark_entry__.queries()
for name in sorted(n for n in queries if n[:2] == "op" and n[2].isdigit()):
    print(name, queries[name](spark, "/root/testdata/sf0.001").count(), flush=True)
"""


def test_queries_run_where_the_package_is_not_installed(tmp_path):
    environment = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT], cwd=tmp_path, env=environment, capture_output=True, text=True, timeout=900
    )
    assert done.returncode == 0, done.stderr[-3000:]
    found = dict(line.split() for line in done.stdout.splitlines() if line[:2] == "op" and line[2].isdigit())
    assert len(found) == 13 and all(int(n) > 0 for k, n in found.items() if k != "op5_warc_audit")
