"""What workers keep between steps."""

import subprocess
import sys

import pyarrow as pa
from pyspark.sql import functions as F

from plyspark.llm.runtime import BATCH_BOUND, BATCH_BYTES, Scratch

SCRIPT = """
import pyarrow as pa
from plyspark.llm.text import steps
held = lambda: int(open("/proc/self/statm").read().split()[1]) * 4 // 1024
batch = pa.RecordBatch.from_arrays([pa.array(["a" * 1000] * 5000)], names=["text"])
before = held()
pool = [pa.allocate_buffer(1 << 20) for _ in range(300)]
for b in pool:
    memoryview(b).cast("B")[:] = bytes(1 << 20)
del pool, b
assert sum(part.num_rows for part in steps(batch)) == 5000
print(held() - before)
"""


def test_arrow_gives_back_what_batches_took():
    env = {"ARROW_DEFAULT_MEMORY_POOL": "mimalloc", "PATH": "", "PYTHONPATH": ":".join(sys.path)}
    found = subprocess.run([sys.executable, "-c", SCRIPT], capture_output=True, text=True, check=True, env=env, timeout=60)
    assert int(found.stdout) < 100


def test_batches_for_workers_are_small(spark):
    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], names=["rows", "bytes"])

    before = spark.conf.get(BATCH_BOUND)
    texts = spark.range(0, 3000, 1, 1).select(F.repeat(F.lit("x"), 10_000).alias("text"))
    found = Scratch(spark, "batches").save(texts.mapInArrow(run, "rows long, bytes long"), "sizes").collect()
    assert sum(r["rows"] for r in found) == 3000 and max(r["bytes"] for r in found) < 1.5 * BATCH_BYTES
    assert spark.conf.get(BATCH_BOUND) == before
