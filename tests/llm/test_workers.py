"""Every query of the subpackage where workers cannot import the library."""

from __future__ import annotations

import json
import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SCRIPT = """
import importlib.util, json, sys
from pyspark.sql import functions as F
sys.path.insert(0, sys.argv[1])
from legalops.session import local_session
import corpus_pipeline
from legalops.llm import queries

spark = local_session(4, shuffle_partitions=2)
spark.sparkContext.setLogLevel("ERROR")
here = F.udf(lambda _: importlib.util.find_spec("legalops") is not None, "boolean")
found = {"importable": spark.range(1).select(here("id")).first()[0]}
for name, query in {**queries.queries(), "pipeline": corpus_pipeline.run}.items():
    found[name] = query(spark, "/root/testdata/sf0.001").count()
print("FOUND " + json.dumps(found))
"""


def test_all_queries_run_where_workers_lack_the_library(tmp_path):
    kept = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    elsewhere = [p for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p and not os.path.isdir(os.path.join(p, "legalops"))]
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT, REPO], cwd=tmp_path, env={**kept, "PYTHONPATH": os.pathsep.join(elsewhere)}, capture_output=True, text=True, timeout=900
    )
    line = next((x for x in done.stdout.splitlines() if x.startswith("FOUND ")), None)
    assert line, done.stderr[-3000:]
    found = json.loads(line.removeprefix("FOUND "))
    assert found.pop("importable") is False
    assert len(found) == 14 and all(n > 0 for name, n in found.items() if name != "op13_hard_negatives")
