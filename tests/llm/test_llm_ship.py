import os
import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).parents[2]
CODE = """
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
from cityobs.llm.queries import QUERIES
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
print("rows", QUERIES["op8_byte_bpe"](spark, "/root/testdata/sf0.001").count())
"""


def test_workers_find_the_package_from_another_folder(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", CODE.format(repo=str(REPO))], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300
    )
    assert "rows 200" in done.stdout, done.stderr[-2000:]
