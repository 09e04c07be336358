"""A session of which nothing is set but that it is local."""

import os
import subprocess
import sys

import pytest

SF = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
CODE = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
assert spark.conf.get("spark.checkpoint.dir", None) is None
from {queries} import QUERIES
from {common} import base_dir, clean_up
print("rows", QUERIES[{name!r}](spark, {sf!r}).count())
path = base_dir(spark).removeprefix("file://")
import os
assert not {writes} or os.path.isdir(path)
clean_up(spark)
assert not os.path.exists(path)
"""


@pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables are not here")
@pytest.mark.parametrize("name, writes", [("op7_best_fit_packing", False), ("op3_token_files", True)])
def test_plain_local_session(tmp_path, name, writes):
    code = CODE.format(root=ROOT, queries="skygrid.llm.queries", common="skygrid.llm.common", name=name, sf=SF, writes=writes)
    r = subprocess.run([sys.executable, "-c", code], env=os.environ | {"SPARK_CONF_DIR": str(tmp_path)}, cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert r.returncode == 0 and int(r.stdout.rpartition("rows")[2]) > 0, r.stderr[-2000:]
