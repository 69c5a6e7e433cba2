import os
import subprocess
import sys

from conftest import rows
from pyspark.sql import functions as F

from tidepool import storage
from tidepool.plans import all_queries


def test_shared_dir_comes_from_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert storage.shared_dir(spark) == named
    assert storage.scratch_path(spark, "x") != storage.scratch_path(spark, "x")


LOCAL = """
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
assert spark.conf.get("spark.checkpoint.dir", None) is None
from tidepool import storage
from tidepool.plans import all_queries
first = storage.materialize(spark.range(3))
assert first.count() == 3
assert storage.shared_dir(spark) == storage.shared_dir(spark)
assert storage.release(spark)
print("fine")
"""


def test_local_session_without_a_folder(tmp_path):
    # An empty configuration folder keeps the machine's defaults out.
    done = subprocess.run([sys.executable, "-c", LOCAL], capture_output=True, text=True, timeout=120,
                          cwd=storage.__file__.rsplit("/tidepool/", 1)[0],
                          env={**os.environ, "SPARK_CONF_DIR": str(tmp_path)})
    assert "fine" in done.stdout, done.stderr[-2000:]


def test_materialize_cuts_the_plan(spark):
    df = spark.range(10).withColumn("x", F.rand())
    once = storage.materialize(df)
    assert rows(once) == rows(once)
    assert "Rand" not in once._jdf.queryExecution().optimizedPlan().toString()


def test_fits_broadcast(spark):
    df = spark.range(1000).withColumn("s", F.repeat(F.lit("x"), 100))
    assert storage.fits_broadcast(df, 1000 * 150)
    assert not storage.fits_broadcast(df, 1000 * 100)
    assert storage.fits_broadcast(df.filter("id < 0"), 0)


def test_hot_keys(spark):
    df = spark.range(90).select((F.col("id") / 60).cast("int").alias("k"))
    assert rows(storage.hot_keys(df, ["k"], 59)) == [(0, 60)]


ELSEWHERE = """
import sys
sys.path.insert(0, sys.argv[1])
import __spark_entry__ as e
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
print(e.queries()["throttle"](spark, sys.argv[2]).count(), "rows")
"""


def test_workers_find_the_package(spark, tmp_path, sf):
    """The repository is only on the driver's path and the working folder is another."""
    want = all_queries()["throttle"].build(spark, sf).count()  # greedy sequences run in Python
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    root = storage.__file__.rsplit("/tidepool/", 1)[0]
    done = subprocess.run([sys.executable, "-c", ELSEWHERE, root, sf], capture_output=True, text=True,
                          timeout=200, cwd=tmp_path, env=env)
    assert want > 10 and done.stdout == f"{want} rows\n", done.stderr[-2000:]
