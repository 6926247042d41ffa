import os
from types import SimpleNamespace

from tidewater import staging


def test_steps_can_be_dropped(spark):
    first = staging.mark()
    a = staging.written(spark.range(3).toDF("n"))
    second = staging.mark()
    b = staging.written(a.where("n > 0"))
    staging.drop(spark, first, second)
    assert b.count() == 2 and not os.path.exists(a.inputFiles()[0].removeprefix("file://"))
    staging.drop(spark, first, staging.mark())
    staging.drop(spark, first, staging.mark())


def session(master: str, **conf: str):
    return SimpleNamespace(conf=SimpleNamespace(get=lambda k, default=None: conf.get(k.replace(".", "_"), default)), sparkContext=SimpleNamespace(master=master))


def test_folder_is_the_clusters():
    assert staging.folder(session("yarn", spark_checkpoint_dir="hdfs:///shared/")) == "hdfs:///shared"
    assert staging.folder(session("yarn", spark_sql_warehouse_dir="hdfs:///warehouse")) == "hdfs:///warehouse/_steps"
    assert staging.folder(session("local[4]")).startswith("file:///")


def test_one_table_can_be_discarded(spark):
    a, b = staging.written(spark.range(3).toDF("n")), staging.written(spark.range(4).toDF("n"))
    at = a.inputFiles()[0].removeprefix("file://")
    staging.discard(a)
    assert b.count() == 4 and not os.path.exists(at)
    staging.discard(a, b)


def test_tables_end_with_the_driver(tmp_path):
    import subprocess
    import sys

    run = f"""
from pyspark.sql import SparkSession
from tidewater import staging
s = SparkSession.builder.master("local[1]").config("spark.checkpoint.dir", "file://{tmp_path}").config("spark.ui.enabled", "false").getOrCreate()
print(staging.written(s.range(3)).count(), len(list(__import__("pathlib").Path("{tmp_path}").glob("tidewater-*"))))
"""
    out = subprocess.run([sys.executable, "-c", run], capture_output=True, text=True, cwd=os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    assert out.stdout.split() == ["3", "1"]
    import time

    for _ in range(50):  # the JVM ends a little later
        if not list(tmp_path.glob("tidewater-*")):
            break
        time.sleep(0.2)
    assert not list(tmp_path.glob("tidewater-*"))
