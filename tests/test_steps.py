"""What steps leave behind on disk."""

import os
import time

from ledgerwave.operators import checks
from ledgerwave.plans.bouts import sample_bouts
from ledgerwave.session import free_shuffles
from ledgerwave.sources.layers import materialize_layer


def shuffle_files(spark):
    """Files of shuffles under the folders of the block manager."""
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    folders = [str(d) for d in manager.localDirsString()]
    return [f for folder in folders for _, _, files in os.walk(folder) for f in files if f.startswith("shuffle_")]


def test_what_earlier_tables_have_shuffled_goes(spark, tmp_path):
    free_shuffles(spark)
    time.sleep(1)
    before = set(shuffle_files(spark))
    for name in ("first", "second", "third", "fourth"):
        rows = spark.range(20_000).repartition(4, "id")
        materialize_layer(spark, "marts", {name: rows}, str(tmp_path))
        del rows
    for _ in range(50):  # files are removed in the background
        left = {f.split("_")[1] for f in set(shuffle_files(spark)) - before}
        if len(left) <= 1:
            break
        time.sleep(0.2)
    assert len(left) <= 1  # the last step's, which something may still refer to


def test_profiles_are_made_before_they_meet_the_bouts(spark, sample_dir):
    plan = sample_bouts(spark, sample_dir, write=True).training._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "round_stats" not in plan and plan.count("lineitem.parquet") == 0


def test_kept_counts_are_stored_small(spark, tmp_path):
    rows = spark.range(1000).selectExpr("md5(cast(id as string)) as arr_key", "date'2001-01-31' as measurement_month")
    of_key = [c for c in checks.GENERIC_CHECKS if c.table == "fct_arr" and c.columns == ("arr_key",)]
    kept = checks.KeptCounts(spark, str(tmp_path), {"fct_arr": "measurement_month"})
    found = checks.run_checks(spark, {"fct_arr": rows}, of_key, kept).collect()
    assert found and all(r["violations"] == 0 for r in found)
    files = [f for _, _, files in os.walk(tmp_path) for f in files if f.endswith(".parquet")]
    assert files and all(".zstd." in f for f in files)
