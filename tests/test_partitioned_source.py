"""Production-layout logs partitioned by date: same results, pruned partitions."""

import datetime as dt

from pyspark.sql import functions as F

from pulsekit.operators import feed as feedm, intraday, messaging
from pulsekit.params import DEFAULT_PARAMS as P
from pulsekit.sources import feed_actions, load_fixture_tables, message_actions
from tools.oracle_check import compare

SF = "/root/testdata/sf0.01"


def test_partition_pruning_and_equal_results(spark, tmp_path):
    fd, ms = load_fixture_tables(spark, SF)
    fpath, mpath = str(tmp_path / "feed"), str(tmp_path / "msg")
    fd.withColumn("event_date", F.to_date("time")).write.partitionBy("event_date").parquet(fpath)
    (ms.withColumnRenamed("receiver_id", "reciever_id").withColumn("event_date", F.to_date("time"))
       .write.partitionBy("event_date").parquet(mpath))
    pf = feed_actions(spark, fpath, date_partition="event_date")
    pm = message_actions(spark, mpath, date_partition="event_date")

    got = feedm.feed_week(pf, P.as_of)
    text = spark.sparkContext._jvm.PythonSQLUtils.explainString(got._jdf.queryExecution(), "formatted")
    assert "PartitionFilters: [isnotnull(event_date" in text and "event_date#" in text
    assert compare(got.toPandas(), feedm.feed_week(fd, P.as_of).toPandas()) is None

    a = intraday.metrics_15m(pf, pm, P.as_of_ts).toPandas()
    b = intraday.metrics_15m(fd, ms, P.as_of_ts).toPandas()
    assert compare(a, b) is None
    c = messaging.message_user_slice(pm, P.as_of).toPandas()
    d = messaging.message_user_slice(ms, P.as_of).toPandas()
    assert compare(c, d) is None
