from pyspark.sql import functions as F

from adtrail.fixed import LOG_FIELD_DELIMITER
from adtrail.plans import registry as R
from adtrail.session import fresh_dir
from adtrail.sinks.partitions import write_text_partitions
from adtrail.streaming.log_stream import start
from conftest import SMOKE


def test_stream_parses_like_batch(spark):
    src = fresh_dir(spark, "stream_src")
    raw = R.raw_log(spark, SMOKE)
    write_text_partitions(raw, src, LOG_FIELD_DELIMITER, compression="none")
    out, ckpt = fresh_dir(spark, "stream_out"), fresh_dir(spark, "stream_ckpt")
    q = start(spark, src, out, ckpt, available_now=True)
    q.awaitTermination(300)
    got = spark.read.parquet(out).withColumn("dt", F.col("dt").cast("string"))
    want = R.coarse_log(spark, SMOKE)
    key = lambda df: sorted(map(tuple, df.select(*sorted(want.columns)).collect()), key=repr)
    assert key(got) == key(want)
    # a second run finds nothing new (exactly once)
    q2 = start(spark, src, out, ckpt, available_now=True)
    q2.awaitTermination(300)
    assert spark.read.parquet(out).count() == want.count()
