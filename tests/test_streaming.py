"""The same windows from a stream of files as from the table."""

from pyspark.sql import functions as F

from seamwright.streaming.events import windowed


def test_stream_gives_what_the_table_gives(spark, tmp_path):
    rows = spark.range(400).select((F.lit("2024-01-01").cast("timestamp") + F.make_interval(mins=F.col("id").cast("int") * 7)).alias("ts"), (F.col("id") % 3).cast("string").alias("event_type"), F.col("id").cast("double").alias("value"))
    rows.repartition(4).write.parquet(str(tmp_path / "in"))
    table = spark.read.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(table.schema).parquet(str(tmp_path / "in"))
    done = windowed(stream).writeStream.format("memory").queryName("windows").outputMode("complete").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    assert done.awaitTermination(120)
    assert sorted(map(tuple, spark.table("windows").collect())) == sorted(map(tuple, windowed(table).collect()))
