import datetime

from pyspark.sql import functions as F

from lodestrata.operators.journal import current_entries
from lodestrata.streaming import journals


def run(stream, mode, name):
    query = stream.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    query.awaitTermination()


def test_latest_state_equals_batch(spark, tmp_path):
    rows = [("u1", 1, "a"), ("u2", 2, "b"), ("u1", 5, "skip"), ("u2", 1, "late"), ("u3", 3, "c"), ("u1", 4, "d")]
    frame = spark.createDataFrame(rows, "unit string, at long, choice string")
    for i in range(3):
        frame.where(F.col("at") % 3 == i).coalesce(1).write.mode("append").parquet(f"{tmp_path}/j")
    stream = journals.stream_table(spark, f"{tmp_path}/j", frame.schema, files_a_batch=1)
    run(journals.latest_state(stream, "unit", "at", "choice"), "update", "state")
    found = spark.table("state").groupBy("unit").agg(F.max_by(F.struct("choice", "live"), "at").alias("x")).where("x.live").select("unit", "x.choice")
    assert sorted(map(tuple, found.collect())) == sorted((r["unit"], r["choice"]) for r in current_entries(frame, ["unit"], ["at"], "choice").collect())


def test_windowed_counts(spark, tmp_path):
    start = datetime.datetime(2024, 1, 1)
    frame = spark.createDataFrame([(start + datetime.timedelta(minutes=7 * i), "k") for i in range(20)], "ts timestamp, k string")
    frame.coalesce(1).write.parquet(f"{tmp_path}/e")
    stream = journals.stream_table(spark, f"{tmp_path}/e", frame.schema)
    run(journals.windowed_counts(stream, "ts", ["k"], "1 hour", "10 minutes"), "complete", "counts")
    assert spark.table("counts").agg(F.sum("n")).first()[0] == 20
