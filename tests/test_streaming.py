"""The streamed days must equal the batch ones."""

import datetime as dt

from pyspark.sql import functions as F

from martloom.operators.rolling import roll_sketches, rolling_users
from martloom.streaming import daily_sketches, sliding_users, write_daily


def test_streamed_days_give_the_batch_counts(spark, sf_dir, tmp_path):
    batch = spark.read.parquet(f"{sf_dir}/events.parquet")
    half = F.dayofmonth("ts") <= 15
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    args = (out, str(tmp_path / "checkpoint"))
    for part in (batch.filter(half), batch.filter(~half)):
        part.coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(batch.schema).parquet(source)
        write_daily(daily_sketches(stream, "ts", "user_id"), *args).awaitTermination(120)
    done = spark.read.parquet(out)
    days = batch.select(F.to_date("ts").alias("day")).distinct()
    last = days.agg(F.max("day")).first()[0]
    # the watermark has not passed the newest day yet, all others came exactly once
    assert sorted(r.day for r in done.collect()) == sorted(
        r.day for r in days.collect() if r.day < last
    )
    events = batch.select(F.to_date("ts").alias("day"), "user_id").filter(F.col("day") < last)
    want = {r.day: r.users for r in rolling_users(events, "day", "user_id", 7).collect()}
    got = {r.day: r.users for r in roll_sketches(done, "day", "sketch", 7).collect()}
    assert got == want


def test_sliding_windows_take_late_events_and_drop_those_too_late(spark, tmp_path):
    """One event half a day late counts in all its windows; one that is eight days late counts in none."""

    def at(day, hour, user):
        return dt.datetime(2024, 1, day, hour), user

    first = [at(d, 1 + u % 20, u) for d in range(1, 11) for u in range(3 * d)]
    late, too_late = at(10, 2, 900), at(2, 5, 901)
    loads = [first, [at(10, 22, 1), late, too_late], [at(d, 3, d) for d in range(14, 20)], [at(28, 0, 1)]]
    schema, source, out = "ts timestamp, user_id long", str(tmp_path / "in"), str(tmp_path / "out")
    for rows in loads:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        write_daily(sliding_users(stream, "ts", "user_id", 7, "1 day"), out, str(tmp_path / "checkpoint")).awaitTermination(120)
    got = {r.day: r.users for r in spark.read.parquet(out).collect()}
    kept = [r for rows in loads[:3] for r in rows if r != too_late]
    events = spark.createDataFrame(kept, schema).select(F.to_date("ts").alias("day"), "user_id")
    want = {r.day: r.users for r in rolling_users(events, "day", "user_id", 7).collect()}
    ended = {d: n for d, n in want.items() if d <= dt.date(2024, 1, 25)}
    assert got == ended and len(got) == 25
    assert got[dt.date(2024, 1, 16)] == 31  # the thirty users of day 10 and the late one
