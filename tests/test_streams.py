import datetime as dt
import time

from pyspark.sql import functions as F

from loomline.operators import caps
from loomline.streaming import streams

SCHEMA = "doc_id long, text string, lang string"


def put(spark, folder, name, rows, schema=SCHEMA):
    folder.mkdir(exist_ok=True)
    spark.createDataFrame(rows, schema).toPandas().to_parquet(
        folder / name, coerce_timestamps="us", allow_truncated_timestamps=True)


def texts(start, count, lang="python"):
    return [(i, f"text {i} " * (4 if i % 4 == 0 else 40), lang) for i in range(start, start + count)]


def test_shards_are_taken_once_and_gate_opens(spark, tmp_path):
    landing, out, progress = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "progress")
    put(spark, landing, "shard_00000.parquet", texts(0, 5))
    put(spark, landing, "shard_00001.parquet", texts(5, 5))
    (landing / "shard_00002.parquet.tmp").write_text("half")

    def run():
        streams.stream_shards(spark, str(landing), SCHEMA, out, progress).awaitTermination()
        rows = spark.read.parquet(out)
        return rows.count(), streams.shard_status(rows, 3).first().ready

    assert run() == (10, False)
    assert run() == (10, False)
    put(spark, landing, "shard_00002.parquet", texts(10, 5))
    assert run() == (15, True)


def test_stream_prepare_equals_batch(spark, tmp_path):
    landing = tmp_path / "in"
    for part in range(3):
        put(spark, landing, f"p{part}.parquet", texts(part * 10, 10) + [(900 + part, None, "go")])
    stream = streams.read_arriving(spark, str(landing), SCHEMA, files_per_batch=1)
    out = str(tmp_path / "out")
    streams.stream_prepare(stream, out, str(tmp_path / "progress")).awaitTermination()
    got = {(r.doc_id, tuple(r.tokens)) for r in spark.read.parquet(out).collect()}
    batch = streams.prepare_rows(spark.read.schema(SCHEMA).parquet(str(landing)))
    assert got == {(r.doc_id, tuple(r.tokens)) for r in batch.collect()} and len(got) == 22


def test_cap_holds_across_batches_and_restarts(spark, tmp_path):
    landing, out, progress = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "progress")

    def run():
        stream = streams.read_arriving(spark, str(landing), SCHEMA, files_per_batch=1)
        streams.stream_cap_per_language(
            stream, out, progress, 20, ["python", "go"]).awaitTermination()
        rows = spark.read.parquet(out).collect()
        return {lang: sorted(r.doc_id for r in rows if r.lang == lang) for lang in ("python", "go", "c")}

    put(spark, landing, "a.parquet", texts(0, 20) + texts(100, 2, "go"))
    first = run()
    assert len(first["python"]) == 15 and len(first["go"]) == 1
    put(spark, landing, "b.parquet", texts(20, 40) + texts(200, 8, "go") + texts(300, 9, "c"))
    second = run()
    assert len(second["python"]) == 20 and len(second["go"]) == 7 and second["c"] == []
    assert second["python"][:15] == first["python"]
    put(spark, landing, "d.parquet", texts(60, 10))
    assert run() == second
    # In one batch the stream does the same as the table operator.
    rows = spark.read.schema(SCHEMA).parquet(str(landing))
    same = caps.cap_per_language(rows, 20, ["python"]).collect()
    assert sorted(r.doc_id for r in same) == second["python"]


def test_late_rows_are_dropped_and_counted(spark, tmp_path):
    landing, out = tmp_path / "in", str(tmp_path / "out")
    schema = "ts timestamp, loss double"
    base = dt.datetime(2024, 1, 1, 0, 0)

    def at(*minutes):
        return [(base + dt.timedelta(minutes=m), float(m)) for m in minutes]

    put(spark, landing, "a.parquet", at(1, 2, 61, 130), schema)
    progress = str(tmp_path / "progress")

    def run():
        stream = streams.read_arriving(spark, str(landing), schema)
        query = streams.stream_run_metrics(stream, out, progress, 36_000)
        query.awaitTermination()
        return query

    late = streams.count_late_rows(spark)
    run()
    put(spark, landing, "b.parquet", at(3, 135, 300), schema)
    query = run()
    until = time.time() + 20
    while late.dropped.get(str(query.id), 0) < 1 and time.time() < until:
        time.sleep(0.1)  # reports come a moment later
    spark.streams.removeListener(late)
    assert late.dropped[str(query.id)] == 1
    rows = {r.window_start.hour: r for r in spark.read.parquet(out).collect()}
    assert rows[0].n_steps == 2 and rows[0].mean_loss == 1.5 and rows[0].tokens_per_second == 20.0
    assert rows[2].n_steps == 2 and 5 not in rows
