import random
from datetime import datetime, timedelta

from corpusflow.operators.runs import early_stopping
from corpusflow.scratch import scratch_path
from corpusflow.streaming.runs import rocksdb_state, stream_early_stopping, stream_metric_tracker
from test_runs import fold


def run(spark, streamed, name):
    query = (
        streamed.writeStream.outputMode("update").format("memory").queryName(name)
        .option("checkpointLocation", scratch_path(spark, name)).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.table(name).collect()


def files(spark, tmp_path, parts, schema):
    for i, rows in enumerate(parts):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / f"in{i}"))
        # One folder per arrival keeps the files in order of their names.
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in*"))


def test_early_stopping_keeps_its_state(spark, tmp_path):
    losses = {1: [2.5, 2.52, 2.55, 1.0], 2: [1.0, 0.9, 0.8, 0.7]}
    parts = [[(r, i, losses[r][i]) for r in losses] for i in range(4)]
    stream = files(spark, tmp_path, parts, "run int, step bigint, loss double")
    with rocksdb_state(spark):
        rows = run(spark, stream_early_stopping(stream, "run", "step", "loss", 2, 0.01), "stops")
    last = {}
    for r in rows:
        if r["run"] not in last or r["checks"] > last[r["run"]]["checks"]:
            last[r["run"]] = r
    for name, values in losses.items():
        counter, stopped = fold(values, 2, 0.01)[-1]
        assert (last[name]["checks"], last[name]["counter"], last[name]["stopped"]) == (4, counter, stopped)
    assert last[1]["stop_step"] == 2 and last[2]["stop_step"] is None and last[1]["best_loss"] == 1.0


def test_metric_tracker(spark, tmp_path):
    parts = [[("loss", 1, 4.0), ("acc", 1, 0.75)], [("loss", 2, 3.6), ("acc", 2, 0.78)]]
    stream = files(spark, tmp_path, parts, "name string, step bigint, value double")
    rows = run(spark, stream_metric_tracker(stream, ["step"]), "metrics")
    final = {r["name"]: r for r in rows if r["updates"] == 2}
    assert (final["loss"]["average"], final["loss"]["latest"], final["acc"]["latest"]) == (3.8, 3.6, 0.78)


def test_early_stopping_of_late_losses_over_restarts(spark, tmp_path):
    rng = random.Random(2)
    day = datetime(2024, 1, 1)
    made = [
        (name, i, rng.choice([None, float("nan"), 1.0, rng.random(), 5 - 0.05 * i]), day + timedelta(hours=i))
        for name in ("a", "b", None) for i in range(60)
    ]
    schema = "run string, step bigint, loss double, time timestamp"
    arrivals = [[], [], [], []]
    for row in made:
        arrivals[min((row[1] + rng.randrange(8)) // 17, 3)].append(row)  # up to 8 hours late
    state, seen, conf = scratch_path(spark, "late"), {}, spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    for number, rows in enumerate(arrivals):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in")).withWatermark("time", "8 hours")
        stops = stream_early_stopping(stream, "run", "step", "loss", 3, 0.1, time="time")
        with rocksdb_state(spark):  # every arrival restarts the query from its checkpoint
            query = stops.writeStream.outputMode("update").option("checkpointLocation", state).trigger(availableNow=True)
            query.foreachBatch(lambda batch, _: seen.update({r["run"]: r for r in batch.collect()})).start().awaitTermination()
        table = spark.createDataFrame(sum(arrivals[: number + 1], []), schema)
        wanted = early_stopping(table, "run", ["time", "step"], "loss", 3, 0.1).orderBy("time").collect()
        for name in seen:
            own = [r for r in wanted if r["run"] == name]
            stops_at = [r["step"] for r in own if r["early_stop"] and r["loss"] is not None]
            found = seen[name]
            assert (found["checks"], found["counter"]) == (sum(r["loss"] is not None for r in own), own[-1]["counter"])
            assert found["stop_step"] == (stops_at[0] if stops_at else None) and found["stopped"] == bool(stops_at)
    assert len(seen) == 3 and spark.conf.get("spark.sql.streaming.stateStore.providerClass") == conf
