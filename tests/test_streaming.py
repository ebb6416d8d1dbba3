"""A stream of turns and a table of them give the same."""

from pyspark.sql import functions as F

from turnloom import streaming as ST


def drained(stream, tmp_path, mode="append"):
    name = "t" + str(abs(hash(str(tmp_path))))
    q = stream.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    return sorted(map(tuple, stream.sparkSession.table(name).collect()), key=str)


TURNS = [(1, 0, "user", "Well, um I think so. Do you agree, or not?"), (1, 1, "assistant", " "), (1, 2, "user", None), (1, 3, "user", "yes, no, um maybe, so, then. ok"), (2, 0, "user", "a. b. c, d")]


def test_decisions(spark, tmp_path):
    df = spark.createDataFrame(TURNS, "record_id bigint, turn int, role string, content string")
    df.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    assert drained(ST.decisions(stream), tmp_path) == sorted(map(tuple, ST.decisions(df).collect()), key=str)


def test_contexts(spark, tmp_path):
    df = spark.createDataFrame(TURNS, "record_id bigint, turn int, role string, content string")
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    got = {(a, b): c for a, b, c in drained(ST.contexts(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))), tmp_path)}
    assert got[1, 0] == "" and got[1, 3] == "user: " + TURNS[0][3] and got[2, 0] == ""


def test_sessions_and_repeats(spark, tmp_path):
    df = spark.createDataFrame([(1, "2024-01-01 10:00:00", 1.0), (1, "2024-01-01 10:10:00", 2.0), (1, "2024-01-01 12:00:00", 4.0)], "user_id bigint, ts string, value double").withColumn("ts", F.to_timestamp("ts"))
    assert sorted(r.n for r in ST.sessions(df).collect()) == [1, 2]
    df.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    assert len(drained(ST.once(stream, "value", "ts"), tmp_path)) == 3


def test_contexts_in_any_batches(spark, tmp_path):
    """Many files and batches of one row: a dialogue's turns are put in order before any is told."""
    rows = [(d, t, "user", f"{d}-{t}") for t in (5, 0, 3, 1, 4, 2) for d in (1, 2)]
    df = spark.createDataFrame(rows, "record_id bigint, turn int, role string, content string")
    df.repartition(6).write.parquet(str(tmp_path / "in"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")
    try:
        got = drained(ST.contexts(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))), tmp_path)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = {(d, t): "\n".join(f"user: {d}-{k}" for k in range(max(0, t - 4), t)) for d in (1, 2) for t in range(6)}
    assert {(a, b): c for a, b, c in got} == want and len(got) == 12


def test_late_turns_and_idle_dialogues(spark, tmp_path):
    schema = "record_id bigint, turn int, role string, content string, ts timestamp"
    at = lambda m: f"2024-01-01 10:{m:02d}:00"
    parts = [[(1, 0, "user", "a", at(0)), (1, 2, "user", "c", at(1))], [(1, 1, "user", "late", at(2)), (1, 3, "user", "d", at(3))], [(2, 0, "user", "x", at(59))], [(2, 1, "user", "y", at(59))]]
    for i, p in enumerate(parts):
        rows = [(*r[:4], r[4]) for r in p]
        spark.createDataFrame(rows, "record_id bigint, turn int, role string, content string, t string").selectExpr("record_id", "turn", "role", "content", "CAST(t AS timestamp) AS ts").coalesce(1).write.mode("append").parquet(str(tmp_path / f"in{i}"))
    import shutil

    (tmp_path / "in").mkdir()
    out = []
    for i in range(4):
        for f in (tmp_path / f"in{i}").glob("*.parquet"):
            shutil.copy(f, tmp_path / "in" / f"{i}-{f.name}")
        stream = ST.contexts(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), idle="5 minutes")
        q = stream.writeStream.format("parquet").outputMode("append").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        q.awaitTermination(120)
        assert q.exception() is None
    out = {(r.record_id, r.turn): r.context for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert out == {(1, 0): "", (1, 2): "user: a", (1, 1): "user: a", (1, 3): "user: a\nuser: c", (2, 0): "", (2, 1): "user: x"}
