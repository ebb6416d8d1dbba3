"""Release records written as JSON lines and read back."""

from pyspark.sql import functions as F

from turnloom.operators import release as R


def test_round_trip(spark, tmp_path):
    seg = "array<struct<full_content:string,word_index:int,probs:struct<floor_taking:double,backchannel:double,silence:double>,decision:string,inserted_token:string,content:string>>"
    rows = [
        ("a", "ctx", "spoken", 0.5, ["user"], [("user", "one two", [("one two", None, None, None, None, None), (None, 0, (0.1, 0.4, 0.5), "backchannel", "[BACKCHANNEL]", "yeah")]), ("assistant", None, None)]),
        ("b", None, None, None, None, []),
        ("c", "", "", 0.0, [], None),
    ]
    df = spark.createDataFrame(rows, f"example_id string, context string, style string, disfluency_target double, speakers array<string>, history array<struct<role:string,content:string,history:{seg}>>").withColumn("config", F.lit("dropped"))
    packed = R.pack_dialogues(df, F.lit("NEG"), F.lit("MIT"))
    assert "config" not in packed.columns and packed.schema["history"].dataType.elementType.names == ["role", "content", "segments"]
    packed.write.json(str(tmp_path / "out"))
    schema = spark.range(1).select(F.from_json(F.lit("{}"), R.DIALOGUE).alias("r")).select("r.*").schema
    back = {r.example_id: r for r in R.unpack_dialogues(spark.read.schema(schema).json(str(tmp_path / "out")), F.lit("negotiator"), F.lit("train")).collect()}
    a = back["a"]
    assert a.meta.license == "MIT" and a.meta.style == "spoken" and a.meta.disfluency_target == 0.5 and a.meta.dataset == "negotiator" and a.config == {}
    assert a.history[0].history[1].content == "yeah" and a.history[0].history[0].full_content == "one two" and a.history[1].history == []
    assert back["b"].history == [] and back["b"].meta.style is None and back["c"].history is None


def test_annotations(spark):
    rows = [("a", [("user", "x", [(1, 5, (1, 1, 3), (0.2, 0.2, 0.6))]), ("user", "y", []), ("assistant", "z", None)])]
    df = spark.createDataFrame(rows, f"example_id string, history array<struct<role:string,content:string,boundaries:array<{R.BOUNDARY}>>>")
    packed = R.pack_annotations(df, F.lit("OTH"), F.lit(None).cast("string"))
    assert [len(t.boundaries) for t in packed.collect()[0].history] == [1, 0, 0]
    back = R.unpack_annotations(packed, F.lit("d"), F.lit("test")).collect()[0]
    assert [t.boundaries is None for t in back.history] == [False, True, True] and back.meta.license is None
    assert R.unpack_annotations(R.pack_annotations(df.limit(0), F.lit(""), F.lit("")), F.lit(""), F.lit("")).count() == 0
