import __spark_entry__ as e


def test_every_shard_with_a_heartbeat_has_a_state(spark, tmp_path):
    events = spark.createDataFrame([(5, 0), (251, 0), (1499, 100_000), (270, 100_000), (None, 0)], "user_id long, at long").selectExpr("user_id", "timestamp_seconds(at) as ts")
    events.write.parquet(str(tmp_path / "events.parquet"))
    got = {r["shard"]: r["state"] for r in e.queries()["hb2_shard_state"](spark, str(tmp_path)).collect()}
    assert len(got) == 203 and got[5] == got[251] == "STALE" and got[1499] == "ACTIVE" and got[270] == "DONE" and got[3] == "PARTIAL" and got[4] == "MISSING"
