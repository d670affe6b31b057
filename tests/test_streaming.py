from tallyweave.functions.text import normalized
from tallyweave.streaming.arrivals import late_records_once, streamed_candidates

SCHEMA = "entity_id string, business_name string, business_address string, country string, loaded_at timestamp"


def test_stream_equals_batch(spark, tmp_path):
    import datetime as dt

    day = dt.datetime(2024, 1, 1)
    rows = [(f"S2-{k}", f"acme foods {k % 3}", "1 main st 560001", "IN", day) for k in range(9)] + [("S2-1", "acme foods 1", "1 main st 560001", "IN", day)]
    arrivals = spark.createDataFrame(rows, SCHEMA)
    arrivals.write.parquet(str(tmp_path / "in"))
    reference = normalized(spark.createDataFrame([("S1-1", "acme foods 1", "1 main st 560001", "IN")], "entity_id string, business_name string, business_address string, country string"))
    stream = late_records_once(spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in")))
    query = streamed_candidates(stream, reference).writeStream.format("memory").queryName("found").outputMode("append").option("checkpointLocation", str(tmp_path / "state")).start()
    try:
        query.processAllAvailable()
        got = {(r.s1_id, r.cand_id) for r in spark.sql("select * from found").collect()}
    finally:
        query.stop()
    want = {(r.s1_id, r.cand_id) for r in streamed_candidates(arrivals, reference).collect()}
    assert got == want and ("S1-1", "S2-1") in got
