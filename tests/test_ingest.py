"""Raw frames, rejects, Kafka framing, bronze layout, pruning, compaction."""

import datetime as dt

from pyspark.sql import functions as F

from tests.conftest import MS, SF_SMALL, bronze_rows, trade
from tradelake.schema import BRONZE_COLUMNS
from tradelake.session import new_scratch_path
from tradelake.sources import bronze as B
from tradelake.sources import raw as R
from tradelake.sources.adapters import event_trades
from tradelake.sources.kafka import kafka_envelope, source_options


def frames(spark, texts):
    return spark.createDataFrame([(t, dt.datetime(2024, 1, 1, 10)) for t in texts], "value string, timestamp timestamp")


def test_both_shapes_parse(spark):
    bare = '{"e":"trade","s":"BTCUSDT","t":5,"p":"100.5","q":"0.2","T":1704103200000,"m":true}'
    wrapped = '{"stream":"btcusdt@trade","data":{"e":"trade","s":"BTCUSDT","t":6,"p":"1","q":"2","T":1704103200001,"m":false}}'
    rows = {r.trade_id: r for r in R.parse_raw_trades(frames(spark, [bare, wrapped])).collect()}
    assert rows[5].side == "SELL" and rows[5].is_buyer is False and rows[5].price == 100.5
    assert rows[5].volume_usd == 20.1
    assert rows[6].side == "BUY" and rows[6].timestamp == 1704103200001
    assert rows[5].ingested_at == "2024-01-01T10:00:00.000000+00:00"


def test_rejects_with_reasons(spark):
    texts = ['{"e":"trade","s":"X","t":1,"p":"1"',                         # truncated
             '{"e":"trade","s":"X","t":1,"q":"1","T":1,"m":true}',          # no p
             '{"e":"trade","s":"X","t":1,"p":"abc","q":"1","T":1,"m":true}',
             '{"e":"trade","s":"X","t":1,"p":null,"q":"1","T":1,"m":true}',
             '{"e":"trade","s":"X","t":2,"p":"3","q":"1","T":1,"m":true}']  # good
    rej = {r.reject_reason for r in R.parse_rejects(frames(spark, texts)).collect()}
    assert rej == {"malformed_json", "missing_field:p", "bad_number:p"}
    assert R.parse_raw_trades(frames(spark, texts)).count() == 1


def test_frames_round_trip(spark):
    tr = event_trades(spark, SF_SMALL)
    back = R.parse_raw_trades(R.frames_from_trades(tr)).drop("ingested_at")
    assert back.exceptAll(tr.drop("ingested_at")).count() == 0
    assert back.count() == tr.count()


def test_kafka_envelope(spark):
    tr = event_trades(spark, SF_SMALL)
    env = kafka_envelope(tr)
    r = env.where(F.col("key") == "1").collect()[0]
    assert r.topic.endswith("_trades") and r.topic == r.topic.lower()
    from tradelake.schema import BRONZE_SCHEMA
    back = env.select(F.from_json("value", BRONZE_SCHEMA).alias("j")).select("j.*")
    assert back.exceptAll(tr).count() == 0
    assert source_options("b:9092")["subscribe"] == "btcusdt_trades,ethusdt_trades,solusdt_trades"


def test_midnight_batch_splits_days(spark):
    midnight = 1_704_153_600_000      # 2024-01-02 00:00:00 UTC
    df = bronze_rows(spark, [trade(trade_id=1, ms=midnight - 1), trade(trade_id=2, ms=midnight + 1)])
    path = new_scratch_path(spark, "bronze_midnight")
    B.write_bronze(df, path)
    got = {(r.trade_id, r.day) for r in B.read_bronze(spark, path).collect()}
    assert got == {(1, "01"), (2, "02")}


def test_partition_pruning_in_plan(spark):
    path = new_scratch_path(spark, "bronze_prune")
    B.write_bronze(event_trades(spark, SF_SMALL), path)
    q = B.read_bronze(spark, path).where(B.day_filter("CLICK", "2024-01-15"))
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(symbol" in plan and "(day#" in plan
    assert q.count() == event_trades(spark, SF_SMALL).where(
        (F.col("symbol") == "CLICK") & (F.to_date(F.timestamp_millis("timestamp")) == F.lit("2024-01-15"))).count()


def test_compaction_keeps_rows(spark):
    path = new_scratch_path(spark, "bronze_small")
    tr = event_trades(spark, SF_SMALL)
    B.write_bronze(tr.repartition(8), path)
    out = B.compact_bronze(spark, path, new_scratch_path(spark, "bronze_big"))
    assert out.select(*BRONZE_COLUMNS).exceptAll(tr).count() == 0
    assert out.count() == tr.count()
    some = B.compact_bronze(spark, path, new_scratch_path(spark, "bronze_day"), days=["2024-01-15"])
    assert {(r.month, r.day) for r in some.select("month", "day").distinct().collect()} == {("01", "15")}


def test_gold_table_and_listing(spark):
    from tradelake.sources.tables import list_tables, write_table
    df = event_trades(spark, SF_SMALL).limit(10)
    back = write_table(spark, df, "gold", "sample_trades", partition_by=["symbol"])
    assert back.count() == 10
    assert "sample_trades" in list_tables(spark, "gold")


def test_rebuild_of_one_symbol_keeps_the_others(spark):
    from tradelake.sources.tables import write_table
    rows = spark.createDataFrame([("A", 1), ("B", 2)], "symbol string, v int")
    write_table(spark, rows, "gold", "two_symbols", partition_by=["symbol"])
    back = write_table(spark, spark.createDataFrame([("A", 9)], "symbol string, v int"), "gold", "two_symbols", partition_by=["symbol"])
    assert sorted((r.symbol, r.v) for r in back.collect()) == [("A", 9), ("B", 2)]


def test_every_unusable_value_is_a_reject(spark):
    good = {"e": '"trade"', "s": '"X"', "t": "1", "p": '"1"', "q": '"1"', "T": "1", "m": "true"}
    cases = {"bad_value:s": {"s": "null"}, "bad_number:t": {"t": '"abc"'}, "bad_number:p": {"p": '"NaN"'},
             "bad_number:q": {"q": '"Infinity"'}, "bad_number:T": {"T": '"zzz"'}, "out_of_range:T": {"T": "1704103200000000"},
             "bad_value:m": {"m": '"maybe"'}}
    texts = ["{" + ",".join(f'"{k}":{v}' for k, v in (good | change).items()) + "}" for change in cases.values()]
    rejected = [r.reject_reason for r in R.parse_rejects(frames(spark, texts)).collect()]
    assert sorted(rejected) == sorted(cases)


def test_source_fails_on_lost_offsets_by_default():
    assert source_options("b:9092")["failOnDataLoss"] == "true"
    assert source_options("b:9092", fail_on_data_loss=False)["failOnDataLoss"] == "false"


def test_bronze_types_are_enforced(spark):
    path = new_scratch_path(spark, "bronze_typed")
    tr = event_trades(spark, SF_SMALL).limit(5)
    B.write_bronze(tr.withColumn("trade_id", F.col("trade_id").cast("string")), path)
    assert B.read_bronze(spark, path).schema["trade_id"].dataType.simpleString() == "bigint"
    assert B.read_bronze(spark, path).count() == 5


def test_time_range_filter_prunes_days(spark):
    path = new_scratch_path(spark, "bronze_range")
    B.write_bronze(event_trades(spark, SF_SMALL), path)
    start, end = 1_705_276_800_000, 1_705_276_800_000 + 36 * 3_600_000     # 15th 00:00 .. 16th 12:00
    q = B.read_bronze(spark, path).where(B.time_range_filter(start, end))
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "concat_ws" in plan
    exp = event_trades(spark, SF_SMALL).where((F.col("timestamp") >= start) & (F.col("timestamp") < end))
    assert q.count() == exp.count() > 0


def test_frames_are_typed_once(spark):
    """The reason feeds a filter and a group: neither may type the fields anew."""
    from tradelake.plans.registry import event_frames
    rejects = R.reject_counts(R.parse_rejects(event_frames(spark, SF_SMALL).select("value", "timestamp")))
    plan = rejects._jdf.queryExecution().optimizedPlan().toString()
    assert "_m#" in plan and plan.count("try_cast(_m#") == 5


def test_frames_of_a_small_file_are_made_by_all_tasks(spark):
    from tradelake.plans.registry import event_frames
    assert event_frames(spark, SF_SMALL).rdd.getNumPartitions() >= int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_frame_columns_do_not_clash_with_the_parse(spark):
    bare = '{"e":"trade","s":"X","t":"x","p":"1","q":"2","T":1,"m":null}'
    odd = frames(spark, [bare, bare.replace('"x"', "7")]).withColumn("reject_reason", F.lit("old"))
    rows = R.parse_with_rejects(odd).select("trade_id", "reject_reason", "side").collect()
    assert sorted(map(tuple, rows), key=str) == [(7, None, "BUY"), (None, "bad_number:t", "BUY")]
