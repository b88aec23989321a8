"""Physical-plan checks: the plans we rely on at scale are the ones we get."""

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tradelake.plans import serving as S
from tradelake.plans.registry import REGISTRY, events_candles, events_stg, whale_mart


def plan(df):
    """The final plan of the execution that ran, not of one beside it."""
    qe = df._jdf.queryExecution()
    qe.executedPlan().executeCollect()
    text = qe.executedPlan().toString()
    assert "isFinalPlan=false" not in text
    return text


def test_candles_hash_aggregate_with_partial_step(spark):
    p = plan(events_candles(spark, SF_SMALL))
    assert "SortAggregate" not in p and "partial_min_by" in p and "HashAggregate" in p


def test_dedup_uses_window_group_limit(spark):
    p = REGISTRY["dedup_trades"].run(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in p


def test_top_k_is_take_ordered(spark):
    p = S.top_whales(whale_mart(spark, SF_SMALL))._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in p


def test_symbol_filter_reaches_scan(spark):
    df = S.last_candles(events_candles(spark, SF_SMALL), "CLICK")
    p = df._jdf.queryExecution().executedPlan().toString()
    scan = p[p.index("FileScan"):]
    assert "(upper(event_type" in scan[scan.index("DataFilters:"):scan.index("Format:")]   # a filter on the scan itself


def test_rolling_windows_not_partitioned_by_symbol_alone(spark):
    p = REGISTRY["mart_volatility"].run(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "_blk" in p


def test_no_python_udfs_anywhere(spark):
    for name in ["mart_vwap", "mart_volatility", "mart_whale_trades", "parse_raw_trades", "overview"]:
        p = REGISTRY[name].run(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, name


def test_column_pruning(spark):
    from tradelake.plans.registry import lineitem_stg
    p = lineitem_stg(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    read = p[p.index("ReadSchema:"):].split("\n")[0]
    assert "l_discount" not in read and "l_tax" not in read and "l_extendedprice" in read


def test_whale_join_splits_a_hot_hour(spark):
    """All whales of one (symbol, hour): AQE splits the join to the written context."""
    from tradelake.operators import whales as W
    from tradelake.plans.build import materialize
    from tradelake.plans.registry import lineitem_stg
    stg = lineitem_stg(spark, "/root/testdata/sf0.01").withColumn("traded_at", F.lit("2024-01-01 10:00:00").cast("timestamp"))
    stg = materialize(stg.withColumn("symbol", F.when(F.col("trade_id") % 5 > 0, "HOT").otherwise(F.col("symbol"))), spark, "hot")
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        context = materialize(W.hourly_context(stg, 1.0), spark, "context")
        p = plan(W.with_hour(W.whale_base(stg.repartition(8), 1.0), context))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert "skew=true" in p


def test_dedup_compares_ids_before_symbols(spark):
    p = REGISTRY["dedup_trades"].run(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    sorts = [line for line in p.split("\n") if "Sort [" in line]
    assert sorts and all(line.split("Sort [")[1].startswith("trade_id") for line in sorts)


def test_whale_rank_reads_written_whales(spark):
    """The rank reads its input twice: the dedup must not run for each of them."""
    p = REGISTRY["whale_rank"].run(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "l_shipdate" not in p and "WindowGroupLimit" not in p
