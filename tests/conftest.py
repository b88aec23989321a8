import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tradelake.session import build_session
    s = build_session("local[4]", app_name="tradelake-tests", shuffle_partitions=8)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def bronze_rows(spark, rows):
    """Bronze DataFrame from tuples in BRONZE_COLUMNS order."""
    from tradelake.schema import BRONZE_SCHEMA
    return spark.createDataFrame(rows, BRONZE_SCHEMA)


MS = 1_704_103_200_000      # 2024-01-01 10:00:00 UTC in Unix ms


def trade(symbol="BTCUSDT", trade_id=1, price=100.0, qty=1.0, side="BUY", ms=MS,
          ingested="2024-01-01T10:00:00.000000+00:00"):
    vol = None if price is None or qty is None else round(price * qty, 6)
    return ("trade", symbol, trade_id, price, qty, vol, side, side == "BUY", ms, ingested)
