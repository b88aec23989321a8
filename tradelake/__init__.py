"""tradelake: market-trade analytics on PySpark.

Raw trade frames -> bronze Parquet -> silver (deduplicated trades, OHLCV
candles) -> gold marts (VWAP, volatility, whale trades) -> serving queries,
with data-quality assertions and Structured Streaming variants.  Every
transform is a ``DataFrame -> DataFrame`` function so batch jobs, streaming
micro-batches and tests share one implementation.
"""

__version__ = "0.1.0"
