"""Raw exchange frames -> bronze trade rows, with a dead-letter split.

A frame is JSON text, either bare ``{"e","s","t","p","q","T","m"}`` or
wrapped as ``{"stream": ..., "data": {...}}``.  Parsing is one ``from_json``
into a string map per frame (the keys "t" and "T" differ only by case, which
a struct field lookup would treat as ambiguous), then typed extraction.
A frame that is not a JSON object, lacks a required key, or has a symbol, id,
price, quantity, time or maker flag that cannot be used goes to the rejects with
a reason; the batch goes on.  No Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradelake.functions import BUY, round_half_away, side_from_maker
from tradelake.schema import BRONZE_COLUMNS, RAW_REQUIRED_KEYS
from tradelake.sources.adapters import iso_utc

MAP = "map<string,string>"


def frames_from_trades(trades: DataFrame) -> DataFrame:
    """Exchange-style frames from bronze-shaped trades (for tests and replays).

    BUY trades come wrapped in a combined-stream envelope, SELL trades bare;
    price and quantity are quoted text as on the wire.  ``timestamp`` is the
    arrival time (the trade time), as a broker would stamp it.
    """
    inner = F.struct(
        F.col("event_type").alias("e"), F.col("symbol").alias("s"), F.col("trade_id").alias("t"),
        F.col("price").cast("string").alias("p"), F.col("quantity").cast("string").alias("q"),
        F.col("timestamp").alias("T"), (~F.col("is_buyer")).alias("m"))
    wrapped = F.to_json(F.struct(F.concat(F.lower("symbol"), F.lit("@trade")).alias("stream"),
                                 inner.alias("data")))
    text = F.when(F.col("side") == F.lit(BUY), wrapped).otherwise(F.to_json(inner))
    return trades.select(text.alias("value"), F.timestamp_millis("timestamp").alias("timestamp"))


# One way to damage a frame for each reject reason: reason -> pattern, replacement.
DAMAGES = {
    "malformed_json": (r"^(.*)\}$", "$1"),
    "malformed_envelope": (r"\"data\":\{.*\}\}$", "\"data\":null}"),
    "missing_field:q": (r"\"q\":", "\"qty\":"),
    "bad_value:s": (r"\"s\":\"[^\"]*\"", "\"s\":null"),
    "bad_number:t": (r"\"t\":\d+", "\"t\":\"abc\""),
    "bad_number:p": (r"\"p\":\"[^\"]*\"", "\"p\":\"NaN\""),
    "bad_number:q": (r"\"q\":\"[^\"]*\"", "\"q\":\"many\""),
    "bad_number:T": (r"\"T\":\d+", "\"T\":\"zzz\""),
    "out_of_range:T": (r"\"T\":(\d+)", "\"T\":$1000000"),
    "bad_value:m": (r"\"m\":(true|false)", "\"m\":\"maybe\""),
}


def damaged_frames(frames: DataFrame) -> DataFrame:
    """A damaged copy of every frame for every reason that applies to it, to
    exercise the reject path without giving up any good frame."""
    broken = F.array(*[F.regexp_replace("value", pattern, to) for pattern, to in DAMAGES.values()])
    return (frames.select(F.col("value").alias("whole"), "timestamp", F.explode(broken).alias("value"))
            .where(F.col("whole") != F.col("value")).select("value", "timestamp"))


def _parsed(frames: DataFrame) -> DataFrame:
    """Parse each frame's ``raw`` text once, type its fields once and judge it once:
    columns ``_m`` (the parsed map), ``_v`` (typed fields) and ``reject_reason``.
    Each feeds several expressions and a filter; the one-element ``explode`` keeps the
    optimizer from inlining (re-computing) it into each of them."""
    o, m = F.col("_outer"), F.col("_m")
    inner = F.when(F.map_contains_key(o, "data"), F.from_json(o["data"], MAP)).otherwise(o)
    missing = F.coalesce(*[F.when(~F.map_contains_key(m, k), F.lit(k)) for k in RAW_REQUIRED_KEYS])
    typed = F.struct(missing.alias("missing"), m["t"].try_cast("long").alias("id"), m["p"].try_cast("double").alias("price"),
                     m["q"].try_cast("double").alias("quantity"), m["T"].try_cast("long").alias("ms"),
                     m["m"].try_cast("boolean").alias("maker"))
    out = frames
    for name, made in (("_outer", F.from_json("raw", MAP)), ("_m", inner), ("_v", typed), ("reject_reason", _reason())):
        out = out.select("*", F.explode(F.array(made)).alias(name))
    return out


def _reason() -> Column:
    m, v = F.col("_m"), F.col("_v")
    return (F.when(F.col("_outer").isNull(), F.lit("malformed_json"))
            .when(m.isNull(), F.lit("malformed_envelope"))
            .when(v["missing"].isNotNull(), F.concat(F.lit("missing_field:"), v["missing"]))
            .when(F.coalesce(m["s"], F.lit("")) == "", F.lit("bad_value:s"))
            .when(v["id"].isNull(), F.lit("bad_number:t"))
            .when(~finite(v["price"]), F.lit("bad_number:p"))
            .when(~finite(v["quantity"]), F.lit("bad_number:q"))
            .when(v["ms"].isNull(), F.lit("bad_number:T"))
            .when(~v["ms"].between(0, LAST_MS), F.lit("out_of_range:T"))
            .when(m["m"].isNotNull() & v["maker"].isNull(), F.lit("bad_value:m")))


LAST_MS = 253_402_300_799_999   # the last millisecond of the year 9999


def finite(v: Column) -> Column:
    """Whether a double is a number, and neither NaN nor infinite."""
    return F.coalesce(v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))), F.lit(False))


def parse_with_rejects(frames: DataFrame, value_col: str = "value",
                       arrival: Column | None = None) -> DataFrame:
    """Every frame with either its bronze fields or a ``reject_reason``.

    ``arrival`` is the ingest clock (a Kafka message timestamp); default: the
    query's current timestamp, taken once per batch.
    """
    arr = arrival if arrival is not None else (
        F.col("timestamp") if "timestamp" in frames.columns else F.current_timestamp())
    p = _parsed(frames.select(F.col(value_col).cast("string").alias("raw"), arr.alias("_arrival")))
    m, v = F.col("_m"), F.col("_v")
    side = side_from_maker(v["maker"])
    return p.select(
        "raw", "reject_reason",
        m["e"].alias("event_type"), m["s"].alias("symbol"),
        v["id"].alias("trade_id"),
        v["price"].alias("price"), v["quantity"].alias("quantity"),
        round_half_away(v["price"] * v["quantity"], 6).alias("volume_usd"),
        side.alias("side"), (side == F.lit(BUY)).alias("is_buyer"),
        v["ms"].alias("timestamp"),
        iso_utc(F.col("_arrival")).alias("ingested_at"),
    )


def parse_raw_trades(frames: DataFrame, value_col: str = "value", arrival: Column | None = None) -> DataFrame:
    """Accepted frames as bronze rows."""
    return (parse_with_rejects(frames, value_col, arrival)
            .where(F.col("reject_reason").isNull()).select(*BRONZE_COLUMNS))


def parse_rejects(frames: DataFrame, value_col: str = "value", arrival: Column | None = None) -> DataFrame:
    """Dead-letter rows: the raw text, the reason and the arrival time."""
    return (parse_with_rejects(frames, value_col, arrival)
            .where(F.col("reject_reason").isNotNull())
            .select("raw", "reject_reason", "ingested_at"))


def reject_counts(rejects: DataFrame) -> DataFrame:
    return rejects.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("n"))
