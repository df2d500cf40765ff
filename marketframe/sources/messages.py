"""Inbound message handling (P1–P3, P10, F6, F20, F22, S6): envelopes → ticks, JSON payloads ↔ rows.

All parsing is ``from_json`` with an explicit schema plus ``try_*`` casts, so a bad row becomes
NULLs and lands in the quarantine split instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from marketframe.functions.timefn import format_iso, parse_iso_utc
from marketframe.schemas import ENVELOPE, TICK_MESSAGE


def envelope_json(ticks: DataFrame) -> DataFrame:
    """Serialise ticks as exchange envelopes ``{"type":"trade","data":[{t,s,p,v}]}``, one per tick,
    with the receive time alongside (the transport's arrival timestamp)."""
    trade = F.struct(F.col("timestamp_ms").alias("t"), F.col("symbol").alias("s"), F.col("price").alias("p"),
                     F.col("volume").alias("v"))
    env = F.struct(F.lit("trade").alias("type"), F.array(trade).alias("data"))
    return ticks.select(F.to_json(env).alias("value"), F.col("received_at"))


def explode_envelopes(raw: DataFrame, value: str = "value", received_at: str = "received_at") -> DataFrame:
    """Keep ``type == 'trade'`` envelopes, one row per trade, renamed to tick fields."""
    m = raw.select(F.from_json(F.col(value), ENVELOPE).alias("m"), F.col(received_at))
    t = m.filter(F.col("m.type") == "trade").select(F.explode("m.data").alias("d"), received_at)
    return t.select(F.timestamp_millis(F.col("d.t")).alias("timestamp"), F.col("d.t").alias("timestamp_ms"),
                    F.col("d.s").alias("symbol"), F.col("d.p").alias("price"), F.col("d.v").alias("volume"),
                    F.col(received_at).alias("received_at"))


def tick_message_json(ticks: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """S6 payload: ISO-8601 timestamp, epoch ms, symbol, price, volume, ISO receive time, as JSON text."""
    payload = F.struct(format_iso("timestamp").alias("timestamp"), F.col("timestamp_ms"), F.col("symbol"),
                       F.col("price"), F.col("volume"), format_iso("received_at").alias("received_at"))
    return ticks.select(F.to_json(payload).alias("value"), *(keep or []))


def parse_tick_messages(raw: DataFrame, value: str = "value") -> DataFrame:
    """Parse and validate tick payloads. Adds ``error`` (NULL when the row is valid).

    price/volume arrive as any JSON scalar; they are read as text and converted with try_cast, so
    a non-numeric price yields an error instead of a failed job.
    """
    m = raw.select(F.from_json(F.col(value), TICK_MESSAGE).alias("m"), F.col(value).alias("raw_value"))
    ts, rc = parse_iso_utc(F.col("m.timestamp")), parse_iso_utc(F.col("m.received_at"))
    price, volume = F.col("m.price").try_cast("double"), F.col("m.volume").try_cast("double")
    # PERMISSIVE parsing turns unparseable text into a struct of NULLs
    fields = ["timestamp", "timestamp_ms", "symbol", "price", "volume", "received_at"]
    malformed = F.col("m").isNull() | F.coalesce(*[F.col(f"m.{f}").cast("string") for f in fields]).isNull()
    err = (F.when(malformed, F.lit("malformed json"))
            .when(ts.isNull(), F.lit("bad timestamp")).when(F.col("m.timestamp_ms").isNull(), F.lit("bad timestamp_ms"))
            .when(F.col("m.symbol").isNull(), F.lit("missing symbol")).when(price.isNull(), F.lit("bad price"))
            .when(volume.isNull(), F.lit("bad volume")).when(rc.isNull(), F.lit("bad received_at")))
    return m.select(ts.alias("timestamp"), F.col("m.timestamp_ms").alias("timestamp_ms"), F.col("m.symbol").alias("symbol"),
                    price.alias("price"), volume.alias("volume"), rc.alias("received_at"), err.alias("error"),
                    "raw_value")


def valid(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("error").isNull()).drop("error", "raw_value")


def quarantine(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("error").isNotNull()).select("raw_value", "error")
