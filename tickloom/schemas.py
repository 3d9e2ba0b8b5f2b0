"""Schemas of ticks, bars, anomalies and ground truth."""

from __future__ import annotations

TICK = "ticker string, ts timestamp, price double, volume bigint, side string, exchange string, session_id string, seq bigint"
#: Every field a string: the validator casts, so that numbers in quotes are accepted.
TICK_JSON = "ticker string, timestamp_ist string, price string, volume string, side string, exchange string, session_id string, seq string"
REQUIRED = ("ticker", "timestamp_ist", "price", "volume", "side", "session_id", "seq")
METADATA = "ticker string, name string, sector string, industry string, mcap_bucket string"
BAR = "ticker string, bar_size string, window_start timestamp, window_end timestamp, open double, high double, low double, close double, volume bigint, vwap double, tick_count bigint"
ANOMALY = "ticker string, ts timestamp, detection_method string, score double, severity int, context string, session_id string"
TRUTH = "session_id string, seed bigint, trading_date string, generated_at string, anomalies array<struct<anomaly_id:string,ticker:string,anomaly_type:string,start_ts:timestamp,end_ts:timestamp,magnitude:double,description:string>>"
