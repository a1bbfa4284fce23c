"""Schemas of the decoded record shapes as DDL strings.

DDL is accepted wherever Spark takes a schema (``from_json``,
``readStream.schema``, ``createDataFrame``) and needs no live session to define."""

from __future__ import annotations


KAFKA_RECORD = ("key BINARY, value BINARY, topic STRING, partition INT, offset BIGINT, "
    "timestamp TIMESTAMP, timestampType INT, headers ARRAY<STRUCT<key: STRING, value: BINARY>>")

PAYLOAD_MESSAGE = ("id BIGINT, payload STRING, ts BIGINT")
CDC_SOURCE_DDL = (
    "STRUCT<connector: STRING, db: STRING, lsn: BIGINT, name: STRING, schema: STRING, "
    "sequence: STRING, snapshot: STRING, table: STRING, ts_ms: BIGINT, ts_ns: BIGINT, "
    "ts_us: BIGINT, txId: BIGINT, version: STRING, xmin: BIGINT>")
CDC_ENVELOPE = (f"before VARIANT, after VARIANT, source {CDC_SOURCE_DDL}, transaction VARIANT, "
    "op STRING, ts_ms BIGINT, ts_us BIGINT, ts_ns BIGINT")
