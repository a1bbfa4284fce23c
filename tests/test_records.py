"""Codecs, request validation, change envelopes, metrics and projections."""

import datetime as dt
import json

from pyspark.sql import functions as F

from streamfold.functions.codecs import CORRUPT, decode_json, encode_json
from streamfold.functions.ids import parse_uint64
from streamfold.functions.timefmt import format_message, nanos_to_timestamp
from streamfold.operators import cdc, ingest, metrics, projections
from streamfold.schemas import PAYLOAD_MESSAGE
from streamfold.sources import generators
from streamfold.sources.kafka import TlsOptions, TopicScan, sink_options


def test_json_encode_printed_case(spark):
    df = spark.createDataFrame([("John",)], "name string")
    enc = df.select(encode_json("name").alias("v")).first().v
    assert enc == '{"name":"John"}'
    dec = df.select(decode_json(encode_json("name"), "name string").alias("d")).first().d
    assert dec.name == "John" and dec[CORRUPT] is None


def test_corrupt_records(spark):
    raw = ['{"id": 1, "payload": "x", "ts": 5}', '{"id": 1.5}', "not json", "null",
           '{"id": 99999999999999999999}', '{"payload": "only"}']
    df = spark.createDataFrame([(r,) for r in raw], "value string")
    got = df.select(decode_json("value", PAYLOAD_MESSAGE).alias("d")).select("d.*").collect()
    flags = [r[CORRUPT] is not None for r in got]
    assert flags == [False, True, True, True, True, False]
    assert got[5].id is None and got[5].payload == "only"


def test_request_checks(spark):
    req = spark.createDataFrame([(1, "mute", "1", "2"), (2, "block", "1", "1"), (3, "block", "1", "2")],
                                "request_id int, action string, user_id string, block_uid string")
    got = {r.request_id: (r.status, r.reason, r.event) for r in ingest.validate_block_requests(req).collect()}
    assert got[1][1] == "Action must be: block or unblock"
    assert got[2][1] == "userID is equal blockUID"
    assert got[3] == ("accepted", None, "block:1:2")
    msgs = spark.createDataFrame(
        [(1, "-1", "2", "hi"), (2, "x", "2", "hi"), (3, "1", "2", "   "), (4, "007", "18446744073709551615", " a "),
         (5, "1", "18446744073709551616", "a")],
        "n int, from_uid string, to_uid string, text string")
    got = {r.n: r for r in ingest.validate_messages(msgs, id_cols=["n"]).collect()}
    assert got[1].reason == "from_uid is not int" and got[2].reason == "from_uid is not int"
    assert got[3].reason == "text is empty"
    assert (got[4].status, got[4].from_user_id, got[4].to_user_id, got[4].text) == \
        ("accepted", "7", "18446744073709551615", "a")
    assert got[4].id is not None and got[4].emit_key == str(got[4].id)
    assert got[5].reason == "to_uid is not int"
    words = spark.createDataFrame([(" x ",), ("　",)], "word string")
    got = [(r.status, r.clean_word, r.emit_key) for r in ingest.validate_bad_words(words).collect()]
    assert got == [("accepted", "x", "bad-word"), ("rejected", "", None)]


SAMPLE_ENVELOPE = {
    "before": None,
    "after": {"created_at": 1786139395635838, "email": "john@example.com", "id": 1, "name": "John Doe"},
    "source": {"connector": "postgresql", "db": "customers", "lsn": 26683472, "name": "pg",
               "schema": "public", "sequence": "[null,\"26683472\"]", "snapshot": "false",
               "table": "users", "ts_ms": 1786128595637, "ts_ns": 1786128595637128000,
               "ts_us": 1786128595637128, "txId": 747, "version": "3.0.0.Final", "xmin": None},
    "transaction": None, "op": "c", "ts_ms": 1786128595933, "ts_us": 1786128595933573,
    "ts_ns": 1786128595933573878,
}


def test_printed_envelope(spark):
    rec = spark.createDataFrame([('{"id":1}', json.dumps(SAMPLE_ENVELOPE), "pg.public.users", 0, 0)],
                                "key string, value string, topic string, partition int, offset bigint")
    d = cdc.decode_changes(rec, include=["public.users"])
    r = d.select("op", "lsn", "table", "key_id", F.is_variant_null("before").alias("bnull"),
                 F.variant_get("after", "$.id", "int").alias("id"),
                 F.timestamp_micros(F.variant_get("after", "$.created_at", "bigint"))
                 .cast("timestamp_ntz").alias("created_at"),
                 (F.col("ts_us") - F.col("source_ts_us")).alias("delay")).first()
    assert (r.op, r.lsn, r.table, r.key_id, r.bnull, r.id) == ("c", 26683472, "users", 1, True, 1)
    assert r.created_at == dt.datetime(2026, 8, 7, 21, 49, 55, 635838)
    assert r.delay == 296445
    assert cdc.decode_changes(rec, include=["public.orders"]).count() == 0


def test_change_replay(spark):
    def env(op, i, v, lsn):
        img = {"id": i, "value": v}
        return json.dumps({"before": img if op == "d" else None, "after": None if op == "d" else img,
                           "source": {"schema": "public", "table": "users", "lsn": lsn, "ts_us": 0},
                           "op": op, "ts_us": 10})
    rows = [('{"id":1}', env("c", 1, 1.0, 1)), ('{"id":1}', env("u", 1, 2.0, 2)),
            ('{"id":2}', env("c", 2, 5.0, 3)), ('{"id":2}', env("d", 2, 5.0, 4))]
    rec = spark.createDataFrame([(k, v, "t", 0, i) for i, (k, v) in enumerate(rows)],
                                "key string, value string, topic string, partition int, offset bigint")
    st = cdc.current_state(cdc.decode_changes(rec), {"id": "int", "value": "double"}).collect()
    assert [(r.key_id, r.value, r.lsn) for r in st] == [(1, 2.0, 2)]
    counts = {(r.table, r.op): r.n_changes for r in cdc.op_counts(cdc.decode_changes(rec)).collect()}
    assert counts == {("users", "c"): 2, ("users", "u"): 1, ("users", "d"): 1}


def test_metric_rename_matches_dashboard_name(spark):
    s = spark.createDataFrame(
        [(1, "kafka.connect<type=source-task-metrics, connector=postgres-connector, task=0>source-record-poll-rate",
          dt.datetime(2024, 1, 1), 1.0),
         (2, "kafka.connect<type=connect-worker-metrics>connector-count", dt.datetime(2024, 1, 1), 3.0),
         (3, "kafka.consumer<type=consumer-fetch-manager-metrics, client-id=c-1>records-lag", dt.datetime(2024, 1, 1), 0.0),
         (4, "something.else", dt.datetime(2024, 1, 1), 0.0)],
        "sample_id bigint, metric string, ts timestamp, value double")
    got = {r.sample_id: (r.name, r.connector, r.task, r.client_id) for r in metrics.rename_metrics(s).collect()}
    assert got[1] == ("kafka_connect_source_task_postgres_connector_0_source_record_poll_rate",
                      "postgres-connector", "0", None)
    assert got[2] == ("kafka_connect_worker_connector_count", None, None, None)
    assert got[3] == ("kafka_consumer_fetch_manager_records_lag", None, None, "c-1")
    assert 4 not in got
    mx = {r.panel: r.value for r in metrics.max_of_latest(metrics.rename_metrics(s)).collect()}
    assert mx["worker_connector_count"] == 3.0 and mx["worker_task_count"] is None


def test_projections(spark):
    df = spark.createDataFrame([(3,), (999999,)], "n bigint")
    assert [r.squared for r in projections.square(df, "n").collect()] == [9, 999998000001]
    msgs = spark.createDataFrame([(1, 'say "hi"\\', 1704078023688080999)], PAYLOAD_MESSAGE)
    r = msgs.select(format_message("id", "payload", "ts").alias("t"),
                    nanos_to_timestamp("ts").alias("at")).first()
    assert r.t == 'Message{ID:1, Payload:"say \\"hi\\"\\\\", Ts:1704078023688080999}'
    assert r.at == dt.datetime(2024, 1, 1, 3, 0, 23, 688080)
    two = spark.createDataFrame([(1,), (2,)], "id bigint")
    assert projections.fan_out(two, ["topic-1", "topic-2"]).count() == 4
    gen = generators.payload_messages(spark, 100).collect()
    assert [r.id for r in gen] == list(range(100)) and gen[0].payload == "Hello from producer"


def test_kafka_options():
    tls = TlsOptions("/ca.pem", "/client.pem", "pw")
    o = TopicScan("b:9092", ["t1"], group_id="g", max_records_per_trigger=10, tls=tls).options()
    assert o["subscribe"] == "t1" and o["maxOffsetsPerTrigger"] == "10"
    assert o["kafka.ssl.keystore.location"] == "/client.pem" and "kafka.ssl.keystore.key" not in o
    assert o["kafka.security.protocol"] == "SSL" and o["kafka.ssl.key.password"] == "pw"
    assert TopicScan("b:9092", pattern="pg\\.public\\..*").options(False)["subscribePattern"] == "pg\\.public\\..*"
    assert sink_options("b:9092", "t")["kafka.acks"] == "all"


def test_uint_parse(spark):
    df = spark.createDataFrame([("0",), ("18446744073709551615",), ("18446744073709551616",), (" 1",), ("+1",)], "s string")
    assert [r[0] for r in df.select(parse_uint64("s")).collect()] == ["0", "18446744073709551615", None, None, None]


def test_pretty_json_and_snapshot(spark):
    df = spark.createDataFrame([(1, "a")], "id int, name string")
    pretty = df.select(encode_json("id", "name", pretty=True).alias("j")).first().j
    assert json.loads(pretty) == {"id": 1, "name": "a"} and "\n" in pretty
    snap = spark.createDataFrame([("users", 1, 1, 9.0)], "table string, key_id bigint, id int, value double")
    ch = spark.createDataFrame([("users", 1, "u", 5, 1, 10.0)],
                               "table string, key_id bigint, op string, lsn bigint, id int, value double")
    both = cdc.with_snapshot(snap, ch)
    from streamfold.operators.scan import latest_per_key
    last = latest_per_key(both, ["table", "key_id"], "lsn", ["op", "value"]).first()
    assert (last.op, last.value) == ("u", 10.0)
    assert sorted(r.op for r in both.collect()) == ["r", "u"]


def test_insert_defaults(spark):
    from streamfold.sources.jdbc import jdbc_options, with_insert_defaults
    rows = spark.createDataFrame([(n, f"{n}@x") for n in ["John", "Jane", "Alice", "Bob"]],
                                 "name string, email string").withColumn("seq", F.monotonically_increasing_id())
    out = with_insert_defaults(rows, "seq", ts_col="created_at").orderBy("id").collect()
    assert [(r.id, r.name) for r in out] == [(1, "John"), (2, "Jane"), (3, "Alice"), (4, "Bob")]
    assert all(r.created_at is not None for r in out)
    o = jdbc_options("jdbc:postgresql://h/db", "users", partition_column="id", lower=1, upper=9,
                     num_partitions=3)
    assert o["numPartitions"] == "3" and o["dbtable"] == "users"


def test_run_each_and_counter(spark):
    from streamfold.streaming.outputs import DeliveryCounter
    from streamfold.streaming.sinks import run_each

    def bad():
        raise PermissionError("topic-2: not authorized")

    failed = run_each({"topic-1": lambda: None, "topic-2": bad})
    assert list(failed) == ["topic-2"]
    with DeliveryCounter(spark) as c:
        assert c.counts() == {}


def test_route_quantiles_and_key_mismatch(spark):
    from streamfold.operators import blocklist
    from streamfold.sources import fixtures
    d = cdc.decode_changes(fixtures.cdc_records(spark, "/root/testdata/sf0.001"),
                           include=["public.users", "public.orders"])
    users = cdc.route(d, "users")
    assert users.count() > 0 and users.filter("table <> 'users'").count() == 0
    q = cdc.merged_quantiles(cdc.delay_sketches(d))
    assert {(r.table, r.probability) for r in q.collect()} == {(t, p) for t in ("users", "orders") for p in (0.5, 0.95, 0.99)}
    ev = spark.createDataFrame([("1", "block:1:2", 1), ("3", "block:4:2", 2)],
                               "key string, value string, offset bigint")
    good, _ = blocklist.parse_block_events(ev)
    assert [r.user_id for r in blocklist.key_mismatches(good).collect()] == ["3"]


def test_message_text_escapes_controls(spark):
    msgs = spark.createDataFrame([(2, 'a"b\\c\td\x01e\x7f', 5)], PAYLOAD_MESSAGE)
    t = msgs.select(format_message("id", "payload", "ts").alias("t")).first().t
    assert t == 'Message{ID:2, Payload:"a\\"b\\\\c\\td\\x01e\\x7f", Ts:5}'


def test_zero_filled_missing_fields(spark):
    from streamfold.functions.codecs import zero_filled
    df = spark.createDataFrame([('{"payload": "only"}',)], "value string")
    d = zero_filled(df.select(decode_json("value", PAYLOAD_MESSAGE).alias("d")).select("d.*"))
    r = d.first()
    assert (r.id, r.payload, r.ts, r[CORRUPT]) == (0, "only", 0, None)


def test_typed_users_projection(spark):
    """CDC-02 on the printed envelope: users row with created_at."""
    rec = spark.createDataFrame([('{"id":1}', json.dumps(SAMPLE_ENVELOPE), "pg.public.users", 0, 0)],
                                "key string, value string, topic string, partition int, offset bigint")
    users = cdc.typed_projection(cdc.decode_changes(rec), {
        "id": "int", "name": "string", "email": "string", "created_at": "timestamp_micros"}).first()
    assert (users.id, users.name, users.email) == (1, "John Doe", "john@example.com")
    assert users.created_at == dt.datetime(2026, 8, 7, 21, 49, 55, 635838)


def test_missing_request_parameters(spark):
    """A missing parameter is the empty string; a trailing line feed is no number."""
    from streamfold.operators import ingest
    words = spark.createDataFrame([(None,), (" ",), ("ok",)], "word string")
    assert [r.status for r in ingest.validate_bad_words(words).collect()] == ["rejected", "rejected", "accepted"]
    req = spark.createDataFrame([(None, "1", "2"), ("block", None, "2"), ("block", None, None), ("block", "1", "2")],
                                "action string, user_id string, block_uid string")
    got = [(r.status, r.event) for r in ingest.validate_block_requests(req).collect()]
    assert got == [("rejected", None), ("accepted", "block::2"), ("rejected", None), ("accepted", "block:1:2")]
    msg = spark.createDataFrame([("12\n", "1", "x"), ("12", "1", "x"), (None, "1", "x")],
                                "from_uid string, to_uid string, text string")
    assert [r.reason for r in ingest.validate_messages(msg).collect()] == ["from_uid is not int", None, "from_uid is not int"]


def test_tombstones_are_no_changes(spark):
    from streamfold.operators import cdc
    from streamfold.plans import catalog
    from streamfold.sources import fixtures
    sf = "/root/testdata/sf0.001"
    recs = fixtures.cdc_records_with_rejects(spark, sf)
    good, bad = cdc.split_changes(recs, list(catalog.CDC_TABLES))
    assert good.count() + bad.count() == recs.count() and bad.count() > 0
    counts = cdc.op_counts(cdc.decode_changes(recs, list(catalog.CDC_TABLES))).collect()
    assert sum(r.n_changes for r in counts) == good.count() and all(r.table and r.op for r in counts)
    assert all(r.table for r in cdc.capture_delay(cdc.decode_changes(recs, list(catalog.CDC_TABLES))).collect())


def test_unprintable_characters_are_escaped(spark):
    from streamfold.functions.text import rune_upper
    from streamfold.functions.timefmt import quote_text
    rows = [("plain é 中",), ('a"b\\c',), ("\t\x01\x7f",), ("\x85\xa0​﻿",), ("\U000F0000 ß",), (None,), ("",)]
    got = [tuple(r) for r in spark.createDataFrame(rows, "t string").select(quote_text("t"), rune_upper("t")).collect()]
    assert [g[0] for g in got] == ["plain é 中", 'a\\"b\\\\c', "\\t\\x01\\x7f", "\\u0085\\u00a0\\u200b\\ufeff",
                                   "\\U000f0000 ß", None, ""]
    assert got[4][1] == "\U000F0000 ß" and got[0][1] == "PLAIN É 中" and got[5][1] is None


def test_batch_read_cannot_start_at_the_end():
    import pytest
    from streamfold.sources.kafka import TopicScan
    with pytest.raises(ValueError):
        TopicScan("b:9092", ["t"], starting_offsets="latest").options(streaming=False)


def test_queries_run_at_the_same_time():
    import threading
    from streamfold.streaming.sinks import run_each
    met = threading.Barrier(2, timeout=20)

    def fail():
        met.wait()
        raise RuntimeError("no access")
    assert list(run_each({"a": met.wait, "b": fail})) == ["b"]


def test_merged_sketches_are_as_good_as_stated(spark):
    """Sketches of many days, merged, are within the stated rank error; a
    quantile that is off is found out."""
    from pyspark.sql import functions as F
    d = spark.range(200_000).select(
        F.lit("t").alias("table"), (F.col("id") * 1_000_000_007 % 86_400_000_000 * 30).alias("source_ts_us"), F.col("id")).withColumn(
        "ts_us", F.col("source_ts_us") + F.pow(F.col("id") % 1000, 2).cast("bigint"))
    sketches = cdc.delay_sketches(d)
    assert sketches.count() == 30 and sketches.agg(F.max(F.length("sketch"))).first()[0] < 20_000
    q = cdc.merged_quantiles(sketches, (0.01, 0.5, 0.999))
    ranks = cdc.quantile_ranks(d, q).collect()
    assert len(ranks) == 3 and all(r.within_error and r.n_changes == 200_000 for r in ranks)
    off = cdc.quantile_ranks(d, q.withColumn("quantile", F.col("quantile") * 2 + 1)).filter("probability = 0.5").first()
    assert not off.within_error
    none = d.limit(0)
    assert cdc.quantile_ranks(none, cdc.merged_quantiles(cdc.delay_sketches(none))).count() == 0


def test_discovered_columns(spark):
    """Types that hold all values; columns that only some images have."""
    def change(image, before="null", op="u"):
        return (f'{{"before":{before},"after":{image},"source":{{"schema":"s","table":"t","lsn":1}},"op":"{op}","ts_ms":1,"ts_us":1}}',)
    rows = [change('{"id":1,"v":1}'), change('{"id":2,"v":1.5,"x":"a"}'), change("null", '{"id":3,"y":[1]}', "d"), (None,)]
    recs = spark.createDataFrame([("k", *r) for r in rows], "key string, value string").selectExpr(
        "CAST(key AS BINARY) AS key", "CAST(value AS BINARY) AS value", "'pg.s.t' AS topic", "0 AS partition", "0L AS offset")
    got = {r.column: (r.type, r.n_images) for r in cdc.discovered_columns(cdc.decode_changes(recs)).collect()}
    assert got["id"] == ("BIGINT", 3) and got["v"][1] == 2 and got["v"][0] in ("DOUBLE", "DECIMAL(2,1)", "DECIMAL(11,1)", "DECIMAL(20,1)", "DECIMAL(21,1)")
    assert got["x"] == ("STRING", 1) and got["y"] == ("ARRAY<BIGINT>", 1) and set(got) == {"id", "v", "x", "y"}


def test_csv_codec(spark):
    from streamfold.functions.codecs import CODECS
    encode, decode = CODECS["csv"]
    rows = spark.createDataFrame([(1, 'a "quoted", text', 1.5), (2, None, None), (3, "two\tparts", -0.25)], "i int, s string, d double")
    back = rows.select(decode(encode("i", "s", "d"), "i INT, s STRING, d DOUBLE").alias("v")).select("v.*")
    assert [tuple(r)[:3] for r in back.orderBy("i").collect()] == [tuple(r) for r in rows.orderBy("i").collect()]
    bad = spark.createDataFrame([("x,y,z",)], "line string").select(decode("line", "i INT, s STRING, d DOUBLE").alias("v")).first().v
    assert bad["_corrupt"] == "x,y,z" and bad.i is None


def test_counter_increases(spark, monkeypatch):
    """Counters that start anew, the first sample, ties in time, and a series
    that spans many chunks."""
    from pyspark.sql import functions as F
    name = "kafka.connect<type=source-task-metrics, connector=c, task=0>source-record-poll-total"
    day = 86_400_000_000
    values = [5.0, 8.0, 8.0, 2.0, 2.0, 9.0]
    rows = [(i, name, i // 2 * day, v) for i, v in enumerate(values)]
    s = spark.createDataFrame(rows, "sample_id bigint, metric string, us bigint, value double").withColumn("ts", F.timestamp_micros("us"))
    tagged = metrics.rename_metrics(s, panels=metrics.TOTAL_PANELS)
    got = [r.increase for r in metrics.increases(tagged).orderBy("sample_id").collect()]
    assert got == [0.0, 3.0, 0.0, 2.0, 0.0, 7.0]
    steps = metrics.cumulative(tagged).orderBy("window_start").collect()
    assert [(r.increase, r.cumulative) for r in steps] == [(3.0, 3.0), (2.0, 5.0), (7.0, 12.0)]
    monkeypatch.setattr(metrics, "DAY_MICROS", 10_000_000)
    many = spark.range(3000).select(F.col("id").alias("sample_id"), F.lit(name).alias("metric"),
                                    F.timestamp_micros(F.col("id") * 1_000_000).alias("ts"), (F.col("id") * 7 % 100).cast("double").alias("value"))
    total = metrics.cumulative(metrics.rename_metrics(many, panels=metrics.TOTAL_PANELS)).agg(F.max("cumulative")).first()[0]
    vs = [i * 7 % 100 for i in range(3000)]
    assert total == sum(b - a if b >= a else b for a, b in zip(vs, vs[1:]))


def test_metric_samples_reach_every_rule_and_panel(spark):
    from streamfold.sources import fixtures
    s = fixtures.metric_samples(spark, "/root/testdata/sf0.001")
    names = [r.metric for r in s.select("metric").distinct().collect()]
    import re
    for pattern, _, _ in metrics.RENAME_RULES:
        assert any(re.fullmatch(pattern, n) for n in names), pattern
    assert any(not any(re.fullmatch(p, n) for p, _, _ in metrics.RENAME_RULES) for n in names)
    assert all(r.n_series > 0 for r in metrics.max_of_latest(metrics.rename_metrics(s)).collect())
