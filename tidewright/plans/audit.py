"""Parsing, audits, revisions, sets and lineage."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..bindings import read, revisions, ticks, with_sql
from ..functions.scalars import micros, to_double, to_long
from ..operators import joins as J
from ..operators import lineage as N
from ..operators import quality as Q
from .common import Registry, r

A = Registry()
_REV_KEYS = ["l_orderkey", "l_linenumber"]
_REV_ORDER = "received_us, l_partkey, l_suppkey, l_extendedprice, l_quantity"


def rev_order():
    return [F.col(c) for c in _REV_ORDER.split(", ")]


@A.add("""SELECT event_id, TRY_CAST(nullif(trim(json_extract_string(props, '$.k')), '') AS BIGINT) AS k, TRY_CAST(nullif(trim(json_extract_string(props, '$.k')), '') AS DOUBLE) AS k_value,
  CASE WHEN TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) > 0 THEN TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) END AS k_positive FROM events""")
def json_payload_parse(spark, sf):
    k = F.get_json_object("props", "$.k")
    return read(spark, sf, "events").select("event_id", to_long(k).alias("k"), to_double(k).alias("k_value"), to_double(k, positive=True).alias("k_positive"))


@A.add("""SELECT user_id, ts::DATE::VARCHAR AS day, event_id, value FROM events""")
def trade_explode(spark, sf):
    e = read(spark, sf, "events")
    item = F.to_json(F.struct("event_id", "value"))
    batches = e.groupBy("user_id", F.to_date("ts").cast("string").alias("day")).agg(F.concat(F.lit("["), F.concat_ws(",", F.collect_list(item)), F.lit("]")).alias("payload"))
    parsed = F.from_json("payload", "array<struct<event_id: bigint, value: double>>")
    return batches.select("user_id", "day", F.inline(parsed))


@A.add("""SELECT CASE WHEN event_id % 13 = 0 THEN 'bad_version' WHEN value <= 1 THEN 'not_positive' WHEN event_type = 'view' AND user_id % 2 = 0 THEN 'wrong_path' ELSE 'ok' END AS reason, count(*) AS n FROM events GROUP BY ALL""")
def envelope_validation(spark, sf):
    reason = F.when(F.col("event_id") % 13 == 0, "bad_version").when(F.col("value") <= 1, "not_positive").when((F.col("event_type") == "view") & (F.col("user_id") % 2 == 0), "wrong_path").otherwise("ok")
    return read(spark, sf, "events").groupBy(reason.alias("reason")).agg(F.count("*").alias("n"))


@A.add(f"""{with_sql('revisions')}, n AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {', '.join(c + ' DESC' for c in _REV_ORDER.split(', '))}) AS k FROM revisions)
SELECT l_orderkey, l_linenumber, received_us, payload_sha256, l_extendedprice FROM n WHERE k = 1""")
def latest_revision(spark, sf):
    return J.latest_by(revisions(spark, sf), _REV_KEYS, rev_order()).select(*_REV_KEYS, "received_us", "payload_sha256", "l_extendedprice")


@A.add(f"""{with_sql('revisions')}, p AS (SELECT *, lag(payload_sha256) OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_REV_ORDER}) AS before FROM revisions)
SELECT l_orderkey, l_linenumber, count(*) AS deliveries, count(*) FILTER (before = payload_sha256) AS redeliveries, count(*) FILTER (before <> payload_sha256) AS revisions FROM p GROUP BY ALL""")
def duplicate_vs_revision(spark, sf):
    return Q.revisions(revisions(spark, sf), _REV_KEYS, "payload_sha256", _REV_ORDER.split(", "))


@A.add(f"{with_sql('revisions')} SELECT l_orderkey, received_us // 2592000000000 AS month, count(DISTINCT payload_sha256) AS payloads FROM revisions GROUP BY ALL HAVING count(DISTINCT payload_sha256) > 1")
def ambiguous_revision(spark, sf):
    rows = revisions(spark, sf).withColumn("month", F.expr("received_us div 2592000000000"))
    return Q.ambiguous_revisions(rows, ["l_orderkey"], "month", "payload_sha256")


_CAUSAL = """c AS (SELECT *, coalesce(received_at_ns >= max(received_at_ns) OVER (PARTITION BY symbol, day ORDER BY sequence ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) AS causal FROM (SELECT *, user_id % 10 AS day FROM ticks))"""


def causal(spark, sf):
    return Q.causal(ticks(spark, sf).withColumn("day", F.col("user_id") % 10), ["symbol", "day"], "received_at_ns", ["sequence"])


@A.add(f"{with_sql('ticks')}, {_CAUSAL} SELECT symbol, day, count(*) AS n, count(*) FILTER (causal) AS n_causal FROM c GROUP BY ALL")
def causal_running_max(spark, sf):
    return causal(spark, sf).groupBy("symbol", "day").agg(F.count("*").alias("n"), F.count_if("causal").alias("n_causal"))


@A.add(f"""{with_sql('ticks')}, {_CAUSAL}, p AS (SELECT *, lag(event_ts_ms % 1000) OVER (PARTITION BY symbol, day ORDER BY sequence) AS previous FROM c WHERE causal)
SELECT symbol, day, count(*) AS regressions FROM p WHERE event_ts_ms % 1000 <= previous GROUP BY ALL""")
def sequence_regression(spark, sf):
    rows = causal(spark, sf).withColumn("number", F.col("event_ts_ms") % 1000)
    return Q.regressions(rows, ["symbol", "day"], "number", ["sequence"]).groupBy("symbol", "day").agg(F.count("*").alias("regressions"))


@A.add(f"""{with_sql('ticks')}, {_CAUSAL}, p AS (SELECT symbol, day, event_ts_ms - lag(event_ts_ms) OVER (PARTITION BY symbol, day ORDER BY sequence) AS delta, event_ts_ms % 3600000 <> 0 AS mis FROM c WHERE causal)
SELECT symbol, day, sum(CASE WHEN delta > 3600000 THEN greatest(1, (delta + 3599999) // 3600000 - 1) ELSE 0 END)::BIGINT AS missing, count(*) FILTER (delta < 0) AS regressions, max(delta) AS longest, count(*) FILTER (mis) AS misaligned FROM p GROUP BY ALL""")
def gap_audit(spark, sf):
    out = Q.gaps(causal(spark, sf), ["symbol", "day"], "event_ts_ms", ["sequence"], 3_600_000)
    return out.groupBy("symbol", "day").agg(F.sum("missing").alias("missing"), F.count_if("regression").alias("regressions"), F.max("delta").alias("longest"), F.count_if("misaligned").alias("misaligned"))


@A.add(f"""{with_sql('ticks')} SELECT symbol, count(*) AS records, min(event_ts_ms) AS first_ms, max(event_ts_ms) AS last_ms, {r('min(received_at_ns / 1e6::DOUBLE - event_ts_ms)')} AS latency_min, {r('max(received_at_ns / 1e6::DOUBLE - event_ts_ms)')} AS latency_max,
  max(event_ts_ms) - min(event_ts_ms) AS duration_ms, count(DISTINCT session_id) AS files FROM ticks GROUP BY symbol""")
def stream_statistics(spark, sf):
    return Q.stream_statistics(ticks(spark, sf), ["symbol"], "event_ts_ms", "received_at_ns", "session_id").drop("latency_mean")


@A.add(f"""{with_sql('ticks')}, i AS (SELECT 'block' AS code, symbol, sequence, session_id FROM ticks WHERE is_block UNION ALL SELECT 'small', symbol, sequence, session_id FROM ticks WHERE size < 5 UNION ALL SELECT 'cheap', symbol, sequence, session_id FROM ticks WHERE price < 1002)
SELECT code, symbol, count(*) AS issues, arg_min(session_id, sequence) AS first_sample FROM i GROUP BY ALL""")
def issue_summary(spark, sf):
    rules = {"block": F.col("is_block"), "small": F.col("size") < 5, "cheap": F.col("price") < 1002}
    return Q.issues(ticks(spark, sf), rules, ["symbol"], ["sequence"], "session_id")


@A.add(f"""{with_sql('ticks')}, i AS (SELECT symbol, CASE WHEN is_block AND size > 90 THEN 'trade_error' WHEN size > 60 THEN 'kline_gap' END AS code FROM ticks WHERE symbol <> 'click' OR size < 20), j AS (SELECT * FROM i WHERE code IS NOT NULL)
SELECT CASE WHEN count(*) = 0 THEN 'clean' WHEN count(*) FILTER (NOT ends_with(code, '_gap')) = 0 THEN 'gapped' ELSE 'rejected' END AS verdict FROM j""")
def archive_acceptance(spark, sf):
    t = ticks(spark, sf).where((F.col("symbol") != "click") | (F.col("size") < 20))
    code = F.when(F.col("is_block") & (F.col("size") > 90), "trade_error").when(F.col("size") > 60, "kline_gap")
    return Q.acceptance(t.select(code.alias("code"), F.when(code == "trade_error", "error").otherwise("warning").alias("severity")).where("code is not null"))


@A.add(f"""{with_sql('ticks')} SELECT sum(size)::BIGINT AS total_bytes, count(*) AS total_records, max(event_ts_ms) - min(event_ts_ms) AS duration_ms, {r('sum(size)::BIGINT * 86400000 / (max(event_ts_ms) - min(event_ts_ms))::DOUBLE', 2)} AS bytes_per_day FROM ticks""")
def projected_volume(spark, sf):
    return Q.projected_volume(ticks(spark, sf).withColumn("size", F.col("size").cast("long")), "size", "event_ts_ms", "event_ts_ms")


@A.add("""SELECT e.symbol, e.day FROM (SELECT DISTINCT event_type AS symbol FROM events) s, LATERAL (SELECT s.symbol, unnest(range(0, 1000)) AS day) e WHERE NOT EXISTS (SELECT 1 FROM events x WHERE x.event_type = e.symbol AND x.user_id = e.day)""")
def expected_streams_anti(spark, sf):
    e = read(spark, sf, "events").select(F.col("event_type").alias("symbol"), F.col("user_id").alias("day"))
    expected = e.select("symbol").distinct().select("symbol", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(999).cast("long"))).alias("day"))
    return expected.join(e, ["symbol", "day"], "left_anti")


@A.add("""SELECT o_orderkey AS path, CASE WHEN strftime(o_orderdate, '%Y-%m-%d') >= '1997-01-01' THEN 'kept' WHEN a.digest IS NULL THEN 'not_audited' WHEN a.size <> o_totalprice::BIGINT THEN 'size_mismatch' WHEN a.digest <> sha256(o_orderkey::VARCHAR) THEN 'digest_mismatch' ELSE 'candidate' END AS verdict
FROM orders o LEFT JOIN (SELECT o_orderkey AS path, o_totalprice::BIGINT + CASE WHEN o_orderkey % 5 = 0 THEN 1 ELSE 0 END AS size, sha256(CASE WHEN o_orderkey % 7 = 0 THEN 'x' ELSE o_orderkey::VARCHAR END) AS digest FROM orders WHERE o_orderkey % 3 <> 0) a ON a.path = o.o_orderkey""")
def retention_candidates(spark, sf):
    key = F.col("o_orderkey")
    size = F.rint("o_totalprice").cast("long")
    o = read(spark, sf, "orders")
    raw = o.select(key.alias("path"), size.alias("size"), F.sha2(key.cast("string"), 256).alias("digest"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"))
    audited = o.where(key % 3 != 0).select(key.alias("path"), (size + F.when(key % 5 == 0, 1).otherwise(0)).alias("size"), F.sha2(F.when(key % 7 == 0, "x").otherwise(key.cast("string")), 256).alias("digest"))
    return Q.retention(raw, audited, "path", "size", "digest", "date", "1997-01-01").select("path", "verdict")


@A.add("SELECT c_nationkey AS nationkey FROM customer WHERE c_acctbal > 9000 EXCEPT SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000")
def set_diff(spark, sf):
    c = read(spark, sf, "customer").where("c_acctbal > 9000").select(F.col("c_nationkey").alias("nationkey"))
    return c.subtract(read(spark, sf, "supplier").where("s_acctbal > 5000").select("s_nationkey"))


@A.add("SELECT c_nationkey AS nationkey FROM customer WHERE c_acctbal > 9000 INTERSECT SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000")
def set_intersect(spark, sf):
    c = read(spark, sf, "customer").where("c_acctbal > 9000").select(F.col("c_nationkey").alias("nationkey"))
    return c.intersect(read(spark, sf, "supplier").where("s_acctbal > 5000").select("s_nationkey"))


@A.add("SELECT 'c' AS kind, c_nationkey AS nationkey, count(*) AS n FROM customer GROUP BY ALL UNION ALL SELECT 's', s_nationkey, count(*) FROM supplier GROUP BY ALL")
def union_batches(spark, sf):
    c = read(spark, sf, "customer").groupBy(F.lit("c").alias("kind"), F.col("c_nationkey").alias("nationkey")).agg(F.count("*").alias("n"))
    return c.unionByName(read(spark, sf, "supplier").groupBy(F.lit("s").alias("kind"), F.col("s_nationkey").alias("nationkey")).agg(F.count("*").alias("n")))


@A.add("""SELECT source, count(*) AS files, sha256(string_agg(doc_id::VARCHAR || chr(31) || strlen(coalesce(text, ''))::VARCHAR || chr(31) || sha256(coalesce(text, '')), chr(10) ORDER BY doc_id)) AS fingerprint FROM documents GROUP BY source""")
def dataset_fingerprint(spark, sf):
    d = read(spark, sf, "documents")
    text = F.coalesce("text", F.lit(""))
    return N.fingerprint(d.select("source", F.col("doc_id").alias("path"), F.octet_length(text).alias("bytes"), F.sha2(text, 256).alias("sha256")), ["source"])


@A.add("""WITH RECURSIVE e AS (SELECT user_id, event_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS k FROM events),
c AS (SELECT user_id, k, event_id, repeat('0', 64) AS previous_hash, sha256(repeat('0', 64) || '|' || event_id::VARCHAR || '|' || event_type) AS event_hash FROM e WHERE k = 1
  UNION ALL SELECT e.user_id, e.k, e.event_id, c.event_hash, sha256(c.event_hash || '|' || e.event_id::VARCHAR || '|' || e.event_type) FROM c JOIN e ON e.user_id = c.user_id AND e.k = c.k + 1)
SELECT user_id, k AS sequence, event_id, previous_hash, event_hash FROM c""")
def journal_chain(spark, sf):
    e = read(spark, sf, "events").select("user_id", "event_id", F.concat_ws("|", F.col("event_id").cast("string"), "event_type").alias("body"))
    return N.chain(e, "user_id", "event_id", "body")


@A.add("SELECT event_id, value FROM events WHERE ts >= TIMESTAMP '2024-01-08' AND ts < TIMESTAMP '2024-01-15' AND event_type IN ('click', 'purchase')")
def partition_scan(spark, sf):
    e = read(spark, sf, "events")
    return e.where((F.col("ts") >= F.lit("2024-01-08").cast("timestamp_ntz")) & (F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz")) & F.col("event_type").isin("click", "purchase")).select("event_id", "value")


@A.add("""SELECT 1 + (ts::DATE - DATE '2024-01-01') AS day, count(*) AS n, ((ts::DATE - DATE '2024-01-01') - coalesce(lag(ts::DATE - DATE '2024-01-01') OVER (ORDER BY ts::DATE), -1)) = 1 AS consecutive FROM events GROUP BY ts::DATE""")
def catalog_days(spark, sf):
    days = read(spark, sf, "events").groupBy(F.datediff(F.to_date("ts"), F.lit("2024-01-01").cast("date")).alias("d")).agg(F.count("*").alias("n"))
    return N.consecutive(days, "d").select((F.col("d") + 1).cast("long").alias("day"), "n", "consecutive")


@A.add("""SELECT event_id, epoch_us(ts)::BIGINT * 1000 AS event_ns FROM events""")
def exact_event_time(spark, sf):
    from ..functions.scalars import event_ns

    us = micros(F.col("ts"))
    seconds = F.concat(F.expr("cast(unix_micros(cast(ts as timestamp)) div 1000000 as string)"), F.lit("."), F.lpad((us % 1_000_000).cast("string"), 6, "0"))
    return read(spark, sf, "events").select("event_id", event_ns(seconds).alias("event_ns"))


