"""Sources, projections, filters, routing and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import fixtures as fx
from checks.registry import over_filtered, over_mentions, over_valid, query
from tidelog.functions import json_fields as J
from tidelog.functions import text, times
from tidelog.functions import summary as S
from tidelog.operators import apply, audit, envelope, route, versions
from tidelog.session import cut_lineage

ROUTES = {"db.urgent": "1-URGENT|2-HIGH", "db.low": r"5-.*", "db.any": ".*", "db.part": "URGENT", "db.none": None}


@query("src_1_topic_scan", over_valid(
    "SELECT topic, part AS partition, off AS \"offset\", NOT tomb AS has_value FROM msg WHERE topic IN ('evt-click', 'evt-view')"))
def topic_scan(spark, sf):
    rows = fx.cdc_messages(spark, sf).where(F.col("topic").isin("evt-click", "evt-view"))
    return rows.select("topic", "partition", "offset", F.col("value").isNotNull().alias("has_value"))


@query("src_3_json_decode", over_valid(
    """SELECT off AS "offset", type, version, CASE WHEN nokey THEN NULL ELSE 'user_id' END AS key_field,
       CAST(n_items AS INTEGER) AS items FROM msg WHERE NOT tomb"""))
def json_decode(spark, sf):
    doc = F.col("doc")
    return envelope.decode_records(envelope.drop_tombstones(fx.cdc_messages(spark, sf))).select(
        "offset", J.field_text(doc, "type").alias("type"), J.field_long(doc, "version").alias("version"),
        J.field_text(doc, "key").alias("key_field"), F.size(J.item_list(doc)).alias("items"))


@query("src_4_struct_to_document",
       "SELECT o_orderkey, o_custkey AS custkey, o_orderpriority AS priority, 'OBJECT' AS nested FROM orders")
def struct_to_document(spark, sf):
    orders = fx.table(spark, sf, "orders").withColumn("nested", F.struct("o_orderstatus", "o_totalprice"))
    rows = envelope.struct_as_document(orders, "o_custkey", "o_orderpriority", "nested")
    doc = F.col("doc")
    nested = F.regexp_extract(F.schema_of_variant(F.try_variant_get(doc, "$.nested", "variant")), "^[A-Z]+", 0)
    return envelope.decode_records(rows).select(
        "o_orderkey", J.field_long(doc, "o_custkey").alias("custkey"),
        J.field_text(doc, "o_orderpriority").alias("priority"), nested.alias("nested"))


CURRENT = """
, last AS (SELECT tbl, dedup_key, max((commit_seq, part, off)) AS l FROM {rows} WHERE op IN ('U', 'D') GROUP BY ALL),
cur AS (SELECT a.* FROM {rows} a LEFT JOIN last USING (tbl, dedup_key)
        WHERE a.op <> 'D' AND (l IS NULL OR (a.commit_seq, a.part, a.off) >= l))
"""


@query("src_5_current_table", over_filtered(
    CURRENT.format(rows="acc") + "SELECT tbl AS iceberg_table, dedup_key, type, version FROM cur"))
def current_table(spark, sf):
    # The changelog is written once, as an ingestion job does; the view then reads it twice.
    rows = cut_lineage(fx.numbered(fx.accepted_rows(spark, sf)))
    view = apply.merge_on_read(rows, ["iceberg_table", "dedup_key"])
    return view.select("iceberg_table", "dedup_key", "type", "version").orderBy("iceberg_table", "dedup_key", "version")


@query("src_7_file_metadata", "SELECT 'events.parquet' AS file_name, count(*) AS records FROM events")
def file_metadata(spark, sf):
    name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
    return fx.table(spark, sf, "events").groupBy(name.alias("file_name")).agg(F.count(F.lit(1)).alias("records"))


@query("src_8_time_travel", over_valid(
    ", old AS (SELECT * FROM valid WHERE commit_seq <= 7)" + CURRENT.format(rows="old")
    + "SELECT tbl AS iceberg_table, dedup_key, type, version FROM cur"))
def time_travel(spark, sf):
    rows = apply.as_of(fx.changelog(spark, sf), 7)
    return apply.merge_on_read(rows, ["iceberg_table", "dedup_key"]).select(
        "iceberg_table", "dedup_key", "type", "version")


@query("src_9_commit_event_scan", over_mentions(
    "SELECT event_id, off AS \"offset\" FROM ev WHERE group_id = 'cg-control-sink' AND off % 89 <> 3"))
def commit_event_scan(spark, sf):
    return audit.readable_events(fx.raw_commit_events(spark, sf), fx.GROUP).select("event_id", "offset")


@query("src_9_next_offsets", over_mentions("SELECT part AS partition, max(off) + 1 AS next_offset FROM ev GROUP BY part"))
def next_offsets(spark, sf):
    return audit.next_offsets(fx.raw_commit_events(spark, sf))


# --- projections --------------------------------------------------------------------------------


@query("prj_1_record_id", over_valid("SELECT id FROM msg"))
def record_id(spark, sf):
    return fx.cdc_messages(spark, sf).select(envelope.record_id().alias("id"))


@query("prj_2_random_id", over_valid("SELECT count(*) AS ids, count(*) FILTER (off % 2 = 0) AS own_ids FROM msg"))
def random_id(spark, sf):
    rows = fx.cdc_messages(spark, sf).withColumn("offset", F.when(F.col("offset") % 2 == 0, F.col("offset")))
    ids = rows.select(envelope.record_id_or_random().alias("id"))
    return ids.agg(F.count_distinct("id").alias("ids"), F.count_if(F.col("id").startswith("evt-")).alias("own_ids"))


@query("prj_3_composite_key", over_valid("SELECT id, dedup_key FROM valid"))
def composite_key(spark, sf):
    return fx.valid_rows(spark, sf).select("id", "dedup_key")


@query("prj_4_legacy_key", over_valid("SELECT id, topic || ':user_id' AS dedup_key FROM valid"))
def legacy_key(spark, sf):
    rows = envelope.parse_legacy_envelopes(fx.cdc_messages(spark, sf))
    return envelope.split_errors(rows)[0].select("id", "dedup_key")


@query("prj_5_record_json", over_valid(
    """SELECT id, CASE WHEN n_items = 2 THEN '[{"user_id":"U' || (user_id + 1) || '","value":' || value || '},{"user_id":"U'
       || user_id || '","value":' || value || '}]' ELSE '[{"user_id":"U' || user_id || '","value":' || value || '}]' END
       AS record FROM valid"""))
def record_json(spark, sf):
    return fx.valid_rows(spark, sf).select("id", "record")


@query("prj_6_version_cast", """
    SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN o_orderkey WHEN 1 THEN o_orderkey
        WHEN 2 THEN CAST(trunc(o_totalprice) AS BIGINT) WHEN 3 THEN -o_orderkey END AS version FROM orders""")
def version_cast(spark, sf):
    # A number, text, a fraction (truncated), signed text, padded text and fraction text (both refused).
    key, number = F.col("o_orderkey"), F.col("o_orderkey").cast("string")
    shapes = [number, F.concat(F.lit('"'), number, F.lit('"')), F.col("o_totalprice").cast("string"),
              F.concat(F.lit('"-'), number, F.lit('"')), F.concat(F.lit('" '), number, F.lit('"')), F.lit('"1.9"')]
    value = F.element_at(F.array(*shapes), (key % 6 + 1).cast("int"))
    doc = F.parse_json(F.concat(F.lit('{"version":'), value, F.lit("}")))
    return fx.table(spark, sf, "orders").select("o_orderkey", J.field_long(doc, "version").alias("version"))


@query("prj_7_length_text", over_valid("SELECT id, CAST(n_items AS VARCHAR) AS length FROM valid"))
def length_text(spark, sf):
    return fx.valid_rows(spark, sf).select("id", "length")


@query("prj_8_legacy_length", over_valid("SELECT id, CAST(n_items AS BIGINT) AS length FROM valid"))
def legacy_length(spark, sf):
    rows = envelope.parse_legacy_envelopes(fx.cdc_messages(spark, sf))
    return envelope.split_errors(rows)[0].select("id", "length")


@query("prj_9_operation", """
    SELECT event_id, CASE event_id % 4 WHEN 1 THEN 'U' WHEN 2 THEN 'D' ELSE 'I' END AS op FROM events""")
def operation(spark, sf):
    words = F.array(F.lit("insert"), F.lit("Update"), F.lit("DELETE"), F.lit("truncate"))
    word = F.element_at(words, (F.col("event_id") % 4 + 1).cast("int"))
    return fx.table(spark, sf, "events").select("event_id", text.operation_code(word).alias("op"))


@query("prj_10_ten_fields", over_valid(
    """SELECT id, dedup_key, version, type, 'user_id' AS key, upd AS ngay_cap_nhat, CAST(n_items AS VARCHAR) AS length,
       tbl AS iceberg_table, op AS _cdc_op, topic, part AS partition, off AS "offset", (epoch_us(ts) // 1000) AS ts_ms FROM valid"""))
def ten_fields(spark, sf):
    return fx.valid_rows(spark, sf).select(
        "id", "dedup_key", "version", "type", "key", "ngay_cap_nhat", "length", "iceberg_table", "_cdc_op",
        "topic", "partition", "offset", times.to_epoch_ms(F.col("timestamp")).alias("ts_ms"))


@query("prj_10_legacy_fields", over_valid(
    "SELECT id, topic || ':user_id' AS dedup_key, upd AS ingest_time, CAST(n_items AS BIGINT) AS length, "
    "'user_id' AS key, type, version FROM valid"))
def legacy_fields(spark, sf):
    rows = envelope.parse_legacy_envelopes(fx.cdc_messages(spark, sf))
    return envelope.split_errors(rows)[0].select("id", "dedup_key", "ingest_time", "length", "key", "type", "version")


@query("prj_11_strip_internal", over_valid(
    "SELECT id, dedup_key, version, type, 'user_id' AS key, upd AS ngay_cap_nhat, CAST(n_items AS VARCHAR) AS length FROM valid"))
def strip_internal(spark, sf):
    rows = fx.valid_rows(spark, sf).drop("topic", "partition", "offset", "timestamp", "record")
    return envelope.strip_internal(rows)


@query("prj_12_route_value", """
    SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 0 THEN CAST(o_custkey AS VARCHAR) END AS route_value FROM orders""")
def route_value(spark, sf):
    rows = fx.table(spark, sf, "orders").withColumn("c", F.when(F.col("o_orderkey") % 5 != 0, F.col("o_custkey")))
    return route.route_value(rows, "c").select("o_orderkey", "route_value")


# --- filters ------------------------------------------------------------------------------------


@query("flt_1_tombstones", over_valid("SELECT topic, count(*) AS read_records, count(*) FILTER (NOT tomb) AS row_records "
                                      "FROM msg GROUP BY topic"))
def tombstones(spark, sf):
    rows = fx.cdc_messages(spark, sf)
    kept = envelope.drop_tombstones(rows).groupBy("topic").agg(F.count(F.lit(1)).alias("row_records"))
    return rows.groupBy("topic").agg(F.count(F.lit(1)).alias("read_records")).join(kept, "topic")


ERROR_CASES = """
    SELECT o_orderkey, CASE o_orderkey % 11
        WHEN 1 THEN 'missing field data' WHEN 2 THEN 'missing field type' WHEN 3 THEN 'missing field version'
        WHEN 4 THEN 'missing field key' WHEN 5 THEN 'data is an empty list' WHEN 6 THEN 'no key value in data'
        WHEN 7 THEN 'version is not an integer' WHEN 8 THEN 'value is not JSON' WHEN 9 THEN 'value is not a JSON object'
        WHEN 10 THEN 'no key value in data' END AS error FROM orders"""


def _broken_messages(spark, sf):
    order = F.col("o_orderkey")
    item = F.concat(F.lit('[{"k":'), order.cast("string"), F.lit("}]"))
    bodies = [
        F.concat(F.lit('{"data":'), item, F.lit(',"key":"k","type":"INSERT","version":1}')),
        F.lit('{"key":"k","type":"INSERT","version":1}'),
        F.concat(F.lit('{"data":'), item, F.lit(',"key":"k","version":1}')),
        F.concat(F.lit('{"data":'), item, F.lit(',"key":"k","type":"INSERT","version":null}')),
        F.concat(F.lit('{"data":'), item, F.lit(',"type":"INSERT","version":1}')),
        F.lit('{"data":[],"key":"k","type":"INSERT","version":1}'),
        F.lit('{"data":[{"other":1},7,{"k":null}],"key":"k","type":"INSERT","version":1}'),
        F.concat(F.lit('{"data":'), item, F.lit(',"key":"k","type":"INSERT","version":"one"}')),
        F.lit('{"data":['),
        F.lit("[1,2]"),
        F.lit('{"data":{"k":1},"key":"k","type":"INSERT","version":1}'),
    ]
    value = F.element_at(F.array(*bodies), (order % 11 + 1).cast("int"))
    return fx.table(spark, sf, "orders").select(
        F.lit("orders").alias("topic"), F.lit(0).alias("partition"), order.alias("offset"),
        F.col("o_orderdate").cast("timestamp").alias("timestamp"), F.lit(None).cast("string").alias("key"),
        value.alias("value"))


@query("flt_2_3_validation", ERROR_CASES)
def validation(spark, sf):
    return envelope.parse_envelopes(_broken_messages(spark, sf)).select(F.col("offset").alias("o_orderkey"), "error")


@query("flt_4_legacy_validation", over_valid(
    "SELECT id, CASE WHEN nokey THEN 'missing field key' END AS error FROM msg WHERE NOT tomb"))
def legacy_validation(spark, sf):
    return envelope.parse_legacy_envelopes(fx.cdc_messages(spark, sf)).select("id", "error")


@query("flt_5_version_filter", over_filtered("SELECT id, dedup_key, type, version FROM acc"))
def version_filter(spark, sf):
    return fx.accepted_rows(spark, sf, (*fx.FILTER_COLUMNS, "id")).select("id", "dedup_key", "type", "version")


@query("flt_5_shared_state", """
    WITH RECURSIVE
    o AS (SELECT o_orderkey AS off, o_custkey AS k, CAST(o_totalprice AS BIGINT) % 1000 AS version, o_orderstatus = 'P' AS del,
                 row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn FROM orders),
    f AS (SELECT k, rn, off, TRUE AS ok, CASE WHEN del THEN NULL ELSE version END AS s FROM o WHERE rn = 1
          UNION ALL
          SELECT o.k, o.rn, o.off, f.s IS NULL OR o.version > f.s,
                 CASE WHEN f.s IS NULL OR o.version > f.s THEN CASE WHEN o.del THEN NULL ELSE o.version END ELSE f.s END
          FROM f JOIN o ON o.k = f.k AND o.rn = f.rn + 1)
    SELECT off AS o_orderkey FROM f WHERE ok""")
def shared_state(spark, sf):
    # A second key space, states shared by all topics, many deletes and unordered versions.
    rows = fx.table(spark, sf, "orders").select(
        F.col("o_custkey").cast("string").alias("dedup_key"), F.col("o_orderkey").alias("offset"),
        # A price of half a unit goes to the even neighbour, as SQL casts do here.
        (F.rint("o_totalprice").cast("bigint") % 1000).alias("version"),
        F.when(F.col("o_orderstatus") == "P", "DELETE").otherwise("UPDATE").alias("type"))
    return versions.filter_versions(rows, scope=(), order=("offset",), chunk_bits=(8, 12)).select(
        F.col("offset").alias("o_orderkey"))


@query("flt_6_route_regex", """
    SELECT o_orderkey, regexp_full_match(o_orderpriority, '1-URGENT|2-HIGH') AS alternation,
           regexp_full_match(o_orderpriority, 'URGENT') AS part FROM orders""")
def route_regex(spark, sf):
    value = F.col("o_orderpriority")
    return fx.table(spark, sf, "orders").select(
        "o_orderkey", text.matches_fully(value, "1-URGENT|2-HIGH").alias("alternation"),
        text.matches_fully(value, "URGENT").alias("part"))


@query("flt_10_point_lookup", over_valid(
    CURRENT.format(rows="valid") + "SELECT dedup_key, type, version, tbl AS iceberg_table FROM cur WHERE dedup_key = 'U7'"))
def point_lookup(spark, sf):
    view = apply.merge_on_read(fx.changelog(spark, sf), ["iceberg_table", "dedup_key"])
    return view.where(F.col("dedup_key") == "U7").select("dedup_key", "type", "version", "iceberg_table")


# --- routing ------------------------------------------------------------------------------------


@query("rte_1_topic_table", over_valid("SELECT DISTINCT topic, tbl AS iceberg_table FROM msg"))
def topic_table(spark, sf):
    return fx.cdc_messages(spark, sf).select(
        "topic", envelope.topic_table(F.col("topic"), "default", fx.TOPIC_TABLES).alias("iceberg_table")).distinct()


@query("rte_3_dynamic_route",
       "SELECT o_orderkey, lower(o_orderpriority) AS route_table FROM orders WHERE o_orderkey % 7 <> 0")
def dynamic_route(spark, sf):
    rows = fx.table(spark, sf, "orders").withColumn(
        "target", F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderpriority")))
    return route.route_dynamic(rows, "target").select("o_orderkey", "route_table")


@query("rte_4_all_tables", "SELECT o_orderkey, t.t AS route_table FROM orders, (VALUES ('db.a'), ('db.b')) t(t)")
def all_tables(spark, sf):
    return route.route_to_all(fx.table(spark, sf, "orders"), ["db.a", "db.b"]).select("o_orderkey", "route_table")


@query("rte_5_pattern_route", """
    SELECT o_orderkey, t.t AS route_table FROM orders,
        (VALUES ('db.urgent', '1-URGENT|2-HIGH'), ('db.low', '5-.*'), ('db.any', '.*'), ('db.part', 'URGENT')) t(t, p)
    WHERE regexp_full_match(o_orderpriority, t.p)""")
def pattern_route(spark, sf):
    return route.route_by_pattern(fx.table(spark, sf, "orders"), "o_orderpriority", ROUTES).select(
        "o_orderkey", "route_table")


# --- scalar functions and sorting ---------------------------------------------------------------


@query("fn_1_list_split", """
    SELECT p_partkey, len(string_split(p_name || ', ' || p_brand, ',')) AS parts,
           trim(p_brand) AS last_part FROM part""")
def list_split(spark, sf):
    parts = text.split_trimmed(F.concat_ws(", ", F.col("p_name"), F.col("p_brand")))
    return fx.table(spark, sf, "part").select(
        "p_partkey", F.size(parts).cast("bigint").alias("parts"), F.element_at(parts, -1).alias("last_part"))


@query("fn_2_case_and_replace", """
    SELECT o_orderkey, 'ns.' || replace(o_orderpriority, '-', '_') AS table_name, lower(o_orderpriority) AS low,
           upper(o_orderpriority) AS up FROM orders""")
def case_and_replace(spark, sf):
    value = F.col("o_orderpriority")
    return fx.table(spark, sf, "orders").select(
        "o_orderkey", text.table_from_topic(value, "ns").alias("table_name"), F.lower(value).alias("low"),
        F.upper(value).alias("up"))


@query("fn_3_srt_3_sort_and_join", """
    SELECT c_custkey, array_to_string(list_sort(['K' || c_custkey, 'K' || c_nationkey, 'k' || c_custkey]), '||') AS joined
    FROM customer""")
def sort_and_join(spark, sf):
    parts = F.array(F.concat(F.lit("K"), "c_custkey"), F.concat(F.lit("K"), "c_nationkey"), F.concat(F.lit("k"), "c_custkey"))
    return fx.table(spark, sf, "customer").select("c_custkey", F.array_join(F.array_sort(parts), "||").alias("joined"))


@query("fn_4_full_match", "SELECT user_id, event_id, regexp_full_match(event_type, '(cl|v).*') AS hit FROM events")
def full_match(spark, sf):
    return fx.table(spark, sf, "events").select(
        "user_id", "event_id", text.matches_fully(F.col("event_type"), "(cl|v).*").alias("hit"))


@query("fn_5_map_lookup", "SELECT event_id, event_type AS found, CAST(NULL AS VARCHAR) AS absent FROM events")
def map_lookup(spark, sf):
    entries = F.create_map(F.lit("kind"), F.col("event_type"))
    return fx.table(spark, sf, "events").select(
        "event_id", S.summary_value(entries, "kind").alias("found"), S.summary_value(entries, "none").alias("absent"))


@query("fn_6_epoch_ms", "SELECT event_id, (epoch_us(ts) // 1000) AS ms, (epoch_us(ts) // 1000) // 1000 AS seconds FROM events")
def epoch_ms(spark, sf):
    ms = times.to_epoch_ms(F.col("ts"))
    return fx.table(spark, sf, "events").select(
        "event_id", ms.alias("ms"), F.unix_seconds(times.from_epoch_ms(ms)).alias("seconds"))


@query("fn_7_latency", "SELECT event_id, CAST(event_id * 1000 AS BIGINT) - user_id AS latency_ms FROM events")
def latency(spark, sf):
    later, sooner = (F.col("event_id") * 1000).cast("string"), F.col("user_id").cast("string")
    return fx.table(spark, sf, "events").select("event_id", times.latency_ms(later, sooner).alias("latency_ms"))


@query("fn_8_json_field", "SELECT event_id, regexp_extract(props, '[0-9]+') AS k, CAST(NULL AS VARCHAR) AS gone FROM events")
def json_field(spark, sf):
    doc = J.decode(F.col("props"))
    return fx.table(spark, sf, "events").select(
        "event_id", J.field_text(doc, "k").alias("k"), J.field_text(doc, "gone").alias("gone"))


@query("fn_9_update_time", over_valid("SELECT id, (epoch_us(date_trunc('minute', ts)) // 1000) AS updated_ms FROM valid"))
def update_time(spark, sf):
    return fx.valid_rows(spark, sf).select(
        "id", times.to_epoch_ms(times.parse_update_time(F.col("ngay_cap_nhat"))).alias("updated_ms"))
