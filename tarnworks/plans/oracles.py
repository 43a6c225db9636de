"""The registered queries as plain SQL over the same Parquet tables."""

from __future__ import annotations

_LOADED_AT = "TIMESTAMP '2025-01-01 00:00:00'"

_CTES = {
    "landing_sales": f"""
        SELECT l_orderkey * 10 + l_linenumber AS id, CAST(l_shipdate AS DATE) AS sale_date,
               r_name AS region, p_type AS product,
               CAST(l_quantity * 21.5 AS DECIMAL(12,2)) AS amount,
               {_LOADED_AT} AS _loaded_at, 'greenplum' AS _source
        FROM lineitem
        JOIN part ON l_partkey = p_partkey
        JOIN supplier ON l_suppkey = s_suppkey
        JOIN nation ON s_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey""",
    "landing_events": f"""
        SELECT CASE WHEN event_id % 101 = 0 THEN NULL ELSE event_id - event_id % 3 END AS id, ts,
               CASE WHEN event_id % 97 = 0 THEN NULL ELSE upper(event_type) END AS region,
               concat('p', CAST(user_id % 4 AS VARCHAR)) AS product,
               CASE WHEN event_id % 89 = 0 THEN NULL WHEN event_id % 83 = 0 THEN -value * 4 ELSE value * 4 END AS amount,
               CAST(user_id % 3 AS INT) AS kafka_partition, event_id AS kafka_offset,
               {_LOADED_AT} AS _loaded_at, 'kafka' AS _source
        FROM events""",
    "topic": """
        SELECT id, ts, region, product, amount, kafka_partition,
               row_number() OVER (PARTITION BY kafka_partition ORDER BY kafka_offset) - 1 AS kafka_offset
        FROM landing_events""",
    "unified": """
        SELECT CAST(id AS BIGINT) AS id, sale_date, lower(region) AS region, product, amount, _source, _loaded_at,
               CAST(NULL AS TIMESTAMP) AS event_ts, CAST(NULL AS INT) AS kafka_partition,
               CAST(NULL AS BIGINT) AS kafka_offset
        FROM landing_sales
        UNION ALL
        SELECT CAST(id AS BIGINT), CAST(ts AS DATE), lower(region), product, TRY_CAST(amount AS DECIMAL(12,2)),
               _source, _loaded_at, ts, kafka_partition, kafka_offset
        FROM landing_events""",
    "ranked": """
        SELECT unified.*, row_number() OVER newest AS rn FROM unified
        WINDOW newest AS (PARTITION BY id, _source ORDER BY
            coalesce(_loaded_at, TIMESTAMP '0001-01-01 00:00:00') DESC, coalesce(event_ts, TIMESTAMP '0001-01-01 00:00:00') DESC,
            coalesce(kafka_partition, -1) DESC, coalesce(kafka_offset, -1) DESC, sale_date DESC NULLS LAST,
            amount DESC NULLS LAST, region DESC NULLS LAST, product DESC NULLS LAST)""",
    "core": """
        SELECT best.id, best.day AS sale_date, best.region, best.product, best.amount,
               best.id IS NOT NULL AND best.amount BETWEEN 0.01 AND 1000 AS is_valid,
               CAST(strftime(best.day, '%Y-%m-01') AS DATE) AS sale_month, src AS _source, best.loaded AS _loaded_at
        FROM (
            SELECT _source AS src, id, max({
                -- a field's NULL flag comes before the field, so that NULL is the least of its values
                'loaded': _loaded_at, 'ets': coalesce(event_ts, TIMESTAMP '0001-01-01 00:00:00'),
                'part': coalesce(kafka_partition, -1), 'off': coalesce(kafka_offset, -1),
                'has_day': sale_date IS NOT NULL, 'day': sale_date,
                'has_amount': amount IS NOT NULL, 'amount': amount,
                'has_region': region IS NOT NULL, 'region': region,
                'has_product': product IS NOT NULL, 'product': product, 'id': id}) AS best
            FROM unified GROUP BY src, id)""",
    "by_product": """
        SELECT sale_month, _source, region, product, n AS orders_cnt,
               CAST(CAST(s AS DECIMAL(18,2)) * 0.01 AS DECIMAL(18,2)) AS total_amount,
               CAST(CAST(((2 * s * 10000 + n) // (2 * n) + 5000) // 10000 AS DECIMAL(18,2)) * 0.01 AS DECIMAL(18,2))
                   AS avg_amount
        FROM (SELECT sale_month, _source, region, product, count(*) AS n,
                     CAST(sum(CAST(amount * 100 AS BIGINT)) AS HUGEINT) AS s
              FROM core WHERE is_valid GROUP BY ALL)""",
    "monthly": """
        SELECT sale_month, _source, count(*) AS orders_cnt, CAST(sum(amount) AS DECIMAL(18,2)) AS total_amount,
               count(DISTINCT region) AS regions_cnt, count(DISTINCT product) AS products_cnt
        FROM core WHERE is_valid GROUP BY sale_month, _source""",
    "landing_all": """
        SELECT _source, make_date(year(sale_date), month(sale_date), 1) AS month, CAST(id AS BIGINT) AS id, region,
               CAST(amount AS DOUBLE) AS amount
        FROM landing_sales
        UNION ALL
        SELECT _source, make_date(year(ts), month(ts), 1), CAST(id AS BIGINT), region, amount
        FROM landing_events""",
    "quality": f"""
        SELECT _source, month, count(*) AS rows_cnt,
               count(*) FILTER (WHERE id IS NULL) AS null_id_cnt,
               count(*) FILTER (WHERE region IS NULL) AS null_region_cnt,
               count(*) FILTER (WHERE amount IS NULL) AS null_amount_cnt,
               count(*) - count(DISTINCT id) AS dup_id_cnt,
               count(*) FILTER (WHERE amount <= 0 OR amount > 1000) AS amount_out_of_range_cnt,
               {_LOADED_AT} AS checked_at
        FROM landing_all GROUP BY _source, month""",
    "totals": """
        SELECT region, product, CAST(sum(amount) AS DECIMAL(22,2)) AS total_amount
        FROM landing_sales GROUP BY region, product""",
    "order_events": """
        SELECT o_orderkey AS id, o_orderdate AS ts, o_orderstatus AS kind, o_orderpriority AS payload FROM orders""",
    "first_orders": "SELECT * FROM order_events WHERE ts < TIMESTAMP '1998-01-01 00:00:00'",
    "shipped": """
        SELECT CASE WHEN l_returnflag = 'R' THEN -l_orderkey ELSE l_orderkey END AS id, max(l_returnflag) AS kind
        FROM lineitem GROUP BY 1""",
    "source_total": "SELECT CAST(sum(amount) AS DECIMAL(28,2)) AS v FROM landing_sales",
    "core_total": """
        SELECT CAST(sum(amount) AS DECIMAL(28,2)) AS v FROM core WHERE is_valid AND _source = 'greenplum'""",
}

_NEEDS = {
    "topic": ["landing_events"],
    "unified": ["landing_sales", "landing_events"],
    "ranked": ["unified"],
    "core": ["unified"],
    "by_product": ["core"],
    "monthly": ["core"],
    "landing_all": ["landing_sales", "landing_events"],
    "quality": ["landing_all"],
    "totals": ["landing_sales"],
    "first_orders": ["order_events"],
    "source_total": ["landing_sales"],
    "core_total": ["core"],
}


def _with(names: list[str], body: str) -> str:
    ordered: list[str] = []

    def visit(name: str) -> None:
        for needed in _NEEDS.get(name, []):
            visit(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        visit(name)
    return "WITH " + ",\n".join(f"{n} AS ({_CTES[n]})" for n in ordered) + "\n" + body


_SALES = "id, sale_date, region, product, amount"
_EVENT = "id, ts, region, product, amount"
_STREAMED = _EVENT + ", kafka_partition, kafka_offset"
_MONEY2 = "CAST(round(sum(amount), 2) AS DECIMAL(18,2))"
_ROUNDED = "CAST(round(sum(amount), 2) AS DECIMAL(23,2))"
_KEPT = "NOT coalesce(region = 'CLICK', false)"


def _pair(name: str, left: str, right: str, ok: str = "abs(l.v - r.v) < 0.01") -> str:
    return (
        f"SELECT '{name}' AS check_name, l.v AS left_value, r.v AS right_value, {ok} AS ok "
        f"FROM ({left}) l, ({right}) r"
    )


_SOURCE, _CORE = "SELECT v FROM source_total", "SELECT v FROM core_total"
_AT_MOST = "l.v <= r.v + 0.01"
_BY_PRODUCT = "SELECT CAST(sum(total_amount) AS DECIMAL(28,2)) AS v FROM by_product"
_MONTHLY = "SELECT CAST(sum(total_amount) AS DECIMAL(28,2)) AS v FROM monthly"
_RELATIONAL = " WHERE _source = 'greenplum'"
_QUALITY_ROWS = "SELECT CAST(count(*) AS DECIMAL(28,2)) AS v FROM quality"
_EVENT_ROWS = "SELECT CAST(count(*) AS DECIMAL(28,2)) AS v FROM events"


def _union(*parts: str) -> str:
    return "\nUNION ALL\n".join(parts)


ORACLES = {
    # sources
    "scan_jdbc": _with(["landing_sales"], f"SELECT {_SALES} FROM landing_sales"),
    "scan_pushdown": """
        SELECT l_orderkey, l_quantity FROM lineitem
        WHERE l_returnflag = 'R' AND l_shipdate >= TIMESTAMP '1998-01-01 00:00:00'""",
    "federated_region_totals": _with(
        ["landing_sales"], f"SELECT region, count(*) AS rows_cnt, {_MONEY2} AS total FROM landing_sales GROUP BY region"),
    "scan_raw_glob": _with(["totals"], """
        SELECT 2 * count(*) AS rows_cnt, CAST(2 * sum(total_amount) AS DECIMAL(33,2)) AS total FROM totals"""),
    "scan_versioned": _with(["totals"], """
        SELECT count(*) AS rows_cnt, CAST(sum(total_amount) AS DECIMAL(33,2)) AS total FROM totals"""),
    "seed_sales": """
        SELECT g AS id, CAST(DATE '2025-01-01' + CAST(g % 180 AS INT) AS DATE) AS sale_date,
               (['EMEA', 'APAC', 'AMER', 'LATAM'])[1 + g % 4] AS region,
               (['widget', 'gadget', 'gizmo', 'doohickey'])[1 + g % 4] AS product,
               CAST(CAST((((g % 100003) * 48271) % 100003) % 100001 AS DECIMAL(12,2)) * 0.01 AS DECIMAL(12,2)) AS amount
        FROM (SELECT o_orderkey + 1 AS g FROM orders)""",
    "seed_events": """
        SELECT CAST(g AS BIGINT) AS id, TIMESTAMP '2025-01-01 00:00:00' + to_seconds(g) AS ts,
               (['north', 'south', 'east', 'west'])[1 + h % 4] AS region,
               (['widget', 'gadget', 'gizmo', 'doohickey'])[1 + (h // 4) % 4] AS product,
               round(1 + (h % 99901) / 100.0, 2)::DOUBLE AS amount
        FROM (SELECT g, ((g % 100003) * 48271) % 100003 AS h FROM (SELECT event_id + 1 AS g FROM events))""",
    "topic_peek": _with(["topic"], """
        SELECT kafka_partition AS "partition", kafka_offset AS "offset", region AS "key", id, ts, region, product, amount
        FROM topic ORDER BY kafka_partition, kafka_offset LIMIT 3"""),
    "topic_watermarks": _with(["topic"], """
        SELECT kafka_partition AS "partition", min(kafka_offset) AS low, max(kafka_offset) + 1 AS high,
               max(kafka_offset) + 1 - min(kafka_offset) AS held
        FROM topic GROUP BY kafka_partition"""),
    # sinks
    "write_replace": _with(["totals"], "SELECT * FROM totals"),
    "create_if_absent": """
        SELECT 'created' AS step, CAST(0 AS BIGINT) AS rows_cnt
        UNION ALL SELECT 'filled', count(*) FROM events
        UNION ALL SELECT 'created_again', count(*) FROM events""",
    "write_append": _with(["totals"], "SELECT * FROM totals UNION ALL (VALUES ('POLAR', 'sundries', 17.25), (NULL, 'sundries', 0.50))"),
    "append_arrow": _with(["totals"], "SELECT * FROM totals UNION ALL (VALUES ('POLAR', 'correction', -2.50), ('INLAND', 'correction', 40.75))"),
    "insert_select": _with(["landing_sales"], "SELECT id, region, product, amount FROM landing_sales"),
    "seed_if_empty": """
        SELECT CAST(a AS INT) AS attempt, n AS rows_cnt
        FROM (SELECT count(*) AS n FROM orders), (SELECT unnest([1, 2]) AS a)""",
    "segment_counts": _with(["landing_sales"], """
        SELECT CAST(id % 4 AS INT) AS segment, count(*) AS rows_cnt FROM landing_sales GROUP BY 1"""),
    "replicated_counts": """
        SELECT CAST(s AS INT) AS segment, n AS rows_cnt
        FROM (SELECT count(*) AS n FROM supplier), (SELECT unnest([0, 1, 2, 3]) AS s)""",
    "partition_by_day": """
        SELECT event_id AS id, ts, event_type AS kind, props AS payload FROM events
        WHERE ts >= TIMESTAMP '2024-01-02 06:00:00' AND ts < TIMESTAMP '2024-01-11 18:00:00'""",
    "topic_produce": _with(["landing_events"], f"""
        SELECT {_EVENT}, kafka_partition,
               row_number() OVER (PARTITION BY kafka_partition ORDER BY event_no) - 1 AS kafka_offset
        FROM (SELECT {_EVENT}, kafka_offset AS event_no,
                     CAST(('0x' || substr(md5(coalesce(region, CAST(kafka_offset AS VARCHAR))), 1, 7))::BIGINT % 3 AS INT)
                         AS kafka_partition
              FROM landing_events)"""),
    "topic_produce_unkeyed": """
        SELECT count(*) AS messages, CAST(0 AS BIGINT) AS keyed, true AS spread, count(*) AS delivered,
               CAST(0 AS BIGINT) AS offset_gaps
        FROM events""",
    "landing_fallback": """
        SELECT 'absent' AS step, CAST(0 AS BIGINT) AS rows_cnt
        UNION ALL SELECT 'present', count(*) FROM events
        UNION ALL SELECT 'gone', count(*) FROM events""",
    "publish_marts": _with(["by_product"], """
        SELECT sale_month, _source, coalesce(region, '') AS region, coalesce(product, '') AS product, orders_cnt,
               total_amount, avg_amount
        FROM by_product"""),
    # conform
    "landing_sales": _with(["landing_sales"], f"SELECT {_SALES}, _loaded_at, _source FROM landing_sales"),
    "landing_union": _with(["landing_all"], "SELECT * FROM landing_all"),
    "landing_events": _with(["topic"], f"SELECT *, {_LOADED_AT} AS _loaded_at, 'kafka' AS _source FROM topic"),
    "core_unified": _with(["unified"], "SELECT * FROM unified"),
    "core_sales": _with(["core"], "SELECT * FROM core"),
    "dedup_ranked": _with(["ranked"], """
        SELECT _source, id, sale_date, region, product, amount, kafka_offset, rn FROM ranked"""),
    # aggregates
    "core_valid_total": _with(["core"], """
        SELECT count(*) AS rows_cnt, CAST(sum(amount) AS DECIMAL(18,2)) AS total
        FROM core WHERE is_valid AND _source = 'greenplum'"""),
    "mart_by_region_product_monthly": _with(["by_product"], "SELECT * FROM by_product"),
    "mart_monthly": _with(["monthly"], "SELECT * FROM monthly"),
    "mart_quality": _with(["quality"], "SELECT * FROM quality"),
    "layer_counts": _with(["core"], "SELECT count(*) AS rows_cnt, count(*) FILTER (WHERE is_valid) AS valid_cnt FROM core"),
    "sales_by_region_product": _with(["totals"], "SELECT * FROM totals"),
    "grand_total": _with(["landing_sales"], f"SELECT {_ROUNDED} AS total FROM landing_sales"),
    "region_stats": _with(
        ["landing_sales"], f"SELECT region, count(*) AS rows_cnt, {_ROUNDED} AS total FROM landing_sales GROUP BY region"),
    "one_region_stats": _with(["landing_sales"], f"""
        SELECT 'ASIA' AS region, count(*) AS rows_cnt, {_ROUNDED} AS total FROM landing_sales WHERE region = 'ASIA'"""),
    "region_stats_total": _with(["landing_sales"], f"""
        SELECT count(*) AS regions_cnt, CAST(sum(n) AS BIGINT) AS rows_cnt, CAST(sum(t) AS DECIMAL(34,2)) AS total
        FROM (SELECT count(*) AS n, {_ROUNDED} AS t FROM landing_sales GROUP BY region)"""),
    "approx_regions": _with(
        ["landing_sales"], "SELECT count(*) AS rows_cnt, count(DISTINCT region) AS regions_cnt FROM landing_sales"),
    "distinct_ids": _with(["landing_all"], """
        SELECT _source, CAST(date_trunc('quarter', month) AS DATE) AS quarter, count(DISTINCT id) AS ids_cnt
        FROM landing_all GROUP BY 1, 2
        UNION ALL SELECT _source, CAST(NULL AS DATE), count(DISTINCT id) FROM landing_all GROUP BY 1"""),
    "approx_distinct_ids": _with(["landing_all"], """
        SELECT _source, CAST(date_trunc('year', month) AS DATE) AS year, count(DISTINCT id) AS exact_cnt, true AS within_2_percent
        FROM landing_all GROUP BY 1, 2"""),
    "distinct_regions": _with(["landing_sales"], "SELECT DISTINCT region FROM landing_sales"),
    "weekday_split": _with(["landing_sales"], """
        SELECT isodow(sale_date) >= 6 AS is_weekend, count(*) AS rows_cnt,
               CAST(sum(amount) AS DECIMAL(18,2)) AS total_amount
        FROM landing_sales GROUP BY 1"""),
    "order_by": _with(["quality"], "SELECT * FROM quality ORDER BY _source, month"),
    "top_n": _with(["totals"], "SELECT * FROM totals ORDER BY region NULLS FIRST, product NULLS FIRST LIMIT 20"),
    # streams
    "parse_events": _with(["topic"], f"SELECT {_STREAMED} FROM topic"),
    "stream_ingest": _with(["topic"], f"SELECT {_STREAMED} FROM topic"),
    "stream_incremental": _with(["topic"], f"SELECT {_STREAMED} FROM topic"),
    "stream_two_readers": _with(["landing_events"], """
        SELECT reader, n AS rows_cnt, k AS ids_cnt
        FROM (SELECT count(*) AS n, count(id) AS k FROM landing_events), (SELECT unnest(['eager', 'late']) AS reader)"""),
    "stream_mv_pump": _with(
        ["landing_events"], "SELECT id, CAST(date_trunc('second', ts) AS TIMESTAMP) AS ts, region, product, amount FROM landing_events"),
    "stream_latest": "SELECT count(*) AS rows_cnt, CAST(date_trunc('second', max(ts)) AS TIMESTAMP) AS latest_ts FROM events",
    "raw_json_landing": _with(["landing_events"], f"SELECT {_EVENT} FROM landing_events"),
    "raw_object_sizes": "SELECT count(*) AS lines_cnt, true AS none_above, true AS none_below FROM events",
    "stream_quarantine": _with(["landing_events"], """
        SELECT kafka_partition, kafka_offset, '{spoilt ' || CAST(kafka_offset AS VARCHAR) AS message
        FROM landing_events WHERE kafka_offset % 50 = 7"""),
    "message_quality": _with(["landing_events"], """
        SELECT kafka_partition, count(*) AS messages, count(*) FILTER (WHERE kafka_offset % 50 <> 7) AS good,
               count(*) FILTER (WHERE kafka_offset % 50 = 7) AS malformed
        FROM landing_events GROUP BY kafka_partition"""),
    "snapshot_summary": """
        SELECT 'append' AS operation, count(*) AS added_records, count(*) AS total_records
        FROM events WHERE ts < TIMESTAMP '2024-01-15 00:00:00'
        UNION ALL
        SELECT 'append', count(*) FILTER (WHERE ts >= TIMESTAMP '2024-01-15 00:00:00'), count(*) FROM events""",
    "stream_flow": _with(["landing_events"], """
        SELECT region, count(*) AS rows_cnt, max(ts) AS latest_ts FROM landing_events GROUP BY region"""),
    "file_size_profile": _with(["order_events"], """
        SELECT strftime(ts, '%Y') AS year, CAST(1 AS BIGINT) AS file_count, count(*) AS rows_cnt, true AS sketch_agrees
        FROM order_events GROUP BY 1"""),
    # versions
    "table_history": """
        SELECT CAST(0 AS BIGINT) AS version, 'create' AS operation, CAST(0 AS BIGINT) AS total_records
        UNION ALL SELECT 1, 'append', count(*) FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01 00:00:00'
        UNION ALL SELECT 2, 'append', count(*) FROM orders
        UNION ALL SELECT 3, 'delete', count(*) FROM orders WHERE NOT coalesce(o_orderstatus = 'P', false)""",
    "time_travel": _with(["first_orders"], "SELECT * FROM first_orders"),
    "schema_evolution": _with(["order_events"], """
        SELECT *, CASE WHEN ts >= TIMESTAMP '1998-01-01 00:00:00' THEN 'web' END AS source FROM order_events"""),
    "merge_upsert": _with(["order_events", "shipped"], """
        SELECT coalesce(o.id, u.id) AS id, o.ts, CASE WHEN u.id IS NULL THEN o.kind ELSE u.kind END AS kind, o.payload
        FROM order_events o FULL JOIN shipped u ON o.id = u.id"""),
    "delete_copy_on_write": _with(["landing_events"], f"SELECT {_STREAMED} FROM landing_events WHERE {_KEPT}"),
    "delete_merge_on_read": _with(["landing_events"], f"""
        SELECT {_STREAMED} FROM landing_events WHERE {_KEPT} AND NOT coalesce(amount > 500, false)"""),
    "table_delete_files": _with(["landing_events"], """
        SELECT count(*) AS deleted_rows, true AS has_delete_files FROM landing_events WHERE region = 'CLICK'"""),
    "compact_files": _with(["order_events"], "SELECT *, true AS fewer_files, true AS settled FROM order_events"),
    "compact_deletes": _with(["landing_events"], f"""
        SELECT {_STREAMED}, CAST(0 AS BIGINT) AS delete_files FROM landing_events WHERE {_KEPT}"""),
    "expire_snapshots": _with(["order_events"], """
        SELECT *, CAST(1 AS INT) AS snapshots FROM order_events WHERE NOT coalesce(kind = 'P', false)"""),
    "orphan_files": "SELECT count(*) AS orphan_rows FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01 00:00:00'",
    "table_partitions": """
        SELECT '_day=' || CAST(CAST(ts AS DATE) AS VARCHAR) AS "partition", count(*) AS record_count
        FROM events GROUP BY 1""",
    # checks and whole flows
    "reconcile_layers": _with(["source_total", "core_total", "by_product", "monthly"], _union(
        _pair("mart_equals_core", _BY_PRODUCT + _RELATIONAL, _CORE),
        _pair("marts_agree", _BY_PRODUCT + _RELATIONAL, _MONTHLY + _RELATIONAL),
        _pair("core_within_source", _CORE, _SOURCE, _AT_MOST),
        _pair("core_equals_source", _CORE, _SOURCE),
    )),
    "verify_publish": _with(["source_total", "core_total", "by_product", "monthly", "quality"], _union(
        _pair("serving_by_region_product", _BY_PRODUCT, _BY_PRODUCT),
        _pair("serving_monthly", _MONTHLY, _MONTHLY),
        _pair("serving_quality_rows", _QUALITY_ROWS, _QUALITY_ROWS),
        _pair("mart_equals_core", _MONTHLY + _RELATIONAL, _CORE),
        _pair("core_within_source", _CORE, _SOURCE, _AT_MOST),
    )),
    "verify_paths": _with(["source_total"], _union(*[
        _pair(name, _SOURCE, _SOURCE)
        for name in ("source_equals_catalog", "source_equals_snapshot", "source_equals_files")
    ])),
    "verify_stream_counts": _pair("topic_equals_table", _EVENT_ROWS, _EVENT_ROWS),
    "etl_region_product": _with(["totals"], "SELECT * FROM totals"),
    "medallion_flow": _with(["monthly"], "SELECT * FROM monthly"),
}
