"""Oracle SQL of the log queries and log streams."""

from oracle.tables import r

MS = r("avg(execution_time_ms)")
DAY = "(year, month, day) = (2024, 1, 5)"

LOG_QUERIES = {
    "parse_database_logs": "SELECT * FROM database_logs",
    "parse_network_logs": "SELECT * FROM network_logs",
    "stream_database_logs": "SELECT * FROM database_logs",
    "stream_network_logs": "SELECT * FROM network_logs",
    "traffic_rollup": """
        SELECT date_trunc('hour', event_timestamp) AS window_start,
               date_trunc('hour', event_timestamp) + INTERVAL 1 HOUR AS window_end, protocol,
               count(*) AS connections, CAST(sum(bytes_sent) + sum(bytes_received) AS BIGINT) AS total_bytes
        FROM network_logs GROUP BY ALL""",
    "traffic_rollup_stream": """
        WITH delivered AS (
            SELECT *, (day - 1) // 6 + CASE WHEN CAST(connection_id[2:] AS BIGINT) % 7 = 0 THEN 3
                                            WHEN CAST(connection_id[2:] AS BIGINT) % 10 = 0 THEN 1 ELSE 0 END AS delivery,
                   date_trunc('hour', event_timestamp) AS window_start,
                   date_trunc('hour', event_timestamp) + INTERVAL 1 HOUR AS window_end
            FROM network_logs WHERE (day - 1) // 6 < 5
        ), reached AS (
            SELECT delivery, date_trunc('millisecond', max(event_timestamp)) - INTERVAL 9 DAY AS mark
            FROM delivered GROUP BY delivery
        ), marks AS (
            SELECT delivery, max(mark) OVER (ORDER BY delivery ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS mark
            FROM reached
        )
        SELECT window_start, window_end, protocol, count(*) AS connections,
               CAST(sum(bytes_sent) + sum(bytes_received) AS BIGINT) AS total_bytes
        FROM delivered JOIN marks USING (delivery)
        WHERE mark IS NULL OR window_end > mark
        GROUP BY ALL HAVING window_end <= (SELECT max(mark) FROM reached)""",
    "masked_connections": """
        SELECT * REPLACE (
            concat_ws('.', split_part(source_ip, '.', 1), split_part(source_ip, '.', 2), 'x', 'x') AS source_ip,
            concat_ws('.', split_part(destination_ip, '.', 1), split_part(destination_ip, '.', 2), 'x', 'x')
                AS destination_ip)
        FROM network_logs""",
    "masked_queries": """
        SELECT * REPLACE (
            concat_ws('.', split_part(client_ip, '.', 1), split_part(client_ip, '.', 2), 'x', 'x') AS client_ip,
            sha256(concat('lake', "user")) AS "user")
        FROM database_logs""",
    "quarantined_database_logs": """
        SELECT query_id, CAST(query_id[2:] AS BIGINT) % 7 = 0 AS truncated FROM database_logs
        WHERE CAST(query_id[2:] AS BIGINT) % 7 = 0 OR CAST(query_id[2:] AS BIGINT) % 11 = 0""",
    "logs_compacted": "SELECT * FROM database_logs",
    "logs_packed": "SELECT * FROM database_logs",
    "valid_database_logs": """
        SELECT * FROM database_logs WHERE CAST(query_id[2:] AS BIGINT) % 7 > 0 AND CAST(query_id[2:] AS BIGINT) % 11 > 0""",
    "db_query_count": "SELECT count(*) AS total_queries FROM database_logs",
    "db_perf_by_type": f"""
        SELECT query_type, count(*) AS query_count, {MS} AS avg_execution_time_ms,
               {r('max(execution_time_ms)')} AS max_execution_time_ms,
               {r('min(execution_time_ms)')} AS min_execution_time_ms
        FROM database_logs GROUP BY ALL""",
    "db_failed_queries": """
        SELECT "database", "table", query_type, error_message, count(*) AS failure_count
        FROM database_logs WHERE status = 'FAILED' GROUP BY ALL
        ORDER BY failure_count DESC, "database", "table", query_type, error_message LIMIT 20""",
    "db_top_users": f"""
        SELECT "user", count(*) AS query_count, {MS} AS avg_execution_time_ms
        FROM database_logs GROUP BY ALL ORDER BY query_count DESC, "user" LIMIT 10""",
    "db_hourly_pattern": f"""
        SELECT year, month, day, hour, count(*) AS query_count, {MS} AS avg_execution_time_ms
        FROM database_logs WHERE {DAY} GROUP BY ALL""",
    "db_slow_queries": """
        SELECT query_id, "database", "table", query_type, execution_time_ms, "user", "timestamp"
        FROM database_logs WHERE execution_time_ms > 5000 ORDER BY execution_time_ms DESC, query_id LIMIT 50""",
    "db_activity_by_database": f"""
        SELECT "database", count(*) AS total_queries, count(*) FILTER (status = 'SUCCESS') AS successful_queries,
               count(*) FILTER (status = 'FAILED') AS failed_queries, {MS} AS avg_execution_time_ms
        FROM database_logs GROUP BY ALL""",
    "net_connection_count": "SELECT count(*) AS total_connections FROM network_logs",
    "net_traffic_by_protocol": f"""
        SELECT protocol, count(*) AS connection_count, CAST(sum(bytes_sent) AS BIGINT) AS total_bytes_sent,
               CAST(sum(bytes_received) AS BIGINT) AS total_bytes_received, {r('avg(duration_ms)')} AS avg_duration_ms
        FROM network_logs GROUP BY ALL""",
    "net_http_status_distribution": f"""
        WITH web AS (SELECT status_code FROM network_logs WHERE protocol IN ('HTTP', 'HTTPS'))
        SELECT status_code, count(*) AS request_count,
               {r('100.0::DOUBLE * count(*) / (SELECT count(*) FROM web)')} AS percentage
        FROM web GROUP BY ALL""",
    "net_top_source_ips": """
        SELECT source_ip, count(*) AS connection_count, CAST(sum(bytes_sent) AS BIGINT) AS total_bytes_sent,
               CAST(sum(bytes_received) AS BIGINT) AS total_bytes_received
        FROM network_logs GROUP BY ALL ORDER BY connection_count DESC, source_ip LIMIT 20""",
    "net_top_ports": """
        SELECT destination_port, protocol, count(*) AS connection_count
        FROM network_logs GROUP BY ALL ORDER BY connection_count DESC, destination_port, protocol LIMIT 15""",
    "net_http_errors": """
        SELECT status_code, http_method, url_path, count(*) AS error_count
        FROM network_logs WHERE status_code >= 400 GROUP BY ALL
        ORDER BY error_count DESC, status_code, http_method, url_path LIMIT 30""",
    "net_hourly_traffic": f"""
        SELECT year, month, day, hour, count(*) AS connection_count,
               CAST(sum(bytes_sent) + sum(bytes_received) AS BIGINT) AS total_bytes
        FROM network_logs WHERE {DAY} GROUP BY ALL""",
    "net_top_user_agents": """
        SELECT user_agent, count(*) AS request_count
        FROM network_logs WHERE user_agent IS NOT NULL GROUP BY ALL
        ORDER BY request_count DESC, user_agent LIMIT 10""",
    "activity_correlation": f"""
        SELECT d.hour, count(DISTINCT d.query_id) AS db_queries, count(DISTINCT n.connection_id) AS network_connections
        FROM database_logs d LEFT JOIN network_logs n USING (year, month, day, hour)
        WHERE {DAY} GROUP BY d.hour""",
    "db_partition_scan": """
        SELECT year, month, day, hour, count(*) AS record_count
        FROM database_logs WHERE year = 2024 AND month = 1 GROUP BY ALL""",
}
