"""Common table expressions of the SQL twins: the whole analysis, written once in SQL."""

PRELUDE = r"""
WITH ev AS (
  SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         CAST(round(value * 100) AS BIGINT) AS bo FROM events
), net AS (
  SELECT event_id, ts AS event_time,
         CASE WHEN user_id <= 3 AND ts >= TIMESTAMP '2024-01-24 00:00:00' THEN 'new' ELSE 'u' END
           || CAST(user_id AS VARCHAR) AS "user",
         '10.0.' || CAST(user_id // 250 AS VARCHAR) || '.' || CAST(user_id % 250 + 1 AS VARCHAR) AS src_ip,
         CAST(49152 + event_id % 16384 AS INTEGER) AS src_port,
         CASE WHEN k < 10 THEN '10.1.0.' ELSE '203.0.113.' END || CAST(k AS VARCHAR) AS dest_ip,
         event_type || '.example' AS dest_host,
         CAST(CASE k % 5 WHEN 0 THEN 443 WHEN 1 THEN 80 WHEN 2 THEN 22 WHEN 3 THEN 445 ELSE 3389 END AS INTEGER)
           AS dest_port,
         'tcp' AS protocol, event_type AS app_name,
         bo * 3 AS bytes_in, bo AS bytes_out,
         (bo * 3) // 1500 AS packets_in, bo // 1500 AS packets_out,
         CAST(1 + event_id % 300 AS INTEGER) AS session_duration,
         'Allowed' AS action, bo >= 25000 AS is_anomaly, k, user_id
  FROM ev
), netr AS (
  SELECT *, CASE WHEN is_anomaly AND bytes_out > 25000 THEN 'data_exfiltration'
                 WHEN hour(event_time) < 8 OR hour(event_time) > 18 THEN 'after_hours' END AS anomaly_reason
  FROM net
), proc AS (
  SELECT event_id, ts AS event_time, 'u' || CAST(user_id AS VARCHAR) AS "user",
         'h' || CAST(k % 7 AS VARCHAR) AS host,
         CASE WHEN event_type = 'signup' THEN 'powershell.exe' WHEN event_type = 'purchase' THEN 'cmd.exe'
              WHEN event_type = 'error' AND value >= 150 THEN 'mimikatz.exe'
              WHEN event_type = 'error' THEN 'python.exe' WHEN event_type = 'click' THEN 'chrome.exe'
              ELSE 'excel.exe' END AS process_name,
         '/opt/p' || CAST(k % 13 AS VARCHAR) AS process_path,
         CASE WHEN k % 2 = 0 THEN 'explorer.exe' ELSE 'bash' END AS parent_process,
         event_type = 'error' AND value >= 150 AS is_anomaly, k
  FROM ev
), procx AS (
  SELECT *, process_name || ' --k ' || CAST(k AS VARCHAR) AS cmd_line,
         md5(process_name) AS md5_hash, sha256(process_name) AS sha256_hash FROM proc
), b AS (
  SELECT max(event_time) - INTERVAL 28 DAYS AS baseline_start,
         max(event_time) - INTERVAL 7 DAYS AS analysis_start, max(event_time) AS analysis_end FROM net
), net_both AS (
  SELECT net.*, CAST(event_time AS DATE) AS date,
         CASE WHEN event_time < analysis_start THEN 'baseline' ELSE 'analysis' END AS period
  FROM net, b WHERE event_time >= baseline_start AND event_time <= analysis_end
), proc_both AS (
  SELECT procx.*, CAST(event_time AS DATE) AS date,
         CASE WHEN event_time < analysis_start THEN 'baseline' ELSE 'analysis' END AS period
  FROM procx, b WHERE event_time >= baseline_start AND event_time <= analysis_end
), net_daily AS (
  SELECT "user", date, period, count(*) AS daily_events,
         CAST(sum(bytes_out) AS BIGINT) AS daily_bytes_out, CAST(sum(bytes_in) AS BIGINT) AS daily_bytes_in,
         CAST(sum(packets_out) AS BIGINT) AS daily_packets_out,
         CAST(sum(packets_in) AS BIGINT) AS daily_packets_in,
         count(DISTINCT dest_ip) AS unique_destinations, count(DISTINCT dest_host) AS unique_hosts,
         count(DISTINCT dest_port) AS unique_ports, count(DISTINCT app_name) AS unique_apps,
         count(DISTINCT hour(event_time)) AS active_hours,
         CAST(min(hour(event_time)) AS INTEGER) AS first_activity_hour,
         CAST(max(hour(event_time)) AS INTEGER) AS last_activity_hour,
         avg(session_duration) AS avg_session_duration, max(session_duration) AS max_session_duration
  FROM net_both GROUP BY "user", date, period
), proc_daily AS (
  SELECT "user", date, period, count(*) AS daily_processes,
         count(DISTINCT process_name) AS unique_processes, count(DISTINCT process_path) AS unique_paths,
         count(DISTINCT host) AS unique_hosts, count(DISTINCT parent_process) AS unique_parents,
         count(*) FILTER (WHERE process_name IN ('powershell.exe','cmd.exe','bash','sudo','ssh'))
           AS admin_process_count,
         count(*) FILTER (WHERE process_name = 'mimikatz.exe') AS suspicious_process_count
  FROM proc_both GROUP BY "user", date, period
), net_base AS (
  SELECT "user", avg(daily_events) AS baseline_avg_events, stddev_samp(daily_events) AS baseline_std_events,
         max(daily_events) AS baseline_max_events,
         avg(daily_bytes_out) AS baseline_avg_bytes_out, stddev_samp(daily_bytes_out) AS baseline_std_bytes_out,
         max(daily_bytes_out) AS baseline_max_bytes_out,
         avg(unique_destinations) AS baseline_avg_destinations,
         stddev_samp(unique_destinations) AS baseline_std_destinations,
         avg(unique_hosts) AS baseline_avg_hosts, stddev_samp(unique_hosts) AS baseline_std_hosts,
         avg(active_hours) AS baseline_avg_active_hours,
         avg(first_activity_hour) AS baseline_typical_start_hour,
         avg(last_activity_hour) AS baseline_typical_end_hour, count(DISTINCT date) AS baseline_active_days
  FROM net_daily WHERE period = 'baseline' GROUP BY "user"
), proc_base AS (
  SELECT "user", avg(daily_processes) AS baseline_avg_processes,
         stddev_samp(daily_processes) AS baseline_std_processes,
         avg(unique_processes) AS baseline_avg_unique_processes,
         stddev_samp(unique_processes) AS baseline_std_unique_processes,
         avg(admin_process_count) AS baseline_avg_admin_processes,
         stddev_samp(admin_process_count) AS baseline_std_admin_processes,
         count(DISTINCT date) AS baseline_process_active_days
  FROM proc_daily WHERE period = 'baseline' GROUP BY "user"
), ranges AS (
  SELECT min(baseline_avg_events) AS min_e, max(baseline_avg_events) AS max_e,
         min(baseline_avg_bytes_out) AS min_b, max(baseline_avg_bytes_out) AS max_b FROM net_base
), norm AS (
  SELECT "user",
         CASE WHEN max_e - min_e > 0 THEN (baseline_avg_events - min_e) / (max_e - min_e) ELSE 0 END
           AS norm_baseline_avg_events,
         CASE WHEN max_b - min_b > 0 THEN (baseline_avg_bytes_out - min_b) / (max_b - min_b) ELSE 0 END
           AS norm_baseline_avg_bytes_out
  FROM net_base, ranges
), centroids AS (
  SELECT * FROM (VALUES (0, 0.1::DOUBLE), (1, 0.3::DOUBLE), (2, 0.5::DOUBLE), (3, 0.7::DOUBLE), (4, 0.9::DOUBLE))
    AS c(peer_group, v)
), peer_dist AS (
  SELECT norm.*, peer_group,
         (norm_baseline_avg_events - v) * (norm_baseline_avg_events - v)
           + (norm_baseline_avg_bytes_out - v) * (norm_baseline_avg_bytes_out - v) AS sq
  FROM norm, centroids
), assigned AS (
  SELECT * FROM peer_dist QUALIFY row_number() OVER (PARTITION BY "user" ORDER BY sq, peer_group) = 1
), peers AS (
  SELECT "user", peer_group FROM assigned
), net_joined AS (
  SELECT d.*, baseline_avg_events, baseline_std_events, baseline_max_events, baseline_avg_bytes_out,
         baseline_std_bytes_out, baseline_max_bytes_out, baseline_avg_destinations, baseline_std_destinations,
         baseline_avg_hosts, baseline_std_hosts, baseline_avg_active_hours, baseline_typical_start_hour,
         baseline_typical_end_hour, baseline_active_days, peer_group
  FROM net_daily d LEFT JOIN net_base USING ("user") LEFT JOIN peers USING ("user") WHERE period = 'analysis'
), net_z AS (
  SELECT *,
         coalesce(CASE WHEN baseline_std_events > 0
           THEN abs(daily_events - baseline_avg_events) / baseline_std_events END, 0) AS events_zscore,
         coalesce(CASE WHEN baseline_std_bytes_out > 0
           THEN abs(daily_bytes_out - baseline_avg_bytes_out) / baseline_std_bytes_out END, 0) AS bytes_out_zscore,
         coalesce(CASE WHEN baseline_std_destinations > 0
           THEN abs(unique_destinations - baseline_avg_destinations) / baseline_std_destinations END, 0)
           AS destinations_zscore,
         coalesce(CASE WHEN baseline_std_hosts > 0
           THEN abs(unique_hosts - baseline_avg_hosts) / baseline_std_hosts END, 0) AS hosts_zscore,
         CASE WHEN first_activity_hour < baseline_typical_start_hour - 2
                OR last_activity_hour > baseline_typical_end_hour + 2 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END
           AS after_hours_anomaly
  FROM net_joined
), net_sc0 AS (
  SELECT *,
         least(events_zscore / 3.0::DOUBLE, 1.0::DOUBLE) * 0.2::DOUBLE
           + least(bytes_out_zscore / 3.0::DOUBLE, 1.0::DOUBLE) * 0.4::DOUBLE
           + least(destinations_zscore / 3.0::DOUBLE, 1.0::DOUBLE) * 0.2::DOUBLE
           + least(hosts_zscore / 3.0::DOUBLE, 1.0::DOUBLE) * 0.1::DOUBLE
           + after_hours_anomaly * 0.1::DOUBLE AS network_anomaly_score,
         least(events_zscore / 3.0::DOUBLE, 1.0::DOUBLE) * 0.2::DOUBLE
           + least(bytes_out_zscore / 3.0::DOUBLE, 1.0::DOUBLE) * 0.4::DOUBLE
           + least(destinations_zscore / 3.0::DOUBLE, 1.0::DOUBLE) * 0.2::DOUBLE
           + after_hours_anomaly * 0.2::DOUBLE AS four_score
  FROM net_z
), net_sc AS (
  SELECT *, CASE WHEN network_anomaly_score >= 0.85::DOUBLE THEN 'CRITICAL'
                 WHEN network_anomaly_score >= 0.7::DOUBLE THEN 'HIGH'
                 WHEN network_anomaly_score >= 0.5::DOUBLE THEN 'MEDIUM' ELSE 'LOW' END AS network_anomaly_level
  FROM net_sc0
), proc_z AS (
  SELECT d.*, baseline_avg_processes, baseline_std_processes, baseline_avg_unique_processes,
         baseline_std_unique_processes, baseline_avg_admin_processes, baseline_std_admin_processes,
         baseline_process_active_days,
         coalesce(CASE WHEN baseline_std_processes > 0
           THEN abs(daily_processes - baseline_avg_processes) / baseline_std_processes END, 0) AS processes_zscore,
         coalesce(CASE WHEN baseline_std_unique_processes > 0
           THEN abs(unique_processes - baseline_avg_unique_processes) / baseline_std_unique_processes END, 0)
           AS unique_processes_zscore,
         coalesce(CASE WHEN baseline_std_admin_processes > 0
           THEN abs(admin_process_count - baseline_avg_admin_processes) / baseline_std_admin_processes END, 0)
           AS admin_processes_zscore
  FROM proc_daily d LEFT JOIN proc_base USING ("user") WHERE period = 'analysis'
), proc_sc0 AS (
  SELECT *,
         least(processes_zscore / 3.0::DOUBLE, 1.0::DOUBLE) * 0.3::DOUBLE
           + least(unique_processes_zscore / 3.0::DOUBLE, 1.0::DOUBLE) * 0.2::DOUBLE
           + least(admin_processes_zscore / 3.0::DOUBLE, 1.0::DOUBLE) * 0.3::DOUBLE
           + CASE WHEN suspicious_process_count > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END * 0.2::DOUBLE
           AS process_anomaly_score
  FROM proc_z
), proc_sc AS (
  SELECT *, CASE WHEN process_anomaly_score >= 0.85::DOUBLE THEN 'CRITICAL'
                 WHEN process_anomaly_score >= 0.7::DOUBLE THEN 'HIGH'
                 WHEN process_anomaly_score >= 0.5::DOUBLE THEN 'MEDIUM' ELSE 'LOW' END AS process_anomaly_level
  FROM proc_sc0
), net_group AS (
  SELECT peer_group, date, count(*) AS n, avg(daily_events) AS me, var_samp(daily_events) AS ve,
         avg(daily_bytes_out) AS mb, var_samp(daily_bytes_out) AS vb
  FROM net_sc WHERE peer_group IS NOT NULL GROUP BY 1, 2
), net_others AS (
  SELECT s.*, n, ve, vb, (n * me - daily_events) / nullif(n - 1, 0) AS oe, (n * mb - daily_bytes_out) / nullif(n - 1, 0) AS ob, me, mb
  FROM net_sc s LEFT JOIN net_group g ON g.peer_group = s.peer_group AND g.date = s.date
), net_spread AS (
  SELECT *, CASE WHEN n > 2 THEN greatest(ve * (n - 1) - (daily_events - me) * (daily_events - oe), 0) / (n - 2) END AS re,
         CASE WHEN n > 2 THEN greatest(vb * (n - 1) - (daily_bytes_out - mb) * (daily_bytes_out - ob), 0) / (n - 2) END AS rb
  FROM net_others
), net_peer AS (
  SELECT *, coalesce(CASE WHEN re > 1e-9 * greatest(ve, 1) THEN abs(daily_events - oe) / sqrt(re) END, 0) AS peer_z_events,
         coalesce(CASE WHEN rb > 1e-9 * greatest(vb, 1) THEN abs(daily_bytes_out - ob) / sqrt(rb) END, 0) AS peer_z_bytes_out
  FROM net_spread
), net_kinds AS (
  SELECT *, concat_ws(',',
           CASE WHEN events_zscore > 2.5 OR bytes_out_zscore > 2.5 THEN 'volume' END,
           CASE WHEN destinations_zscore > 2.5 OR hosts_zscore > 2.5 THEN 'diversity' END,
           CASE WHEN after_hours_anomaly > 0 THEN 'temporal' END,
           CASE WHEN greatest(peer_z_events, peer_z_bytes_out) > 2.5 THEN 'peer_deviation' END) AS anomaly_types
  FROM net_peer
), proc_grouped AS (
  SELECT s.*, peer_group FROM proc_sc s LEFT JOIN peers USING ("user")
), proc_group AS (
  SELECT peer_group, date, count(*) AS n, avg(daily_processes) AS mp, var_samp(daily_processes) AS vp,
         avg(unique_processes) AS mu, var_samp(unique_processes) AS vu
  FROM proc_grouped WHERE peer_group IS NOT NULL GROUP BY 1, 2
), proc_others AS (
  SELECT s.*, n, vp, vu, mp, mu, (n * mp - daily_processes) / nullif(n - 1, 0) AS op, (n * mu - unique_processes) / nullif(n - 1, 0) AS ou
  FROM proc_grouped s LEFT JOIN proc_group g ON g.peer_group = s.peer_group AND g.date = s.date
), proc_spread AS (
  SELECT *, CASE WHEN n > 2 THEN greatest(vp * (n - 1) - (daily_processes - mp) * (daily_processes - op), 0) / (n - 2) END AS rp,
         CASE WHEN n > 2 THEN greatest(vu * (n - 1) - (unique_processes - mu) * (unique_processes - ou), 0) / (n - 2) END AS ru
  FROM proc_others
), proc_kinds AS (
  SELECT *, concat_ws(',',
           CASE WHEN processes_zscore > 2.5 THEN 'volume' END,
           CASE WHEN unique_processes_zscore > 2.5 THEN 'diversity' END,
           CASE WHEN coalesce(CASE WHEN rp > 1e-9 * greatest(vp, 1) THEN abs(daily_processes - op) / sqrt(rp) END, 0) > 2.5
                  OR coalesce(CASE WHEN ru > 1e-9 * greatest(vu, 1) THEN abs(unique_processes - ou) / sqrt(ru) END, 0) > 2.5
                THEN 'peer_deviation' END,
           CASE WHEN suspicious_process_count > 0 THEN 'suspicious_resource' END) AS anomaly_types
  FROM proc_spread
), net_risk AS (
  SELECT "user", max(network_anomaly_score) AS max_network_risk,
         count(*) FILTER (WHERE network_anomaly_score >= 0.5::DOUBLE) AS medium_high_network_days,
         CAST(sum(daily_events) AS BIGINT) AS total_events, CAST(sum(daily_bytes_out) AS BIGINT) AS total_bytes_out,
         string_agg(DISTINCT CAST(date AS VARCHAR), ',' ORDER BY CAST(date AS VARCHAR)) AS analysed_dates,
         coalesce(string_agg(DISTINCT CAST(date AS VARCHAR), ',' ORDER BY CAST(date AS VARCHAR))
           FILTER (WHERE network_anomaly_score >= 0.5::DOUBLE), '') AS anomalous_dates
  FROM net_sc GROUP BY "user"
), proc_risk AS (
  SELECT "user", max(process_anomaly_score) AS max_process_risk,
         count(*) FILTER (WHERE process_anomaly_score >= 0.5::DOUBLE) AS medium_high_process_days,
         CAST(sum(suspicious_process_count) AS BIGINT) AS total_suspicious_processes
  FROM proc_sc GROUP BY "user"
), combined AS (
  SELECT coalesce(n."user", p."user") AS "user", coalesce(max_network_risk, 0) AS max_network_risk,
         coalesce(medium_high_network_days, 0) AS medium_high_network_days,
         coalesce(total_events, 0) AS total_events, coalesce(total_bytes_out, 0) AS total_bytes_out,
         coalesce(analysed_dates, '') AS analysed_dates, coalesce(anomalous_dates, '') AS anomalous_dates,
         coalesce(max_process_risk, 0) AS max_process_risk,
         coalesce(medium_high_process_days, 0) AS medium_high_process_days,
         coalesce(total_suspicious_processes, 0) AS total_suspicious_processes
  FROM net_risk n FULL OUTER JOIN proc_risk p ON n."user" = p."user"
), risk AS (
  SELECT x.*, peer_group,
         CASE WHEN combined_risk_score >= 0.85::DOUBLE THEN 'CRITICAL'
              WHEN combined_risk_score >= 0.7::DOUBLE THEN 'HIGH'
              WHEN combined_risk_score >= 0.5::DOUBLE THEN 'MEDIUM' ELSE 'LOW' END AS final_risk_level
  FROM (SELECT *, max_network_risk * 0.6::DOUBLE + max_process_risk * 0.4::DOUBLE AS combined_risk_score
        FROM combined) x LEFT JOIN peers USING ("user")
), net_find AS (
  SELECT sha256('network_anomaly|' || s."user" || '|' || CAST(date AS VARCHAR)) AS finding_id,
         CAST(date AS TIMESTAMP) AS event_time, s."user", 'network_anomaly' AS finding_type,
         network_anomaly_level AS severity,
         'Anomalous Network Behavior Detected - ' || s."user" AS title,
         'User ' || s."user" || ' (Peer Group ' || CAST(coalesce(r.peer_group, -1) AS VARCHAR)
           || ') exhibited unusual network activity on ' || CAST(date AS VARCHAR) AS description,
         network_anomaly_score AS risk_score, final_risk_level AS risk_level,
         'ueba_network_anomaly_detection' AS analytic_name, 'statistical_ml' AS analytic_type,
         coalesce(r.peer_group, -1) AS peer_group,
         'Review detailed network logs for this user,Verify user identity and location,'
           || CASE WHEN bytes_out_zscore > 2 THEN 'Check for data exfiltration indicators'
                   ELSE 'Monitor ongoing activity' END AS recommended_actions,
         daily_events, coalesce(baseline_avg_events, 0) AS baseline_avg_events, events_zscore,
         coalesce(daily_bytes_out, 0) AS daily_bytes_out, bytes_out_zscore, unique_destinations,
         after_hours_anomaly > 0 AS after_hours, anomaly_types
  FROM net_kinds s JOIN risk r ON s."user" = r."user" WHERE network_anomaly_score >= 0.5::DOUBLE
), proc_find AS (
  SELECT sha256('process_anomaly|' || s."user" || '|' || CAST(date AS VARCHAR)) AS finding_id,
         CAST(date AS TIMESTAMP) AS event_time, s."user", 'process_anomaly' AS finding_type,
         process_anomaly_level AS severity,
         'Anomalous Process Activity Detected - ' || s."user" AS title,
         'User ' || s."user" || ' executed unusual processes on ' || CAST(date AS VARCHAR) AS description,
         process_anomaly_score AS risk_score, final_risk_level AS risk_level,
         'ueba_process_anomaly_detection' AS analytic_name, 'statistical_ml' AS analytic_type,
         coalesce(r.peer_group, -1) AS peer_group,
         'Review process execution logs,Verify process hashes against threat intelligence,'
           || 'Check for privilege escalation attempts' AS recommended_actions,
         daily_processes, coalesce(baseline_avg_processes, 0) AS baseline_avg_processes,
         suspicious_process_count, anomaly_types
  FROM proc_kinds s JOIN risk r ON s."user" = r."user" WHERE process_anomaly_score >= 0.5::DOUBLE
), find AS (
  SELECT finding_id, event_time, "user", finding_type, severity, title, description, risk_score, risk_level,
         analytic_name, analytic_type, peer_group, recommended_actions FROM net_find
  UNION ALL
  SELECT finding_id, event_time, "user", finding_type, severity, title, description, risk_score, risk_level,
         analytic_name, analytic_type, peer_group, recommended_actions FROM proc_find
), rule_net AS (
  SELECT event_id, event_time, "user", 'network_anomaly' AS finding_type,
         CASE WHEN anomaly_reason = 'data_exfiltration' THEN 'High' ELSE 'Medium' END AS severity,
         'Anomalous Network Activity Detected - ' || coalesce(anomaly_reason, 'None') AS title,
         'User ' || "user" || ' exhibited unusual network behavior' AS description,
         src_ip, dest_ip, dest_host, bytes_out AS bytes_transferred,
         'rule_network_' || coalesce(anomaly_reason, 'None') AS analytic_name,
         CASE WHEN anomaly_reason = 'data_exfiltration' THEN 0.8::DOUBLE ELSE 0.6::DOUBLE END AS risk_score,
         'Alert Generated' AS action_taken
  FROM netr WHERE is_anomaly
), rule_proc AS (
  SELECT event_id, event_time, "user", 'process_anomaly' AS finding_type, 'High' AS severity,
         'Suspicious Process Execution Detected' AS title,
         'User ' || "user" || ' executed suspicious process: ' || process_name AS description,
         host, process_name, cmd_line, sha256_hash AS process_hash, 'rule_suspicious_process' AS analytic_name,
         0.9::DOUBLE AS risk_score, 'Alert Generated' AS action_taken
  FROM procx WHERE is_anomaly
), feed AS (
  SELECT DISTINCT dest_ip, 'high' AS threat_level FROM net WHERE bytes_out >= 30000
), user_hist AS (
  SELECT "user", CAST(event_time AS DATE) AS date, count(*) AS daily_events,
         CAST(sum(bytes_out) AS BIGINT) AS daily_bytes_out, count(DISTINCT dest_ip) AS unique_destinations
  FROM net GROUP BY 1, 2
), roles AS (
  SELECT "user", peer_group FROM peers
  UNION ALL
  SELECT DISTINCT "user", 2 AS peer_group FROM net WHERE "user" IN ('new1', 'new2')
), feats AS (
  SELECT "user", baseline_avg_events, coalesce(baseline_std_events, 0) AS baseline_std_events,
         baseline_avg_bytes_out, coalesce(baseline_std_bytes_out, 0) AS baseline_std_bytes_out,
         baseline_avg_destinations, coalesce(baseline_std_destinations, 0) AS baseline_std_destinations,
         baseline_typical_start_hour, baseline_typical_end_hour, peer_group,
         combined_risk_score, final_risk_level
  FROM net_base JOIN peers USING ("user")
  JOIN (SELECT "user", combined_risk_score, final_risk_level FROM risk) r USING ("user")
), vec AS (
  SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS anomaly_score FROM embeddings
)
"""
