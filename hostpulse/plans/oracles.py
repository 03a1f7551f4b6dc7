"""The registered queries as plain SQL over the given tables, for another engine to check.

Written for DuckDB. ``WITH`` parts are shared text; each query names the ones it
reads and gets those they need. Numbers that Spark rounds are rounded here in
decimal, half up, from the shortest text of the double, which is Spark's rule.
"""

from __future__ import annotations

import re


def _rounded(number: str, digits: int) -> str:
    text = f"cast(cast({number} as double) as varchar)"
    return f"cast(round(cast({text} as decimal(38, 20)), {digits}) as double)"


def _share(part: str, whole: str) -> str:
    return _rounded(f"({part}) / ({whole})", 4)


def _percent(part: str, whole: str) -> str:
    return _rounded(f"({part}) / ({whole}) * 100", 2)


def _zscore(value: str, name: str) -> str:
    return _rounded(f"({value} - mean_{name}) / nullif(stddev_{name}, 0)", 2)


_HOST = """
    case when event_id % 29 = 4 then 'crawler'
         when event_type = 'error' and event_id % 31 = 5 then 'scanner'
         when event_type <> 'error' and event_id % 18 = 1 then 'poller'
         when event_id % 2000 = 5 then concat('mirror', event_id)
         when event_type <> 'error' and event_id % 7 = 6
           then concat('host', user_id, '-', event_id % 11)
         else concat('host', user_id) end"""


def _line(host: str) -> str:
    return f"""
    case when event_id % 97 = 0 then concat('GARBAGE ', event_id)
         when event_id % 107 = 1 then '   '
         else concat({host}, ' - - [',
             case when event_id % 101 = 0 then 'bad-time'
                  when ts >= timestamp '2024-01-12 04:00:00' and ts < timestamp '2024-01-12 07:00:00'
                    and event_id % 100 <> 0 then 'bad-time'
                  else concat(strftime(ts, '%d/%b/%Y:%H:%M:%S'),
                    case event_id % 13 when 0 then ' -0400' when 1 then ' +0530'
                      else ' +0000' end) end,
             '] "', case when event_type in ('purchase', 'signup') then 'POST' else 'GET' end, ' ',
             case when event_id % 6 = 1 then '/index'
                  when event_type <> 'error' and event_id % 11 = 2 then '/home'
                  when event_type = 'error' and event_id % 13 = 8 then '/missing'
                  else concat('/', event_type, '/', json_extract_string(props, '$.k'),
                    case when event_id % 23 = 7 then concat('/', event_id % 5) else '' end) end,
             ' HTTP/1.0" ',
             case when event_type = 'error' and event_id % 3 <> 0 then 404
                  when event_type = 'error' then 500
                  when event_id % 17 = 0 then 304 else 200 end, ' ',
             case when event_id % 17 = 0 then '-'
                  when event_id % 89 = 1 then '12x'
                  when event_id % 89 = 2 then '3000000000'
                  when event_id % 2000 = 5 then '90000000'
                  else cast(cast(floor(value * 100) as bigint) as varchar) end,
             case when event_id % 103 = 1 then '  ' else '' end)
    end"""


_PATTERN = r"""'^(\S+) \S+ \S+ \[([^\]]+)\] "(\S+) (\S+) (\S+)" (\d{3}) (\S+)'"""


def _requests(lines: str) -> str:
    parts = ", ".join(f"regexp_extract(log, {_PATTERN}, {i}) as p{i}" for i in range(1, 8))
    return f"""
    select p1 as host,
        try_strptime(p2, '%d/%b/%Y:%H:%M:%S %z') at time zone 'UTC' as "timestamp",
        p3 as method, p4 as endpoint, p5 as protocol, cast(p6 as integer) as status,
        try_cast(case when p7 = '-' then '0' else p7 end as integer) as bytes
    from (select {parts} from {lines}) where p1 <> ''"""


def _mean_and_spread(**columns: str) -> str:
    return ", ".join(
        f"avg({column}) as mean_{name}, stddev_samp({column}) as stddev_{name}"
        for name, column in columns.items()
    )


def _guarded(value: str, name: str) -> str:
    return f"case when stddev_{name} = 0 then 0 else ({value} - mean_{name}) / stddev_{name} end"


def _enriched(expected: str) -> str:
    return f"""
    select a.*, b.batch_total_requests, b.batch_error_rate, b.batch_endpoint_breadth,
        b.expected_hourly_requests,
        {_rounded(f"live_requests / ({expected} / 6 + 1)", 2)} as rate_multiplier,
        {_rounded("(live_requests - global_mean / 6) / nullif(global_stddev / 6, 0)", 2)}
            as global_z_score
    from live_activity a left join ip_baselines b on a.host = b.host
        cross join global_stats"""


_RANK = """case severity when 'CRITICAL' then 1 when 'HIGH' then 2 when 'MEDIUM' then 3
    when 'LOW' then 4 else 5 end"""

_PARTS = {
    "lines": f"select {_line(_HOST)} as log from events",
    "live_lines": f"""
        select log from (select {_line(
            f"case when event_id % 2500 = 3 then concat('ghost', event_id) else {_HOST} end")} as log,
            case event_id % 2500 when 1 then 60 when 2 then 8 when 3 then 40 else 1 end as reps
            from events), unnest(range(reps)) as copies(copy)""",
    "silver": _requests("lines"),
    "live_silver": _requests("live_lines"),
    "hours": f"""
        select date_trunc('hour', "timestamp") as hour_bucket,
            count(*) as total_requests, cast(sum(bytes) as bigint) as total_bytes,
            count(*) filter (status = 404) as errors_404,
            count(*) filter (status = 500) as errors_500,
            count(*) filter (status between 200 and 299) as success_count,
            {_share("count(*) filter (status in (404, 500))", "count(*)")} as error_rate,
            {_share("count(*) filter (status between 200 and 299)", "count(*)")} as success_rate
        from silver group by 1""",
    "hourly_stats": f"""
        select *, {_rounded('''avg(total_requests) over (
            order by hour_bucket nulls first rows between 2 preceding and current row)''', 2)}
            as rolling_3hr_avg_requests from hours""",
    "ip_behaviour": f"""
        select host, count(*) as total_requests,
            cast(sum(bytes) as bigint) as total_bytes_transferred,
            count(*) filter (status >= 400) as total_errors,
            {_percent("count(*) filter (status >= 400)", "count(*)")} as error_rate_pct,
            min("timestamp") as first_seen, max("timestamp") as last_seen,
            count(distinct endpoint) as unique_endpoints_hit
        from silver group by host""",
    "endpoint_stats": f"""
        select endpoint, count(*) as total_hits,
            {_rounded("cast(sum(bytes) as double) / count(bytes)", 2)} as avg_bytes,
            max(bytes) as max_bytes, count(*) filter (status = 404) as not_found_count,
            count(*) filter (status = 200) as success_count,
            count(distinct host) as unique_visitors
        from silver group by endpoint""",
    "ip_baselines": f"""
        select host, total_requests as batch_total_requests,
            error_rate_pct as batch_error_rate, unique_endpoints_hit as batch_endpoint_breadth,
            {_rounded("total_requests / (28 * 24)", 2)} as expected_hourly_requests
        from ip_behaviour""",
    "global_stats": """
        select avg(total_requests) as global_mean, stddev_samp(total_requests) as global_stddev
        from hourly_stats""",
    "hour_norms": "select " + _mean_and_spread(
        requests="total_requests", error_rate="error_rate", bytes="total_bytes"
    ) + " from hourly_stats",
    "ip_norms": "select " + _mean_and_spread(
        requests="total_requests", error_rate="error_rate_pct",
        endpoints="unique_endpoints_hit", bytes="total_bytes_transferred",
    ) + " from ip_behaviour",
    "endpoint_norms": "select " + _mean_and_spread(
        **{"404": "not_found_count"}, bytes="avg_bytes", hits="total_hits"
    ) + " from endpoint_stats",
    "hour_changes": """
        select *,
            case when prev_requests is null or prev_requests = 0 then 0.0::double
                else (total_requests - prev_requests) / prev_requests * 100
                end as request_change_pct,
            case when prev_error_rate is null or prev_error_rate = 0 then 0.0::double
                else (error_rate - prev_error_rate) / (prev_error_rate + 0.0001::double) * 100
                end as error_rate_change_pct
        from (select *, lag(total_requests) over clock as prev_requests,
                lag(error_rate) over clock as prev_error_rate,
                lag(total_bytes) over clock as prev_bytes
            from hourly_stats window clock as (order by hour_bucket nulls first))""",
    "hour_scores": f"""
        select c.*, {_guarded("total_requests", "requests")} as request_z_score,
            {_guarded("error_rate", "error_rate")} as error_rate_z_score,
            {_guarded("total_bytes", "bytes")} as bytes_z_score
        from hour_changes c cross join hour_norms""",
    "ip_zs": f"""
        select h.*, {_zscore("total_requests", "requests")} as volume_z,
            {_zscore("error_rate_pct", "error_rate")} as error_z,
            {_zscore("unique_endpoints_hit", "endpoints")} as breadth_z,
            {_zscore("total_bytes_transferred", "bytes")} as bytes_z
        from ip_behaviour h cross join ip_norms""",
    "ip_scores": f"""
        select *, {_rounded('''volume_z * 0.3::double + error_z * 0.3::double
            + breadth_z * 0.25::double + bytes_z * 0.15::double''', 2)} as suspicion_score
        from ip_zs""",
    "endpoint_scores": f"""
        select e.*, {_percent("not_found_count", "total_hits")} as not_found_rate,
            {_zscore("not_found_count", "404")} as "404_z",
            {_zscore("avg_bytes", "bytes")} as bytes_z,
            {_zscore("total_hits", "hits")} as hits_z
        from endpoint_stats e cross join endpoint_norms""",
    "hour_findings": """
        select 'HOURLY' as anomaly_source, hour_bucket as detected_at,
            cast(null as varchar) as host, cast(null as varchar) as endpoint,
            case when request_z_score > 2.5 then 'TRAFFIC_SPIKE'
                 when request_z_score < -2.5 then 'UNUSUAL_QUIET'
                 when error_rate_z_score > 2.5 then 'ERROR_SURGE'
                 when request_change_pct > 100 then 'SUDDEN_HOH_JUMP' end as anomaly_type,
            request_z_score as z_score, total_requests as metric_value,
            request_change_pct as change_pct, rolling_3hr_avg_requests as baseline_value
        from hour_scores""",
    "ip_findings": """
        select 'IP' as anomaly_source, first_seen as detected_at, host,
            cast(null as varchar) as endpoint,
            case when volume_z > 3 and breadth_z > 3 then 'BOT_SCRAPER'
                 when error_z > 3 and volume_z > 1 then 'ENDPOINT_SCANNER'
                 when bytes_z > 3 and volume_z < 1 then 'BULK_DOWNLOADER'
                 when error_rate_pct > 20 then 'HIGH_ERROR_IP'
                 when suspicion_score > 2.5 then 'GENERALLY_SUSPICIOUS' end as anomaly_type,
            suspicion_score as z_score, total_requests as metric_value,
            error_rate_pct as change_pct, cast(total_requests as double) as baseline_value
        from ip_scores""",
    "endpoint_findings": """
        select 'ENDPOINT' as anomaly_source, cast(null as timestamp) as detected_at,
            cast(null as varchar) as host, endpoint,
            case when not_found_rate > 50 then 'MOSTLY_BROKEN_ENDPOINT'
                 when "404_z" > 3 and hits_z > 2 then 'ATTACKED_ENDPOINT'
                 when bytes_z > 3 then 'UNUSUALLY_HEAVY_PAYLOAD'
                 when hits_z > 4 and not_found_rate < 1 then 'HOTSPOT_ENDPOINT'
                 end as anomaly_type,
            hits_z as z_score, total_hits as metric_value,
            not_found_rate as change_pct, avg_bytes as baseline_value
        from endpoint_scores""",
    "findings": """
        select *, case when z_score >= 6 then 'CRITICAL' when z_score >= 4 then 'HIGH'
            when z_score >= 2.5 then 'MEDIUM' else 'LOW' end as severity
        from (select * from hour_findings union all select * from ip_findings
            union all select * from endpoint_findings)
        where anomaly_type is not null""",
    "live_activity": f"""
        select host, window_start, count(*) as live_requests,
            count(*) filter (status >= 400) as live_errors,
            count(*) filter (status = 404) as live_404s,
            {_percent("count(*) filter (status >= 400)", "count(*)")} as live_error_rate
        from (select host, status,
                time_bucket(interval 5 minute, "timestamp") - to_minutes(cast(5 * back as integer))
                    as window_start
            from live_silver, unnest([0, 1]) as slides(back)
            where "timestamp" is not null)
        group by host, window_start""",
    # Lines by the trigger that takes them; a line without a time comes with the first.
    "live_slices": f"""
        select log, event_at,
            dense_rank() over (order by coalesce(slot, first_slot)) - 1 as batch_id
        from (select *, min(slot) over () as first_slot
            from (select log, event_at, cast(floor(epoch(event_at) / (3 * 86400)) as bigint)
                    + case when md5(log) like '0%' then 2 else 0 end as slot
                from (select log,
                    try_strptime(nullif(regexp_extract(log, {_PATTERN}, 2), ''),
                        '%d/%b/%Y:%H:%M:%S %z') at time zone 'UTC' as event_at
                    from live_lines)))""",
    "live_batches": """
        select batch_id, count(*) as input_rows,
            max(max(event_at)) over (order by batch_id
                rows between unbounded preceding and 1 preceding) - interval 10 minute as watermark
        from live_slices group by batch_id""",
    # Rows are late by the watermark that the trigger before theirs started with.
    "live_rows": f"""
        select host, status, window_start,
            coalesce(window_start + interval 10 minute <= b.watermark, false) as late
        from (select batch_id, regexp_extract(log, {_PATTERN}, 1) as host,
                cast(regexp_extract(log, {_PATTERN}, 6) as integer) as status,
                time_bucket(interval 5 minute, event_at) - to_minutes(cast(5 * back as integer))
                    as window_start
            from live_slices, unnest([0, 1]) as slides(back) where event_at is not null) r
        left join live_batches b on b.batch_id = r.batch_id - 1""",
    "live_enriched": _enriched("expected_hourly_requests"),
    "live_enriched_v2": _enriched("coalesce(expected_hourly_requests, 0)"),
    "live_findings": """
        select *, case when rate_multiplier > 10 then 'CRITICAL' when rate_multiplier > 5 then 'HIGH'
            when live_error_rate > 50 then 'CRITICAL' else 'MEDIUM' end as severity
        from (select *,
                case when batch_total_requests is not null and rate_multiplier > 5
                        then 'PERSONAL_SPIKE'
                     when batch_total_requests is null and global_z_score > 3
                        then 'UNKNOWN_IP_SURGE'
                     when live_error_rate > 30 then 'LIVE_ERROR_SURGE'
                     when live_404s > 20 and batch_error_rate < 5
                        then 'NEW_SCANNING_BEHAVIOUR' end as anomaly_type
            from live_enriched)
        where anomaly_type is not null""",
    "live_findings_v2": """
        select *,
            case when rate_multiplier > 15 or live_error_rate > 60 then 'CRITICAL'
                 when rate_multiplier > 8 or global_z_score > 4 then 'HIGH'
                 when rate_multiplier > 5 or live_error_rate > 30 then 'MEDIUM'
                 else 'LOW' end as severity
        from (select *,
                case when batch_total_requests is not null and rate_multiplier > 10
                        then 'PERSONAL_SPIKE'
                     when batch_total_requests is not null and rate_multiplier > 5
                        then 'SUSPICIOUS_ACTIVITY'
                     when batch_total_requests is null and global_z_score > 3
                        then 'UNKNOWN_IP_SURGE'
                     when live_error_rate > 30 then 'LIVE_ERROR_SURGE'
                     when live_404s > 20 and batch_error_rate < 5
                        then 'SCANNING_BEHAVIOUR' end as anomaly_type
            from live_enriched_v2)
        where anomaly_type is not null""",
    "page_findings": f"""
        select * from live_findings
        order by {_RANK}, window_start desc, host limit 1000""",
    "page_hours": "select * from hourly_stats order by hour_bucket desc nulls last limit 168",
    "page_hosts": "select * from ip_behaviour order by total_requests desc, host limit 500",
    "page_endpoints": "select * from endpoint_stats order by total_hits desc, endpoint limit 500",
    "shown_hosts": "select * from ip_behaviour order by total_requests desc, host limit 20",
    "found": """
        select * from live_findings
        where severity in ('CRITICAL', 'HIGH') and regexp_matches(host, '(?i)HOST1')""",
}


def _needed(text: str, found: dict[str, None]) -> None:
    """Collect the parts a text mentions, each after the parts it mentions itself."""
    for name in _PARTS:
        if name not in found and re.search(rf"\b(from|join|union all select \* from)\s+{name}\b", text):
            _needed(_PARTS[name], found)
            found[name] = None


def _sql(body: str) -> str:
    parts: dict[str, None] = {}
    _needed(body, parts)
    heads = ",\n".join(f"{name} as ({_PARTS[name]})" for name in parts)
    return f"with {heads}\n{body}"


def _six(*names: str) -> str:
    return "replace (" + ", ".join(f'round("{name}", 6) as "{name}"' for name in names) + ")"


def _norms(table: str, prefix: str, *names: str) -> str:
    columns = ", ".join(
        f'round({word}_{name}, 6) as "{prefix}{word}_{name}"'
        for name in names
        for word in ("mean", "stddev")
    )
    return f"select {columns} from {table}"


_FEED = "window_start, host, anomaly_type, severity, rate_multiplier, global_z_score"

_CLOSED = """
    window_start + interval 10 minute
        <= (select max("timestamp") from live_silver) - interval 10 minute"""

# The blanks that a replay strips.
_BLANKS = " || ".join(f"chr({code})" for code in (32, 9, 10, 13, 12, 11, 28, 29, 30, 31))
_TRIMMED = f"select trim(log, {_BLANKS}) as log from lines"

_BODIES = {
    "bronze_lines": "select log from lines",
    "silver_parse": "select * from silver",
    "parse_quality": f"""
        select count(*) filter (not regexp_matches(log, {_PATTERN})) as malformed_rows,
            count(*) filter (regexp_matches(log, {_PATTERN})) as clean_rows from lines""",
    "status_distribution": 'select status, count(*) as "count" from silver group by status',
    "status_partition_scan": "select * from silver where status = 404",
    "replay_feed": f"""
        select log from (select log, try_strptime(regexp_extract(log, {_PATTERN}, 2),
            '%d/%b/%Y:%H:%M:%S %z') as event_time from ({_TRIMMED}) where log <> '')
        order by event_time nulls last, log""",
    "replay_summary": f"""
        select count(*) as lines, count(*) filter (log <> '') as sent,
            count(*) filter (log = '') as blank from ({_TRIMMED})""",
    "layer_counts": " union all ".join(
        f"""select '{layer}' as layer, count(*) as "rows" from {part}"""
        for layer, part in (
            ("bronze", "lines"),
            ("silver", "silver"),
            ("hourly_stats", "hourly_stats"),
            ("ip_behaviour", "ip_behaviour"),
            ("endpoint_stats", "endpoint_stats"),
            ("ip_baselines", "ip_baselines"),
            ("global_stats", "global_stats"),
            ("anomalies", "findings"),
            ("live_anomalies", "live_findings"),
        )
    ),
    "hourly_stats": "select * from hourly_stats",
    "ip_behaviour": "select * from ip_behaviour",
    "endpoint_stats": "select * from endpoint_stats",
    "ip_hourly": """
        select host, date_trunc('hour', "timestamp") as hour_start, count(*) as requests_in_hour
        from silver where "timestamp" is not null group by 1, 2""",
    "daily_hourly_stats": "select * from hourly_stats",
    "daily_ip_behaviour": "select * from ip_behaviour",
    "daily_endpoint_stats": "select * from endpoint_stats",
    "daily_ip_hourly": """
        select host, date_trunc('hour', "timestamp") as hour_start, count(*) as requests_in_hour
        from silver where "timestamp" is not null group by 1, 2""",
    "daily_traffic": f"""
        select cast(date_trunc('day', "timestamp") as timestamp) as day,
            count(*) as total_requests, cast(sum(bytes) as bigint) as total_bytes,
            {_percent("count(*) filter (status >= 400)", "count(*)")} as error_rate_pct,
            count(distinct host) as hosts, count(distinct endpoint) as endpoints
        from silver group by 1""",
    "ip_baselines": "select * from ip_baselines",
    "global_stats": """
        select round(global_mean, 6) as global_mean, round(global_stddev, 6) as global_stddev
        from global_stats""",
    "broken_endpoints_ranked": f"""
        select *, {_percent("not_found_count", "total_hits")} as not_found_rate_pct
        from endpoint_stats where total_hits > 50""",
    "known_broken_endpoints": f"""
        select endpoint from endpoint_stats
        where {_rounded("not_found_count / total_hits", 2)} > 0.2::double""",
    "hourly_baseline": _norms("hour_norms", "global_", "requests", "error_rate", "bytes"),
    "ip_baseline_stats": _norms("ip_norms", "", "requests", "error_rate", "endpoints", "bytes"),
    "endpoint_baseline_stats": _norms("endpoint_norms", "", "404", "bytes", "hits"),
    "minute_stats": f"""
        select * exclude (rolling, change), {_rounded("rolling", 2)} as rolling_avg_requests,
            round(change, 6) as request_change_pct
        from (select *, coalesce((total_requests - prev_requests) / prev_requests * 100, 0.0) as change
            from (select *, avg(total_requests) over (clock rows between 4 preceding and current row)
                    as rolling, lag(total_requests) over clock as prev_requests
                from (select date_trunc('minute', "timestamp") as minute_bucket,
                        count(*) as total_requests, cast(sum(bytes) as bigint) as total_bytes,
                        count(*) filter (status = 404) as errors_404,
                        count(*) filter (status = 500) as errors_500,
                        count(*) filter (status between 200 and 299) as success_count,
                        {_share("count(*) filter (status in (404, 500))", "count(*)")} as error_rate,
                        {_share("count(*) filter (status between 200 and 299)", "count(*)")}
                            as success_rate
                    from silver group by 1)
                window clock as (order by minute_bucket nulls first)))""",
    "hourly_lag_change": f"""
        select * {_six("request_change_pct", "error_rate_change_pct")} from hour_changes""",
    "hourly_zscores": """
        select hour_bucket, round(request_z_score, 6) as request_z_score,
            round(error_rate_z_score, 6) as error_rate_z_score,
            round(bytes_z_score, 6) as bytes_z_score from hour_scores""",
    "hourly_anomalies": f"""
        select * {_six("z_score", "change_pct")} from hour_findings
        where anomaly_type is not null""",
    "ip_scored": "select * from ip_scores",
    "ip_anomalies": "select * from ip_findings where anomaly_type is not null",
    "endpoint_scored": "select * from endpoint_scores",
    "endpoint_anomalies": "select * from endpoint_findings where anomaly_type is not null",
    "batch_anomalies": f"""select * {_six("z_score", "change_pct")} from findings""",
    "anomaly_summary": """
        select anomaly_source, anomaly_type, severity, count(*) as "count"
        from findings group by all""",
    "anomaly_by_source_type": """
        select anomaly_source, anomaly_type, count(*) as "count" from findings group by all""",
    "anomaly_by_severity": """select severity, count(*) as "count" from findings group by 1""",
    "critical_batch": """
        select anomaly_source, anomaly_type, host, endpoint, round(z_score, 6) as z_score,
            metric_value
        from findings where severity = 'CRITICAL'
        order by findings.z_score desc nulls last, anomaly_source, host nulls first,
            endpoint nulls first, detected_at nulls first""",
    "live_activity": "select * from live_activity",
    "live_enriched": "select * from live_enriched",
    "live_enriched_bucketed": "select * from live_enriched",
    "live_anomalies": "select * from live_findings",
    "live_enriched_v2": "select * from live_enriched_v2",
    "live_anomalies_v2": "select * from live_findings_v2",
    "live_by_type": """select anomaly_type, count(*) as "count" from live_findings group by 1""",
    "live_by_severity": """select severity, count(*) as "count" from live_findings group by 1""",
    "critical_live": """
        select host, window_start, live_requests, rate_multiplier, global_z_score, anomaly_type
        from live_findings where severity = 'CRITICAL'
        order by rate_multiplier desc nulls last, window_start, host""",
    "live_activity_stream": f"select * from live_activity where {_CLOSED}",
    "live_anomalies_stream": f"select * from live_findings where {_CLOSED}",
    "live_activity_bounded": f"""
        select host, window_start, count(*) as live_requests,
            count(*) filter (status >= 400) as live_errors,
            count(*) filter (status = 404) as live_404s,
            {_percent("count(*) filter (status >= 400)", "count(*)")} as live_error_rate
        from live_rows where not late and {_CLOSED} group by 1, 2""",
    "live_late_rows": """
        select host, window_start, count(*) as late_requests
        from live_rows where late group by 1, 2""",
    "live_progress": """
        select batch_id, input_rows, coalesce(watermark, timestamp '1970-01-01') as watermark,
            cast(0 as bigint) as unseen from live_batches""",
    "serve_anomalies": "select * from page_findings",
    "serve_anomalies_next": f"""
        select * from live_findings
        order by {_RANK}, window_start desc, host limit 1000 offset 1000""",
    "serve_hourly": "select * from page_hours",
    "serve_ip": "select * from page_hosts",
    "serve_endpoint": "select * from page_endpoints",
    "serve_kpi": """
        select a.*, latest_error_rate, latest_total_requests, unique_ips,
            case when latest_error_rate > 0.1::double then 'RED'
                 when latest_error_rate > 0.05::double then 'AMBER' else 'GREEN' end as error_band,
            case when critical_count > 0 then 'RED' else 'GREEN' end as critical_band
        from (select count(*) as total_anomalies,
                count(*) filter (severity = 'CRITICAL') as critical_count,
                count(*) filter (severity = 'HIGH') as high_count from live_findings) a,
            (select error_rate as latest_error_rate, total_requests as latest_total_requests
             from hourly_stats order by hour_bucket desc nulls last limit 1) h,
            (select count(*) as unique_ips from ip_behaviour) i""",
    "overview_feed": f"""
        select {_FEED} from live_findings order by {_RANK}, window_start desc, host limit 15""",
    "overview_trend": """
        select hour_bucket, total_requests, rolling_3hr_avg_requests,
            round(error_rate * 100, 6) as error_pct
        from hourly_stats order by hour_bucket desc nulls last limit 48""",
    "source_status": """
        select 'anomalies_stream' as source,
            (select coalesce(bool_or(severity = 'CRITICAL'), false) from live_findings) as has_data,
            'CONNECTED' as status
        union all select 'hourly_stats', (select count(*) > 0 from hourly_stats), 'CONNECTED'
        union all select 'ip_behaviour', (select count(*) > 0 from ip_behaviour), 'CONNECTED'
        union all select 'endpoint_stats', (select count(*) > 0 from endpoint_stats),
            'CONNECTED'""",
    "anomaly_facets": f"""
        select 'anomaly_type' as facet, anomaly_type as choice,
            cast(row_number() over (order by anomaly_type) as integer) as position
        from (select distinct anomaly_type from live_findings)
        union all
        select 'severity', severity, cast(row_number() over (order by {_RANK}) as integer)
        from (select distinct severity from live_findings)""",
    "anomaly_search": "select * from found",
    "anomaly_host_search": " union all ".join(
        f"""select '{wanted}' as wanted, {indexed} as indexed, host, window_start, anomaly_type, severity
            from live_findings where {test}"""
        for wanted, indexed, test in (
            ("HOST1", "true", "contains(lower(host), 'host1')"),
            ("host1[0-9]+-3", "true", "regexp_matches(host, '(?i)host1[0-9]+-3')"),
            ("(poll|crawl)er", "false", "regexp_matches(host, '(?i)(poll|crawl)er')"),
            ("r.?$", "false", "regexp_matches(host, '(?i)r.?$')"),
        )
    ),
    "anomaly_search_tiles": """
        select count(*) as showing, count(*) filter (severity = 'CRITICAL') as critical,
            count(*) filter (severity = 'HIGH') as high,
            count(*) filter (severity = 'MEDIUM') as medium,
            count(*) filter (severity = 'LOW') as low from found""",
    "top_anomalous_hosts": """
        select host, count(*) as "count" from live_findings
        group by host order by 2 desc, host limit 15""",
    "severity_distribution": f"""
        select severity, n as "count", {_rounded("n / (sum(n) over ()) * 100", 1)} as share_pct
        from (select severity, count(*) as n from live_findings group by 1)""",
    "type_severity_pivot": """
        select anomaly_type, count(*) filter (severity = 'CRITICAL') as "CRITICAL",
            count(*) filter (severity = 'HIGH') as "HIGH",
            count(*) filter (severity = 'MEDIUM') as "MEDIUM",
            count(*) filter (severity = 'LOW') as "LOW" from live_findings group by 1""",
    "anomaly_feed": f"select {_FEED} from page_findings",
    "traffic_snapshot": """
        select *, case when total_errors > 10000 then 'RED' else 'AMBER' end as errors_band,
            case when avg_error_pct > 10 then 'RED' when avg_error_pct > 5 then 'AMBER'
                else 'GREEN' end as rate_band
        from (select cast(sum(total_requests) as bigint) as total_requests,
                cast(sum(errors_404 + errors_500) as bigint) as total_errors,
                round(avg(error_rate) * 100, 6) as avg_error_pct,
                max(total_requests) as peak_requests,
                round(avg(success_rate) * 100, 6) as avg_success_pct from page_hours)""",
    "peak_hour": """
        select hour_bucket, total_requests from page_hours
        order by total_requests desc, hour_bucket limit 1""",
    "traffic_trend": """
        select *, round(error_rate * 100, 6) as error_pct, error_rate * 100 > 10 as high_risk,
            round(success_rate * 100, 6) as success_pct,
            round(total_bytes / (1024 * 1024), 6) as total_mb from page_hours""",
    "ip_fleet_summary": """
        select *, case when avg_error_pct > 10 then 'RED' when avg_error_pct > 5 then 'AMBER'
                else 'GREEN' end as error_band
        from (select count(*) as hosts, round(avg(total_requests), 6) as avg_requests,
                round(avg(error_rate_pct), 6) as avg_error_pct,
                max(total_requests) as max_requests,
                max(unique_endpoints_hit) as max_endpoint_breadth from ip_behaviour)""",
    "ip_risk_quadrant": """
        select host, total_requests, error_rate_pct, q75,
            case when total_requests > q75 and error_rate_pct > 5 then 'HIGH VOLUME + HIGH ERROR'
                 when total_requests > q75 then 'HIGH VOLUME'
                 when error_rate_pct > 10 then 'HIGH ERROR' else 'NORMAL' end as risk
        from (select *, quantile_cont(cast(total_requests as double), 0.75) over () as q75
            from ip_behaviour)""",
    "ip_quantiles": """
        select measure, unnest([0.0, 0.25, 0.5, 0.75, 0.99, 1.0])::double as share,
            round(unnest(quantile_cont(number, [0.0, 0.25, 0.5, 0.75, 0.99, 1.0])), 6) as value
        from (select 'total_requests' as measure, cast(total_requests as double) as number from ip_behaviour
            union all select 'error_rate_pct', error_rate_pct from ip_behaviour
            union all select 'total_bytes_transferred', cast(total_bytes_transferred as double)
                from ip_behaviour)
        group by measure""",
    "ip_top_volume": "select host, total_requests from shown_hosts",
    "ip_top_error": """
        select host, error_rate_pct, case when error_rate_pct > 10 then 'RED'
            when error_rate_pct > 5 then 'AMBER' else 'GREEN' end as error_band
        from shown_hosts""",
    "ip_density": """
        select request_bin, error_bin, count(*) as hosts from (
            select
                cast(least(floor(coalesce((x - x0) * 20 / nullif(x1 - x0, 0), 0)), 19) as integer)
                    as request_bin,
                cast(least(floor(coalesce((y - y0) * 20 / nullif(y1 - y0, 0), 0)), 19) as integer)
                    as error_bin
            from (select x, y, min(x) over () as x0, max(x) over () as x1,
                    min(y) over () as y0, max(y) over () as y1
                from (select cast(total_requests as double) as x, error_rate_pct as y
                    from ip_behaviour)))
        group by 1, 2""",
    "ip_lifecycle": """
        select host, total_requests,
            coalesce(printf('%.1f', error_rate_pct) || '%', '—') as error_rate_pct,
            case when error_rate_pct > 10 then 'RED' when error_rate_pct > 5 then 'AMBER'
                else 'GREEN' end as error_band,
            first_seen, last_seen, unique_endpoints_hit from shown_hosts""",
    "endpoint_snapshot": """
        select *, case when total_404 > 1000 then 'RED' else 'AMBER' end as not_found_band
        from (select count(*) as endpoints, cast(sum(total_hits) as bigint) as total_hits,
                cast(sum(not_found_count) as bigint) as total_404,
                round(avg(avg_bytes) / 1024, 6) as avg_kb,
                (select endpoint from endpoint_stats order by total_hits desc, endpoint limit 1)
                    as hotspot
            from endpoint_stats)""",
    "endpoint_top": """
        select endpoint, total_hits, unique_visitors from endpoint_stats
        order by total_hits desc, endpoint limit 25""",
    "endpoint_404_heavy": """
        select endpoint, total_hits, not_found_count, round(pct, 6) as not_found_pct,
            case when pct > 50 then 'RED' when pct > 20 then 'ORANGE' else 'AMBER' end
                as not_found_band
        from (select *, not_found_count / greatest(total_hits, 1) * 100 as pct
            from endpoint_stats where not_found_count > 0)
        order by not_found_count desc, endpoint limit 25""",
    "endpoint_heaviest": """
        select endpoint, avg_bytes, round(avg_bytes / 1024, 6) as avg_kb from endpoint_stats
        order by avg_bytes desc nulls last, endpoint limit 25""",
    "endpoint_table": """
        select endpoint, total_hits, not_found_count,
            coalesce(printf('%.1f', avg_bytes / 1024) || ' KB', '—') as avg_bytes,
            unique_visitors from endpoint_stats""",
}

ORACLES = {name: _sql(body) for name, body in _BODIES.items()}
