"""Independent DuckDB SQL for every registered query (the correctness oracle).

Written from the table contracts, not generated from the Spark code: one CTE
per layer over the pre-registered ``events`` view, composed per query.
DuckDB notes: ``sum`` / ``count_if`` return HUGEINT, so results are cast to
BIGINT; ``month()`` / ``year()`` are cast to INTEGER; ratios divide a DOUBLE
by ``NULLIF(.., 0)``; ascending tie-breakers say NULLS LAST explicitly.
"""

from __future__ import annotations

# --- fixed scenario values shared with __spark_entry__ ------------------------
MERGE_FIRST_RUN_CUTOFF = "2024-01-20 12:00:00"  # first run saw events before this instant
MERGE_SECOND_RUN_FROM = "2024-01-18"  # second run recomputes whole days from this date
OVERWRITE_SECOND_RUN_FROM = "2024-01-15"  # partition re-run covers these days
LOOKBACK_AS_OF = "2024-01-30"
LOOKBACK_DAYS = 3
YEAR_END_AS_OF = "2024-01-05"  # monthly lookback: the window starts in December
YEAR_END_DAYS = 10
TOP_N = 10
MOVED_FROM = "2024-01-20"  # events from this day on reappear later
MOVED_BY_DAYS = 40
BROKEN_EVERY = 50  # ids divisible by this have a broken line beside their own
MONTH_IDS = 1_000_000_000_000  # id offset of the second month
#: rows that the dirty tables hold twice (read by both engines)
_BY_ID, _BY_EVENTS = "TRY_CAST(event_id AS BIGINT) % 13 = 0", "total_events % 2 = 0"
TWICE = {
    "bronze_events": _BY_ID,
    "bronze_commits": _BY_ID,
    "bronze_productivity": _BY_ID,
    "silver_developer_activity": _BY_ID,
    "silver_repo_summary": _BY_EVENTS,
    "developer_productivity_monthly": "total_prs % 2 = 0",
    "repo_health_scorecard": _BY_EVENTS,
    "commit_stats_by_day": "total_commits % 2 = 1",
    "activity_by_day": _BY_EVENTS,
}
# ------------------------------------------------------------------------------

_BOT_RE = r"(?i).*\[bot\].*|.*-bot$"

LAYERS = f"""
raw AS (
    SELECT
        CAST(event_id - CASE WHEN event_id % 10 = 9 THEN 1 ELSE 0 END AS VARCHAR) AS id,
        CASE event_type WHEN 'click' THEN 'PushEvent' WHEN 'purchase' THEN 'PullRequestEvent'
             WHEN 'view' THEN 'WatchEvent' WHEN 'signup' THEN 'ForkEvent' ELSE 'IssuesEvent' END AS type,
        ts AS created_at,
        CAST(ts AS DATE) AS date,
        CAST(month(ts) AS INTEGER) AS month,
        CAST(year(ts) AS INTEGER) AS year,
        CASE user_id % 20 WHEN 0 THEN 'u' || CAST(user_id AS VARCHAR) || '[bot]'
                          WHEN 1 THEN 'u' || CAST(user_id AS VARCHAR) || '-bot'
                          WHEN 2 THEN 'U' || CAST(user_id AS VARCHAR) || '[BOT]'
                          WHEN 3 THEN NULL
                          ELSE 'u' || CAST(user_id AS VARCHAR) END AS login,
        CASE WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) = 99 THEN NULL
             ELSE 'org/repo-' || CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) % 25 AS VARCHAR) END AS repo_name,
        md5(CAST(CAST(floor(event_id / 5) AS BIGINT) AS VARCHAR)) AS head,
        CASE CAST(json_extract_string(props, '$.k') AS INTEGER) % 4
             WHEN 0 THEN 'opened' WHEN 1 THEN 'closed' WHEN 2 THEN 'synchronize' ELSE 'reopened' END AS action,
        CASE WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) % 10 = 0 THEN NULL
             ELSE CAST(floor(value * 10) AS BIGINT) END AS lines_added,
        CASE WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) % 10 = 0 THEN NULL
             ELSE CAST(floor(value) AS BIGINT) END AS lines_deleted,
        CASE WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) % 10 = 0 THEN NULL
             ELSE CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) % 13 AS BIGINT) END AS files_changed
    FROM events
),
classified AS (
    SELECT *, regexp_matches(login, '{_BOT_RE}') AS is_bot FROM raw
),
clean AS (SELECT * FROM classified WHERE NOT is_bot),
bots AS (SELECT * FROM classified WHERE is_bot),
staging_events AS (
    SELECT id AS event_id, type, created_at, date, month, year, repo_name, login AS actor_login FROM clean
),
staging_commits AS (
    SELECT id AS event_id, date, month, year, repo_name, login AS actor_login, head AS commit_sha,
           CAST(NULL AS VARCHAR) AS commit_message, login AS author_name
    FROM clean WHERE type = 'PushEvent'
),
pr_rows AS (
    SELECT id AS event_id, date, month, year, repo_name, login AS developer_login,
           lines_added, lines_deleted, files_changed, action AS pr_state, action = 'closed' AS is_merged
    FROM clean WHERE type = 'PullRequestEvent'
),
staging_productivity AS (
    SELECT * FROM pr_rows
    UNION ALL
    SELECT event_id, date, month, year, repo_name, developer_login,
           CAST(NULL AS BIGINT), CAST(NULL AS BIGINT), CAST(NULL AS BIGINT), 'reopened', FALSE
    FROM pr_rows WHERE TRY_CAST(event_id AS BIGINT) % 4 = 0
    UNION ALL
    SELECT event_id, date, month, year, repo_name, developer_login,
           lines_added, lines_deleted, files_changed, 'closed', TRUE
    FROM pr_rows WHERE TRY_CAST(event_id AS BIGINT) % 4 = 1
),
bronze_events AS (
    SELECT event_id, type, created_at, date, month, year, repo_name, actor_login
    FROM staging_events
    QUALIFY row_number() OVER (
        PARTITION BY event_id
        ORDER BY created_at DESC NULLS LAST, type ASC NULLS LAST, repo_name ASC NULLS LAST,
                 actor_login ASC NULLS LAST, date ASC NULLS LAST) = 1
),
event_times AS (SELECT event_id, created_at FROM bronze_events),
bronze_commits AS (
    SELECT c.event_id, e.created_at, c.date, c.month, c.year, c.repo_name, c.actor_login,
           c.commit_sha, c.commit_message, c.author_name
    FROM staging_commits c JOIN event_times e ON c.event_id = e.event_id
    QUALIFY row_number() OVER (
        PARTITION BY c.commit_sha
        ORDER BY e.created_at DESC NULLS LAST, c.event_id ASC NULLS LAST, c.actor_login ASC NULLS LAST,
                 c.repo_name ASC NULLS LAST, c.date ASC NULLS LAST) = 1
),
bronze_productivity AS (
    SELECT d.event_id, e.created_at, d.date, d.month, d.year, d.repo_name, d.developer_login,
           d.lines_added, d.lines_deleted, d.files_changed, d.pr_state, d.is_merged
    FROM staging_productivity d JOIN event_times e ON d.event_id = e.event_id
    WHERE d.developer_login IS NOT NULL AND d.developer_login <> ''
    QUALIFY row_number() OVER (
        PARTITION BY d.event_id, d.developer_login
        ORDER BY e.created_at DESC NULLS LAST, d.repo_name ASC NULLS LAST, d.date ASC NULLS LAST,
                 d.lines_added ASC NULLS LAST, d.lines_deleted ASC NULLS LAST,
                 d.files_changed ASC NULLS LAST, d.pr_state ASC NULLS LAST) = 1
),
silver_developer_activity AS (
    SELECT event_id, actor_login AS developer_login, created_at, date, month, year, repo_name,
           'PushEvent' AS event_type, commit_sha, author_name,
           CAST(NULL AS BIGINT) AS lines_added, CAST(NULL AS BIGINT) AS lines_deleted,
           CAST(NULL AS BIGINT) AS files_changed, CAST(NULL AS BIGINT) AS net_loc,
           CAST(NULL AS VARCHAR) AS pr_state, CAST(NULL AS BOOLEAN) AS is_merged
    FROM bronze_commits
    WHERE actor_login IS NOT NULL AND repo_name IS NOT NULL AND actor_login NOT LIKE '%[bot]%'
    UNION ALL
    SELECT event_id, developer_login, created_at, date, month, year, repo_name,
           'PullRequestEvent', CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR),
           lines_added, lines_deleted, files_changed, lines_added - lines_deleted, pr_state, is_merged
    FROM bronze_productivity
    WHERE developer_login IS NOT NULL AND repo_name IS NOT NULL AND developer_login NOT LIKE '%[bot]%'
    UNION ALL
    SELECT event_id, actor_login, created_at, date, month, year, repo_name,
           type, CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR),
           CAST(NULL AS BIGINT), CAST(NULL AS BIGINT), CAST(NULL AS BIGINT), CAST(NULL AS BIGINT),
           CAST(NULL AS VARCHAR), CAST(NULL AS BOOLEAN)
    FROM bronze_events
    WHERE actor_login IS NOT NULL AND actor_login NOT LIKE '%[bot]%' AND repo_name IS NOT NULL
      AND type NOT IN ('PushEvent', 'PullRequestEvent')
),
silver_repo_summary AS (
    SELECT repo_name, date, max(created_at) AS created_at, month, year,
           count(DISTINCT event_id) AS total_events,
           count(DISTINCT developer_login) AS unique_contributors,
           CAST(count_if(event_type = 'PushEvent') AS BIGINT) AS total_commits,
           CAST(count_if(event_type = 'PullRequestEvent') AS BIGINT) AS total_prs,
           CAST(count_if(event_type = 'PullRequestEvent' AND is_merged = TRUE) AS BIGINT) AS merged_prs,
           CAST(count_if(event_type = 'PullRequestEvent' AND is_merged = TRUE) AS DOUBLE)
               / NULLIF(count_if(event_type = 'PullRequestEvent'), 0) AS merge_rate,
           CAST(coalesce(sum(lines_added), 0) AS BIGINT) AS total_lines_added,
           CAST(coalesce(sum(lines_deleted), 0) AS BIGINT) AS total_lines_deleted
    FROM silver_developer_activity
    GROUP BY repo_name, date, month, year
),
developer_productivity_monthly AS (
    SELECT year, month, make_date(year, month, 1) AS month_start_date, developer_login, repo_name,
           count(*) AS total_prs,
           CAST(count_if(is_merged = TRUE) AS BIGINT) AS merged_prs,
           least(CAST(count_if(is_merged = TRUE) AS DOUBLE) / NULLIF(count(*), 0), 1.0) AS merge_rate,
           CAST(coalesce(sum(lines_added), 0) AS BIGINT) AS total_lines_added,
           CAST(coalesce(sum(lines_deleted), 0) AS BIGINT) AS total_lines_deleted,
           CAST(coalesce(sum(lines_added), 0) - coalesce(sum(lines_deleted), 0) AS BIGINT) AS net_loc,
           avg(coalesce(files_changed, 0)) AS avg_files_changed,
           avg(coalesce(lines_added, 0) + coalesce(lines_deleted, 0)) AS avg_pr_size
    FROM silver_developer_activity
    WHERE event_type = 'PullRequestEvent'
    GROUP BY year, month, developer_login, repo_name
),
repo_health_scorecard AS (
    SELECT repo_name, year, month, make_date(year, month, 1) AS month_start_date,
           CAST(sum(total_events) AS BIGINT) AS total_events,
           max(unique_contributors) AS unique_contributors,
           CAST(sum(total_commits) AS BIGINT) AS total_commits,
           CAST(sum(total_prs) AS BIGINT) AS total_prs,
           CAST(sum(merged_prs) AS BIGINT) AS merged_prs,
           CAST(sum(merged_prs) AS DOUBLE) / NULLIF(sum(total_prs), 0) AS merge_rate,
           CAST(sum(total_lines_added) - sum(total_lines_deleted) AS BIGINT) AS net_loc,
           CAST(sum(total_commits) AS DOUBLE) / NULLIF(max(unique_contributors), 0) AS avg_commits_per_contributor
    FROM silver_repo_summary
    GROUP BY repo_name, year, month
),
commit_stats_by_day AS (
    SELECT date, repo_name, developer_login AS actor_login, author_name, count(*) AS total_commits,
           developer_login = author_name AS is_author_actor_match
    FROM silver_developer_activity
    WHERE event_type = 'PushEvent'
    GROUP BY date, repo_name, developer_login, author_name
),
activity_by_day AS (
    SELECT date, month, year, event_type, count(*) AS total_events,
           count(DISTINCT repo_name) AS unique_repos, count(DISTINCT developer_login) AS unique_actors
    FROM silver_developer_activity
    GROUP BY date, month, year, event_type
)"""


def _q(body: str, extra_ctes: str = "") -> str:
    ctes = LAYERS + (",\n" + extra_ctes if extra_ctes else "")
    return f"WITH {ctes}\n{body}"


def _two_months(body: str) -> str:
    """The layers over two archive months: the raw events, and the same shifted, with strays and undated rows."""
    months = f"""raw AS (
    SELECT CAST(CAST(id AS BIGINT) + (m - 1) * {MONTH_IDS} AS VARCHAR) AS id, type, ts AS created_at,
        CAST(ts AS DATE) AS date, CAST(month(ts) AS INTEGER) AS month, CAST(year(ts) AS INTEGER) AS year, login,
        repo_name, head || CASE m WHEN 1 THEN '' ELSE CAST(m AS VARCHAR) END AS head, action,
        lines_added, lines_deleted, files_changed
    FROM (
        SELECT *, CASE WHEN CAST(id AS BIGINT) % 89 <> 1 THEN created_at + to_days(CAST(
            31 * (m - 1) + CASE WHEN CAST(id AS BIGINT) % 97 = 0 THEN 31 ELSE 0 END AS INTEGER)) END AS ts
        FROM raw_month CROSS JOIN (VALUES (1), (2)) AS months(m)
    )
),
classified AS ("""
    layers = LAYERS.replace("raw AS (", "raw_month AS (", 1).replace("classified AS (", months, 1)
    return f"WITH {layers}\n{body}"


def _overlapping_months(body: str) -> str:
    """The layers over both of two archive months of which the second delivers ids and SHAs of the first again."""
    months = f"""raw AS (
    SELECT CASE WHEN m = 1 OR k % 3 <> 2 THEN id ELSE CAST(k + {MONTH_IDS} AS VARCHAR) END AS id, type, ts AS created_at,
        CAST(ts AS DATE) AS date, CAST(month(ts) AS INTEGER) AS month, CAST(year(ts) AS INTEGER) AS year,
        CASE WHEN m = 2 AND k % 3 <> 2 AND k % 7 = 0 THEN login || 'x' ELSE login END AS login,
        repo_name, CASE WHEN m = 1 OR k % 3 <> 2 OR k % 5 = 0 THEN head ELSE head || '2' END AS head, action,
        lines_added, lines_deleted, files_changed
    FROM (
        SELECT *, CASE WHEN k % 89 <> 1 THEN created_at + to_days(CAST(
            CASE WHEN m = 2 AND k % 3 <> 1 THEN 31 ELSE 0 END + CASE WHEN k % 97 = 0 THEN 31 ELSE 0 END AS INTEGER)) END AS ts
        FROM (SELECT *, CAST(id AS BIGINT) AS k FROM raw_month) CROSS JOIN (VALUES (1), (2)) AS months(m)
    )
),
classified AS ("""
    layers = LAYERS.replace("raw AS (", "raw_month AS (", 1).replace("classified AS (", months, 1)
    return f"WITH {layers}\n{body}"


def _table(name: str) -> str:
    return _q(f"SELECT * FROM {name}")


def _top(source: str, key: str, measure: str) -> str:
    return _q(
        f"SELECT {key}, CAST(sum({measure}) AS BIGINT) AS {measure} FROM {source} GROUP BY {key} "
        f"ORDER BY {measure} DESC NULLS LAST, {key} ASC NULLS LAST LIMIT {TOP_N}"
    )


# (table, column, check, expression over the table) for the quality report.
_NOT_NULL = {
    "bronze_events": ["event_id"],
    "bronze_commits": ["event_id", "created_at", "commit_sha"],
    "bronze_productivity": ["event_id", "date", "developer_login"],
    "silver_developer_activity": ["event_id", "developer_login", "event_type", "created_at", "date", "month", "year", "repo_name"],
    "silver_repo_summary": ["repo_name", "date", "created_at", "month", "year"],
    "developer_productivity_monthly": ["year", "month", "month_start_date", "developer_login", "repo_name"],
    "repo_health_scorecard": ["repo_name", "month_start_date", "year", "month"],
    "commit_stats_by_day": ["date", "repo_name", "actor_login"],
    "activity_by_day": ["date", "event_type", "month", "year"],
}
_NOT_NEGATIVE = {
    "bronze_productivity": ["lines_added", "lines_deleted", "files_changed"],
    "silver_developer_activity": ["lines_added", "lines_deleted", "files_changed"],
    "silver_repo_summary": ["total_events", "unique_contributors", "total_commits", "total_prs", "merged_prs", "total_lines_added", "total_lines_deleted"],
    "developer_productivity_monthly": ["total_prs", "merged_prs", "total_lines_added", "total_lines_deleted"],
    "repo_health_scorecard": ["total_events", "unique_contributors", "total_commits", "total_prs", "merged_prs"],
    "commit_stats_by_day": ["total_commits"],
    "activity_by_day": ["total_events", "unique_repos", "unique_actors"],
}
_KEYS = {
    "bronze_events": ["event_id"],
    "bronze_commits": ["commit_sha"],
    "bronze_productivity": ["event_id", "developer_login"],
    "silver_developer_activity": ["event_id", "developer_login", "event_type"],
    "silver_repo_summary": ["repo_name", "date"],
    "developer_productivity_monthly": ["year", "month", "developer_login", "repo_name"],
    "repo_health_scorecard": ["repo_name", "year", "month"],
    "commit_stats_by_day": ["date", "repo_name", "actor_login", "author_name"],
    "activity_by_day": ["date", "event_type"],
}


def _quality_rows() -> str:
    parts = []
    for table in _KEYS:
        for c in _NOT_NULL.get(table, []):
            parts.append(f"SELECT '{table}' AS \"table\", '{c}' AS \"column\", 'not_null' AS \"check\", "
                         f"CAST(count_if({c} IS NULL) AS BIGINT) AS failed_rows FROM {table}")
        for c in _NOT_NEGATIVE.get(table, []):
            parts.append(f"SELECT '{table}', '{c}', 'not_negative', CAST(count_if({c} < 0) AS BIGINT) FROM {table}")
        if table == "bronze_events":
            parts.append("SELECT 'bronze_events', 'event_id', 'unique', "
                         "CAST(count(event_id) - count(DISTINCT event_id) AS BIGINT) FROM bronze_events")
        keys = ", ".join(_KEYS[table])
        parts.append(f"SELECT '{table}', '{','.join(_KEYS[table])}', 'unique_key', "
                     f"CAST(coalesce(sum(n - 1), 0) AS BIGINT) FROM (SELECT count(*) AS n FROM {table} GROUP BY {keys})")
    return "\nUNION ALL\n".join(parts)


_DIRTY_RAW = """raw AS (
    SELECT CASE WHEN k % 101 <> 7 THEN id END AS id, CASE WHEN k % 19 <> 5 THEN type END AS type,
        CASE WHEN k % 89 <> 1 THEN created_at END AS created_at, CASE WHEN k % 89 <> 1 THEN date END AS date,
        CASE WHEN k % 89 <> 1 THEN month END AS month, CASE WHEN k % 89 <> 1 THEN year END AS year,
        CASE WHEN k % 17 = 3 THEN '' ELSE login END AS login, repo_name, head, action,
        CASE WHEN k % 11 = 0 THEN -lines_added ELSE lines_added END AS lines_added, lines_deleted, files_changed
    FROM (SELECT *, CAST(id AS BIGINT) AS k FROM raw_clean)
),
classified AS ("""


def _dirty_layers() -> str:
    return LAYERS.replace("raw AS (", "raw_clean AS (", 1).replace("classified AS (", _DIRTY_RAW, 1)


def _behind(layers: str, table: str, body: str) -> str:
    """The layers with ``table`` put behind ``body``, which reads it as ``<table>_all``; later layers read the new one."""
    start = layers.index(f"\n{table} AS (")
    end = layers.index("\n)", start) + 2
    renamed = layers[start:end].replace(f"{table} AS (", f"{table}_all AS (", 1)
    return layers[:start] + renamed + f",\n{table} AS ({body})" + layers[end:]


def _delivered_twice(body: str) -> str:
    """Each table of the dirty layers with some rows twice; the layers themselves read each other as built."""
    twice = ",\n".join(f"{t}_twice AS (SELECT * FROM {t} UNION ALL SELECT * FROM {t} WHERE {c})" for t, c in TWICE.items())
    outer = ",\n".join(f"{t} AS (SELECT * FROM {t}_twice)" for t in TWICE)
    return f"WITH {_dirty_layers()},\n{twice}\nSELECT * FROM (WITH {outer}\n{body})"


def _tags(table: str) -> str:
    """The per-row tags of a row, joined by a space ('' for a good row)."""
    found = [f"CASE WHEN {c} IS NULL THEN 'not_null:{c} ' ELSE '' END" for c in _NOT_NULL.get(table, [])]
    found += [f"CASE WHEN {c} < 0 THEN 'not_negative:{c} ' ELSE '' END" for c in _NOT_NEGATIVE.get(table, [])]
    return f"rtrim({' || '.join(found)})"


def _quarantined(body: str) -> str:
    """The layers up to silver, each built on the rows before it that fail no per-row check."""
    layers = _dirty_layers()
    for table in list(_KEYS)[:4]:
        layers = _behind(layers, table, f"SELECT * FROM {table}_all WHERE {_tags(table)} = ''")
    return f"WITH {layers}\n{body}"


def oracle_queries() -> dict[str, str]:
    q: dict[str, str] = {}
    q["raw_json_scan"] = _q(
        "SELECT id AS event_id, type, created_at, date, month, year, repo_name, login AS actor_login, "
        "head AS commit_sha, action AS pr_state, lines_added, lines_deleted, files_changed, is_bot FROM classified"
    )
    q["classify_bots"] = _q("SELECT id AS event_id, login AS actor_login, is_bot FROM classified")
    q["bot_events"] = _q(
        "SELECT id AS event_id, type, created_at, date, month, year, repo_name, login AS actor_login FROM bots"
    )
    for name in ("staging_events", "staging_commits", "staging_productivity"):
        q[name] = _table(name)
    q["staging_append"] = _table("bronze_events")
    q["event_time_by_id"] = _q("SELECT event_id, max(created_at) AS created_at FROM bronze_events GROUP BY event_id")
    for name in _KEYS:
        q[name] = _table(name)
    q["quality_report"] = _q(_quality_rows())
    q["quality_report_dirty"] = _delivered_twice(_quality_rows())
    q["dirty_row_tags"] = _delivered_twice(
        "SELECT \"table\", \"check\" || ':' || \"column\" AS tag, failed_rows "
        f"FROM ({_quality_rows()}) WHERE failed_rows > 0"
    )
    q["dirty_silver"] = f"WITH {_dirty_layers()}\nSELECT * FROM silver_developer_activity"
    q["quarantined_silver"] = _quarantined("SELECT * FROM silver_developer_activity")
    q["quarantined_rows"] = _quarantined(
        "SELECT \"table\", tags, count(*) AS rows FROM ("
        + " UNION ALL ".join(f"SELECT '{t}' AS \"table\", {_tags(t)} AS tags FROM {t}_all" for t in list(_KEYS)[:4])
        + ") WHERE tags <> '' GROUP BY \"table\", tags"
    )
    q["partition_overwrite_roundtrip"] = _table("staging_events")
    scenario = f"""
first_silver AS (SELECT * FROM silver_developer_activity WHERE created_at < TIMESTAMP '{MERGE_FIRST_RUN_CUTOFF}'),
first_run AS (
    SELECT repo_name, date, max(created_at) AS created_at, month, year,
           count(DISTINCT event_id) AS total_events,
           count(DISTINCT developer_login) AS unique_contributors,
           CAST(count_if(event_type = 'PushEvent') AS BIGINT) AS total_commits,
           CAST(count_if(event_type = 'PullRequestEvent') AS BIGINT) AS total_prs,
           CAST(count_if(event_type = 'PullRequestEvent' AND is_merged = TRUE) AS BIGINT) AS merged_prs,
           CAST(count_if(event_type = 'PullRequestEvent' AND is_merged = TRUE) AS DOUBLE)
               / NULLIF(count_if(event_type = 'PullRequestEvent'), 0) AS merge_rate,
           CAST(coalesce(sum(lines_added), 0) AS BIGINT) AS total_lines_added,
           CAST(coalesce(sum(lines_deleted), 0) AS BIGINT) AS total_lines_deleted
    FROM first_silver
    GROUP BY repo_name, date, month, year
),
second_run AS (SELECT * FROM silver_repo_summary WHERE date >= DATE '{MERGE_SECOND_RUN_FROM}')"""
    q["merge_insert_only"] = _q(
        "SELECT * FROM first_run UNION ALL "
        "SELECT s.* FROM second_run s ANTI JOIN first_run f ON s.repo_name = f.repo_name AND s.date = f.date",
        scenario,
    )
    q["merge_upsert"] = _q(
        "SELECT f.* FROM first_run f ANTI JOIN second_run s ON s.repo_name = f.repo_name AND s.date = f.date "
        "UNION ALL SELECT * FROM second_run",
        scenario,
    )
    late = f"created_at + INTERVAL {MOVED_BY_DAYS} DAY"
    q["merge_key_moves_partition"] = _q(
        f"SELECT * FROM bronze_events WHERE date < DATE '{MOVED_FROM}' OR date IS NULL UNION ALL "
        f"SELECT event_id, type, {late} AS created_at, CAST({late} AS DATE) AS date, "
        f"CAST(month({late}) AS INTEGER) AS month, CAST(year({late}) AS INTEGER) AS year, repo_name, actor_login "
        f"FROM bronze_events WHERE date >= DATE '{MOVED_FROM}'"
    )
    q["rerun_month"] = _two_months(
        "SELECT *, CAST(202401 + CAST(event_id AS BIGINT) // " + str(MONTH_IDS) + " AS INTEGER) AS source_month "
        "FROM staging_events"
    )
    q["incremental_months"] = _two_months("SELECT * FROM silver_developer_activity")
    q["rerun_older_month"] = _overlapping_months("SELECT * FROM silver_repo_summary")
    for short, name in (("events", "bronze_events"), ("commits", "bronze_commits"), ("productivity", "bronze_productivity"),
                        ("silver", "silver_developer_activity")):
        q[f"rerun_older_month_{short}"] = _overlapping_months(f"SELECT * FROM {name}")
    q["distinct_rollup_monthly"] = _overlapping_months(
        "SELECT CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month, event_type, "
        "count(DISTINCT developer_login) AS unique_actors, count(DISTINCT repo_name) AS unique_repos "
        "FROM silver_developer_activity GROUP BY ALL"
    )
    q["clustered_events"] = _table("bronze_events")
    q["bucketed_event_times"] = _table("bronze_commits")
    broken = f"CAST(id AS BIGINT) % {BROKEN_EVERY} = 0"
    q["raw_accounting"] = _q(
        f"SELECT 'lines' AS kind, count(*) + CAST(count_if({broken}) AS BIGINT) AS rows FROM raw UNION ALL "
        f"SELECT 'bad_lines', CAST(count_if({broken}) AS BIGINT) FROM raw UNION ALL "
        "SELECT 'no_login', CAST(count_if(login IS NULL) AS BIGINT) FROM raw"
    )
    q["merge_unpartitioned_monthly"] = _overlapping_months("SELECT * FROM developer_productivity_monthly")
    q["lookback_events"] = _q(
        "SELECT event_id, type, created_at, date, month, year, repo_name, actor_login FROM staging_events "
        f"WHERE date >= DATE '{LOOKBACK_AS_OF}' - INTERVAL {LOOKBACK_DAYS} DAY "
        "QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY created_at DESC NULLS LAST, type ASC NULLS LAST, "
        "repo_name ASC NULLS LAST, actor_login ASC NULLS LAST, date ASC NULLS LAST) = 1"
    )
    spread = """raw AS (
    SELECT id, type, ts AS created_at, CAST(ts AS DATE) AS date, CAST(month(ts) AS INTEGER) AS month,
        CAST(year(ts) AS INTEGER) AS year, login, repo_name, head, action, lines_added, lines_deleted, files_changed
    FROM (SELECT *, created_at - to_days(CAST(31 * (CAST(id AS BIGINT) % 3) AS INTEGER)) AS ts FROM raw_month)
),
classified AS ("""
    months = LAYERS.replace("raw AS (", "raw_month AS (", 1).replace("classified AS (", spread, 1)
    q["lookback_monthly"] = (
        f"WITH {months}\nSELECT * FROM developer_productivity_monthly "
        f"WHERE month_start_date >= date_trunc('month', DATE '{YEAR_END_AS_OF}' - INTERVAL {YEAR_END_DAYS} DAY)"
    )
    q["rpt_top_developers"] = _top("commit_stats_by_day", "actor_login", "total_commits")
    q["rpt_commits_by_repo"] = _top("commit_stats_by_day", "repo_name", "total_commits")
    q["rpt_event_share"] = _q(
        "SELECT event_type, CAST(sum(total_events) AS BIGINT) AS total_events, "
        "CAST(sum(total_events) AS DOUBLE) / NULLIF((SELECT sum(total_events) FROM activity_by_day), 0) AS share "
        "FROM activity_by_day GROUP BY event_type"
    )
    q["rpt_daily_volume"] = _q(
        "SELECT date, "
        "CAST(sum(CASE WHEN event_type = 'PushEvent' THEN total_events ELSE 0 END) AS BIGINT) AS push_events, "
        "CAST(sum(CASE WHEN event_type = 'CreateEvent' THEN total_events ELSE 0 END) AS BIGINT) AS create_events, "
        "CAST(sum(CASE WHEN event_type = 'PullRequestEvent' THEN total_events ELSE 0 END) AS BIGINT) AS pull_request_events, "
        "CAST(sum(CASE WHEN event_type = 'WatchEvent' THEN total_events ELSE 0 END) AS BIGINT) AS watch_events "
        "FROM activity_by_day GROUP BY date"
    )
    q["rpt_top_pr_developers"] = _top("developer_productivity_monthly", "developer_login", "total_prs")
    q["rpt_merge_rate_vs_volume"] = _q(
        "SELECT developer_login, CAST(sum(total_prs) AS BIGINT) AS total_prs, CAST(sum(merged_prs) AS BIGINT) AS merged_prs, "
        "CAST(sum(merged_prs) AS DOUBLE) / NULLIF(sum(total_prs), 0) AS merge_rate "
        "FROM developer_productivity_monthly GROUP BY developer_login"
    )
    q["rpt_merged_by_month"] = _q(
        "SELECT year, month, month_start_date, CAST(sum(merged_prs) AS BIGINT) AS merged_prs, "
        "CAST(sum(total_prs) - sum(merged_prs) AS BIGINT) AS unmerged_prs "
        "FROM developer_productivity_monthly GROUP BY year, month, month_start_date"
    )
    q["rpt_pr_size_by_month"] = _q(
        "SELECT year, month, count(*) AS total_prs, "
        "avg(coalesce(lines_added, 0) + coalesce(lines_deleted, 0)) AS avg_pr_size "
        "FROM silver_developer_activity WHERE event_type = 'PullRequestEvent' GROUP BY year, month"
    )
    q["rpt_loc_churn_by_month"] = _q(
        "SELECT year, month, CAST(sum(total_lines_added) AS BIGINT) AS lines_added, "
        "CAST(sum(total_lines_deleted) AS BIGINT) AS lines_deleted "
        "FROM developer_productivity_monthly GROUP BY year, month"
    )
    return q
