"""SQL for each registered query, written against the flat tables.

The chat shapes of ``workload/adapter.py`` are stated here again as common table expressions;
nothing is nested into messages and exploded back.
"""

from __future__ import annotations

ORACLES: dict[str, str] = {}

# One row per message. Badge lists are built from the customer key. MATERIALIZED changes no result;
# without it DuckDB 2.0.0 stops with an internal error in one join at sf0.1.
MESSAGE = """
flat AS (
  SELECT *, (l_orderkey // 140) * 21 AS vod FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN part ON l_partkey = p_partkey),
message AS MATERIALIZED (
  SELECT
    CASE WHEN c_custkey % 37 = 0 THEN NULL WHEN c_custkey % 43 = 0 THEN 'guest-' || c_custkey
         ELSE CAST(c_custkey AS VARCHAR) END AS author_id,
    CASE WHEN c_custkey % 41 <> 0 THEN c_name END AS author_name,
    CASE WHEN c_custkey % 3 <> 0 THEN c_mktsegment END AS colour,
    CASE WHEN c_custkey % 5 <> 0 THEN c_custkey % 4 END AS badges,
    CASE WHEN c_custkey % 5 <> 0 THEN
      ['subscriber', CASE WHEN c_custkey % 31 <> 0 THEN 'premium' END, 'moderator'][1:c_custkey % 4] END AS names,
    CASE WHEN c_custkey % 5 <> 0 THEN
      ['Subscriber', 'Fan, None, True', CASE WHEN c_custkey % 29 <> 0 THEN 'Moderator' END][1:c_custkey % 4] END AS titles,
    CASE WHEN c_custkey % 5 <> 0 THEN
      [CAST(c_custkey % 12 AS VARCHAR), CAST(c_custkey % 12 + 1 AS VARCHAR), CAST(c_custkey % 12 + 2 AS VARCHAR)]
      [1:c_custkey % 4] END AS versions,
    CASE WHEN l_returnflag <> 'R' THEN CAST(l_quantity AS BIGINT) // 13 END AS emotes,
    [p_brand, p_type, CASE WHEN l_linenumber = 7 THEN NULL WHEN l_linenumber = 6 THEN '' ELSE p_name END] AS emote_list,
    epoch_us(l_shipdate) + l_orderkey % 86400 * 1000000 + l_partkey % 1000 AS micros,
    printf('%d:%02d:%02d', l_orderkey % 36000 // 3600, l_orderkey % 3600 // 60, l_orderkey % 60) AS time_text,
    l_orderkey % 36000 AS seconds,
    p_name AS message,
    lower(replace(r_name, ' ', '_')) AS channel,
    vod,
    CAST(vod AS VARCHAR) AS vod_id,
    CAST(year(make_timestamp((1356998400 + (vod * 7919 % 4748) * 86400 + vod % 86400) * 1000000)) AS INTEGER) AS year
  FROM flat JOIN region ON vod % 5 = r_regionkey)"""

# One row per emote use.
PANEL = (
    MESSAGE
    + """,
uses AS (SELECT *, unnest(range(emotes)) AS i FROM message),
panel AS (
  SELECT TRY_CAST(author_id AS BIGINT) AS i_user_id, author_name AS i_user_name, colour AS i_display_color,
    names, titles, versions, badges, emotes, channel, year, vod_id, vod, author_id,
    array_to_string(names, ',') AS i_badge_names, array_to_string(titles, ',') AS i_badge_titles,
    array_to_string(versions, ',') AS i_badge_versions,
    CAST(NULL AS VARCHAR) AS i_user_status, channel AS j_streamer,
    emote_list[i + 1] AS k_emote_name, make_timestamp(micros) AS t_timestamp, time_text AS t_time_text,
    seconds AS t_seconds, message AS chat_message
  FROM uses)"""
)

VOD = """
vod AS (
  SELECT p_partkey AS id, p_name || ', "' || p_brand || '" - ' || p_type AS title,
    make_timestamp((1356998400 + (p_partkey * 7919 % 4748) * 86400 + p_partkey % 86400) * 1000000) AS created_at,
    CAST(p_size % 12 AS VARCHAR) || 'h' || p_size || 'm' || p_partkey % 60 || 's' AS duration,
    'https://videos.example/' || p_partkey AS url
  FROM part)"""

GOLD = (
    PANEL
    + ","
    + VOD
    + """,
gold AS (SELECT panel.*, title AS match_title FROM panel LEFT JOIN vod ON panel.vod_id = CAST(vod.id AS VARCHAR))"""
)

# The five awkward files, and per file what the messages of the tables add up to.
FILES = (
    MESSAGE
    + """,
table_file AS (
  SELECT channel || '_' || year || '_' || lpad(CAST(vod // 21 AS VARCHAR), 12, '0') || '_' || vod_id || '.json'
      AS file_name,
    channel, year, CAST(vod // 21 AS BIGINT) AS file_seq, vod_id,
    count(*) AS message_rows, coalesce(sum(emotes), 0) AS emote_rows,
    coalesce(sum(emotes) FILTER (author_id IS NULL OR author_name IS NULL), 0) AS missing_user_rows,
    count(*) AS scanned_rows
  FROM message GROUP BY ALL),
edge_file AS (
  SELECT * FROM (VALUES
    ('edge_case_2019_001_900000000001.json', 'edge_case', 2019, 1, '900000000001', 0, 0, 0, 0, 'no_emote'),
    ('edge_case_2019_002_900000000002.json', 'edge_case', 2019, 2, '900000000002', 0, 0, 0, 1, 'failed'),
    ('edge_case_2019_003_900000000003.json', 'edge_case', 2019, 3, '900000000003', 1, 0, 0, 1, 'no_emote'),
    ('edge_case_2015_3.json', 'edge_case', 2015, 3, CAST(NULL AS VARCHAR), 0, 0, 0, 0, 'no_emote'),
    ('edge_case_2012_7.json', 'edge_case', 2012, 7, CAST(NULL AS VARCHAR), 1, 2, 2, 1, 'processed'))
  AS edge(file_name, channel, year, file_seq, vod_id, message_rows, emote_rows, missing_user_rows,
          scanned_rows, status)),
file AS (
  SELECT file_name, channel, CAST(year AS INTEGER) AS year, CAST(file_seq AS BIGINT) AS file_seq, vod_id,
    CAST(message_rows AS BIGINT) AS message_rows, CAST(emote_rows AS BIGINT) AS emote_rows,
    CAST(missing_user_rows AS BIGINT) AS missing_user_rows, CAST(scanned_rows AS BIGINT) AS scanned_rows, status
  FROM (SELECT *, CASE WHEN emote_rows > 0 THEN 'processed' ELSE 'no_emote' END AS status FROM table_file
        UNION ALL SELECT * FROM edge_file))"""
)

YEARS = "years AS (SELECT CAST(unnest(range(2012, 2027)) AS INTEGER) AS year)"

PANEL_COLUMNS = """i_user_id, i_user_name, i_display_color, i_badge_names, i_badge_titles, i_badge_versions,
  i_user_status, j_streamer, k_emote_name, t_timestamp, t_time_text, t_seconds, vod_id, chat_message"""

# The panel row of the old-form edge file, once per emote.
EDGE_PANEL = f"""
edge_panel AS (
  SELECT CAST(NULL AS BIGINT) AS i_user_id, 'b' AS i_user_name, CAST(NULL AS VARCHAR) AS i_display_color,
    '' AS i_badge_names, '' AS i_badge_titles, '' AS i_badge_versions, CAST(NULL AS VARCHAR) AS i_user_status,
    'edge_case' AS j_streamer, unnest(['e', 'f']) AS k_emote_name,
    TIMESTAMP '2012-01-01 00:00:00.000001' AS t_timestamp, '0:01' AS t_time_text, 1 AS t_seconds,
    CAST(NULL AS VARCHAR) AS vod_id, 'e f' AS chat_message, 'edge_case' AS channel, 2012 AS year)"""

# A CSV reader gives NULL for empty text.
CSV_LIST = "nullif(array_to_string({}, '{}'), '')"


def oracle(name: str, tables: str, select: str) -> None:
    ORACLES[name] = f"WITH {tables.strip()}\n{select.strip()}"


# Sources

CHAT_ROWS = """
SELECT channel, year, vod_id, author_id, author_name, colour, array_to_string(names, ',') AS badge_names,
  array_to_string(titles, ',') AS badge_titles, array_to_string(versions, ',') AS badge_versions,
  array_to_string(emote_list[1:emotes], ',') AS emote_names, micros AS timestamp, time_text,
  CAST(seconds AS DOUBLE) AS time_in_seconds, message, 0 AS blank FROM message
UNION ALL VALUES
  ('edge_case', 2019, '900000000002', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, 1),
  ('edge_case', 2019, '900000000003', '1', 'a', NULL, '', '', '', '', 1, NULL, NULL, 'm', 0),
  ('edge_case', 2012, NULL, NULL, 'b', NULL, '', '', '', 'e,f', 1325376000000001, '0:01', 1.5, 'e f', 0)"""
oracle("read_chat_files", MESSAGE, CHAT_ROWS)
oracle("read_chat_split", MESSAGE, CHAT_ROWS)
oracle("read_vod_catalog", VOD, "SELECT id, title, created_at, duration, url FROM vod")
oracle(
    "read_silver_panel",
    PANEL,
    f"SELECT {PANEL_COLUMNS}, channel, year FROM panel WHERE channel = 'middle_east'",
)
oracle("read_silver_mixed_revisions", PANEL, f"SELECT {PANEL_COLUMNS}, channel, year FROM panel")
oracle("migrate_silver_table", PANEL, f"SELECT {PANEL_COLUMNS}, channel, year FROM panel")
oracle("read_gold_panel", GOLD, f"SELECT {PANEL_COLUMNS}, match_title, channel, year FROM gold")
oracle(
    "read_legacy_csv",
    PANEL,
    """
SELECT author_id AS i_user_id, i_user_name AS i_username, i_display_color,
  CASE WHEN names IS NULL THEN 'None' ELSE '[' || array_to_string(list_transform(range(1, len(names) + 1), lambda k:
    '{''name'': ' || coalesce('''' || names[k] || '''', 'None') || ', ''title'': '
    || coalesce('''' || titles[k] || '''', 'None') || ', ''version'': ''' || versions[k] || '''}'), ', ') || ']'
  END AS i_badges,
  j_streamer, nullif(k_emote_name, '') AS k_emote_name, t_timestamp, t_time_text,
  CAST(t_seconds AS DOUBLE) AS t_seconds, chat_message AS message
FROM panel""",
)
oracle("file_metadata", FILES, "SELECT file_name, channel, year, file_seq, vod_id, scanned_rows FROM file WHERE scanned_rows > 0")
oracle(
    "raw_file_listing",
    FILES,
    "SELECT file_name, channel, year, file_seq, vod_id, 1 AS has_parts, 1 AS has_bytes FROM file",
)

# Sinks

oracle(
    "write_silver_twice",
    PANEL,
    """
SELECT channel, year, vod_id, count(*) FILTER (vod_id <> '21' OR k_emote_name IS NOT NULL) AS record_count,
  count(*) FILTER (vod_id = '21' AND k_emote_name IS NOT NULL) AS edited_count
FROM panel GROUP BY ALL""",
)
oracle("write_silver_by_year", PANEL, f"SELECT {PANEL_COLUMNS}, channel, year FROM panel")
oracle(
    "write_gold_as_parquet",
    GOLD,
    "SELECT channel, year, match_title, count(*) AS record_count FROM gold GROUP BY ALL",
)
oracle(
    "write_gold_as_csv",
    GOLD,
    f"""
SELECT i_user_id, i_user_name, {CSV_LIST.format('names', ',')} AS i_badge_names,
  {CSV_LIST.format('titles', ',')} AS i_badge_titles, {CSV_LIST.format('versions', ',')} AS i_badge_versions,
  nullif(k_emote_name, '') AS k_emote_name, match_title, vod_id, channel, year
FROM gold""",
)
oracle(
    "write_gold_as_exact_csv",
    GOLD,
    f"""
SELECT {PANEL_COLUMNS.replace('chat_message', "chat_message || chr(13) || chr(10) || ' a, " + '"b"' + " " + chr(92) + "N' AS chat_message")},
  match_title, channel, year
FROM gold""",
)
USERS = (
    PANEL
    + """,
per_user AS (
  SELECT i_user_name, CAST(max(coalesce(badges, 0)) AS INTEGER) AS badge_count FROM panel GROUP BY i_user_name)"""
)
DISTRIBUTION = """
SELECT badge_count AS number_of_badges_per_user, count(i_user_name) AS users_volume_count,
  round(100 * count(i_user_name) / (SELECT count(*) FROM per_user), 2) AS users_volume_percentage
FROM per_user GROUP BY badge_count"""
oracle("write_badge_report", USERS, DISTRIBUTION)
oracle(
    "write_legacy_panel",
    PANEL,
    f"""
SELECT CAST(i_user_id AS VARCHAR) AS i_user_id, i_user_name AS i_username, i_display_color,
  {CSV_LIST.format('names', ', ')} AS i_badge_names, {CSV_LIST.format('titles', ', ')} AS i_badge_titles,
  {CSV_LIST.format('versions', ', ')} AS i_badge_versions, j_streamer, nullif(k_emote_name, '') AS k_emote_name,
  t_timestamp, t_time_text, CAST(t_seconds AS DOUBLE) AS t_seconds, chat_message AS message
FROM panel""",
)
oracle("register_view", VOD, "SELECT duration, count(*) AS vods, max(created_at) AS latest FROM vod GROUP BY duration")
oracle("inspect_table", PANEL, "SELECT 14 AS column_count, count(*) AS row_count, least(count(*), 5) AS head_count FROM panel")

# Projections and filters

oracle(
    "with_emotes",
    MESSAGE,
    """SELECT vod_id, micros AS timestamp, message, CAST(emotes AS INTEGER) AS emote_count
FROM message WHERE emotes IS NOT NULL""",
)
oracle(
    "explode_emotes",
    PANEL,
    "SELECT vod_id, epoch_us(t_timestamp) AS timestamp, author_id, k_emote_name AS emote_name FROM panel",
)
oracle(
    "badge_arrays",
    MESSAGE,
    """
SELECT vod_id, micros AS timestamp, array_to_string(names, ',') AS i_badge_names,
  array_to_string(titles, ',') AS i_badge_titles, array_to_string(versions, ',') AS i_badge_versions FROM message""",
)
oracle("emote_panel", PANEL, f"SELECT {PANEL_COLUMNS} FROM panel")
oracle(
    "legacy_panel",
    PANEL,
    """
SELECT author_id AS i_user_id, i_user_name AS i_username, i_display_color,
  array_to_string(list_transform(range(1, len(names) + 1), lambda k:
    coalesce(names[k], '-') || '/' || coalesce(titles[k], '-') || '/' || versions[k]), ',') AS i_badges,
  j_streamer, k_emote_name, t_timestamp, t_time_text, CAST(t_seconds AS DOUBLE) AS t_seconds, chat_message AS message
FROM panel""",
)
oracle("micros_as_timestamp", MESSAGE, "SELECT micros AS timestamp, make_timestamp(micros) AS t_timestamp FROM message")
oracle("user_status", MESSAGE, "SELECT CAST(NULL AS VARCHAR) AS i_user_status, count(*) AS message_count FROM message")
oracle(
    "missing_users",
    PANEL,
    """SELECT i_user_id, i_user_name, k_emote_name, t_timestamp, vod_id FROM panel
WHERE i_user_id IS NULL OR i_user_name IS NULL""",
)
oracle(
    "drop_incomplete",
    PANEL,
    """SELECT i_user_id, k_emote_name, t_timestamp, vod_id FROM panel
WHERE i_user_id IS NOT NULL AND k_emote_name IS NOT NULL AND k_emote_name <> ''""",
)
oracle(
    "flatten_badges",
    PANEL,
    """SELECT vod_id, t_timestamp, coalesce(i_badge_names, '') AS i_badge_names,
  coalesce(i_badge_titles, '') AS i_badge_titles, coalesce(i_badge_versions, '') AS i_badge_versions FROM panel""",
)
oracle(
    "legacy_badge_info",
    PANEL,
    """
SELECT author_id AS i_user_id, i_user_name AS i_username, i_display_color,
  coalesce(array_to_string(list_transform(names, lambda x: coalesce(x, '')), ', '), '') AS i_badge_names,
  coalesce(array_to_string(list_transform(titles, lambda x: coalesce(x, '')), ', '), '') AS i_badge_titles,
  coalesce(array_to_string(versions, ', '), '') AS i_badge_versions,
  j_streamer, k_emote_name, t_timestamp, t_time_text, CAST(t_seconds AS DOUBLE) AS t_seconds,
  chat_message AS message
FROM panel""",
)
oracle(
    "select_badge_columns",
    PANEL,
    "SELECT i_user_name, t_timestamp, i_badge_names, i_badge_titles, i_badge_versions FROM panel",
)
oracle(
    "badge_count",
    PANEL,
    """SELECT i_user_name, t_timestamp, CAST(coalesce(badges, -1) AS INTEGER) AS raw_count,
  CAST(coalesce(badges, 0) AS INTEGER) AS badges_count FROM panel""",
)
oracle(
    "clean_badge_count",
    PANEL,
    """SELECT i_user_name, t_timestamp, CAST(coalesce(badges, -1) AS INTEGER) AS badges_count,
  CAST(CASE WHEN names IS NULL THEN 0 ELSE badges END AS INTEGER) AS badges_count_tf FROM panel""",
)
oracle(
    "users_with_badges_over",
    MESSAGE,
    """SELECT author_id AS i_user_id, author_name AS i_username, CAST(badges AS INTEGER) AS tot_badges
FROM message WHERE badges > 2""",
)
oracle("search_titles", VOD, "SELECT title, created_at FROM vod WHERE lower(title) LIKE '%bolt%' ORDER BY created_at, id")
oracle("search_titles_by_case", VOD, "SELECT * FROM vod WHERE title LIKE '%ECONOMY%'")
oracle("vods_of_year", VOD, "SELECT id, title FROM vod WHERE year(created_at) = 2020")
oracle("rename_title_drop_key", VOD, "SELECT title AS match_title, created_at, duration, url FROM vod")
EVENTS = """
old AS (
  SELECT user_id AS i_user_id, 'viewer_' || user_id AS i_user_name, CAST(NULL AS VARCHAR) AS i_display_color,
    CAST(NULL AS VARCHAR) AS i_badge_names, CAST(NULL AS VARCHAR) AS i_badge_titles,
    CAST(NULL AS VARCHAR) AS i_badge_versions, CAST(NULL AS VARCHAR) AS i_user_status, 'events' AS j_streamer,
    event_type AS k_emote_name, ts AS t_timestamp, CAST(NULL AS VARCHAR) AS t_time_text,
    CAST(trunc(value) AS BIGINT) AS t_seconds, CAST(NULL AS VARCHAR) AS vod_id, props AS chat_message
  FROM events)"""
oracle("normalize_panel", EVENTS, f"SELECT {PANEL_COLUMNS} FROM old")
oracle(
    "safe_titles",
    VOD,
    r"SELECT id, regexp_replace(title, '[^\p{L}\p{N}._-]', '_', 'g')[1:50] AS safe_title FROM vod",
)

# Joins

oracle("attach_titles", GOLD, "SELECT vod_id, i_user_id, k_emote_name, t_timestamp, match_title FROM gold")
oracle(
    "records_per_title",
    GOLD,
    """SELECT match_title, count(*) AS record_count,
  count(*) FILTER (i_user_id IS NULL OR i_user_name IS NULL) AS missing_user_count FROM gold GROUP BY match_title""",
)
CHOSEN = (
    PANEL
    + """,
chosen AS (
  SELECT DISTINCT i_user_name FROM panel WHERE badges IS NULL ORDER BY i_user_name NULLS LAST LIMIT 10)"""
)
BEST = """
SELECT i_user_name, i_badge_names, i_badge_titles, i_badge_versions FROM panel
WHERE {}
ORDER BY coalesce(badges, -1) DESC, i_user_name NULLS LAST, names NULLS LAST, titles NULLS LAST, versions NULLS LAST
LIMIT 10"""
oracle(
    "badges_of_users_without_badges",
    CHOSEN,
    BEST.format("i_user_name IN (SELECT i_user_name FROM chosen)"),
)
oracle(
    "badges_of_users_or_not",
    CHOSEN,
    BEST.format("i_user_name IN (SELECT i_user_name FROM chosen) OR i_user_name <> 'Customer#000000003'"),
)
oracle("badge_distribution_subquery", USERS, DISTRIBUTION)
VOD_YEAR = """
wanted AS (SELECT CAST(year(created_at) AS INTEGER) AS year, CAST(id AS VARCHAR) AS vod_id, title FROM vod)"""
# A broadcast is there if a file has its id, or a file without id has its year and its number in the year.
LANDED = """
numbered AS (
  SELECT CAST(year(created_at) AS INTEGER) AS year, CAST(id AS VARCHAR) AS vod_id, title,
    row_number() OVER (PARTITION BY year(created_at) ORDER BY created_at, id) - 1 AS number
  FROM vod),
landed AS (
  SELECT *, vod_id IN (SELECT vod_id FROM file WHERE vod_id IS NOT NULL)
    OR (year, number) IN (SELECT (year, file_seq) FROM file WHERE vod_id IS NULL) AS there
  FROM numbered)"""
oracle("missing_raw_files", f"{FILES},{VOD},{LANDED}", "SELECT year, vod_id, title FROM landed WHERE NOT there")

# Aggregations

oracle("record_count", PANEL, "SELECT year, count(*) AS record_count FROM panel GROUP BY year")
oracle("vods_per_year", VOD, "SELECT CAST(year(created_at) AS INTEGER) AS year, count(*) AS vods FROM vod GROUP BY ALL")
oracle("max_badges_per_user", USERS, "SELECT i_user_name, badge_count FROM per_user")
oracle("badge_distribution", USERS, DISTRIBUTION)
FREQUENCY = """
SELECT x AS {0}s, count(x) AS tot_count FROM (SELECT unnest({1}) AS x FROM panel) GROUP BY x"""
oracle("badge_name_frequency", PANEL, FREQUENCY.format("badge_name", "names"))
oracle("badge_title_frequency", PANEL, FREQUENCY.format("badge_title", "titles"))
CROSS = (
    PANEL
    + """,
by_name AS (SELECT unnest(names) AS name, titles, versions FROM panel),
by_title AS (SELECT name, unnest(titles) AS title, versions FROM by_name),
crossed AS (SELECT name, title, unnest(versions) AS version FROM by_title)"""
)
oracle("badge_name_frequency_cross", CROSS, "SELECT name AS badge_names, count(name) AS tot_count FROM crossed GROUP BY name")
oracle("badge_title_frequency_cross", CROSS, "SELECT title AS badge_titles, count(title) AS tot_count FROM crossed GROUP BY title")
oracle(
    "distinct_badges",
    PANEL,
    """
SELECT (SELECT count(*) FROM (SELECT DISTINCT x FROM (SELECT unnest(names) AS x FROM panel))) AS distinct_names,
  (SELECT count(*) FROM (SELECT DISTINCT x FROM (SELECT unnest(titles) AS x FROM panel))) AS distinct_titles""",
)
oracle(
    "colour_share_rows",
    PANEL,
    "SELECT avg(CASE WHEN i_display_color IS NOT NULL THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS colour_share FROM panel",
)
oracle(
    "colour_share_users",
    PANEL,
    """
SELECT count(DISTINCT i_user_id) AS total_users,
  count(DISTINCT i_user_id) FILTER (i_display_color IS NOT NULL) AS users_with_colour,
  100 * users_with_colour / total_users AS users_with_colour_percentage
FROM panel""",
)
oracle(
    "badge_version_counts",
    PANEL,
    """SELECT array_to_string(versions, ', ') AS i_badge_versions, count(*) AS row_count FROM panel
WHERE len(versions) > 0 GROUP BY ALL""",
)
GOLD_REPORT = """
SELECT year, count(vod_id) AS total_emote_records,
  count(*) FILTER (vod_id IS NOT NULL AND (i_user_id IS NULL OR i_user_name IS NULL)) AS records_missing_user_info,
  coalesce(round(100 * records_missing_user_info / nullif(total_emote_records, 0), 2), 0)
    AS records_missing_user_info_percentage
FROM years LEFT JOIN (SELECT * FROM panel WHERE {}) USING (year) GROUP BY year"""
oracle("gold_report", f"{PANEL}, {YEARS}", GOLD_REPORT.format("true"))
INGEST = """
SELECT year, count(file_name) AS total_files,
  count(*) FILTER (status = 'processed') AS processed_files,
  count(*) FILTER (status <> 'processed') AS unprocessed_files,
  count(*) FILTER (status = 'no_emote') AS no_emote_files,
  count(*) FILTER (status = 'failed') AS failed_files,
  count(*) FILTER (status = 'pending') AS pending_files,
  count(*) FILTER (missing_user_rows > 0) AS missing_user_files
FROM years LEFT JOIN file USING (year) GROUP BY year"""
oracle("ingest_report", f"{FILES}, {YEARS}", INGEST)
oracle(
    "file_status",
    FILES,
    """SELECT file_name, channel, year, file_seq, vod_id, message_rows, emote_rows, missing_user_rows, status
FROM file""",
)
oracle(
    "files_with_status",
    FILES,
    """
SELECT channel, year, file_name, vod_id, status AS listed_as FROM file WHERE status <> 'processed'
UNION ALL
SELECT channel, year, file_name, vod_id, 'missing_user' FROM file WHERE missing_user_rows > 0""",
)
oracle(
    "download_report",
    f"{FILES},{VOD},{LANDED}, {YEARS}",
    """
SELECT years.year, count(vod_id) AS vods_wanted, count(*) FILTER (there) AS vods_present,
  vods_wanted - vods_present AS vods_missing
FROM years LEFT JOIN landed ON years.year = landed.year
GROUP BY years.year""",
)

# Windows, sorts, set operations

oracle(
    "download_manifest",
    f"{VOD},{VOD_YEAR.replace('title FROM', 'title, url, created_at, id FROM')}",
    """
SELECT year, row_number() OVER (PARTITION BY year ORDER BY created_at, id) - 1 AS file_number, vod_id, title, url,
  printf('middle_east_%d_%03d_%d.json', year, file_number, id) AS file_name,
  'raw_bronze/middle_east/' || year || '/' || file_name AS key
FROM wanted""",
)
oracle(
    "day_number",
    FILES,
    """SELECT file_name, file_seq, dense_rank() OVER (PARTITION BY channel, year ORDER BY file_seq) AS day_number
FROM file""",
)
oracle("order_files", FILES, "SELECT channel, year, file_seq, file_name FROM file ORDER BY ALL")
oracle("sort_vods", VOD, "SELECT created_at, id FROM vod ORDER BY created_at, id")
oracle(
    "top_k",
    PANEL,
    FREQUENCY.format("badge_name", "names") + " ORDER BY tot_count DESC, badge_names NULLS LAST LIMIT 2",
)
oracle(
    "union_panels",
    f"{PANEL},{EVENTS}",
    f"""
SELECT j_streamer, k_emote_name, count(*) AS record_count, count(vod_id) AS with_vod,
  CAST(sum(t_seconds) AS BIGINT) AS seconds
FROM (SELECT {PANEL_COLUMNS} FROM panel UNION ALL SELECT {PANEL_COLUMNS} FROM old) GROUP BY ALL""",
)
oracle("distinct_users", PANEL, "SELECT DISTINCT i_user_name FROM panel")

# Streaming and whole jobs

oracle(
    "ingest_chat_stream",
    f"{PANEL},{EDGE_PANEL}",
    f"""SELECT {PANEL_COLUMNS}, channel, year FROM panel
UNION ALL SELECT {PANEL_COLUMNS}, channel, year FROM edge_panel""",
)
oracle(
    "ingest_stream_failures",
    FILES,
    """SELECT file_name, channel, year, file_seq, vod_id, status, message_rows, emote_rows, missing_user_rows
FROM file""",
)
oracle("silver_job", f"{FILES}, {YEARS}", INGEST)
oracle("gold_job", f"{PANEL}, {YEARS}", GOLD_REPORT.format("channel = 'middle_east'"))
