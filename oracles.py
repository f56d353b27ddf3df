"""DuckDB statements that check the registered queries.

``BASE`` rebuilds the four-table model from the star-schema tables; every
statement adds its own CTEs and a final SELECT.
"""

from __future__ import annotations

BASE = """
WITH catalogue AS (
  SELECT p_partkey,
    'i' || p_partkey AS item_id,
    CASE WHEN p_size % 3 = 0 THEN 'series' ELSE 'movie' END AS type,
    p_name AS title,
    CAST(NULL AS VARCHAR) AS description,
    CAST(1950 + p_partkey % 75 AS INTEGER) AS release_year,
    CAST(DATE '2020-01-01' + CAST(p_partkey % 1000 AS INTEGER) AS DATE) AS date_added,
    CASE WHEN p_size % 3 <> 0 AND p_partkey % 97 <> 0 THEN p_size END AS runtime_minutes,
    CASE WHEN p_size % 3 = 0 THEN p_size % 10 + 1 END AS season_count,
    CASE WHEN p_size % 3 = 0 THEN p_size END AS episode_count,
    CASE p_partkey % 3 WHEN 0 THEN 'PG' WHEN 1 THEN 'TV-MA' END AS content_rating,
    CASE WHEN p_partkey % 13 <> 0 THEN 'NATION_' || (p_partkey % 20) END AS country,
    CASE WHEN p_type <> 'ECONOMY' THEN lower(substr(p_type, 1, 2)) END AS original_language,
    CAST(CAST(p_partkey % 100 AS DECIMAL(6,1)) / 10 AS DECIMAL(3,1)) AS imdb_score,
    p_partkey % 4 = 0 AS is_netflix_original,
    p_partkey % 9 = 0 AS content_warning,
    CASE WHEN p_brand <> 'Brand#11' THEN p_brand END AS genre_primary,
    CASE WHEN p_size % 2 <> 0 THEN 'Brand#' || p_size END AS genre_secondary,
    CASE p_partkey % 10 WHEN 0 THEN 'archived' WHEN 1 THEN 'coming_soon' ELSE 'active' END AS catalog_status,
    CASE WHEN p_partkey % 6 <> 0 THEN 'pack' || (p_partkey % 6) END AS seed_source
  FROM part
), items AS (
  SELECT * EXCLUDE (p_partkey) FROM catalogue WHERE p_partkey % 50 <> 7
), accounts AS (
  SELECT c_custkey,
    'u' || c_custkey AS user_id,
    CASE WHEN c_acctbal >= 0 THEN CAST(18 + c_custkey % 60 AS INTEGER) END AS age,
    CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'male' WHEN 'BUILDING' THEN 'female'
      WHEN 'FURNITURE' THEN 'other' WHEN 'MACHINERY' THEN 'nonbinary' END AS gender,
    lower(c_mktsegment) AS occupation,
    n_name AS country,
    CASE c_custkey % 5 WHEN 0 THEN 'en' WHEN 1 THEN 'es' WHEN 2 THEN 'st' WHEN 3 THEN 'me' END AS preferred_language,
    CAST(DATE '2023-01-01' + CAST(c_custkey % 700 AS INTEGER) AS DATE) AS signup_date,
    CASE c_custkey % 4 WHEN 0 THEN 'basic' WHEN 1 THEN 'standard' WHEN 2 THEN 'premium' ELSE 'premium_plus' END AS subscription_plan,
    CASE c_custkey % 10 WHEN 0 THEN 'cancelled' WHEN 1 THEN 'suspended' ELSE 'active' END AS account_status,
    CASE c_custkey % 3 WHEN 0 THEN 'Mobile' WHEN 1 THEN 'Smart TV' END AS primary_device,
    CASE WHEN c_custkey % 7 <> 0 THEN 'pack' || (c_custkey % 7) END AS seed_source
  FROM customer JOIN nation ON n_nationkey = c_nationkey
), users AS (
  SELECT * EXCLUDE (c_custkey) FROM accounts WHERE c_custkey % 40 <> 3
), watch_events AS (
  SELECT 'u' || o_custkey AS user_id, 'i' || l_partkey AS item_id,
    CAST(l_quantity * 60 AS INTEGER) AS watched_seconds,
    CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'smart_tv' WHEN '2' THEN 'mobile'
      WHEN '3' THEN 'desktop' WHEN '4' THEN 'tablet' WHEN '5' THEN 'game_console' END AS device_type,
    l_shipdate AS session_ended_at
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
), rating_events AS (
  SELECT 'u' || o_custkey AS user_id, 'i' || l_partkey AS item_id,
    1 + CAST(round(l_discount * 100) AS INTEGER) % 5 AS rating, l_shipdate AS rated_at,
    row_number() OVER (PARTITION BY o_custkey, l_partkey
      ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, l_discount DESC) AS age_rank
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
), ratings AS (
  SELECT user_id, item_id, rating, rated_at FROM rating_events WHERE age_rank = 1
), heartbeats AS (
  SELECT 'u' || user_id AS user_id, event_type AS item_id, CAST(trunc(value) AS INTEGER) AS watched_seconds,
    CASE event_id % 5 WHEN 0 THEN 'smart_tv' WHEN 1 THEN 'mobile' WHEN 2 THEN 'desktop'
      WHEN 3 THEN 'tablet' ELSE 'game_console' END AS device_type,
    ts AS session_ended_at, event_id AS seq
  FROM events
), lw AS (
  SELECT w.* FROM watch_events w
  WHERE w.item_id IN (SELECT item_id FROM items) AND w.user_id IN (SELECT user_id FROM users)
), lr AS (
  SELECT r.* FROM ratings r
  WHERE r.item_id IN (SELECT item_id FROM items) AND r.user_id IN (SELECT user_id FROM users)
), clock AS (
  SELECT max(l_shipdate) AS now FROM lineitem
)
"""

# Report tables as CTEs, so that panels can be checked on top of them.
REPORTS = {
    "user_rating_avg": """
  SELECT user_id, avg(rating) AS avg_rating, count(*) AS rating_count FROM lr GROUP BY user_id""",
    "item_rating_avg": """
  SELECT item_id, avg(rating) AS avg_rating, count(*) AS rating_count FROM lr GROUP BY item_id""",
    "user_mood": """
  SELECT user_id,
    CASE WHEN avg(rating) <= 4.5 AND avg(rating) >= 3.5 THEN 'average' WHEN avg(rating) < 3.5 THEN 'bad' ELSE 'good' END AS mood,
    avg(rating) AS avg_recent_rating, CAST(count(*) AS INTEGER) AS ratings_used
  FROM (SELECT * FROM lr QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY rated_at DESC, item_id) <= 3)
  GROUP BY user_id""",
    "item_view_ranking": """
  SELECT type, CAST(row_number() OVER (PARTITION BY type ORDER BY n DESC, item_id) AS INTEGER) AS rank, item_id, n AS view_count
  FROM (SELECT type, item_id, count(*) AS n FROM lw JOIN items USING (item_id), clock
        WHERE session_ended_at >= now - INTERVAL 90 DAY GROUP BY type, item_id)
  QUALIFY rank <= 10""",
    "item_rating_ranking": """
  SELECT type,
    CAST(row_number() OVER (PARTITION BY type ORDER BY avg_rating DESC, rating_count DESC, coalesce(views, 0) DESC, item_id) AS INTEGER) AS rank,
    item_id, avg_rating, rating_count
  FROM (SELECT type, item_id, avg(rating) AS avg_rating, count(*) AS rating_count
        FROM lr JOIN items USING (item_id), clock WHERE rated_at >= now - INTERVAL 90 DAY GROUP BY type, item_id)
  LEFT JOIN (SELECT item_id, count(*) AS views FROM lw, clock
             WHERE session_ended_at >= now - INTERVAL 90 DAY GROUP BY item_id) USING (item_id)
  QUALIFY rank <= 10""",
    "item_completion_rate": """
  SELECT item_id, type,
    avg(CASE WHEN watched_seconds >= 0.85 * secs THEN 1.0::DOUBLE WHEN secs IS NOT NULL THEN 0.0::DOUBLE END) AS completion_rate,
    count(*) AS watch_count
  FROM lw JOIN (SELECT item_id, type, CASE type WHEN 'series' THEN 2400 ELSE 60 * runtime_minutes END AS secs FROM items) USING (item_id)
  GROUP BY item_id, type""",
    "item_viewer_demographics": """
  SELECT item_id, avg(age) AS average_age,
    count(*) FILTER (gender = 'male') / count(*) AS pct_male,
    count(*) FILTER (gender = 'female') / count(*) AS pct_female,
    count(*) FILTER (gender = 'other') / count(*) AS pct_other,
    count(*) FILTER (gender IS NULL OR gender = 'nonbinary') / count(*) AS pct_unknown,
    count(*) AS viewer_count
  FROM (SELECT DISTINCT item_id, user_id FROM lw) JOIN users USING (user_id) GROUP BY item_id""",
    "user_series_movie_ratio": """
  SELECT user_id, count(*) FILTER (type = 'movie') AS movie_watch_count,
    count(*) FILTER (type = 'series') AS series_watch_count,
    count(*) FILTER (type = 'movie') / count(*) AS movie_percentage,
    count(*) FILTER (type = 'series') / count(*) AS series_percentage
  FROM lw JOIN items USING (item_id) GROUP BY user_id""",
    "user_top_genre": """
  SELECT user_id, genre_primary AS top_genre, n AS genre_watch_count, used AS watches_used
  FROM (SELECT user_id, genre_primary, count(*) AS n,
          CAST(sum(count(*)) OVER (PARTITION BY user_id) AS BIGINT) AS used
        FROM (SELECT user_id, genre_primary FROM lw JOIN items USING (item_id)
              QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY session_ended_at DESC, item_id) <= 8)
        WHERE genre_primary IS NOT NULL GROUP BY user_id, genre_primary)
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY n DESC, genre_primary) = 1""",
    "user_top_device_language": """
  SELECT d.user_id, device_type AS top_device, device_n AS device_watch_count,
    original_language AS top_language, language_n AS language_watch_count
  FROM (SELECT * FROM
          (SELECT user_id, device_type, count(*) AS device_n, max(session_ended_at) AS seen FROM lw GROUP BY user_id, device_type)
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY device_n DESC, seen DESC, device_type) = 1) d
  LEFT JOIN (SELECT * FROM
          (SELECT user_id, original_language, count(*) AS language_n, max(session_ended_at) AS seen
           FROM lw JOIN items USING (item_id) WHERE original_language IS NOT NULL GROUP BY user_id, original_language)
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY language_n DESC, seen DESC, original_language) = 1) l
    ON l.user_id = d.user_id""",
    "user_watch_count": """
  SELECT user_id, count(DISTINCT item_id) AS distinct_items_watched, count(*) AS total_watches FROM lw GROUP BY user_id""",
}


def statement(body: str, *reports: str) -> str:
    """``BASE``, the named report CTEs, then ``body``."""
    ctes = "".join(f", {name} AS ({REPORTS[name]}\n)" for name in reports)
    return f"{BASE}{ctes}\n{body.strip()}"


STATEMENTS = {name: statement(sql) for name, sql in REPORTS.items()}


def check(name: str, body: str, *reports: str) -> None:
    STATEMENTS[name] = statement(body, *reports)


# Change streams and state

# All columns of items and users, as the change log carries them.
_ITEM_FIELDS = """item_id, type, title, description, release_year, date_added, runtime_minutes, season_count, episode_count,
  content_rating, country, original_language, imdb_score, is_netflix_original, content_warning, genre_primary, genre_secondary,
  seed_source, created_at, updated_at"""
_USER_FIELDS = """user_id, age, gender, occupation, country, preferred_language, signup_date, subscription_plan, email, first_name,
  last_name, state_province, city, monthly_spend_hours, primary_device, seed_source, created_at, updated_at"""
_FULL_ITEMS = """(SELECT *, created AS created_at, CASE WHEN p_partkey % 4 <> 0 THEN created + INTERVAL 1 DAY END AS updated_at FROM
  (SELECT *, date_added::TIMESTAMP + to_microseconds(p_partkey % 86400 * 1000007) AS created FROM catalogue))"""
_FULL_USERS = """(SELECT a.*, CASE WHEN c_custkey % 9 <> 0 THEN 'c' || c_custkey || '@example.com' END AS email, 'Ann' AS first_name,
  CAST(NULL AS VARCHAR) AS last_name, CAST(NULL AS VARCHAR) AS state_province, upper(occupation[1]) || occupation[2:] AS city,
  CAST(c_acctbal AS DECIMAL(6,2)) AS monthly_spend_hours, signup_date::TIMESTAMP + to_microseconds(c_custkey % 86400 * 1000007) AS created_at,
  signup_date::TIMESTAMP + to_microseconds(c_custkey % 86400 * 1000007) AS updated_at
  FROM accounts a JOIN customer USING (c_custkey))"""


def _unwrapped(fields: str, status: str, rows: str, number: str, deleted: str) -> str:
    """Created as a draft, completed, deleted."""
    key, *rest = [f.strip() for f in fields.split(",")]
    return f"""
SELECT {fields}, 'draft' AS {status}, false AS is_delete, {number} * 4 AS seq FROM {rows}
UNION ALL BY NAME SELECT {fields}, {status}, false AS is_delete, {number} * 4 + 1 AS seq FROM {rows} WHERE {number} % 3 <> 1
UNION ALL BY NAME SELECT {key}, true AS is_delete, {number} * 4 + 2 AS seq FROM {rows} WHERE {deleted}
"""


check("unwrap_changes", _unwrapped(_ITEM_FIELDS, "catalog_status", _FULL_ITEMS, "p_partkey", "p_partkey % 50 = 7"))
check("unwrap_user_changes", _unwrapped(_USER_FIELDS, "account_status", _FULL_USERS, "c_custkey", "c_custkey % 40 = 3"))
check("decode_watches", "SELECT * FROM watch_events WHERE watched_seconds > 60")
check("route_changes", """
SELECT 'catalog.public.app_user' AS origin, '{"user_id":"' || user_id || '"}' AS key, c_custkey * 4 + step AS seq
FROM accounts, (VALUES (0), (1), (2)) s(step)
WHERE step = 0 OR (step = 1 AND c_custkey % 3 <> 1) OR (step = 2 AND c_custkey % 40 = 3)
""")
check("current_state", f"""
SELECT {_ITEM_FIELDS}, CASE WHEN p_partkey % 3 = 1 THEN 'draft' ELSE catalog_status END AS catalog_status
FROM {_FULL_ITEMS} WHERE p_partkey % 50 <> 7
""")
check("current_state_users", f"""
SELECT {_USER_FIELDS}, CASE WHEN c_custkey % 3 = 1 THEN 'draft' ELSE account_status END AS account_status
FROM {_FULL_USERS} WHERE c_custkey % 40 <> 3
""")
check("latest_ratings", "SELECT * FROM ratings")
check("append_mirror", "SELECT * FROM watch_events WHERE watched_seconds > 60")
check("project_items", "SELECT item_id, type, runtime_minutes, catalog_status FROM items")
check("project_users", "SELECT user_id, account_status FROM users")
_REASON = """CASE WHEN i.item_id IS NULL AND u.user_id IS NULL THEN 'unknown item and user'
  WHEN i.item_id IS NULL THEN 'unknown item' ELSE 'unknown user' END AS error_reason"""
check("fk_valid", "SELECT * FROM lw")
for _name, _table in (("fk_dead_letters", "watch_events"), ("fk_dead_letter_ratings", "ratings")):
    check(_name, f"""
SELECT f.*, {_REASON} FROM {_table} f LEFT JOIN items i USING (item_id) LEFT JOIN users u USING (user_id)
WHERE i.item_id IS NULL OR u.user_id IS NULL
""")
check("live_watches", "SELECT * FROM lw")
check("live_ratings", "SELECT * FROM lr")
check("stale_keys", "SELECT item_id, CAST(NULL AS VARCHAR) AS value FROM catalogue WHERE p_partkey % 50 = 7")
check("stale_user_keys", "SELECT user_id, CAST(NULL AS VARCHAR) AS value FROM accounts WHERE c_custkey % 40 = 3")
check("delete_keys", "SELECT item_id, title FROM items WHERE catalog_status <> 'archived'")
check("delete_keys_tombstones", "SELECT item_id, true AS is_delete FROM items WHERE catalog_status = 'archived'")
check("clear_genres", """
SELECT item_id, CASE WHEN genre_primary NOT IN ('Brand#1', 'Brand#3') THEN genre_primary END AS genre_primary,
  CASE WHEN genre_secondary NOT IN ('Brand#1', 'Brand#3') THEN genre_secondary END AS genre_secondary FROM items
""")
check("clear_countries", """
SELECT id, CASE WHEN country NOT IN ('NATION_1', 'NATION_2') THEN country END AS country
FROM (SELECT item_id AS id, country FROM items UNION ALL SELECT user_id, country FROM users)
""")
_GENRES = """(SELECT genre_primary AS name FROM catalogue WHERE genre_primary IS NOT NULL
  UNION SELECT genre_secondary FROM catalogue WHERE genre_secondary IS NOT NULL UNION SELECT 'Unused')"""
check("delete_vocabulary", f"SELECT name FROM {_GENRES} WHERE name NOT IN ('Brand#1', 'Brand#3')")
check("unload_source", "SELECT item_id, seed_source FROM items WHERE seed_source IS DISTINCT FROM 'pack2'")
_LOADS = """(SELECT seed_source || CASE p_partkey % 3 WHEN 0 THEN ':items' WHEN 1 THEN ':users' ELSE '' END AS seed_name,
  p_partkey % 100 AS item_count, p_partkey % 50 AS user_count, CAST(date_added AS TIMESTAMP) AS loaded_at
  FROM catalogue WHERE seed_source IS NOT NULL)"""
check("forget_source", f"SELECT * FROM {_LOADS} WHERE seed_name NOT IN ('pack2', 'pack2:items', 'pack2:users')")
_EARLY = """(SELECT item_id, avg(rating) AS avg_rating, count(*) AS rating_count
  FROM lr WHERE rated_at < TIMESTAMP '2000-01-01' GROUP BY item_id)"""
_SYNC = """
SELECT coalesce(o.item_id, n.item_id) AS item_id,
  CASE WHEN o.item_id IS NULL THEN 'insert' WHEN n.item_id IS NULL THEN 'delete' ELSE 'update' END AS action,
  n.avg_rating, n.rating_count
FROM {old} o FULL JOIN {new} n ON o.item_id = n.item_id
WHERE o.item_id IS NULL OR n.item_id IS NULL OR o.avg_rating IS DISTINCT FROM n.avg_rating
  OR o.rating_count IS DISTINCT FROM n.rating_count
"""
check("full_sync_changes", _SYNC.format(old=_EARLY, new="item_rating_avg"), "item_rating_avg")
check("full_sync_deletes", _SYNC.format(old="item_rating_avg", new=_EARLY), "item_rating_avg")
check("full_sync_applied", "SELECT * FROM item_rating_avg", "item_rating_avg")
check("full_replace", "SELECT * FROM item_view_ranking", "item_view_ranking")
check("retention", """
SELECT * EXCLUDE (seq) FROM heartbeats
WHERE session_ended_at >= (SELECT max(ts) FROM events) - INTERVAL 2 DAY
""")
check("retained_watches", """
SELECT w.* FROM watch_events w, clock WHERE session_ended_at >= now - INTERVAL 30 DAY
""")

# Row rules and pools

check("validate_watches", """
SELECT user_id, item_id, s AS watched_seconds, d AS device_type, session_ended_at,
  CASE WHEN s <= 0 THEN 'watched_seconds must be > 0' WHEN d = '' THEN 'device_type is required'
    WHEN session_ended_at > now - INTERVAL 30 DAY THEN 'session_ended_at is in the future' END AS error
FROM (SELECT *, CASE WHEN watched_seconds % 7 = 0 THEN -watched_seconds ELSE watched_seconds END AS s,
        CASE device_type WHEN 'tablet' THEN '' ELSE device_type END AS d FROM watch_events), clock
""")
check("validate_ratings", """
SELECT user_id, item_id, 2 * rating - 2 AS rating, rated_at,
  CASE WHEN 2 * rating - 2 NOT BETWEEN 1 AND 5 THEN 'rating out of range'
    WHEN rated_at > now - INTERVAL 30 DAY THEN 'rated_at is in the future' END AS error
FROM ratings, clock
""")
check("valid_watches", """
SELECT w.* FROM watch_events w, clock WHERE watched_seconds > 0 AND session_ended_at <= now - INTERVAL 30 DAY
""")
check("validate_items", """
SELECT item_id, concat_ws('; ',
  CASE WHEN p_partkey % 11 = 0 THEN 'type must be movie or series' END,
  CASE WHEN p_partkey % 17 = 0 THEN 'title is required' END,
  CASE WHEN p_partkey % 5 = 0 THEN 'release_year must be a whole number' END,
  CASE WHEN p_partkey % 19 = 0 THEN 'season_count must be a whole number' END,
  CASE WHEN country NOT IN (SELECT country FROM users WHERE country <> 'NATION_5') THEN 'country is not listed' END,
  CASE WHEN original_language NOT IN (SELECT original_language FROM items WHERE original_language <> 'la') THEN 'original_language is not listed' END,
  CASE WHEN p_partkey % 23 = 0 THEN 'imdb_score must be a number' END,
  CASE WHEN genre_primary NOT IN (SELECT genre_primary FROM items WHERE genre_primary IS NOT NULL) THEN 'genre_primary is not listed' END,
  CASE WHEN genre_secondary NOT IN (SELECT genre_primary FROM items WHERE genre_primary IS NOT NULL) THEN 'genre_secondary is not listed' END,
  CASE WHEN p_partkey % 29 = 0 THEN 'catalog_status is invalid' END) AS errors
FROM catalogue
""")
check("validate_users", """
SELECT user_id, concat_ws('; ',
  CASE WHEN c_custkey % 7 = 0 THEN 'age must be a whole number' END,
  CASE WHEN country NOT IN (SELECT country FROM users WHERE country <> 'NATION_5') THEN 'country is not listed' END,
  CASE WHEN preferred_language NOT IN (SELECT preferred_language FROM users WHERE preferred_language <> 'es') THEN 'preferred_language is not listed' END,
  CASE WHEN c_custkey % 13 = 0 THEN 'subscription_plan is invalid' END,
  CASE WHEN c_custkey % 17 = 0 THEN 'monthly_spend_hours must be a number' END,
  CASE WHEN c_custkey % 19 = 0 THEN 'account_status is invalid' END) AS errors
FROM accounts
""")
check("table_constraints", """
SELECT CASE release_year WHEN 1960 THEN upper(item_id) ELSE item_id END AS item_id,
  CASE release_year WHEN 1960 THEN 'item_id is malformed' ELSE 'type is invalid' END AS errors
FROM items WHERE release_year IN (1960, 1961)
""")
check("active_pool", "SELECT item_id, type, runtime_minutes FROM items WHERE catalog_status = 'active'")
check("active_user_pool", "SELECT user_id FROM users WHERE account_status = 'active'")

# Loading

_TITLES = """titles AS (
  SELECT p_partkey AS _order,
    CASE WHEN p_size % 3 = 0 THEN 'series' ELSE 'movie' END AS type,
    upper(p_name) AS title,
    CASE WHEN p_partkey % 9 <> 0 THEN CAST(1950 + p_partkey % 30 AS INTEGER) END AS release_year,
    CAST(NULL AS DATE) AS date_added,
    CASE WHEN p_size % 3 <> 0 AND p_partkey % 8 <> 0 THEN p_size END AS runtime_minutes,
    CASE WHEN p_size % 3 = 0 THEN p_size % 10 END AS season_count,
    CAST(NULL AS INTEGER) AS episode_count,
    CASE WHEN p_partkey % 3 <> 0 THEN 'TV-14' END AS content_rating,
    CASE p_partkey % 6 WHEN 0 THEN 'DE' WHEN 1 THEN 'ZZ' WHEN 2 THEN 'FR' END AS country,
    CASE p_partkey % 6 WHEN 0 THEN 'de' WHEN 2 THEN 'fr' END AS original_language,
    CASE WHEN p_partkey % 7 <> 0 THEN CAST(CAST(p_partkey % 100 AS DECIMAL(6,1)) / 10 AS DECIMAL(3,1)) END AS imdb_score,
    false AS is_netflix_original, false AS content_warning,
    CASE WHEN p_partkey % 5 = 0 THEN p_type WHEN p_partkey % 5 IN (3, 4) THEN p_brand END AS genre_primary,
    CASE WHEN p_partkey % 5 = 0 THEN p_brand WHEN p_partkey % 5 IN (3, 4) THEN p_type END AS genre_secondary,
    'active' AS catalog_status, 'large' AS seed_source
  FROM part WHERE p_partkey % 50 <> 3
)"""
_FRESH = """fresh AS (
  SELECT t.* FROM titles t
  WHERE NOT EXISTS (SELECT 1 FROM items i WHERE i.seed_source = 'pack1' AND lower(i.title) = lower(t.title)
                    AND i.release_year IS NOT DISTINCT FROM t.release_year)
  QUALIFY row_number() OVER (PARTITION BY lower(title), release_year ORDER BY _order) = 1
)"""
check("normalise_titles", f", {_TITLES} SELECT * FROM titles")
_LOOKUP = """lookup AS (
  SELECT lower(p_name) AS t, 1950 + p_partkey % 30 AS y,
    CASE WHEN p_partkey % 4 <> 0 THEN CAST(DATE '2021-01-01' + CAST(p_partkey % 365 AS INTEGER) AS DATE) END AS d,
    CASE WHEN p_partkey % 3 <> 0 THEN 'PG' END AS r
  FROM part WHERE p_partkey % 2 = 0
  QUALIFY row_number() OVER (PARTITION BY lower(p_name), 1950 + p_partkey % 30 ORDER BY p_partkey DESC) = 1
)"""
check("enrich_titles", f""", {_TITLES}, {_FRESH}, {_LOOKUP}
SELECT _order, title, release_year, d AS date_added, coalesce(r, content_rating) AS content_rating
FROM fresh LEFT JOIN lookup ON t = lower(title) AND y = release_year
""")
check("normalise_movies", """
SELECT p_partkey AS _order, CASE WHEN s THEN 'series' ELSE 'movie' END AS type, p_name AS title,
  CAST(1950 + p_partkey % 75 AS INTEGER) AS release_year,
  CASE WHEN p_partkey % 6 <> 0 THEN DATE '2023-08-07' END AS date_added,
  CASE WHEN NOT s THEN p_size END AS runtime_minutes,
  CASE WHEN p_partkey % 3 = 0 THEN p_size END AS season_count,
  CASE WHEN p_partkey % 4 = 0 THEN p_size END AS episode_count,
  CASE WHEN p_partkey % 2 = 0 THEN 'PG' END AS content_rating,
  CASE p_partkey % 3 WHEN 0 THEN 'US' WHEN 1 THEN 'KR' END AS country,
  CASE p_partkey % 3 WHEN 0 THEN 'en' WHEN 1 THEN 'ko' END AS original_language,
  CASE WHEN p_partkey % 5 <> 0 THEN CAST(CAST(p_partkey % 100 AS DECIMAL(6,1)) / 10 AS DECIMAL(3,1)) END AS imdb_score,
  p_partkey % 2 = 0 AS is_netflix_original, p_partkey % 7 = 0 AS content_warning,
  p_brand AS genre_primary, CAST(NULL AS VARCHAR) AS genre_secondary,
  'active' AS catalog_status, 'native' AS seed_source
FROM (SELECT *, p_partkey % 3 = 0 OR p_partkey % 4 = 0 AS s FROM part) WHERE p_partkey % 40 <> 5
""")
_DAT = "FROM customer WHERE c_custkey % 20 <> 0 AND c_custkey % 30 <> 7"
check("users_dat", f"""
SELECT c_custkey AS _order, CAST(c_custkey AS VARCHAR) AS user_ref,
  CASE c_custkey % 3 WHEN 0 THEN 'M' WHEN 1 THEN 'F' ELSE 'x' END AS gender,
  CAST(18 + c_custkey % 40 AS VARCHAR) AS age, CAST(c_custkey % 25 AS VARCHAR) AS occupation, '12345' AS zip {_DAT}
""")
check("normalise_ml_users", f"""
SELECT c_custkey AS _order, CAST(18 + c_custkey % 40 AS INTEGER) AS age,
  CASE c_custkey % 3 WHEN 0 THEN 'male' WHEN 1 THEN 'female' ELSE 'unknown' END AS gender,
  coalesce(['other', 'academic/educator', 'artist', 'clerical/admin', 'college/grad student', 'customer service',
    'doctor/health care', 'executive/managerial', 'farmer', 'homemaker', 'K-12 student', 'lawyer', 'programmer',
    'retired', 'sales/marketing', 'scientist', 'self-employed', 'technician/engineer', 'tradesman/craftsman',
    'unemployed', 'writer'][c_custkey % 25 + 1], 'other') AS occupation,
  'US' AS country, 'en' AS preferred_language,
  CAST(DATE '2023-01-01' + CAST(c_custkey % 700 AS INTEGER) AS DATE) AS signup_date,
  CASE c_custkey % 3 WHEN 0 THEN 'basic' WHEN 1 THEN 'standard' ELSE 'premium' END AS subscription_plan,
  'active' AS account_status, 'large' AS seed_source {_DAT}
""")
check("normalise_users", """
SELECT c_custkey AS _order,
  CASE WHEN c_custkey % 130 - 10 BETWEEN 0 AND 100 THEN CAST(c_custkey % 130 - 10 AS INTEGER) END AS age,
  CASE c_custkey % 5 WHEN 0 THEN 'male' WHEN 1 THEN 'female' WHEN 2 THEN 'unknown' END AS gender,
  CASE c_custkey % 4 WHEN 0 THEN 'US' WHEN 1 THEN 'GB' WHEN 2 THEN 'JP' END AS country,
  CASE c_custkey % 4 WHEN 0 THEN 'en' WHEN 1 THEN 'en' WHEN 2 THEN 'ja' END AS preferred_language,
  CASE c_custkey % 3 WHEN 0 THEN DATE '2022-10-07' END AS signup_date,
  CASE c_custkey % 5 WHEN 1 THEN 'premium_plus' WHEN 2 THEN 'standard' WHEN 4 THEN 'premium' ELSE 'basic' END AS subscription_plan,
  CASE c_custkey % 3 WHEN 0 THEN 'active' ELSE 'cancelled' END AS account_status,
  'c' || c_custkey || '@example.com' AS email, c_name AS first_name, CAST(NULL AS VARCHAR) AS last_name,
  CAST(NULL AS VARCHAR) AS state_province, c_mktsegment AS city,
  CAST(abs(c_acctbal) AS DECIMAL(6,2)) AS monthly_spend_hours,
  CASE c_custkey % 2 WHEN 0 THEN 'Desktop' END AS primary_device, 'native' AS seed_source
FROM customer
""")
check("new_items_dedup", f", {_TITLES}, {_FRESH} SELECT _order, title, release_year FROM fresh")
check("load_counts", f""", {_TITLES}, {_FRESH}
SELECT (SELECT count(*) FROM fresh) AS inserted, (SELECT count(*) FROM titles) - (SELECT count(*) FROM fresh) AS skipped
""")
check("assign_ids", f""", {_TITLES}, {_FRESH}
SELECT 'i' || ((SELECT max(CAST(substr(item_id, 2) AS BIGINT)) FROM items) + row_number() OVER (ORDER BY _order)) AS item_id,
  title, release_year FROM fresh
""")
check("load_pack", f""", {_TITLES}, {_FRESH.replace("i.seed_source = 'pack1' AND ", "")}, {_LOOKUP}
SELECT item_id, title, release_year, seed_source, content_rating FROM items
UNION ALL
SELECT 'i' || ((SELECT max(CAST(substr(item_id, 2) AS BIGINT)) FROM items) + row_number() OVER (ORDER BY _order)),
  title, release_year, seed_source, coalesce(r, content_rating)
FROM fresh LEFT JOIN lookup ON t = lower(title) AND y = release_year
""")
_LOADED = f""", {_TITLES}, {_FRESH.replace("i.seed_source = 'pack1' AND ", "")}, {_LOOKUP}"""
check("load_stored_pack", f"""{_LOADED}
SELECT item_id, title, release_year, seed_source, content_rating FROM items
UNION ALL
SELECT 'i' || ((SELECT max(CAST(substr(item_id, 2) AS BIGINT)) FROM items) + row_number() OVER (ORDER BY _order)),
  title, release_year, seed_source, coalesce(r, content_rating)
FROM fresh LEFT JOIN lookup ON t = lower(title) AND y = release_year
""")
check("load_stored_tables", f"""{_LOADED}, whole AS (
  SELECT genre_primary, genre_secondary, country, original_language FROM items
  UNION ALL SELECT genre_primary, genre_secondary, country, original_language FROM fresh
)
SELECT 'counter' AS kind, 'i' AS name,
  CAST((SELECT max(CAST(substr(item_id, 2) AS BIGINT)) FROM items) + (SELECT count(*) FROM fresh) AS BIGINT) AS n
UNION ALL SELECT 'log', 'large', (SELECT count(*) FROM fresh)
UNION ALL SELECT 'genres', g, 1 FROM (SELECT genre_primary AS g FROM whole UNION SELECT genre_secondary FROM whole) WHERE g IS NOT NULL
UNION ALL SELECT 'countries', c, 1 FROM (SELECT country AS c FROM whole UNION SELECT country FROM users) WHERE c IS NOT NULL
UNION ALL SELECT 'languages', l, 1 FROM (SELECT original_language AS l FROM whole UNION SELECT preferred_language FROM users) WHERE l IS NOT NULL
""")
check("load_guard", f"""
SELECT seed_name, mode, seed_name || CASE mode WHEN 'full' THEN '' ELSE ':' || mode END IN (SELECT seed_name FROM {_LOADS}) AS refused
FROM (SELECT DISTINCT coalesce(seed_source, 'none') AS seed_name FROM catalogue), (VALUES ('full'), ('items'), ('users')) m(mode)
""")
check("mirror_log", """
SELECT item_id AS id, CASE WHEN p_partkey % 3 = 1 THEN 'draft' ELSE catalog_status END AS status
FROM catalogue WHERE p_partkey % 50 <> 7
UNION ALL SELECT user_id, CASE WHEN c_custkey % 3 = 1 THEN 'draft' ELSE account_status END
FROM accounts WHERE c_custkey % 40 <> 3
""")
check("assign_user_ids", """
SELECT 'u' || row_number() OVER (ORDER BY c_custkey) AS user_id, 'c' || c_custkey || '@example.com' AS email FROM customer
""")
check("vocab_sync", """
SELECT name FROM (SELECT genre_primary AS name FROM items UNION SELECT genre_secondary FROM items)
WHERE name IS NOT NULL AND name NOT IN (SELECT genre_primary FROM catalogue WHERE seed_source = 'pack1' AND genre_primary IS NOT NULL)
""")
check("vocab_sync_countries", """
SELECT code FROM (SELECT country AS code FROM items UNION SELECT country FROM users)
WHERE code IS NOT NULL AND code <> 'NATION_1'
""")
check("vocab_sync_languages", """
SELECT code FROM (SELECT original_language AS code FROM items UNION SELECT preferred_language FROM users)
WHERE code IS NOT NULL AND code <> 'en'
""")
check("load_history", f"SELECT seed_name, count(*) AS count, max(loaded_at) AS last_loaded_at FROM {_LOADS} GROUP BY ALL")
check("title_pack_counts", f"""
SELECT (SELECT count(*) FROM part WHERE p_partkey % 50 <> 3) AS item_count,
  (SELECT count(DISTINCT lower(g)) FROM (SELECT p_type AS g FROM part WHERE p_partkey % 5 IN (0, 3, 4)
     UNION ALL SELECT p_brand FROM part WHERE p_partkey % 5 IN (0, 3, 4))) AS genre_count,
  (SELECT count(*) {_DAT}) AS user_count
""")
check("movie_pack_counts", """
SELECT (SELECT count(*) FROM items) AS item_count,
  (SELECT count(DISTINCT lower(g)) FROM (SELECT genre_primary AS g FROM items UNION ALL SELECT genre_secondary FROM items)) AS genre_count,
  (SELECT count(*) FROM customer) AS user_count
""")
_CELL = """p_name || ', the "' || p_brand || '"' || chr(10) || ' film'"""
check("strict_csv_rows", f"""
SELECT CAST(p_partkey AS VARCHAR) AS id, {_CELL} AS title, 'MOVIE' AS type, CAST(p_size AS VARCHAR) AS runtime
FROM part WHERE p_partkey % 25 <> 0 AND p_partkey % 40 <> 1
""")
check("strict_csv_rejects", "SELECT CAST(p_partkey AS VARCHAR) AS id FROM part WHERE p_partkey % 25 = 0 OR p_partkey % 40 = 1")
check("lenient_csv_rows", f"""
SELECT CAST(p_partkey AS VARCHAR) AS id, {_CELL} AS title,
  CASE WHEN p_partkey % 25 <> 0 THEN 'MOVIE' ELSE CAST(p_size AS VARCHAR) END AS type FROM part
""")

# Sessions

_SESSIONS = """sessions AS (
  SELECT *, sum(fresh) OVER (PARTITION BY user_id, item_id ORDER BY session_ended_at, seq) AS session
  FROM (SELECT *, CASE WHEN session_ended_at - lag(session_ended_at) OVER (PARTITION BY user_id, item_id ORDER BY session_ended_at, seq)
                         <= INTERVAL 12 HOUR THEN 0 ELSE 1 END AS fresh FROM heartbeats)
), settled AS (
  SELECT user_id, item_id, watched_seconds, device_type, session_ended_at FROM sessions
  QUALIFY row_number() OVER (PARTITION BY user_id, item_id, session ORDER BY session_ended_at DESC, seq DESC) = 1
), open_now AS (
  SELECT user_id, session_ended_at, item_id, watched_seconds, device_type FROM heartbeats
  WHERE session_ended_at > (SELECT max(ts) FROM events) - INTERVAL 12 HOUR
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY session_ended_at DESC, seq DESC) = 1
)"""
_CLOSED = "WHERE session_ended_at + INTERVAL 12 HOUR <= (SELECT max(ts) FROM events)"
check("settle_sessions", f", {_SESSIONS} SELECT * FROM settled")
check("settle_sessions_closed", f", {_SESSIONS} SELECT * FROM settled {_CLOSED}")
# The watermark is the newest event time, cut to milliseconds.
_LATE = "(SELECT user_id, seq, CAST(epoch(date_trunc('second', session_ended_at)) AS BIGINT) % 8 AS t FROM heartbeats)"
check("settle_stream_late", f"""
, newest AS (SELECT max(t) + 15 AS closed FROM {_LATE})
SELECT user_id, kind || ':' || seq AS item_id, CAST(step AS INTEGER) AS watched_seconds, t + step AS ended
FROM {_LATE}, newest, (VALUES ('a', 0), ('b', 15), ('d', 0), ('d', 15)) k(kind, step)
-- the third record of key d bridges its sessions unless it is late itself
WHERE kind <> 'd' OR step = 15 OR t + 18 <= closed
""")
check("settle_stream", f", {_SESSIONS} SELECT * FROM settled {_CLOSED}")
check("open_sessions", f", {_SESSIONS} SELECT * FROM open_now")
check("free_users", f""", {_SESSIONS}
SELECT user_id FROM users WHERE account_status = 'active' AND user_id NOT IN (SELECT user_id FROM open_now)
""")
check("target_seconds", """
SELECT item_id, CASE WHEN type = 'movie' AND coalesce(runtime_minutes, 0) <> 0 THEN 60 * runtime_minutes ELSE 2400 END AS target_seconds
FROM items
""")

# Streaming state

check("incremental_user_rating_avg", """
SELECT user_id, avg(rating) AS avg_rating, count(*) AS rating_count FROM ratings GROUP BY user_id
""")


def _content(name: str, key: str, texts: str, numbers: str) -> str:
    """The rows of a report under the common columns."""
    texts, numbers = texts.split(), numbers.split()
    columns = [f"{texts[k]} AS text{k + 1}" if k < len(texts) else f"CAST(NULL AS VARCHAR) AS text{k + 1}" for k in range(2)]
    columns += [f"CAST({numbers[k] if k < len(numbers) else 'NULL'} AS DOUBLE) AS n{k + 1}" for k in range(6)]
    return f"SELECT '{name}' AS report, {key} AS key, {', '.join(columns)} FROM {name}"


_CONTENT = " UNION ALL ".join([
    _content("user_rating_avg", "user_id", "", "avg_rating rating_count"),
    _content("item_rating_avg", "item_id", "", "avg_rating rating_count"),
    _content("user_mood", "user_id", "mood", "avg_recent_rating ratings_used"),
    _content("item_view_ranking", "type || ':' || rank", "item_id", "view_count"),
    _content("item_rating_ranking", "type || ':' || rank", "item_id", "avg_rating rating_count"),
    _content("item_completion_rate", "item_id", "type", "completion_rate watch_count"),
    _content("item_viewer_demographics", "item_id", "", "average_age pct_male pct_female pct_other pct_unknown viewer_count"),
    _content("user_series_movie_ratio", "user_id", "", "movie_watch_count series_watch_count movie_percentage series_percentage"),
    _content("user_top_genre", "user_id", "top_genre", "genre_watch_count watches_used"),
    _content("user_top_device_language", "user_id", "top_device top_language", "device_watch_count language_watch_count"),
    _content("user_watch_count", "user_id", "", "distinct_items_watched total_watches"),
])
check("approximate_watch_counts", """
SELECT type, count(DISTINCT user_id) AS viewers, true AS within_error FROM lw JOIN items USING (item_id) GROUP BY type
""")
check("incremental_reports", _CONTENT, *REPORTS)
check("refresh_tick", _CONTENT, *REPORTS)
# A tick uses the default window of ten minutes for the two rankings.
STATEMENTS["refresh_tick"] = STATEMENTS["refresh_tick"].replace("INTERVAL 90 DAY", "INTERVAL 10 MINUTE")

# Dashboard panels

_MEAN = "CAST(round(CAST(avg({}) AS DECIMAL(30,15)), {}) AS DECIMAL(18,{}))"
_MEAN2 = _MEAN.format("avg_rating", 2, 2)
check("total_items", "SELECT count(*) AS total_items FROM items")
check("total_users", "SELECT count(*) AS total_users FROM users")
check("overall_avg_rating", f"SELECT {_MEAN2} AS overall_avg_rating FROM user_rating_avg", "user_rating_avg")
check("users_with_rating", "SELECT count(*) AS users_with_rating FROM user_rating_avg", "user_rating_avg")
check("items_by_type", "SELECT type, count(*) AS item_count FROM items GROUP BY type")
check("users_by_plan", "SELECT subscription_plan, count(*) AS user_count FROM users GROUP BY ALL")
check("item_count_movie", "SELECT count(*) AS item_count FROM items WHERE type = 'movie'")
_ITEM_DETAIL = """
SELECT item_id, type, title, release_year, genre_primary, genre_secondary, content_rating, imdb_score, is_netflix_original,
  catalog_status, avg_rating, rating_count, completion_rate, watch_count, average_age, pct_male, pct_female, pct_other,
  pct_unknown, viewer_count
FROM items LEFT JOIN item_rating_avg USING (item_id)
  LEFT JOIN (SELECT item_id, completion_rate, watch_count FROM item_completion_rate) USING (item_id)
  LEFT JOIN item_viewer_demographics USING (item_id)
{} ORDER BY CAST(substr(item_id, 2) AS BIGINT) LIMIT 200
"""
_ITEM_REPORTS = ("item_rating_avg", "item_completion_rate", "item_viewer_demographics")
check("item_detail", _ITEM_DETAIL.format(""), *_ITEM_REPORTS)
check("item_detail_series", _ITEM_DETAIL.format("WHERE type = 'series'"), *_ITEM_REPORTS)
_PCT = _MEAN.format("completion_rate * 100", 1, 1)
check("avg_completion_pct", f"SELECT {_PCT} AS avg_completion_pct FROM item_completion_rate", "item_completion_rate")
check("avg_completion_pct_movie",
      f"SELECT {_PCT} AS avg_completion_pct FROM item_completion_rate WHERE type = 'movie'", "item_completion_rate")
check("avg_item_rating_series",
      f"SELECT {_MEAN2} AS avg_rating FROM item_rating_avg JOIN items USING (item_id) WHERE type = 'series'", "item_rating_avg")
check("user_count_premium", "SELECT count(*) AS user_count FROM users WHERE subscription_plan = 'premium'")
check("avg_user_rating_basic",
      f"SELECT {_MEAN2} AS avg_rating FROM user_rating_avg JOIN users USING (user_id) WHERE subscription_plan = 'basic'",
      "user_rating_avg")
check("users_by_country_top10",
      "SELECT country, count(*) AS user_count FROM users GROUP BY country ORDER BY user_count DESC, country LIMIT 10")
check("users_by_country_top10_basic", """
SELECT country, count(*) AS user_count FROM users WHERE subscription_plan = 'basic'
GROUP BY country ORDER BY user_count DESC, country LIMIT 10
""")
check("rating_per_user", """
SELECT user_id, avg_rating, rating_count FROM user_rating_avg
ORDER BY avg_rating DESC, CAST(substr(user_id, 2) AS BIGINT) LIMIT 200
""", "user_rating_avg")
_USER_DETAIL = """
SELECT user_id, age, gender, country, subscription_plan, account_status, signup_date, primary_device, avg_rating, rating_count,
  mood, avg_recent_rating, movie_watch_count, series_watch_count, movie_percentage, series_percentage, top_genre,
  genre_watch_count, watches_used, top_device, device_watch_count, top_language, language_watch_count
FROM users LEFT JOIN user_rating_avg USING (user_id) LEFT JOIN user_mood USING (user_id)
  LEFT JOIN user_series_movie_ratio USING (user_id) LEFT JOIN user_top_genre USING (user_id)
  LEFT JOIN user_top_device_language USING (user_id)
{} ORDER BY CAST(substr(user_id, 2) AS BIGINT) LIMIT 200
"""
_USER_REPORTS = ("user_rating_avg", "user_mood", "user_series_movie_ratio", "user_top_genre", "user_top_device_language")
check("user_detail", _USER_DETAIL.format(""), *_USER_REPORTS)
check("user_detail_one", _USER_DETAIL.format("WHERE user_id = 'u20'"), *_USER_REPORTS)
check("users_by_mood", "SELECT mood, count(*) AS user_count FROM user_mood GROUP BY mood", "user_mood")
check("users_by_top_genre", """
SELECT top_genre, count(*) AS user_count FROM user_top_genre GROUP BY top_genre ORDER BY user_count DESC, top_genre LIMIT 10
""", "user_top_genre")
for _kind, _type in (("series", "series"), ("movie", "movie")):
    check(f"trending_{_kind}_views", f"""
SELECT rank, item_id, title, view_count FROM item_view_ranking r JOIN items USING (item_id) WHERE r.type = '{_type}'
""", "item_view_ranking")
    check(f"trending_{_kind}_ratings", f"""
SELECT rank, item_id, title, avg_rating, rating_count FROM item_rating_ranking r JOIN items USING (item_id) WHERE r.type = '{_type}'
""", "item_rating_ranking")
for _name, _column, _table in (
    ("item_id_options", "item_id", "items"), ("item_type_options", "type", "items"),
    ("user_id_options", "user_id", "users"), ("user_plan_options", "subscription_plan", "users"),
):
    check(_name, f"SELECT 'All' AS text, '' AS value UNION ALL SELECT DISTINCT {_column}, {_column} FROM {_table}")

# Catalogue and activity

check("catalog_summary", """
SELECT 'items' AS section, CAST(NULL AS VARCHAR) AS label, count(*) AS n FROM items
UNION ALL SELECT 'active items', NULL, count(*) FROM items WHERE catalog_status = 'active'
UNION ALL SELECT 'items by type', type, count(*) FROM items GROUP BY type
UNION ALL SELECT 'users', NULL, count(*) FROM users
UNION ALL SELECT 'active users', NULL, count(*) FROM users WHERE account_status = 'active'
UNION ALL SELECT 'users by gender', coalesce(gender, 'unspecified'), count(*) FROM users GROUP BY gender
""")
check("item_search", """
SELECT item_id, title, genre_primary, genre_secondary FROM items
WHERE item_id ILIKE '%i1%' AND type = 'movie' AND catalog_status = 'active' AND 'Brand#7' IN (genre_primary, genre_secondary)
""")
check("user_search", """
SELECT user_id, age, country FROM users
WHERE user_id ILIKE '%u1%' AND gender = 'female' AND subscription_plan = 'basic' AND account_status = 'active'
""")
check("items_per_genre", """
SELECT genre, count(DISTINCT item_id) AS n
FROM (SELECT item_id, genre_primary AS genre FROM items UNION ALL SELECT item_id, genre_secondary FROM items)
WHERE genre IS NOT NULL GROUP BY genre
""")
check("option_counts", """
SELECT 'type' AS section, type AS label, count(*) AS n FROM items GROUP BY ALL
UNION ALL SELECT 'catalog_status', catalog_status, count(*) FROM items GROUP BY ALL
UNION ALL SELECT 'gender', gender, count(*) FROM users GROUP BY ALL
UNION ALL SELECT 'subscription_plan', subscription_plan, count(*) FROM users GROUP BY ALL
UNION ALL SELECT 'account_status', account_status, count(*) FROM users GROUP BY ALL
""")
check("genre_usage", f"""
SELECT name, count(DISTINCT item_id) AS item_count
FROM {_GENRES} LEFT JOIN items ON genre_primary = name OR genre_secondary = name GROUP BY name
""")
check("country_usage", """
SELECT n_name AS code, (SELECT count(*) FROM items WHERE country = n_name) + (SELECT count(*) FROM users WHERE country = n_name) AS usage_count
FROM nation
""")
check("language_usage", """
SELECT code, (SELECT count(*) FROM items WHERE original_language = code) + (SELECT count(*) FROM users WHERE preferred_language = code) AS usage_count
FROM (SELECT DISTINCT original_language AS code FROM items WHERE original_language IS NOT NULL)
""")
check("items_per_source", "SELECT seed_source, count(*) AS n FROM items WHERE seed_source IS NOT NULL GROUP BY ALL")
check("users_per_source", "SELECT seed_source, count(*) AS n FROM users WHERE seed_source IS NOT NULL GROUP BY ALL")
check("device_breakdown", "SELECT device_type, count(*) AS count FROM watch_events GROUP BY ALL")
check("recent_watches", """
SELECT * FROM watch_events ORDER BY session_ended_at DESC, user_id, item_id, watched_seconds, device_type LIMIT 50
""")
check("activity_counts", f""", {_SESSIONS}
SELECT (SELECT count(*) FROM open_now) AS active_sessions, (SELECT count(*) FROM watch_events) AS finished_items
""")
