"""Common table expressions of the comparison SQL, mirroring ``inputs``."""

BRONZE = r"""
shifted AS (
    SELECT *, date_trunc('month', o_orderdate) + INTERVAL 240 MONTH AS m
    FROM lineitem
    JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey
    JOIN part ON l_partkey = p_partkey
    JOIN supplier ON l_suppkey = s_suppkey
),
bronze AS (
    SELECT
        CASE WHEN l_partkey % 97 <> 0 THEN 'v' || l_partkey END AS video_id,
        CASE WHEN l_partkey % 50 = 7 THEN 'garbage'
             WHEN l_linenumber = 1 THEN strftime(m, '%Y-%m-%d')
             ELSE strftime(m, '%y.%d.%m') END AS trending_date,
        p_name AS title,
        s_name AS channel_title,
        CAST(CASE WHEN l_partkey % 11 = 5 THEN s_nationkey + 100 ELSE s_nationkey END AS BIGINT) AS category_id,
        strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || '.000Z' AS publish_time,
        CAST(floor(l_extendedprice) AS BIGINT) AS views,
        CASE WHEN l_linenumber <> 7 THEN CAST(floor(l_extendedprice * l_discount) AS BIGINT) END AS likes,
        CAST(l_quantity AS BIGINT) AS comment_count,
        ' ' || r_name || ' ' AS region
    FROM shifted
)"""

_STANDARD = r"""
standard{suffix} AS (
    SELECT
        video_id, trending_date, title, channel_title, category_id, publish_time,
        coalesce(views, 0) AS views, coalesce(likes, 0) AS likes,
        coalesce(comment_count, 0) AS comment_count,
        lower(trim(region)) AS region,
        CASE WHEN regexp_full_match(trending_date, '\d{{2}}\.\d{{2}}\.\d{{2}}')
             THEN CAST(try_strptime(trending_date, '%y.%d.%m') AS DATE)
             ELSE try_cast(trending_date AS DATE) END AS trending_date_parsed{extra}
    FROM {source}
    WHERE video_id IS NOT NULL
)"""

_SILVER = r"""
silver{suffix} AS (
    SELECT
        video_id, trending_date, title, channel_title, category_id, publish_time,
        views, likes, comment_count, region, trending_date_parsed,
        CASE WHEN views > 0 THEN round(likes / views * 100, 4) ELSE 0e0 END AS like_ratio,
        CASE WHEN views > 0 THEN round((likes + comment_count) / views * 100, 4) ELSE 0e0 END
            AS engagement_rate
    FROM (
        SELECT *, row_number() OVER (
            PARTITION BY video_id, region, trending_date_parsed
            ORDER BY {latest}views DESC, likes DESC, comment_count DESC,
                     title, channel_title, category_id, publish_time, trending_date
        ) AS place
        FROM standard{suffix}
    )
    WHERE place = 1
)"""


def standard(source: str = "bronze", suffix: str = "", landed: bool = False) -> str:
    return _STANDARD.format(source=source, suffix=suffix, extra=", landed_at" if landed else "")


def silver(suffix: str = "", landed: bool = False) -> str:
    latest = "landed_at DESC NULLS LAST, " if landed else ""
    return _SILVER.format(suffix=suffix, latest=latest)


STANDARD = f"{BRONZE},{standard()}"
SILVER = f"{STANDARD},{silver()}"

# A CSV file's text counts: a fraction is cut off, other text becomes null, then 0.
BRONZE_TEXT = r"""
bronze_text AS (
    SELECT video_id, trending_date, title, channel_title, category_id, publish_time, views,
           CASE WHEN views % 10 = 4 THEN NULL ELSE likes END AS likes,
           CASE WHEN views % 10 = 5 THEN NULL ELSE comment_count END AS comment_count,
           region
    FROM bronze
)"""

SILVER_OF_TEXT = f"{BRONZE},{BRONZE_TEXT},{standard('bronze_text')},{silver()}"

REFERENCE = r"""
reference AS (
    SELECT CAST(n_nationkey AS VARCHAR) AS id,
           n_name || ' ' || c_mktsegment AS snippet_title,
           lower(c_mktsegment) AS region,
           c_custkey AS position
    FROM customer JOIN nation ON c_nationkey = n_nationkey
)"""

LOOKUP = r"""
lookup AS (
    SELECT CAST(id AS BIGINT) AS category_id, arg_max(snippet_title, position) AS category_name
    FROM reference GROUP BY id
)"""

ENRICHED = f"""{SILVER},{REFERENCE},{LOOKUP},
enriched AS (
    SELECT silver.*, coalesce(category_name, 'Unknown') AS category_name
    FROM silver LEFT JOIN lookup ON silver.category_id = lookup.category_id
)"""

TRENDING = r"""
SELECT region, trending_date_parsed,
       count(video_id) AS total_videos,
       CAST(sum(views) AS BIGINT) AS total_views,
       CAST(sum(likes) AS BIGINT) AS total_likes,
       CAST(sum(comment_count) AS BIGINT) AS total_comments,
       CAST(sum(views) AS DOUBLE) / count(views) AS avg_views_per_video,
       CAST(sum(CAST(like_ratio AS DECIMAL(18, 4))) AS DOUBLE) / count(like_ratio) AS avg_like_ratio,
       CAST(sum(CAST(engagement_rate AS DECIMAL(18, 4))) AS DOUBLE) / count(engagement_rate)
           AS avg_engagement_rate,
       max(views) AS max_views,
       count(DISTINCT channel_title) AS unique_channels,
       count(DISTINCT category_id) AS unique_categories
FROM {source} GROUP BY region, trending_date_parsed"""

CHANNEL = r"""
SELECT *, CAST(row_number() OVER (
           PARTITION BY region ORDER BY total_views DESC, channel_title) AS INTEGER) AS rank_in_region
FROM (
    SELECT channel_title, region,
           count(DISTINCT video_id) AS total_videos,
           CAST(sum(views) AS BIGINT) AS total_views,
           CAST(sum(likes) AS BIGINT) AS total_likes,
           CAST(sum(comment_count) AS BIGINT) AS total_comments,
           CAST(sum(views) AS DOUBLE) / count(views) AS avg_views_per_video,
           CAST(sum(CAST(engagement_rate AS DECIMAL(18, 4))) AS DOUBLE) / count(engagement_rate)
               AS avg_engagement_rate,
           max(views) AS peak_views,
           count(trending_date_parsed) AS times_trending,
           min(trending_date_parsed) AS first_trending,
           max(trending_date_parsed) AS last_trending,
           array_to_string(list_sort(list_distinct(list(category_name))), ',') AS categories
    FROM {source} GROUP BY channel_title, region
)"""

CATEGORY = r"""
SELECT *, round(total_views / nullif(sum(total_views) OVER (
           PARTITION BY region, trending_date_parsed), 0) * 100, 2) AS view_share_pct
FROM (
    SELECT category_name, category_id, region, trending_date_parsed,
           count(video_id) AS video_count,
           CAST(sum(views) AS BIGINT) AS total_views,
           CAST(sum(likes) AS BIGINT) AS total_likes,
           CAST(sum(comment_count) AS BIGINT) AS total_comments,
           CAST(sum(CAST(engagement_rate AS DECIMAL(18, 4))) AS DOUBLE) / count(engagement_rate)
               AS avg_engagement_rate,
           count(DISTINCT channel_title) AS unique_channels
    FROM {source} GROUP BY category_name, category_id, region, trending_date_parsed
)"""

API = r"""
numbered AS (
    SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events
),
paged AS (
    SELECT *, max(ts) OVER (PARTITION BY event_type, CAST(ts AS DATE), event_id // 50) AS landed_at
    FROM numbered
),
api AS (
    SELECT 'v' || user_id AS video_id,
           strftime(landed_at, '%y.%d.%m') AS trending_date,
           event_type AS title,
           'u' || (user_id % 10) AS channel_title,
           CAST(user_id % 44 AS BIGINT) AS category_id,
           strftime(ts, '%Y-%m-%dT%H:%M:%S') || 'Z' AS publish_time,
           k * 1000 AS views,
           k * 7 AS likes,
           CASE WHEN k % 10 <> 0 THEN k END AS comment_count,
           event_type AS region,
           landed_at
    FROM paged
)"""


def with_(ctes: str, body: str) -> str:
    return f"WITH {ctes.strip()}\n{body.strip()}"
