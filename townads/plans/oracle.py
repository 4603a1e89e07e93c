"""What each registered query must return, as independent SQL over the same tables."""

from __future__ import annotations

_ADS = """
ads AS (
    SELECT CASE WHEN event_id % 43 = 0 THEN NULL ELSE CAST(event_id AS VARCHAR) END AS ad_id,
           CASE WHEN event_id % 17 = 0 THEN NULL
                WHEN event_id % 13 = 0 THEN ''
                WHEN event_id % 11 = 0 THEN 'null'
                ELSE event_type END AS city,
           CASE WHEN event_id % 19 = 0 THEN NULL
                ELSE strftime(CAST(ts AS DATE) - CAST(user_id * 100 AS INTEGER), '%Y-%m-%d')
                END AS posted_date,
           strftime(ts, '%Y-%m-%d %H:%M:%S') AS scraped_time,
           'synthetic' AS spider
    FROM events
),
timed AS (
    SELECT *, CAST(scraped_time AS TIMESTAMP) AS ts, substr(posted_date, 1, 4) AS posted_year,
           epoch_us(CAST(scraped_time AS TIMESTAMP)) // 1000000 AS s
    FROM ads
)"""

_MESSAGES = _ADS + """,
numbered AS (SELECT *, coalesce(CAST(ad_id AS BIGINT), 0) AS serial FROM ads),
kinds AS (
    SELECT *, CASE WHEN serial % 29 = 1 THEN 'oops' WHEN serial % 31 = 1 THEN 'extra'
                   WHEN serial % 37 = 1 THEN 'no city' WHEN serial % 41 = 1 THEN 'number'
                   WHEN serial % 47 = 1 THEN 'bad time' ELSE 'plain' END AS kind
    FROM numbered
)"""

_TUMBLING = """
tumbling AS (
    SELECT city, count(ad_id) AS num_ads, posted_year,
           make_timestamp(s // 300 * 300 * 1000000) AS w_start,
           make_timestamp((s // 300 * 300 + 300) * 1000000) AS w_end
    FROM timed
    WHERE city <> '' AND posted_year IS NOT NULL
    GROUP BY city, posted_year, s // 300
)"""


def _sliding(size: int, slide: int, name: str = "sliding") -> str:
    return f"""
{name} AS (
    SELECT city, count(ad_id) AS num_ads, make_timestamp(st * 1000000) AS w_start,
           make_timestamp((st + {size}) * 1000000) AS w_end
    FROM (
        SELECT *, unnest(generate_series(s // {slide} * {slide}, s - {size} + 1, -{slide})) AS st
        FROM timed WHERE city <> 'null'
    )
    GROUP BY city, st
)"""


def _hourly(name: str = "hourly") -> str:
    return f"""
{name} AS (
    SELECT city, count(ad_id) AS num_ads, make_timestamp(s // 3600 * 3600000000) AS w_start,
           make_timestamp((s // 3600 + 1) * 3600000000) AS w_end
    FROM timed WHERE city <> 'null' GROUP BY city, s // 3600
)"""


_SESSIONS = """
flagged AS (
    SELECT *, CASE WHEN s - lag(s) OVER (PARTITION BY city ORDER BY s) <= 1800 THEN 0 ELSE 1 END AS f
    FROM timed WHERE city <> 'null'
),
bursts AS (
    SELECT *, sum(f) OVER (PARTITION BY city ORDER BY s ROWS UNBOUNDED PRECEDING) AS id FROM flagged
)"""
_SESSION_ROWS = """
SELECT city, count(ad_id) AS num_ads, min(ts) AS w_start, max(ts) + INTERVAL 30 MINUTE AS w_end
FROM bursts GROUP BY city, id"""

_TUMBLING_JSON = """to_json({'city': city, 'num_ads': num_ads, 'posted_year': posted_year,
    'w_start': strftime(w_start, '%Y-%m-%d %H:%M:%S'), 'w_end': strftime(w_end, '%Y-%m-%d %H:%M:%S')})"""
_SLIDING_JSON = """to_json({'city': city, 'num_ads': num_ads,
    'window_start': strftime(w_start, '%Y-%m-%d %H:%M:%SZ'),
    'window_end': strftime(w_end, '%Y-%m-%d %H:%M:%SZ')})"""

_TOPK = """
SELECT city, num_ads, w_start, w_end, CAST(r AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY w_start ORDER BY num_ads DESC, city) AS r FROM hourly)
WHERE r <= 3"""

_CHANGES = _ADS + """,
ordered AS (
    SELECT city, ts, ad_id,
           row_number() OVER w AS r,
           count(ad_id) OVER (PARTITION BY city ORDER BY ts, ad_id NULLS FIRST ROWS UNBOUNDED PRECEDING) AS n
    FROM timed WHERE city <> 'null'
    WINDOW w AS (PARTITION BY city ORDER BY ts, ad_id NULLS FIRST)
),
changes AS (
    SELECT city, ts, 2 * n AS seq, 'INSERT' AS op, n AS num_ads
    FROM ordered WHERE ad_id IS NOT NULL OR r = 1
    UNION ALL
    SELECT city, ts, 2 * (n - 1) + 1, 'DELETE', n - 1
    FROM ordered WHERE ad_id IS NOT NULL AND r > 1
)"""

_SPANS = """
bounds AS (SELECT min(s) * 1000 AS lo, max(s) * 1000 AS hi FROM timed),
spans AS (SELECT timed.*, CAST(floor((s * 1000 - lo) * 3 / (hi - lo + 1)) AS BIGINT) AS span
          FROM timed, bounds)"""

_PAGES = r"""
ad_pages AS (
    SELECT page_id,
           CASE WHEN page_id % 5 = 0 THEN url ELSE 'https://board.example.com/ad/' || page_id END AS url,
           html || CASE WHEN page_id % 7 = 0 THEN ''
                        WHEN page_id % 7 = 1 THEN '<a class="ps-20" href="/city/wrong">x</a>'
                             || '<a href="/city/" class="btn ps-2">x</a>'
                        ELSE '<a class="ps-20" href="/city/wrong">x</a><a href="/city/c' || (page_id % 4)
                             || '" class="btn ps-2">x</a>' END
                || CASE WHEN page_id % 6 = 0 THEN ''
                        WHEN page_id % 11 = 0 THEN '<div class="px-3">soon</div>'
                        ELSE '<div class="px-3">Posted: 25/05/202' || (page_id % 5) || '</div>' END
                || CASE WHEN page_id % 3 = 0 THEN '<a href="https://BOARD.example.com/x/../ad/' || (page_id + 1) || '">x</a>'
                        ELSE '' END AS html
    FROM pages
),
bodies AS (
    SELECT page_id, url, regexp_replace(html,
        '<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>', '', 'gis') AS body
    FROM ad_pages
)"""

_LINKS = _PAGES + r""",
hrefs AS (
    SELECT DISTINCT page_id, url AS page_url, trim(regexp_extract(tag, '(?i)\shref\s*=\s*"([^"]*)"', 1)) AS link
    FROM (SELECT page_id, url, unnest(regexp_extract_all(body, '(?i)<(?:a|area)\s[^>]*>')) AS tag FROM bodies)
    WHERE regexp_matches(tag, '(?i)\shref\s*=')
),
links AS (
    SELECT page_id, link, CASE WHEN link LIKE '/%' THEN regexp_extract(page_url, '^([a-z]+://[^/?#]*)', 1) || link
                               ELSE link END AS url
    FROM hrefs
)"""
_IN_DOMAIN = r"""regexp_matches(url, '^https?://([^/?#@]*@)?([^/?#:]*\.)?example\.com([/?#:]|$)')"""

# Links between pages as planted, without reading them out of the markup.
_SITE = _PAGES + """,
planted AS (
    SELECT page_id AS n, unnest([2 * page_id + 1, 2 * page_id + 2, page_id // 2]) AS m FROM pages WHERE page_id % 17 <> 0
),
stored_ads AS (SELECT page_id, url FROM ad_pages WHERE page_id % 5 <> 0),
edges AS (
    SELECT a.url AS source, b.url AS target FROM planted JOIN ad_pages a ON a.page_id = n JOIN stored_ads b ON b.page_id = m
    WHERE m % 13 <> 0
    UNION
    SELECT a.url, b.url FROM ad_pages a JOIN stored_ads b ON b.page_id = a.page_id + 1 WHERE a.page_id % 3 = 0
)"""

_LAST_SUM = """
steps AS (
    SELECT city, make_timestamp((epoch_us(w_end) + 1799999999) // 1800000000 * 1800000000) AS step,
           CAST(sum(num_ads) AS DOUBLE) AS num_ads
    FROM tumbling GROUP BY 1, 2
)"""


def _step_sum(by: str, seconds: int) -> str:
    us = seconds * 1000000
    return f"""WITH {_ADS}, {_TUMBLING}
SELECT {by}, make_timestamp((epoch_us(w_end) + {us - 1}) // {us} * {us}) AS step,
       CAST(sum(num_ads) AS DOUBLE) AS num_ads
FROM tumbling GROUP BY ALL"""


def _cumulative(by: str) -> str:
    return f"""WITH {_ADS}, {_TUMBLING},
sums AS (SELECT {by}, w_start, CAST(sum(num_ads) AS BIGINT) AS num_ads FROM tumbling GROUP BY ALL)
SELECT *, CAST(sum(num_ads) OVER (PARTITION BY {by} ORDER BY w_start) AS BIGINT) AS total FROM sums"""


_EXTRACTED = rf"""WITH {_PAGES},
parsed AS (
    SELECT string_split(url, '/ad/')[-1] AS ad_id,
           string_split(regexp_extract(regexp_extract(body,
               '<a\s[^>]*class="(?:[^"]*\s)?ps-2(?:\s[^"]*)?"[^>]*>'), 'href="([^"]*)"', 1), '/')[-1] AS city,
           nullif(regexp_extract(body, '<div\s[^>]*class="(?:[^"]*\s)?px-3(?:\s[^"]*)?"[^>]*>([^<]+)', 1), '') AS t
    FROM bodies WHERE contains(url, '/ad/')
),
extracted AS (
SELECT ad_id, city, strftime(try_strptime(right(t, 10), '%d/%m/%Y'), '%Y-%m-%d') AS posted_date,
       '2024-02-01 12:30:00' AS scraped_time
FROM parsed
WHERE city <> '' AND (t IS NULL OR try_strptime(right(t, 10), '%d/%m/%Y') IS NOT NULL)
)
"""
_POSTED_DAYS = f"""WITH {_ADS}
SELECT city, count(ad_id) AS num_ads, posted_year, CAST(CAST(posted_date AS DATE) AS TIMESTAMP) AS w_start,
       CAST(posted_date AS DATE) + INTERVAL 1 DAY AS w_end
FROM timed WHERE city <> '' AND posted_date IS NOT NULL GROUP BY city, posted_year, posted_date"""
_ALL_SLIDING = f"WITH {_ADS}, {_sliding(60, 10)}"
_SLIDING_RESULT = _ALL_SLIDING + """
SELECT city, num_ads, w_start AS window_start, w_end AS window_end FROM sliding"""
_UNEVEN_RESULT = f"WITH {_ADS}, {_sliding(5, 2)} SELECT * FROM sliding"
_TUMBLING_RESULT = f"WITH {_ADS}, {_TUMBLING} SELECT * FROM tumbling"
_FILTERED = f"WITH {_ADS} SELECT ad_id, city FROM ads WHERE city <> 'null'"
_DISTINCT = f"WITH {_ADS} SELECT DISTINCT city, ad_id FROM ads WHERE city <> 'null'"
_COUNTS = f"WITH {_ADS} SELECT city, count(ad_id) AS num_ads FROM ads WHERE city <> 'null' GROUP BY city"

# Of a held-back ad only those windows count that were still open when it arrived: their end lies
# after the newest counted time of its own span, less five seconds.
_LATE_RESULT = f"""WITH {_ADS}, {_SPANS},
marked AS (
    SELECT *, coalesce(CAST(ad_id AS BIGINT) % 23 = 0, FALSE) AS held
    FROM spans WHERE city <> ''
),
marks AS (SELECT span, max(s) - 5 AS mark FROM marked WHERE NOT held AND posted_year IS NOT NULL GROUP BY span)
SELECT city, count(ad_id) AS num_ads, posted_year,
       make_timestamp(s // 300 * 300 * 1000000) AS w_start,
       make_timestamp((s // 300 * 300 + 300) * 1000000) AS w_end
FROM marked JOIN marks USING (span)
WHERE posted_year IS NOT NULL AND (NOT held OR s // 300 * 300 + 300 > mark)
GROUP BY city, posted_year, s // 300"""

_BAD_LINE = """CASE kind WHEN 'oops' THEN 'oops ' || ad_id
    WHEN 'extra' THEN CAST(to_json({'ad_id': ad_id, 'city': city, 'posted_date': posted_date,
                               'scraped_time': scraped_time, 'spider': spider, 'zzz': 1}) AS VARCHAR)
    WHEN 'no city' THEN CAST(to_json({'ad_id': ad_id, 'posted_date': posted_date,
                                 'scraped_time': scraped_time, 'spider': spider}) AS VARCHAR)
    WHEN 'number' THEN CAST(to_json({'ad_id': serial, 'city': city, 'posted_date': posted_date,
                                'scraped_time': scraped_time, 'spider': spider}) AS VARCHAR)
    WHEN 'bad time' THEN CAST(to_json({'ad_id': ad_id, 'city': city, 'posted_date': posted_date,
                                  'scraped_time': 'bad', 'spider': spider}) AS VARCHAR)
    ELSE CAST(to_json({'ad_id': ad_id, 'city': city, 'posted_date': posted_date,
                  'scraped_time': scraped_time, 'spider': spider}) AS VARCHAR) END"""

ORACLE: dict[str, str] = {
    # sources
    "source_jsonl": f"WITH {_ADS} SELECT ad_id, city FROM ads",
    "source_jsonl_epoch": f"WITH {_ADS} SELECT s * 1000 AS ts_ms, ad_id, city FROM timed",
    "source_stream_replay": f"WITH {_ADS} SELECT * FROM ads",
    "rename_columns": f"WITH {_ADS} SELECT ts, ad_id, city FROM timed",
    "decode_json": f"""WITH {_MESSAGES}
SELECT ad_id, CASE WHEN kind = 'no city' THEN '' ELSE city END AS city, posted_date,
       CASE WHEN kind = 'bad time' THEN 'bad' ELSE scraped_time END AS scraped_time, spider
FROM kinds WHERE kind NOT IN ('oops', 'extra')""",
    "decode_json_coerced": f"""WITH {_MESSAGES}
SELECT coalesce(ad_id, '') AS ad_id, CASE WHEN kind = 'no city' THEN '' ELSE coalesce(city, '') END AS city,
       coalesce(posted_date, '') AS posted_date,
       CASE WHEN kind = 'bad time' THEN 'bad' ELSE scraped_time END AS scraped_time, spider
FROM kinds WHERE kind <> 'oops'""",
    "quarantine_bad_records": f"""WITH {_MESSAGES}
SELECT {_BAD_LINE} AS value,
       CASE WHEN kind = 'oops' THEN 'bad json' WHEN kind = 'extra' THEN 'unknown field'
            WHEN kind = 'bad time' THEN 'bad scraped_time' ELSE 'bad posted_date' END AS reason
FROM kinds WHERE kind IN ('oops', 'extra', 'bad time') OR posted_date IS NULL""",
    "batch_quarantine_counts": f"""WITH {_MESSAGES}
SELECT CASE WHEN kind IN ('oops', 'bad time') THEN 'bad' ELSE 'good' END AS side, count(*) AS num_messages
FROM kinds GROUP BY 1""",
    "read_result_topics": f"""WITH {_ADS}, {_TUMBLING}, {_sliding(60, 10)}
SELECT 'ads-by-city-and-year-tmbl-win' AS topic, 0 AS partition, CAST(NULL AS VARCHAR) AS message_key,
       city, CAST(num_ads AS VARCHAR) AS num_ads, posted_year, w_end AS ts FROM tumbling
UNION ALL
SELECT 'ads-by-city-sld-win', 0, NULL, city, CAST(num_ads AS VARCHAR), NULL, w_end FROM sliding""",
    "json_labels": f"""WITH {_ADS}, {_TUMBLING}
SELECT city, CAST(num_ads AS VARCHAR) AS num_ads, posted_year FROM tumbling""",
    "pages_scan": rf"""WITH {_PAGES}
SELECT page_id, lower(regexp_extract(url, '^[a-z]+://([^/?#:]*)', 1)) AS host, length(html) AS n_chars
FROM ad_pages""",
    # sinks
    "encode_json": f"WITH {_ADS}, {_TUMBLING} SELECT CAST({_TUMBLING_JSON} AS VARCHAR) AS value FROM tumbling",
    "repeated_messages": f"WITH {_ADS}, {_TUMBLING} SELECT CAST({_TUMBLING_JSON} AS VARCHAR) AS value FROM tumbling",
    "encode_json_ltz": _ALL_SLIDING + f" SELECT CAST({_SLIDING_JSON} AS VARCHAR) AS value FROM sliding",
    "sink_jsonl_roundtrip": f"""WITH {_ADS}
SELECT CAST(to_json({{'ad_id': ad_id, 'city': city, 'posted_date': posted_date,
                      'scraped_time': scraped_time}}) AS VARCHAR) AS line FROM ads""",
    "fanout_two_sinks": f"""WITH {_ADS}
SELECT 'file' AS sink, ad_id, city, posted_date, scraped_time, CAST(NULL AS VARCHAR) AS spider FROM ads
UNION ALL SELECT 'topic', ad_id, city, posted_date, scraped_time, 'replayed' FROM ads""",
    "add_spider": f"WITH {_ADS} SELECT ad_id, city, posted_date, scraped_time, 'replayed' AS spider FROM ads",
    "not_null_enforced": f"""WITH {_ADS}
SELECT * FROM ads WHERE city IS NOT NULL AND ad_id IS NOT NULL AND posted_date IS NOT NULL""",
    "changelog_envelope": f"""WITH {_CHANGES}
SELECT CAST(to_json({{'data': [{{'city': city, 'num_ads': num_ads}}], 'type': op}}) AS VARCHAR) AS value
FROM changes""",
    "insert_envelope": f"""WITH {_ADS}
SELECT CAST(to_json({{'data': [{{'ad_id': ad_id, 'city': city}}], 'type': 'INSERT'}}) AS VARCHAR) AS value
FROM ads WHERE city <> 'null'""",
    # projections and filters
    "pass_through": f"WITH {_ADS} SELECT ad_id, city FROM ads",
    "project_city_ad": f"WITH {_ADS} SELECT city, ad_id FROM ads",
    "derive_posted_year": f"""WITH {_ADS}
SELECT ad_id, posted_date, posted_year FROM timed WHERE posted_year IS NOT NULL""",
    "derive_event_time": f"""WITH {_MESSAGES}
SELECT ad_id, CASE WHEN kind = 'bad time' THEN 'bad' ELSE scraped_time END AS scraped_time,
       CASE WHEN kind = 'bad time' THEN NULL ELSE CAST(scraped_time AS TIMESTAMP) END AS ts
FROM kinds WHERE kind <> 'oops'""",
    "filter_null_cities": _FILTERED,
    "filter_empty_cities": f"WITH {_ADS} SELECT ad_id, city FROM ads WHERE city <> ''",
    "is_ad_page": f"WITH {_PAGES} SELECT page_id, url FROM ad_pages WHERE contains(url, '/ad/')",
    "unwrap_numeric": f"""WITH {_ADS}, {_TUMBLING}
SELECT city, posted_year, w_end AS ts, CAST(num_ads AS DOUBLE) AS num_ads
FROM tumbling WHERE minute(w_end) % 15 <> 0""",
    "year_allow_list": f"""WITH {_ADS}, {_TUMBLING}
SELECT * FROM tumbling
WHERE posted_year IN ('2015', '2016', '2017', '2018', '2019', '2021', '2023', '2024')""",
    "recent_range": _ALL_SLIDING + """
SELECT city, num_ads, w_end AS ts FROM sliding
WHERE w_end > (SELECT max(w_end) FROM sliding) - INTERVAL 30 MINUTE""",
    "recent_range_by_day": _ALL_SLIDING + """
SELECT city, num_ads, w_end AS ts FROM sliding
WHERE w_end > (SELECT max(w_end) FROM sliding) - INTERVAL 30 MINUTE""",
    # counts and windows
    "count_by_city": _COUNTS,
    "distinct_city_ad": _DISTINCT,
    "tumbling_city_year_count": _TUMBLING_RESULT,
    "sliding_city_count": _SLIDING_RESULT,
    "sliding_city_count_direct": _SLIDING_RESULT,
    "sliding_city_count_panes": _SLIDING_RESULT,
    "sliding_city_count_sql": _SLIDING_RESULT,
    "sliding_uneven_count": _UNEVEN_RESULT,
    "assign_windows": f"""WITH {_ADS}
SELECT ad_id, city, ts, make_timestamp(st * 1000000) AS window_start,
       make_timestamp((st + 60) * 1000000) AS window_end
FROM (SELECT *, unnest(generate_series(s // 10 * 10, s - 59, -10)) AS st FROM timed)""",
    "session_city_count": f"WITH {_ADS}, {_SESSIONS} {_SESSION_ROWS}",
    "topk_cities": f"WITH {_ADS}, {_hourly()} {_TOPK}",
    "tumbling_posted_date": _POSTED_DAYS,
    "count_changelog": f"WITH {_CHANGES} SELECT * FROM changes",
    # roll-ups over time
    "sum_over_time_city": _step_sum("city", 1800),
    "sum_over_time_year": _step_sum("posted_year", 1800),
    "sum_city_hour": _step_sum("city", 3600),
    "sum_city_year_hour": _step_sum("city, posted_year", 3600),
    "last_over_time_city": _ALL_SLIDING + """
SELECT city, step, CAST(arg_max(num_ads, w_end) AS DOUBLE) AS num_ads
FROM (
    SELECT *, make_timestamp(unnest([t, t + 30000000])) AS step
    FROM (SELECT *, (epoch_us(w_end) + 29999999) // 30000000 * 30000000 AS t FROM sliding)
)
GROUP BY city, step""",
    "sum_over_hour_every_ten_seconds": f"""WITH {_ADS}, {_TUMBLING}
SELECT city, make_timestamp(t) AS step, CAST(sum(num_ads) AS DOUBLE) AS num_ads
FROM (SELECT *, unnest(generate_series(epoch_us(w_end), epoch_us(w_end) + 3590000000, 10000000)) AS t FROM tumbling)
GROUP BY city, t""",
    "last_over_hour_every_ten_seconds": _ALL_SLIDING + """
SELECT city, make_timestamp(t) AS step, CAST(arg_max(num_ads, w_end) AS DOUBLE) AS num_ads
FROM (SELECT *, unnest(generate_series(epoch_us(w_end), epoch_us(w_end) + 3590000000, 10000000)) AS t FROM sliding)
GROUP BY city, t""",
    "last_not_null": f"""WITH {_ADS}, {_TUMBLING}, {_LAST_SUM}
SELECT city, arg_max(num_ads, step) AS num_ads FROM steps GROUP BY city""",
    "cumulative_city": _cumulative("city"),
    "cumulative_year": _cumulative("posted_year"),
    "total_city": f"""WITH {_ADS}
SELECT city, count(ad_id) AS num_ads FROM timed WHERE city <> '' AND posted_year IS NOT NULL GROUP BY city""",
    # functions
    "to_epoch_millis": f"WITH {_ADS} SELECT scraped_time, s * 1000 AS ts_ms FROM timed",
    "from_epoch_millis": """
SELECT event_id, epoch_us(ts) // 1000 AS ts_ms, date_trunc('second', ts) AS ts FROM events""",
    "stamp_scraped_time": f"WITH {_ADS} SELECT ad_id, '2024-02-01 12:30:00' AS scraped_time FROM ads",
    "ad_id_from_url": f"WITH {_PAGES} SELECT url, string_split(url, '/ad/')[-1] AS ad_id FROM ad_pages",
    "city_from_link": f"WITH {_LINKS} SELECT link, string_split(link, '/')[-1] AS city FROM links",
    "posted_date_parse": f"""WITH {_ADS}
SELECT ad_id,
       CASE WHEN posted_date LIKE '%7' THEN '>posted: ' || left(strftime(CAST(posted_date AS DATE), '%d/%m/%Y'), 9)
            ELSE '>posted: ' || strftime(CAST(posted_date AS DATE), '%d/%m/%Y') END AS text,
       CASE WHEN posted_date NOT LIKE '%7' THEN posted_date END AS posted_date
FROM ads""",
    # pages
    "extract_ads": _EXTRACTED + "SELECT * FROM extracted",
    "stream_ingest": _EXTRACTED
    + "SELECT 'file' AS sink, *, CAST(NULL AS VARCHAR) AS spider FROM extracted"
    + " UNION ALL SELECT 'topic', *, 'stored-pages' FROM extracted",
    "extract_links": f"WITH {_LINKS} SELECT page_id, link, url FROM links",
    "filter_domain": f"WITH {_LINKS} SELECT page_id, link, url FROM links WHERE {_IN_DOMAIN}",
    # Levels grow with the logarithm of the number of pages, far below the bound.
    "crawl_levels": f"""WITH RECURSIVE {_SITE},
reached AS (
    SELECT url, 0 AS level FROM stored_ads WHERE page_id = 1
    UNION
    SELECT target, level + 1 FROM reached JOIN edges ON source = url WHERE level < 40
)
SELECT url, CAST(min(level) AS INTEGER) AS level FROM reached GROUP BY url""",
    "link_frontier": f"""WITH {_LINKS},
spelt AS (SELECT replace(replace(url, '//BOARD.', '//board.'), '/x/../', '/') AS url FROM links)
SELECT DISTINCT url FROM spelt
WHERE {_IN_DOMAIN} AND url NOT IN (SELECT regexp_replace(url, '#.*$', '') FROM ad_pages)""",
    # streams
    "stream_tumbling": _TUMBLING_RESULT,
    "stream_posted_date": _POSTED_DAYS,
    "stream_monotonic": _TUMBLING_RESULT,
    "stream_sliding": _SLIDING_RESULT,
    "stream_sliding_panes": f"""WITH {_ADS}, {_sliding(3600, 10)}
SELECT city, num_ads, w_start AS window_start, w_end AS window_end FROM sliding""",
    "stream_sliding_uneven": _UNEVEN_RESULT,
    "stream_session": f"WITH {_ADS}, {_SESSIONS} {_SESSION_ROWS}",
    "stream_late_rows": _LATE_RESULT,
    "stream_restart": f"WITH {_ADS}, {_hourly()} SELECT * FROM hourly",
    "stream_distinct": _DISTINCT,
    "stream_first_seen": _DISTINCT,
    "stream_topk": f"WITH {_ADS}, {_hourly()} {_TOPK}",
    "stream_running_count": _COUNTS,
    "stream_changelog": f"""WITH {_ADS}, {_SPANS},
per AS (SELECT city, span AS batch, count(ad_id) AS n FROM spans WHERE city <> 'null' GROUP BY city, span),
run AS (
    SELECT city, batch, n, CAST(sum(n) OVER w AS BIGINT) AS total, row_number() OVER w AS r
    FROM per WINDOW w AS (PARTITION BY city ORDER BY batch)
)
SELECT batch, city, 'INSERT' AS op, total AS num_ads FROM run WHERE n > 0 OR r = 1
UNION ALL SELECT batch, city, 'DELETE', total - n FROM run WHERE n > 0 AND r > 1""",
    "stream_quarantine": f"""WITH {_MESSAGES}
SELECT {_BAD_LINE} AS value,
       CASE WHEN kind = 'oops' THEN 'bad json' WHEN kind = 'extra' THEN 'unknown field'
            WHEN kind = 'bad time' THEN 'bad scraped_time' ELSE 'bad posted_date' END AS reason
FROM kinds WHERE kind IN ('oops', 'extra', 'bad time') OR posted_date IS NULL""",
}
