"""Oracle SQL for DuckDB over the shared test tables.

Each query restates the fixture rules, the cleaning chain and the KPI in
plain SQL, row by row (no cube), so it checks the Spark plans rather than
repeating them.  Views ``events``, ``part`` and ``lineitem`` are assumed.
"""

from __future__ import annotations

# The accepted time layouts with their guards, written out here
# so that a slip in the code under test does not pass both sides.
_DAY, _MONTH = "(0[1-9]|[12]\\d|3[01])", "(0[1-9]|1[0-2])"
_CLOCK = "(0\\d|1\\d|2[0-3]):([0-5]\\d):([0-5]\\d)"
TIMESTAMP_FORMATS = (
    (f"^\\d{{4}}-{_MONTH}-{_DAY} {_CLOCK}$", "yyyy-MM-dd HH:mm:ss"),
    (f"^{_DAY}-{_MONTH}-\\d{{4}} {_CLOCK}$", "dd-MM-yyyy HH:mm:ss"),
    (f"^\\d{{4}}/{_MONTH}/{_DAY} {_CLOCK}$", "yyyy/MM/dd HH:mm:ss"),
    (f"^{_DAY}/{_MONTH}/\\d{{4}} {_CLOCK}$", "dd/MM/yyyy HH:mm:ss"),
    ("^\\d{4}-\\d{2}-\\d{2}T\\d{2}:\\d{2}:\\d{2}$", "yyyy-MM-dd'T'HH:mm:ss"),
)

SENTINEL = "TIMESTAMP '9999-12-31 23:59:59'"
CONTACT = "'contact_agent'"


def _strftime(pattern: str) -> str:
    out = pattern.replace("'", "")
    for java, c in (("yyyy", "%Y"), ("MM", "%m"), ("dd", "%d"), ("HH", "%H"), ("mm", "%M"), ("ss", "%S")):
        out = out.replace(java, c)
    return out


def parse_ts(expr: str) -> str:
    arms = " ".join(f"WHEN regexp_matches({expr}, '{rx}') THEN try_strptime({expr}, '{_strftime(p)}')"
                    for rx, p in TIMESTAMP_FORMATS)
    return f"CASE {arms} END"


def to_bool(expr: str) -> str:
    t = f"lower(trim({expr}))"
    return (f"CASE WHEN {t} IN ('t','true','y','yes','1') THEN true "
            f"WHEN {t} IN ('f','false','n','no','0') THEN false END")


def rnd(expr: str) -> str:
    """Half-up rounding on the shortest decimal text, as Spark rounds doubles."""
    return f"CAST(round(CAST(CAST(({expr}) AS VARCHAR) AS DECIMAL(38,18)), 2) AS DOUBLE)"


def time_parts(ts: str = "viewed_at") -> str:
    return (f"CAST(hour({ts}) AS INTEGER) AS view_hour, CAST(day({ts}) AS INTEGER) AS view_day, "
            f"CAST(month({ts}) AS INTEGER) AS view_month, CAST(year({ts}) AS INTEGER) AS view_year")


FIXTURE_CTES = f"""
ev_rows AS (
  SELECT event_id AS _eid,
         CAST(user_id AS VARCHAR) AS user_id,
         CASE WHEN event_id % 53 <> 0 THEN json_extract_string(props, '$.k') END AS apartment_id,
         CASE WHEN event_id % 91 = 4 THEN 'not-a-date'
              WHEN event_id % 91 = 5 THEN '2024-02-31 10:00:00'
              WHEN event_id % 7 = 0 THEN strftime(ts, '%d-%m-%Y %H:%M:%S')
              WHEN event_id % 7 = 1 THEN strftime(ts, '%Y/%m/%d %H:%M:%S')
              WHEN event_id % 7 = 2 THEN strftime(ts, '%d/%m/%Y %H:%M:%S')
              WHEN event_id % 7 = 3 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S')
              ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS viewed_at,
         CASE event_id % 5 WHEN 0 THEN 'y' WHEN 1 THEN 'n' WHEN 2 THEN 'true' WHEN 4 THEN 'maybe' END AS is_wishlisted,
         CASE WHEN event_type IN ('purchase', 'view') THEN 'contact_agent'
              WHEN event_type = 'click' THEN 'shortlisted'
              WHEN event_type = 'error' THEN 'reported' END AS call_to_action
  FROM events),
raw_viewings AS (
  SELECT user_id, apartment_id, viewed_at, is_wishlisted, call_to_action FROM ev_rows
  UNION ALL
  SELECT user_id, apartment_id, viewed_at, is_wishlisted, call_to_action FROM ev_rows WHERE _eid % 101 = 0),
parsed_viewings AS (
  SELECT user_id, apartment_id, {parse_ts('viewed_at')} AS viewed_at,
         {to_bool('is_wishlisted')} AS is_wishlisted, call_to_action
  FROM raw_viewings),
filled_viewings AS (
  SELECT COALESCE(user_id, 'Unknown') AS user_id, COALESCE(apartment_id, 'Unknown') AS apartment_id,
         COALESCE(viewed_at, {SENTINEL}) AS viewed_at, is_wishlisted,
         COALESCE(call_to_action, 'Unknown') AS call_to_action
  FROM parsed_viewings),
clean_viewings AS (
  SELECT user_id, apartment_id, viewed_at, is_wishlisted, call_to_action FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id, apartment_id, viewed_at
                                 ORDER BY is_wishlisted NULLS LAST, call_to_action NULLS LAST) AS _rn
    FROM filled_viewings) WHERE _rn = 1),
clean_viewings_two_key AS (
  SELECT user_id, apartment_id, viewed_at, is_wishlisted, call_to_action FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id, apartment_id
                                 ORDER BY viewed_at NULLS LAST, is_wishlisted NULLS LAST,
                                          call_to_action NULLS LAST) AS _rn
    FROM filled_viewings) WHERE _rn = 1),
raw_apartments AS (
  SELECT CAST(CASE WHEN p_partkey % 11 = 0 THEN -(p_partkey + 1) ELSE p_partkey END AS VARCHAR) AS id,
         p_name AS title,
         CASE WHEN p_partkey % 17 <> 0 THEN p_type END AS source,
         CASE WHEN p_partkey % 13 <> 0 THEN CAST(floor(p_retailprice) AS INTEGER) END AS price,
         'USD' AS currency,
         CASE WHEN p_partkey % 19 = 0 THEN NULL
              WHEN p_partkey % 23 = 0 THEN TIMESTAMP '2023-01-01 00:00:00.5'
              ELSE TIMESTAMP '2023-01-01 00:00:00' + to_hours(CAST(p_partkey % 5000 AS BIGINT)) END
           AS listing_created_on,
         CAST(p_size % 2 AS TINYINT) AS is_active,
         TIMESTAMP '2023-06-01 00:00:00' + to_hours(CAST(p_partkey % 5000 AS BIGINT)) AS last_modified_timestamp
  FROM part),
typed_apartments AS (
  SELECT id, title, source, price, currency,
         {parse_ts('CAST(listing_created_on AS VARCHAR)')} AS listing_created_on,
         CAST(is_active AS BOOLEAN) AS is_active,
         {parse_ts('CAST(last_modified_timestamp AS VARCHAR)')} AS last_modified_timestamp
  FROM raw_apartments),
clean_apartments AS (
  SELECT COALESCE(id, 'Unknown') AS id, COALESCE(title, 'Unknown') AS title,
         COALESCE(source, 'Unknown') AS source, COALESCE(price, 0) AS price,
         COALESCE(currency, 'Unknown') AS currency,
         COALESCE(listing_created_on, {SENTINEL}) AS listing_created_on, is_active,
         COALESCE(last_modified_timestamp, {SENTINEL}) AS last_modified_timestamp
  FROM typed_apartments),
raw_attributes AS (
  SELECT CAST(CASE WHEN p_partkey % 7 = 0 THEN -(p_partkey + 1) ELSE p_partkey END AS VARCHAR) AS id,
         p_brand AS category, p_name AS body,
         CAST(NULL AS VARCHAR) AS amenities,
         CAST(p_size % 3 + 0.5 AS FLOAT) AS bathrooms,
         CAST(CASE WHEN p_partkey % 31 <> 0 THEN p_size % 4 END AS FLOAT) AS bedrooms,
         CAST(CASE WHEN p_partkey % 2 <> 0 THEN 10.5 END AS FLOAT) AS fee,
         CASE WHEN p_size % 2 = 1 THEN 'Yes' ELSE 'No' END AS has_photo,
         CASE WHEN p_partkey % 3 <> 0 THEN 'Cats' END AS pets_allowed,
         '$' || CAST(CAST(floor(p_retailprice) AS INTEGER) AS VARCHAR) AS price_display,
         'Monthly' AS price_type,
         CAST(p_size * 40 AS INTEGER) AS square_feet,
         CASE WHEN p_partkey % 5 <> 0 THEN CAST(p_partkey AS VARCHAR) || ' Main St' END AS address,
         CASE WHEN p_partkey % 29 <> 0 THEN 'City_' || CAST(p_partkey % 12 AS VARCHAR) END AS cityname,
         'ST' || CAST(p_partkey % 5 AS VARCHAR) AS state,
         CAST(30 + p_partkey % 20 AS DOUBLE) AS latitude,
         CAST(-120 + p_partkey % 50 AS DOUBLE) AS longitude
  FROM part),
clean_attributes AS (
  SELECT COALESCE(id, 'Unknown') AS id, COALESCE(category, 'Unknown') AS category,
         COALESCE(body, 'Unknown') AS body, COALESCE(bathrooms, 0) AS bathrooms,
         COALESCE(bedrooms, 0) AS bedrooms, COALESCE(fee, 0) AS fee,
         COALESCE(has_photo, 'Unknown') AS has_photo, COALESCE(pets_allowed, 'Unknown') AS pets_allowed,
         COALESCE(price_display, 'Unknown') AS price_display, COALESCE(price_type, 'Unknown') AS price_type,
         COALESCE(square_feet, 0) AS square_feet, COALESCE(address, 'Unknown') AS address,
         COALESCE(cityname, 'Unknown') AS cityname, COALESCE(state, 'Unknown') AS state,
         COALESCE(latitude, 0) AS latitude, COALESCE(longitude, 0) AS longitude
  FROM raw_attributes),
listing AS (
  SELECT * FROM clean_apartments LEFT JOIN clean_attributes USING (id)),
wide AS (
  SELECT v.*, l.*, {time_parts('v.viewed_at')},
         COALESCE(dayofweek(v.viewed_at) IN (0, 6), false) AS is_weekend
  FROM clean_viewings v LEFT JOIN listing l ON v.apartment_id = l.id),
large_viewings AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS user_id, CAST(l_partkey AS VARCHAR) AS apartment_id,
         strftime(l_shipdate + to_hours(CAST(l_orderkey % 24 AS BIGINT)), '%Y-%m-%d %H:%M:%S') AS viewed_at,
         CASE l_returnflag WHEN 'R' THEN 'y' WHEN 'A' THEN 'n' END AS is_wishlisted,
         CASE WHEN l_linestatus = 'O' THEN 'contact_agent'
              WHEN l_returnflag = 'A' THEN 'shortlisted' ELSE 'reported' END AS call_to_action
  FROM lineitem),
large_clean AS (
  SELECT user_id, apartment_id, viewed_at, is_wishlisted, call_to_action FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id, apartment_id, viewed_at
                                 ORDER BY is_wishlisted NULLS LAST, call_to_action NULLS LAST) AS _rn
    FROM (SELECT COALESCE(user_id, 'Unknown') AS user_id, COALESCE(apartment_id, 'Unknown') AS apartment_id,
                 COALESCE({parse_ts('viewed_at')}, {SENTINEL}) AS viewed_at,
                 {to_bool('is_wishlisted')} AS is_wishlisted,
                 COALESCE(call_to_action, 'Unknown') AS call_to_action
          FROM large_viewings)) WHERE _rn = 1),
large_wide AS (
  SELECT v.*, l.*, {time_parts('v.viewed_at')},
         COALESCE(dayofweek(v.viewed_at) IN (0, 6), false) AS is_weekend
  FROM large_clean v LEFT JOIN listing l ON v.apartment_id = l.id)
"""


def q(body: str) -> str:
    return f"WITH {FIXTURE_CTES.strip()}\n{body}"


TRIPLE = ("count(*) AS total_views, "
          "count(CASE WHEN is_wishlisted THEN 1 END) AS total_wishlists, "
          f"count(CASE WHEN call_to_action = {CONTACT} THEN 1 END) AS total_contact_agent")
RATE = rnd(f"sum(CASE WHEN call_to_action = {CONTACT} THEN 1 END) / count(*) * 100") + " AS engagement_rate"
PRICES = ("min(price) AS min_price, max(price) AS max_price, "
          "count(CASE WHEN is_active THEN 1 END) AS total_active_apartment")
NON_ACTIVE = 'count(CASE WHEN NOT is_active THEN 1 END) AS "total_non-active_apartment"'
AVG = rnd("avg(price)") + " AS avg_price"
CAL_HOUR = "view_year, view_month, view_day, view_hour"
CAL_DAY = "view_year, view_month, view_day"


def views_by(keys: str, item: str, src: str = "wide") -> str:
    return f"SELECT {keys}, {item}, count(*) AS total_views FROM {src} GROUP BY {keys}, {item}"


def ranked(keys: str, item: str, src: str = "wide") -> str:
    return (f"SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY total_views DESC, "
            f"{item} ASC NULLS LAST) AS rn FROM ({views_by(keys, item, src)})")


def mode(keys: str, item: str, out: str, src: str = "wide") -> str:
    return f"SELECT {keys}, {item} AS {out} FROM ({ranked(keys, item, src)}) WHERE rn = 1"


def top3(keys: str, src: str = "wide") -> str:
    return (f"SELECT {keys}, string_agg(apartment_id, ', ' ORDER BY rn) AS top_apartments "
            f"FROM ({ranked(keys, 'apartment_id', src)}) WHERE rn <= 3 GROUP BY {keys}")


def _using(keys: str) -> str:
    return f"USING ({keys})"


def time_summary(keys: str, with_top: bool = True, src: str = "wide") -> str:
    top_sel = ", t.top_apartments" if with_top else ""
    top_join = f" LEFT JOIN ({top3(keys, src)}) t {_using(keys)}" if with_top else ""
    return (f"SELECT {keys}, e.total_views, e.total_wishlists, e.total_contact_agent, "
            f"p.most_viewed_platform{top_sel}, e.engagement_rate FROM "
            f"(SELECT {keys}, {TRIPLE}, {RATE} FROM {src} GROUP BY {keys}) e "
            f"LEFT JOIN ({mode(keys, 'source', 'most_viewed_platform', src)}) p {_using(keys)}{top_join}")


def state_city(src: str = "wide") -> str:
    base = (f"SELECT state, cityname, {TRIPLE}, {PRICES}, {AVG} FROM {src} GROUP BY state, cityname")
    rated = (f"SELECT *, {rnd('total_wishlists / total_views')} AS wishlist_rate, "
             f"{rnd('total_contact_agent / total_views')} AS contact_rate, "
             "CAST(row_number() OVER (PARTITION BY state ORDER BY total_views DESC, cityname ASC NULLS LAST) "
             f"AS INTEGER) AS rank_city FROM ({base})")
    return (f"SELECT r.state, r.cityname, total_views, total_wishlists, total_contact_agent, min_price, "
            f"max_price, total_active_apartment, avg_price, wishlist_rate, contact_rate, rank_city, p.source "
            f"FROM ({rated}) r LEFT JOIN ({mode('state, cityname', 'source', 'source', src)}) p "
            f"ON r.state = p.state AND r.cityname = p.cityname WHERE rank_city <= 5")


def platform(src: str = "wide") -> str:
    base = f"SELECT source, {TRIPLE}, {PRICES}, {NON_ACTIVE}, {AVG} FROM {src} GROUP BY source"
    return (f"SELECT b.source, total_views, total_wishlists, total_contact_agent, min_price, max_price, "
            f'total_active_apartment, "total_non-active_apartment", avg_price, '
            f"{rnd('total_wishlists / total_views')} AS wishlist_rate, "
            f"{rnd('total_contact_agent / total_views')} AS contact_rate, t.top_apartments "
            f"FROM ({base}) b LEFT JOIN ({top3('source', src)}) t ON b.source = t.source")


APARTMENT_PERFORMANCE = (
    "SELECT l.id AS apartment_id, title, category, cityname, state, source, price, currency, is_active, "
    "listing_created_on, last_modified_timestamp, e.total_views, e.total_wishlists, e.total_contact_agent "
    f"FROM listing l LEFT JOIN (SELECT apartment_id, {TRIPLE} FROM clean_viewings GROUP BY apartment_id) e "
    "ON l.id = e.apartment_id")

ATTRIBUTE_COLS = ("id, category, body, bathrooms, bedrooms, fee, has_photo, pets_allowed, price_display, "
                  "price_type, square_feet, address, cityname, state, latitude, longitude")


ORACLE_SQL: dict[str, str] = {
    # -- cleaning -------------------------------------------------------------
    "normalise_timestamps": q(
        f"SELECT user_id, apartment_id, {parse_ts('viewed_at')} AS viewed_at, is_wishlisted, call_to_action "
        "FROM raw_viewings"),
    "invalid_timestamp_count": q(
        "SELECT count(*) FILTER (WHERE viewed_at IS NULL) AS invalid_viewed_at FROM parsed_viewings"),
    "normalise_typed_timestamps": q(
        "SELECT id, title, source, price, currency, listing_created_on, "
        "CAST(is_active AS TINYINT) AS is_active, last_modified_timestamp FROM typed_apartments"),
    "null_profile": q(
        "SELECT count(*) AS total_rows, count(*) FILTER (WHERE user_id IS NULL) AS user_id, "
        "count(*) FILTER (WHERE apartment_id IS NULL) AS apartment_id, "
        "count(*) FILTER (WHERE viewed_at IS NULL) AS viewed_at, "
        "count(*) FILTER (WHERE is_wishlisted IS NULL) AS is_wishlisted, "
        "count(*) FILTER (WHERE call_to_action IS NULL) AS call_to_action FROM parsed_viewings"),
    "any_null": q(
        "SELECT COALESCE(bool_or(user_id IS NULL OR apartment_id IS NULL OR viewed_at IS NULL "
        "OR is_wishlisted IS NULL OR call_to_action IS NULL), false) AS has_nulls FROM parsed_viewings"),
    "drop_all_null_columns": q(
        "SELECT id, category, body, bathrooms, bedrooms, fee, has_photo, pets_allowed, price_display, "
        "price_type, square_feet, address, cityname, state, latitude, longitude FROM raw_attributes"),
    "fill_nulls": q("SELECT * FROM clean_apartments"),
    "nan_to_null": q(
        "SELECT id, category, body, amenities, "
        "CASE WHEN CAST(id AS BIGINT) % 37 = 0 THEN NULL ELSE bathrooms END AS bathrooms, "
        "bedrooms, fee, has_photo, pets_allowed, price_display, price_type, square_feet, address, cityname, "
        "state, latitude, longitude FROM raw_attributes"),
    "duplicate_report": q(
        "SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS total_rows, count(*) AS distinct_keys, "
        "CAST(coalesce(sum(n), 0) - count(*) AS BIGINT) AS duplicate_rows, "
        "sum(n) > count(*) AS has_duplicates FROM (SELECT user_id, apartment_id, viewed_at, count(*) AS n "
        "FROM filled_viewings GROUP BY ALL)"),
    "dedup_viewings": q("SELECT * FROM clean_viewings"),
    "dedup_viewings_two_key": q("SELECT * FROM clean_viewings_two_key"),
    "dedup_listings": q(
        "SELECT id, title, source, price, currency, listing_created_on, is_active, last_modified_timestamp "
        "FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY title NULLS LAST, source NULLS LAST, "
        "price NULLS LAST, currency NULLS LAST, listing_created_on NULLS LAST, is_active NULLS LAST, "
        "last_modified_timestamp NULLS LAST) AS _rn FROM (SELECT * FROM clean_apartments UNION ALL "
        "SELECT id, upper(title), source, price, currency, listing_created_on, is_active, "
        "last_modified_timestamp FROM clean_apartments WHERE CAST(id AS BIGINT) % 10 = 0)) WHERE _rn = 1"),
    "to_boolean": q(
        f"SELECT user_id, apartment_id, viewed_at, {to_bool('is_wishlisted')} AS is_wishlisted, "
        "call_to_action FROM raw_viewings"),
    "clean_viewings": q("SELECT * FROM clean_viewings"),
    "clean_listings": q("SELECT * FROM clean_apartments"),
    "clean_attributes": q(f"SELECT {ATTRIBUTE_COLS} FROM clean_attributes"),
    # -- model ----------------------------------------------------------------
    "listing_dim": q("SELECT * FROM listing"),
    "full_detail": q("SELECT * FROM wide"),
    "time_parts": q(f"SELECT *, {time_parts()} FROM clean_viewings"),
    "weekend_split": q(f"SELECT is_weekend, {TRIPLE} FROM wide GROUP BY is_weekend"),
    # -- engagement -------------------------------------------------------------
    "engagement_by_listing": q(f"SELECT apartment_id, {TRIPLE} FROM clean_viewings GROUP BY apartment_id"),
    "engagement_by_hour": q(f"SELECT view_hour, {TRIPLE} FROM wide GROUP BY view_hour"),
    "engagement_by_day": q(f"SELECT view_day, {TRIPLE} FROM wide GROUP BY view_day"),
    "engagement_by_calendar_hour": q(f"SELECT {CAL_HOUR}, {TRIPLE} FROM wide GROUP BY {CAL_HOUR}"),
    "engagement_by_city": q(
        f"SELECT state, cityname, {TRIPLE}, {PRICES}, {AVG}, "
        f"{rnd('count(CASE WHEN is_wishlisted THEN 1 END) / count(*)')} AS wishlist_rate, "
        f"{rnd(f'count(CASE WHEN call_to_action = {CONTACT} THEN 1 END) / count(*)')} AS contact_rate "
        "FROM wide GROUP BY state, cityname"),
    "engagement_by_platform": q(
        f"SELECT source, {TRIPLE}, {PRICES}, {NON_ACTIVE}, {AVG}, "
        f"{rnd('count(CASE WHEN is_wishlisted THEN 1 END) / count(*)')} AS wishlist_rate, "
        f"{rnd(f'count(CASE WHEN call_to_action = {CONTACT} THEN 1 END) / count(*)')} AS contact_rate "
        "FROM wide GROUP BY source"),
    "engagement_rate_by_hour": q(f"SELECT view_hour, {RATE} FROM wide GROUP BY view_hour"),
    "engagement_rate_by_day": q(f"SELECT view_day, {RATE} FROM wide GROUP BY view_day"),
    "engagement_rate_by_calendar_hour": q(f"SELECT {CAL_HOUR}, {RATE} FROM wide GROUP BY {CAL_HOUR}"),
    "platform_views_by_hour": q(views_by("view_hour", "source")),
    "listing_views_by_hour": q(views_by("view_hour", "apartment_id")),
    "platform_views_by_day": q(views_by("view_day", "source")),
    "listing_views_by_day": q(views_by("view_day", "apartment_id")),
    "platform_views_by_city": q(views_by("state, cityname", "source")),
    "listing_views_by_platform": q(views_by("source", "apartment_id")),
    "platform_views_by_calendar_hour": q(views_by(CAL_HOUR, "source")),
    # -- ranking ----------------------------------------------------------------
    "top_platform_by_hour": q(mode("view_hour", "source", "most_viewed_platform")),
    "top_platform_by_day": q(mode("view_day", "source", "most_viewed_platform")),
    "top_platform_by_city": q(mode("state, cityname", "source", "source")),
    "top_platform_by_calendar_hour": q(mode(CAL_HOUR, "source", "most_viewed_platform")),
    "top3_listings_by_hour": q(top3("view_hour")),
    "top3_listings_by_day": q(top3("view_day")),
    "top3_listings_by_platform": q(top3("source")),
    "listing_rank_by_hour": q(
        "SELECT view_hour, apartment_id, total_views, "
        "CAST(rank() OVER (PARTITION BY view_hour ORDER BY total_views DESC) AS INTEGER) AS rank, "
        "CAST(rn AS INTEGER) AS row_num FROM (" + ranked("view_hour", "apartment_id") + ") "
        "QUALIFY rn <= 3"),
    "top5_cities_by_state": q(
        f"SELECT state, cityname, total_views, CAST(rn AS INTEGER) AS rank_city FROM "
        f"({ranked('state', 'cityname')}) WHERE rn <= 5"),
    # -- KPI tables -------------------------------------------------------------
    "kpi_apartment_performance": q(APARTMENT_PERFORMANCE),
    "kpi_hour_summary": q(time_summary("view_hour")),
    "kpi_calendar_hour": q(time_summary(CAL_HOUR, with_top=False)),
    "kpi_day_of_month": q(time_summary("view_day")),
    "kpi_state_city": q(state_city()),
    "kpi_platform": q(platform()),
    "kpi_daily": q(time_summary(CAL_DAY, with_top=False)),
    "kpi_hour_summary_lineitem": q(time_summary("view_hour", src="large_wide")),
    "kpi_platform_lineitem": q(platform(src="large_wide")),
}

VIEWING_COLS = "user_id, apartment_id, viewed_at, is_wishlisted, call_to_action"

ORACLE_SQL.update({
    "json_roundtrip": q("SELECT * FROM raw_apartments"),
    "json_batches": q("SELECT * FROM raw_attributes"),
    "dt_partition_scan": q(
        f"SELECT {VIEWING_COLS}, CAST({parse_ts('viewed_at')} AS DATE) AS dt FROM raw_viewings"),
    "csv_roundtrip": q("SELECT * FROM raw_viewings"),
    "time_batches": q("SELECT * FROM raw_viewings"),
    "kpi_table_load": q(
        f"SELECT *, DATE '2025-06-27' AS dt FROM ({time_summary('view_hour')}) UNION ALL "
        f"SELECT *, DATE '2025-06-28' AS dt FROM ({time_summary('view_hour')})"),
    "fact_append_load": q("SELECT * FROM clean_viewings UNION ALL SELECT * FROM clean_viewings"),
    "dim_truncate_load": q("SELECT * FROM listing"),
    "topic_messages": q(
        "SELECT CAST(row_number() OVER (ORDER BY viewed_at NULLS LAST, user_id NULLS LAST, "
        "apartment_id NULLS LAST, is_wishlisted NULLS LAST, call_to_action NULLS LAST) - 1 AS VARCHAR) "
        "AS key, CAST(to_json(struct_pack(user_id := user_id, apartment_id := apartment_id, "
        "viewed_at := viewed_at, is_wishlisted := is_wishlisted, call_to_action := call_to_action)) "
        "AS VARCHAR) AS value FROM raw_viewings"),
})

ORACLE_SQL.update({
    "stream_land_by_date": ORACLE_SQL["dt_partition_scan"],
    "stream_dedup": q("SELECT * FROM clean_viewings"),
    "stream_hour_engagement": q(
        f"SELECT {CAL_HOUR}, {TRIPLE} FROM (SELECT *, {time_parts()} FROM clean_viewings) GROUP BY {CAL_HOUR}"),
})


# -- the dated job: viewings of a date are those with an even (odd) user id ------------------
def by_date(body) -> str:
    """``body(src)`` for each date, with the wide table of that date's viewings as its source."""
    parts = [f"SELECT *, DATE '{dt}' AS dt FROM ({body(f'(SELECT * FROM wide WHERE CAST(user_id AS BIGINT) % 2 = {k})')})"
             for k, dt in enumerate(("2025-06-27", "2025-06-28"))]
    return " UNION ALL ".join(parts)


FULL_DETAIL = ("user_id, apartment_id, viewed_at, is_wishlisted, call_to_action, id, title, source, price, currency, "
               "listing_created_on, is_active, last_modified_timestamp, category, body, CAST(NULL AS VARCHAR) AS amenities, "
               "bathrooms, bedrooms, fee, has_photo, pets_allowed, price_display, price_type, square_feet, address, "
               "cityname, state, latitude, longitude, view_hour, view_day, view_month, view_year, is_weekend")
_REPORT_TABLES = {
    "user_viewings": ("parsed_viewings", "user_id, apartment_id, viewed_at, is_wishlisted, call_to_action", ("viewed_at",),
                      f"COALESCE(user_id, 'Unknown'), COALESCE(apartment_id, 'Unknown'), COALESCE(viewed_at, {SENTINEL})"),
    "apartments": ("typed_apartments", "id, title, source, price, currency, listing_created_on, is_active, "
                   "last_modified_timestamp", ("listing_created_on", "last_modified_timestamp"), "COALESCE(id, 'Unknown')"),
    "apartment_attributes": ("raw_attributes", ATTRIBUTE_COLS.replace("body,", "body, amenities,"), (),
                             "COALESCE(id, 'Unknown')"),
}


def _report() -> str:
    out = []
    for k, dt in enumerate(("2025-06-27", "2025-06-28")):
        for name, (src, columns, times, key) in _REPORT_TABLES.items():
            rows = f"(SELECT * FROM {src}" + (f" WHERE CAST(user_id AS BIGINT) % 2 = {k})" if name == "user_viewings" else ")")
            for c in columns.split(", "):
                out.append(
                    f"SELECT DATE '{dt}' AS dt, '{name}' AS \"table\", '{c}' AS \"column\", count(*) AS \"rows\", "
                    f"count(*) FILTER (WHERE {c} IS NULL) AS nulls, "
                    + (f"count(*) FILTER (WHERE {c} IS NULL)" if c in times else "CAST(0 AS BIGINT)") + " AS invalid, "
                    f"count(*) - count(DISTINCT ({key})) AS duplicates FROM {rows}")
    return " UNION ALL ".join(out)


def _warehouse() -> str:
    dated = {"fact_user_viewings": lambda s: f"SELECT 1 FROM {s}", "fact_viewings_full_detail": lambda s: f"SELECT 1 FROM {s}",
             "kpi_apartment_performance": lambda s: "SELECT 1 FROM listing",
             "kpi_hour_summary": lambda s: f"SELECT DISTINCT view_hour FROM {s}",
             "kpi_calendar_hour": lambda s: f"SELECT DISTINCT {CAL_HOUR} FROM {s}",
             "kpi_dayofmonth_summary": lambda s: f"SELECT DISTINCT view_day FROM {s}",
             "kpi_state": lambda s: f"SELECT 1 FROM ({state_city(s)})",
             "kpi_platform": lambda s: f"SELECT DISTINCT source FROM {s}",
             "kpi_daily": lambda s: f"SELECT DISTINCT {CAL_DAY} FROM {s}"}
    out = [f"SELECT '{t}' AS \"table\", CAST(NULL AS DATE) AS dt, count(*) AS \"rows\" FROM {src}"
           for t, src in (("dim_apartments", "clean_apartments"), ("dim_apartment_attributes", "clean_attributes"))]
    for t, body in dated.items():
        out.append(f"SELECT '{t}', dt, count(*) FROM ({by_date(body)}) GROUP BY dt")
    return " UNION ALL ".join(out)


ORACLE_SQL.update({
    "landing_job_hour_summary": q(by_date(lambda s: time_summary("view_hour", src=s))),
    "job_silver_viewings": q("SELECT *, CASE CAST(user_id AS BIGINT) % 2 WHEN 0 THEN DATE '2025-06-27' "
                             "ELSE DATE '2025-06-28' END AS dt FROM clean_viewings"),
    "job_full_detail": q(by_date(lambda s: f"SELECT {FULL_DETAIL} FROM {s}")),
    "job_kpi_state": q(by_date(state_city)),
    "job_quality_report": q(_report()),
    "warehouse_load": q(_warehouse()),
    "csv_listings_roundtrip": (
        "SELECT CAST(p_partkey AS VARCHAR) AS id, CASE p_partkey % 3 WHEN 0 THEN 'He said \"hi\", then left: ' || p_name "
        "WHEN 1 THEN p_name || chr(10) || 'second line, with \"quotes\"' ELSE p_name END AS title, p_type AS source, "
        "CAST(floor(p_retailprice) AS INTEGER) AS price, CASE WHEN p_partkey % 5 <> 0 THEN "
        "'\"' || p_name || '\",' || chr(10) || '\"\"' || CAST(p_partkey AS VARCHAR) END AS body, "
        "CASE WHEN p_partkey % 4 <> 0 THEN CAST(p_size + 0.5 AS DOUBLE) END AS fee, CAST(NULL AS VARCHAR) AS corrupt FROM part"),
})

# -- kept tables: the second date brings the first date's viewings of users ending in 0 again ---
_ALL_HOURS = f"(SELECT *, {time_parts()} FROM filled_viewings)"
_BROKEN = ("CASE CAST(user_id AS BIGINT) % 10 WHEN 3 THEN '{\"user_id\": \"' || user_id WHEN 5 THEN 'no message ' || user_id "
           "WHEN 7 THEN '[' || user_id || ']' END")
_DAY_OF = "CASE CAST(user_id AS BIGINT) % 2 WHEN 0 THEN DATE '2025-06-27' ELSE DATE '2025-06-28' END"


def displayed(body: str, order: str) -> str:
    return f"SELECT *, row_number() OVER (ORDER BY {order}) AS position FROM ({body})"


ORACLE_SQL.update({
    "dedup_across_dates": ORACLE_SQL["job_silver_viewings"],
    "kpi_hour_summary_merged": ORACLE_SQL["kpi_hour_summary"],
    "kpi_apartment_performance_merged": ORACLE_SQL["kpi_apartment_performance"],
    # 2025-06-27 is a Friday, 2025-06-28 a Saturday.
    "dates_from_calendar": q("SELECT *, DATE '2025-06-28' AS dt FROM clean_viewings WHERE CAST(user_id AS BIGINT) % 2 = 1"),
    "full_detail_bucketed": q("SELECT * FROM wide"),
    "silver_value_counts": q(
        f"SELECT {_DAY_OF} AS dt, count(*) AS \"rows\", count(user_id) AS user_id, count(apartment_id) AS apartment_id, "
        "count(viewed_at) AS viewed_at, count(is_wishlisted) AS is_wishlisted, count(call_to_action) AS call_to_action "
        "FROM clean_viewings GROUP BY 1"),
    "landing_quarantine": q(
        "SELECT " + ", ".join(f"CASE WHEN line IS NULL THEN {c} END AS {c}" for c in VIEWING_COLS.split(", "))
        + f", line, CASE WHEN line IS NULL THEN 'viewing' ELSE 'malformed' END AS kind, dt "
        f"FROM (SELECT *, {_BROKEN} AS line, {_DAY_OF} AS dt FROM raw_viewings)"),
    "stream_hour_windows": q(f"SELECT {CAL_HOUR}, {TRIPLE} FROM {_ALL_HOURS} GROUP BY {CAL_HOUR}"),
    "kpi_failed_load": q(f"SELECT *, DATE '2025-06-27' AS dt FROM ({time_summary('view_hour')})"),
    "display_hour_summary": q(displayed(time_summary("view_hour"), "view_hour NULLS LAST")),
    "display_dayofmonth_summary": q(displayed(time_summary("view_day"), "view_day NULLS LAST")),
    "display_calendar_hour": q(displayed(time_summary(CAL_HOUR, with_top=False), "view_year DESC NULLS LAST, "
                                         "view_month DESC NULLS LAST, view_day NULLS LAST, view_hour NULLS LAST")),
    "display_daily": q(displayed(time_summary(CAL_DAY, with_top=False),
                                 "view_year DESC NULLS LAST, view_month DESC NULLS LAST, view_day NULLS LAST")),
    "display_state": q(displayed(state_city(), "state NULLS LAST, rank_city NULLS LAST")),
    "display_platform": q(displayed(platform(), "total_views DESC NULLS LAST, source NULLS LAST")),
})
