"""Schemas of the three raw tables and the fixed values of the job."""

from __future__ import annotations

# --- Fixed values (must equal the original job's for equal results) -------
# Raw table schemas.  Times are wall-clock times without a zone, so they are
# declared TIMESTAMP_NTZ (the original declares TIMESTAMP and runs in one
# zone; NTZ keeps hour/day parts independent of the session zone).
VIEWINGS_DDL = ("user_id STRING, apartment_id STRING, viewed_at STRING, "
                "is_wishlisted STRING, call_to_action STRING")
APARTMENTS_DDL = ("id STRING, title STRING, source STRING, price INT, currency STRING, "
                  "listing_created_on TIMESTAMP_NTZ, is_active TINYINT, "
                  "last_modified_timestamp TIMESTAMP_NTZ")
ATTRIBUTES_DDL = ("id STRING, category STRING, body STRING, amenities STRING, "
                  "bathrooms FLOAT, bedrooms FLOAT, fee FLOAT, has_photo STRING, "
                  "pets_allowed STRING, price_display STRING, price_type STRING, "
                  "square_feet INT, address STRING, cityname STRING, state STRING, "
                  "latitude DOUBLE, longitude DOUBLE")

# Silver (cleaned) forms of the three tables and of the full-detail table.
SILVER_VIEWINGS_DDL = ("user_id STRING, apartment_id STRING, viewed_at TIMESTAMP_NTZ, "
                       "is_wishlisted BOOLEAN, call_to_action STRING")
SILVER_APARTMENTS_DDL = ("id STRING, title STRING, source STRING, price INT, currency STRING, "
                         "listing_created_on TIMESTAMP_NTZ, is_active BOOLEAN, "
                         "last_modified_timestamp TIMESTAMP_NTZ")
SILVER_ATTRIBUTES_DDL = ATTRIBUTES_DDL
FULL_DETAIL_DDL = ", ".join([SILVER_VIEWINGS_DDL, SILVER_APARTMENTS_DDL,
                             SILVER_ATTRIBUTES_DDL.removeprefix("id STRING, "),
                             "view_hour INT, view_day INT, view_month INT, view_year INT, is_weekend BOOLEAN"])

# Null fill values by column type.
FILL_STRING = "Unknown"
FILL_TIMESTAMP = "9999-12-31 23:59:59"
FILL_DATE = "9999-12-31"
FILL_NUMBER = 0

# The call to action that counts as a contact.
CONTACT_ACTION = "contact_agent"

# Dedup keys: the dated job keys viewings on three columns, the other
# variants on two; listings and attributes on their id.
VIEWING_KEY = ("user_id", "apartment_id", "viewed_at")
VIEWING_KEY_TWO = ("user_id", "apartment_id")
LISTING_KEY = ("id",)

# Column order of the apartment performance KPI.
APARTMENT_PERFORMANCE_COLUMNS = (
    "apartment_id", "title", "category", "cityname", "state", "source", "price",
    "currency", "is_active", "listing_created_on", "last_modified_timestamp",
    "total_views", "total_wishlists", "total_contact_agent",
)
# --- end of fixed values ----------------------------------------------------

VIEWING_COLUMNS = ("user_id", "apartment_id", "viewed_at", "is_wishlisted", "call_to_action")
TIME_PARTS = ("view_hour", "view_day", "view_month", "view_year")
CALENDAR_HOUR_KEYS = ("view_year", "view_month", "view_day", "view_hour")
CALENDAR_DAY_KEYS = ("view_year", "view_month", "view_day")
