"""File contracts of the six extracts.

Date-like text columns that may hold blanks or junk stay STRING here; staging
casts them. Schemas are explicit, so reading never needs a second pass.
"""

from __future__ import annotations

CUSTOMERS = (
    "customer_id bigint, customer_name string, email string, signup_date date, region string, "
    "country string, acquisition_channel string, plan string, company_size int, industry string, "
    "is_high_value_seed int"
)
ORDERS = (
    "order_id bigint, customer_id bigint, order_ts timestamp_ntz, gross_amount double, "
    "discount_pct double, net_amount double, num_items int, channel string, status string"
)
SUBSCRIPTIONS = (
    "subscription_id bigint, customer_id bigint, plan string, mrr double, start_date date, "
    "status string, churn_date string, months_active int, billing_interval string"
)
WEB_SESSIONS = (
    "session_id string, session_ts timestamp_ntz, channel string, device string, landing_page string, "
    "pages_viewed int, duration_sec int, converted int, customer_id string"
)
MARKETING_SPEND = (
    "spend_date date, channel string, region string, spend double, impressions bigint, clicks bigint"
)
EVENTS_NESTED = (
    "event_id bigint, customer_id bigint, event_type string, event_ts timestamp_ntz, "
    "properties struct<platform:string,app_version:string,session_len_sec:bigint,feature:string>"
)

RAW_SCHEMAS = {
    "customers": CUSTOMERS,
    "orders": ORDERS,
    "subscriptions": SUBSCRIPTIONS,
    "web_sessions": WEB_SESSIONS,
    "marketing_spend": MARKETING_SPEND,
    "events": EVENTS_NESTED,
}

#: Fields of the nested ``properties`` object and the types they are landed as.
EVENT_FIELDS = {
    "platform": "string",
    "app_version": "string",
    "session_len_sec": "bigint",
    "feature": "string",
}
