"""Declared columns of the raw tables."""

# Column names and types of the four raw tables and the run log.
RAW_SCHEMAS = {
    "products": (
        "product_id string, product_name string, category string, "
        "cost_price double, list_price double"
    ),
    "customers": (
        "customer_id string, name string, email string, city string, "
        "signup_date string, acquisition_channel string"
    ),
    "orders": (
        "order_id string, customer_id string, product_id string, order_date string, "
        "quantity int, unit_price double, status string"
    ),
    "events": (
        "event_id string, customer_id string, product_id string, event_type string, "
        "event_time string, page string, session_id string"
    ),
}
RUN_LOG_SCHEMA = "run_time string, status string"

# Texts that a CSV field may hold for "no value".
NULL_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)
