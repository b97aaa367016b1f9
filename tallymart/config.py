"""Fixed values and default parameters of the retail model."""

# Order status, segment, risk and record labels.
COMPLETED = "completed"
ORDER_STATUSES = ("completed", "returned", "pending")
PRODUCT_CATEGORIES = ("Electronics", "Apparel", "Home", "Beauty", "Sports")
SEGMENTS = ("Champions", "Loyal", "At Risk", "Lost")
RISK_BANDS = ((0.75, "High"), (0.50, "Medium"))
LOWEST_RISK = "Low"
ALL_RISKS = "All"
ACTUAL = "actual"
FORECAST = "forecast"

# Default parameters.
CHURN_AFTER_DAYS = 90
DAYS_PER_MONTH = 30
LABEL_THRESHOLD = 0.5
CLUSTERS = 4
CLUSTER_STARTS = 10
TEST_SHARE = 0.2
SEED = 42
FORECAST_DAYS = 30
HISTOGRAM_BINS = 30
