"""Hand-made raw tables that hold every edge case of the staging and mart rules."""

from tallymart.sources.schemas import RAW_SCHEMAS

# p3 is sold below cost, p4 has no id
PRODUCTS = [
    ("p1", "Lamp", "Home", 60.0, 100.0),
    ("p2", "Ball", "Sports", 10.0, 33.33),
    ("p3", "Mug", "Home", 50.0, 50.0),
    (None, "Ghost", "Home", 1.0, 2.0),
]

# c4 has no email, c5 shares c1's, c6 never orders
CUSTOMERS = [
    ("c1", "Ann", "ANN@Example.com", "Pune", "2024-01-01", "email"),
    ("c2", "Bob", "bob@example.com", "Delhi", "2024-01-02", "organic"),
    ("c3", "Cy", "cy@example.com", None, "2024-03-11", None),
    ("c4", "Di", None, "Pune", "2024-01-04", "email"),
    ("c5", "Eve", "ann@example.com", "Pune", "2024-01-05", "referral"),
    ("c6", "Flo", "flo@example.com", "Pune", "2024-01-06", "referral"),
    (None, "Gus", "gus@example.com", "Pune", "2024-01-06", "referral"),
]

ORDERS = [
    ("o1", "c1", "p1", "2024-02-01", 1, 0.01, "completed"),
    ("o2", "c1", "p1", "2024-02-01", 1, 0.02, "completed"),  # mean 0.015: half a cent
    ("o3", "c1", "p2", "2024-02-02", 3, 3.333, "completed"),  # 9.999
    ("o3", "c2", "p2", "2024-02-02", 2, 10.0, "completed"),  # same order id
    ("o4", "c2", "p3", "2024-02-03", 1, 45.5, "completed"),  # unknown product
    ("o5", "c9", "p1", "2024-02-03", 1, 90.0, "completed"),  # unknown customer
    ("o5", "c8", "p1", "2024-02-04", 1, 90.0, "pending"),  # same order, another unknown one
    ("o6", "c4", "p9", "2024-02-04", 2, 5.0, "completed"),  # both unknown
    ("o7", "c3", "p1", "2024-03-10", 1, 80.0, "returned"),
    ("o8", "c3", "p2", "2024-03-10", 1, 30.0, None),
    ("o9", "c5", "p2", "2024-03-10", 4, 30.25, "completed"),
    ("o10", "c5", "p2", "2024-03-10", 0, 30.0, "completed"),  # no quantity
    ("o11", "c5", "p2", "2024-03-10", 1, 0.0, "completed"),  # no price
    ("o12", None, "p2", "2024-03-10", 1, 30.0, "completed"),
    (None, "c1", "p2", "2024-03-10", 1, 30.0, "completed"),
    ("o13", "c1", None, "2024-03-09", 1, 12.5, "completed"),
]

EVENTS = [
    ("e1", "c1", "p1", "page_view", "2024-02-01 10:00:00", "/product/p1", "S1"),
    ("e2", "c1", "p1", "purchase", "2024-02-01 23:59:59", "/product/p1", "S1"),
    ("e3", "c2", "p2", "page_view", "2024-02-02 00:00:00", "/product/p2", "S2"),
    (None, "c2", "p2", "page_view", "2024-02-02 00:00:00", "/product/p2", "S2"),
]


def raw_tables(spark):
    rows = {"products": PRODUCTS, "customers": CUSTOMERS, "orders": ORDERS, "events": EVENTS}
    return {n: spark.createDataFrame(r, RAW_SCHEMAS[n]) for n, r in rows.items()}


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()] if order else sorted(
        (tuple(r) for r in df.collect()), key=repr
    )
