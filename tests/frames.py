"""Hand-made logs."""

import datetime as dt
import random

LOG = (
    "customer_id bigint, order_id bigint, product_id bigint, order_date timestamp_ntz, "
    "quantity double, price double, total double, line_number int"
)


def make_log(spark, rows):
    from spendcast.sources.log import with_month

    return with_month(spark.createDataFrame(rows, LOG))


def row(customer, order, date, quantity=1.0, price=1.0, total=None, product=1, line=1):
    day = dt.datetime.strptime(date, "%Y-%m-%d")
    total = quantity * price if total is None else total
    return (customer, order, product, day, quantity, price, total, line)


def skewed_rows(n=1200, seed=3, nulls=False, months=30):
    """One customer, one product and one order hold over a third of the rows."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        hot = i % 5 < 2
        customer = 1 if hot else rng.randrange(2, 25)
        if i % 7 < 3:
            order, day = 5, dt.datetime(2001, 3, 5)
            customer = 1
        else:
            order = 100 + i
            day = dt.datetime(1999, 1, 1) + dt.timedelta(days=rng.randrange(30 * months))
        quantity = float(rng.randrange(1, 9))
        price = rng.randrange(100, 9000) / 100
        total = quantity * price
        if nulls and rng.random() < 0.2:
            total = None
        product = 7 if rng.random() < 0.4 else rng.randrange(8, 40)
        rows.append((customer, order, product, day, quantity, price, total, i))
    return rows
