from __future__ import annotations

import datetime
import os
import sys

import pytest

os.environ.setdefault("CARTWISE_PARTITIONS", "3")  # tiny tables
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cartwise.session import local_session  # noqa: E402
from cartwise.sources.tables import SCHEMAS, Sources  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(os.environ.get("TEST_CPUS", "8"), "cartwise-tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def ts(text: str | None) -> datetime.datetime | None:
    return None if text is None else datetime.datetime.fromisoformat(text)


def frame(spark, table: str, rows: list[dict]):
    schema = ", ".join(f"{c} {t}" for c, t in SCHEMAS[table].items())
    return spark.createDataFrame([tuple(r.get(c) for c in SCHEMAS[table]) for r in rows], schema)


def sources(spark, **tables: list[dict]) -> Sources:
    """Source tables from dictionaries; missing tables are empty, missing columns NULL."""
    return Sources(**{name: frame(spark, name, tables.get(name, [])) for name in SCHEMAS})


MASTER = (
    "order_id string, customer_unique_id string, order_status string, order_purchase_timestamp timestamp, "
    "order_ym string, order_month int, order_item_id int, product_id string, category_en string, "
    "customer_state string, seller_state string, payment_type string, review_score double, price double, "
    "freight_value double, item_total double, freight_ratio double, delivery_days double, "
    "estimated_days double, delivery_delay double, is_late int"
)


def master(spark, rows: list[dict]):
    """A hand-made master table; unnamed columns get plain defaults."""
    names = [c.split()[0] for c in MASTER.split(", ")]
    full = []
    for n, row in enumerate(rows):
        base = {
            "order_id": f"o{n}",
            "customer_unique_id": "u",
            "order_status": "delivered",
            "order_purchase_timestamp": datetime.datetime(2018, 1, 1) + datetime.timedelta(hours=n),
            "order_item_id": 1,
            "product_id": "p",
            "category_en": "A",
            "customer_state": "S",
            "seller_state": "S",
            "payment_type": "card",
            "review_score": 4.0,
            "price": 10.0,
            "freight_value": 1.0,
            "delivery_days": 5.0,
            "estimated_days": 10.0,
            "delivery_delay": -5.0,
            "is_late": 0,
            **row,
        }
        when = base["order_purchase_timestamp"]
        base.setdefault("order_ym", when and when.strftime("%Y-%m"))
        base.setdefault("order_month", when and when.month)
        base.setdefault(
            "item_total",
            None if base["price"] is None else base["price"] + base["freight_value"],
        )
        full.append(tuple(base.get(c) for c in names))
    return spark.createDataFrame(full, MASTER)
