import os
import sys
from datetime import datetime

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tillstream.sources.schemas import RAW_SCHEMA  # noqa: E402
from tillstream.sources.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, spark__sql__shuffle__partitions="4")
    yield session
    session.stop()


def at(text: str) -> datetime:
    """'01:30' on the first day, or a full time."""
    return datetime.fromisoformat(text if "-" in text else f"2024-01-01 {text}")


def sale(id, time, store="store_1", quantity=1, price=1.0, payment="cash", product="product_1"):
    return (id, store, product, quantity, price, payment, at(time) if time else None)


@pytest.fixture(scope="session")
def sales(spark):
    """Build a sales frame from `sale(...)` rows."""
    return lambda *rows: spark.createDataFrame(list(rows), RAW_SCHEMA)


def rows(frame, *columns):
    picked = frame.select(*columns) if columns else frame
    return sorted((tuple(r) for r in picked.collect()), key=repr)
