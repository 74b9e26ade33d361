from __future__ import annotations

import pytest

from starloom.plans.transactions import history, lifecycle

SCHEMA = (
    "transaction_id int, customer_id int, purchase_date date, product_name string, quantity int"
)
PURCHASES = [
    (1, 101, None, "O'Neil", 2), (2, 102, None, "B", 5), (3, 103, None, "O'Neil", 3),
    (4, None, None, "O'Neil", 7), (5, 101, None, "C", 1),
]


@pytest.fixture
def steps(spark):
    return lifecycle(spark.createDataFrame(PURCHASES, SCHEMA), "O'Neil", 101)


def quantities(df):
    return {r.transaction_id: r.quantity for r in df.collect()}


def test_every_state(steps):
    assert [quantities(state) for _, state, _ in steps] == [
        {1: 2, 2: 5, 3: 3, 4: 7, 5: 1},
        {1: 3, 2: 5, 3: 4, 4: 8, 5: 1},
        {2: 5, 3: 4, 4: 8},
        {1: 2, 2: 0, 3: 0, 4: 0, 5: 1},
    ]


def test_history_counts_rows(steps):
    log = [tuple(row) for row in history(steps).orderBy("version").collect()]
    assert log == [
        (0, "WRITE", 5, 5, 0, 0), (1, "UPDATE", 5, 0, 3, 0), (2, "DELETE", 3, 0, 0, 2),
        (3, "MERGE", 5, 2, 3, 0),
    ]
