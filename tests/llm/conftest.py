from __future__ import annotations

import pytest


@pytest.fixture(autouse=True)
def small_settings(spark):
    """Few partitions for small inputs, and Arrow batches small enough that groups cross them."""
    wanted = {"spark.sql.shuffle.partitions": "4", "spark.sql.execution.arrow.maxRecordsPerBatch": "97"}
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)
