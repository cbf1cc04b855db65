"""Tasks of the fact joins stay small whatever the size of the tables, unless the session says otherwise."""

import pytest

from shiplens import session
from shiplens.sources import tables as tb

KEY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


@pytest.fixture()
def advisory(spark):
    before = spark.conf.get(KEY)
    spark.conf.unset(KEY)
    yield spark
    spark.conf.set(KEY, before)


def test_the_view_bounds_its_join_tasks(advisory, sf_dir):
    assert advisory.conf.get(KEY) == "67108864b"
    n = tb.shipments(advisory, sf_dir).count()
    assert advisory.conf.get(KEY) == session.TASK_BYTES and n > 0


def test_a_given_size_is_kept(advisory, sf_dir):
    advisory.conf.set(KEY, "4m")
    tb.shipments(advisory, sf_dir)
    assert advisory.conf.get(KEY) == "4m"
