"""Every analysis of the catalog (job runner, SQL views) runs on the smallest fixture."""

import datetime as dt

import pytest

from conftest import SF_SMALL
from orderlens.plans.catalog import jobs
from orderlens.sources.fixture import transactions


@pytest.fixture(scope="module")
def tx(spark):
    df = transactions(spark, SF_SMALL).cache()
    yield df
    df.unpersist()


@pytest.mark.parametrize("name", sorted(jobs()))
def test_catalog_job_runs(tx, name):
    df = jobs()[name](tx, dt.date(2001, 8, 1))
    assert df.count() >= 1 and len(df.columns) >= 1
