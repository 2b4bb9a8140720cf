"""Every registered query runs on the smallest tables and agrees with its SQL."""

import check
import pytest

from folio.plans import catalog

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return check.connect(SF)


# every query is in the run: stacking fits its sixty base models in shared passes
LONG: set[str] = set()


@pytest.mark.parametrize("name", sorted(set(catalog.ORACLES) - LONG))
def test_query_agrees_with_sql(spark, duck, name):
    got = catalog.QUERIES[name](spark, SF).toPandas()
    want = duck.execute(catalog.ORACLES[name]).df()
    assert check.compare(got, want).startswith("ok")


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLES) - {"legacy_confusion"}))
def test_query_without_sql_gives_rows(spark, name):
    assert catalog.QUERIES[name](spark, SF).count() > 0
