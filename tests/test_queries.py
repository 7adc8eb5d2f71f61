import pytest
from compare import compare

import __spark_entry__ as contract
from query_sql import statements
from shelfscan.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"
ORACLE = statements()


def test_every_query_but_the_fuzzy_assignment_has_sql():
    assert set(QUERIES) - set(ORACLE) == {"fuzzy_matches", "match_coverage_fuzzy"} and set(ORACLE) <= set(QUERIES)


def test_entry(spark):
    assert contract.entry(spark).count() == 20


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_rows_equal_the_sql(spark, name):
    problem, _ = compare(spark, SF, name, QUERIES[name], ORACLE[name])
    assert problem == ""


def test_no_cartesian_products_in_row_level_plans(spark):
    for name in ("match_all", "clean_listings", "rppi_rows", "price_dispersion", "replicate_cities"):
        plan = contract.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
