import pytest
from compare import compare

from shelfscan.llm import registry


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_rows_equal_the_sql(spark, name):
    problem, n = compare(spark, "/root/testdata/sf0.001", name, registry.queries()[name], registry.oracle_sql()[name])
    assert problem == "" and n > 20
