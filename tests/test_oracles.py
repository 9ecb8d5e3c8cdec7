import pytest

from ostraka.plans import catalogue

SQL = catalogue.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_queries_give_the_rows_of_their_sql(agrees, name):
    agrees(catalogue.queries()[name], SQL[name])
