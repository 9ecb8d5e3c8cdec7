import pytest

from ostraka.llm import catalogue

SQL = catalogue.oracle_sql()
#: A hundred documents can't be mixed to half a hundredth; a thousand can.
TOO_FEW = {"p9_held"}


@pytest.mark.parametrize("name", sorted(set(SQL) - TOO_FEW))
def test_queries_give_the_rows_of_their_sql(agrees, name):
    agrees(catalogue.queries()[name], SQL[name])
