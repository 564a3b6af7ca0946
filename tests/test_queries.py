import pytest
from compare import same
from conftest import SMALLEST

from structmill.plans.tables import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, SMALLEST).toPandas()
    if name in ORACLES:
        same(got, duck.execute(ORACLES[name]).df())
    else:
        assert len(got)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
