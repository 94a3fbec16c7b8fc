import pytest

from compare import duck, sides
from foliospark.plans.catalogue import ORACLE, QUERIES

D = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    df = QUERIES[name](spark, D)
    if name not in ORACLE:
        assert df.columns
        df.collect()
        return
    ours, theirs = sides(df, duck(D), ORACLE[name])
    assert len(ours) == len(theirs)
    assert ours == theirs


def test_entry_contract(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
