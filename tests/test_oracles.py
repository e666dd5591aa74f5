"""Every query against its SQL on the smallest tables; those without SQL are tested elsewhere and give rows here."""

import pytest

import __spark_entry__ as entry
from helpers import same
from tidelattice.plans import cases, market

CORE = {**cases.QUERIES, **market.QUERIES}


@pytest.mark.parametrize("name", [n for n in CORE if n in entry.oracle_sql()])
def test_equals_sql(name, spark, sf_dir, duck):
    same(CORE[name](spark, sf_dir).toPandas(), duck.sql(entry.oracle_sql()[name]).df())


@pytest.mark.parametrize("name", [n for n in CORE if n not in entry.oracle_sql()])
def test_gives_rows(name, spark, sf_dir):
    df = CORE[name](spark, sf_dir)
    assert df.count() > 0 and len(set(df.columns)) == len(df.columns)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
