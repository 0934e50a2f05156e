"""Every registered query against its SQL, and the queries without SQL for their shape."""

import pytest
from compare import assert_same

from helixframe.plans import registry


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_query_equals_sql(spark, sf, oracle, name):
    assert_same(registry.QUERIES[name](spark, sf).toPandas(), oracle(registry.SQL[name]))


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.SQL)))
def test_query_has_rows(spark, sf, name):
    assert registry.QUERIES[name](spark, sf).count() > 0


@pytest.mark.parametrize("partitions", ["1", "7"])
def test_partitions_do_not_matter(spark, sf, oracle, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        for name in ("template_merge", "neighbor_band_rates", "junction_support_vote"):
            assert_same(registry.QUERIES[name](spark, sf).toPandas(), oracle(registry.SQL[name]))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
