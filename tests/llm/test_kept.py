import pytest

from millrace.llm.common import table
from millrace.llm.queries import QUERIES
from millrace.llm.simhash import keep_one_of_each

SF = "/root/testdata/sf0.001"


def held(spark):
    return spark.sparkContext._jsc.getPersistentRDDs().size(), spark._jsparkSession.sharedState().cacheManager().isEmpty()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_nothing_stays_on_the_executors_disks(spark, name):
    spark.catalog.clearCache()
    assert QUERIES[name](spark, SF).count() > 0
    assert held(spark) == (0, True)


def test_nor_after_the_pipelines_stages(spark):
    assert keep_one_of_each(table(spark, SF, "documents")).count() > 0
    assert held(spark) == (0, True)
