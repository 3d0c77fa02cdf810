import pytest


@pytest.fixture(autouse=True, scope="package")
def few_partitions(spark):
    """The tables here are tiny; three partitions show what crosses them."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)
