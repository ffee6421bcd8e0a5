import pytest

from tests.compare import session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    spark = session(4)
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    yield spark


@pytest.fixture
def values(spark):
    """Evaluate a Column over one string column ``t``, one result per input."""

    def run(inputs, column):
        rows = [(i, t) for i, t in enumerate(inputs)]
        df = spark.createDataFrame(rows, "i int, t string")
        return [r.v for r in df.select("i", column.alias("v")).orderBy("i").collect()]

    return run
