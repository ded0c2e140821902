import pytest


@pytest.fixture(scope="session")
def make(spark):
    """Rows to a DataFrame spread over a few partitions."""
    def build(rows, schema, parts=3):
        return spark.createDataFrame(rows, schema).repartition(parts)
    return build


def collected(df):
    return [r.asDict(recursive=True) for r in df.collect()]
