import pytest

from tidemark.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def one(spark):
    """Evaluate a column over one row of given values."""

    def run(column, **values):
        ddl = ", ".join(f"{n} {'string' if v is None or isinstance(v, str) else 'bigint'}" for n, v in values.items())
        df = spark.createDataFrame([tuple(values.values())], ddl) if values else spark.range(1)
        return df.select(column.alias("out")).first()["out"]

    return run
