import uuid

import hypothesis
import pytest
from pyspark.sql import SparkSession

from lakelayers.names import TableRef
from lakelayers.sinks.tables import create_database

# A first Spark job or a busy machine makes single examples slow.
hypothesis.settings.register_profile("patient", deadline=None)
hypothesis.settings.load_profile("patient")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[4]")
        .appName("lakelayers-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(folder / "warehouse"))
        .config("spark.checkpoint.dir", str(folder / "checkpoints"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def table(spark, tmp_path):
    """A factory of table names in a new database below the test's folder."""
    database = f"test_{uuid.uuid4().hex[:12]}"
    create_database(spark, database, location=str(tmp_path / database))
    return lambda name: TableRef(database, name)


@pytest.fixture
def values(spark):
    """Results of column expressions over literal texts, in input order."""

    def evaluate(texts, expression, kind="string"):
        frame = spark.createDataFrame(list(enumerate(texts)), f"i int, v {kind}")
        return [row[0] for row in frame.orderBy("i").select(expression).collect()]

    return evaluate
