import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("notemask-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="session")
def seed_gazetteers(spark):
    """Lookup tables from the seed rows alone."""
    from notemask import build_gazetteers
    from notemask.operators.gazetteers import literal_rows
    from notemask.plans import fixtures as fx
    from notemask.sources.readers import CITY_COLUMNS, EXTRA_CITY_COLUMNS

    return build_gazetteers(
        literal_rows(spark, ["name"], [(n,) for n in fx.SEED_NAMES]),
        literal_rows(spark, ["state"], [(s,) for s in fx.SEED_STATES]),
        literal_rows(spark, ["ZIP"], [(z,) for z in fx.SEED_ZIPS]),
        literal_rows(spark, CITY_COLUMNS, fx.SEED_CITIES),
        literal_rows(spark, EXTRA_CITY_COLUMNS, fx.SEED_EXTRA_CITIES),
    )


@pytest.fixture(scope="session")
def seed_lexicon(seed_gazetteers):
    return seed_gazetteers.lexicon()
