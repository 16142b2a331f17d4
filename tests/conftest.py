import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pairlab.session import builder, ship  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        builder("pairlab-tests")
        .master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield ship(session)
    session.stop()


LONG = "This is a test article with enough words to be kept. " * 10


@pytest.fixture(scope="session")
def pairs_small(spark):
    """Tagged, null article, null summary, too short, copies in and across splits, equal only after cleaning."""
    rows = [
        (1, "train", "(CNN) -- " + LONG, "a summary that is long enough"),
        (2, "train", None, "a summary that is long enough"),
        (3, "train", LONG, None),
        (4, "train", "short", "a summary that is long enough"),
        (5, "train", "(CNN) -- " + LONG, "a summary that is long enough"),
        (6, "test", "(CNN) -- " + LONG, "a summary that is long enough"),
        (7, "train", LONG, "a summary that is long enough"),
        (8, "train", LONG, "too short"),
    ]
    return spark.createDataFrame(rows, "id long, split string, article string, highlights string")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
