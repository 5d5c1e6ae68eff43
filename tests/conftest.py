import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

FIXTURE_CSV = """1,Alpha,purchase,1.0
1,Alpha,play,3.0
1,"Beta, Deluxe",purchase,1.0
2,Alpha,purchase,1.0
2,Alpha,play,0.5
10,"Beta, Deluxe",purchase,1.0
10,Gamma,purchase,1.0
10,Gamma,play,7.0
9,"Beta, Deluxe",play,2.0
9,Delta,purchase,1.0
"""


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    from ludeme.plans.session import ensure_checkpoint_dir
    s = (SparkSession.builder.master("local[*]")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.adaptive.enabled", "true")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s)
    yield s


@pytest.fixture(scope="session")
def fixture_csv():
    d = tempfile.mkdtemp(prefix="ludeme-fixture-")
    p = os.path.join(d, "interactions.csv")
    with open(p, "w") as f:
        f.write(FIXTURE_CSV)
    return p


@pytest.fixture(scope="session")
def log10(spark, fixture_csv):
    from ludeme.sources.interactions import read_interactions_csv
    return read_interactions_csv(spark, fixture_csv)
