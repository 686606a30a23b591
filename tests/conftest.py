import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from marginalia.session import ensure_checkpoint_dir, local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session("8", "4")
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s)
    return s


@pytest.fixture(scope="session")
def one(spark):
    """Value of a column expression over literal arguments."""
    from pyspark.sql import functions as F

    def run(build, *values):
        names = [f"c{i}" for i in range(len(values))]
        df = spark.createDataFrame([tuple(values)], ", ".join(f"{n} string" for n in names))
        return df.select(build(*[F.col(n) for n in names]).alias("v")).first()["v"]

    return run
