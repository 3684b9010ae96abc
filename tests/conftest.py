import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tools")]

from ebbtide.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("shared")
    session = local_session(8, "6g", **{
        "spark.checkpoint.dir": str(folder / "checkpoints"),
        "spark.sql.warehouse.dir": str(folder / "warehouse"),
        "spark.sql.maxMetadataStringLength": "2000",
    })
    yield session
    session.stop()


@pytest.fixture(scope="session")
def lake(spark):
    from ebbtide.plans.registry import lake_of

    return lake_of(spark, SMALL)


@pytest.fixture
def rows(spark):
    """Frame of a declared schema from dicts; text is cast, other columns are NULL."""

    def make(schema, *records):
        text = spark.createDataFrame(
            [[r.get(n) and str(r[n]) if r.get(n) != "" else "" for n in schema.names] for r in records],
            ", ".join(f"{n} string" for n in schema.names),
        )
        return text.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])

    return make
