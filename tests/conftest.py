import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from cohortlens.schema import responses_schema  # noqa: E402
from cohortlens.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session(cores="*", shuffle_partitions=8, app="cohortlens-tests")
    s.conf.set("spark.sql.maxMetadataStringLength", "1000")  # plans show paths whole, however long pytest's folder is
    yield s
    s.stop()


DEFAULTS = {"response_id": 1, "survey_year": 2023, "country": "UK"}


@pytest.fixture
def responses(spark):
    """Build a ``responses`` frame from partial rows; unspecified columns are NULL."""
    schema = responses_schema()

    def make(*rows):
        full = []
        for r in rows:
            d = {**DEFAULTS, **r}
            full.append(tuple(
                (float(d[f.name]) if f.dataType.typeName() == "double" and d.get(f.name) is not None
                 else d.get(f.name))
                for f in schema.fields))
        return spark.createDataFrame(full, schema)

    return make
