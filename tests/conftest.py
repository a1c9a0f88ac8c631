import json
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent.parent))

from cloudtally.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session("4", shuffle_partitions=4, app="tests")


@pytest.fixture
def land(tmp_path):
    """Write records as a landed page: ``land(entity, records, page)``; returns the landing folder."""

    def write(entity, records, page=1):
        folder = tmp_path / "landing" / entity
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"page-{page:04d}.json").write_text("".join(json.dumps(r) + "\n" for r in records))
        return str(tmp_path / "landing")

    return write


def rows(df):
    return [tuple(r) for r in df.collect()]


@pytest.fixture
def evaluate(spark):
    """Evaluate a column expression once per input row: ``evaluate(schema, rows, column)``."""

    def run(schema, values, column):
        indexed = [(i, *v) for i, v in enumerate(values)]
        df = spark.createDataFrame(indexed, "_i int, " + schema)
        return [r[1] for r in df.select("_i", column.alias("v")).orderBy("_i").collect()]

    return run
