import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

FIXTURES = ROOT / "tests" / "fixtures"


@pytest.fixture(scope="session")
def spark():
    from yearloom.session import build_session

    # plans name the files they scan in full, however long the path of the temporary folder
    s = build_session("local[4]", app="yearloom-tests", shuffle_partitions=8, extra={"spark.sql.maxMetadataStringLength": "2000"})
    yield s
    s.stop()


def rows(df, order=None):
    """Collected rows as tuples, sorted (missing values first)."""
    out = [tuple(r) for r in df.collect()]
    return sorted(out, key=lambda t: tuple((v is not None, str(v)) for v in t))
