import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tributary.session import build_session
    s = build_session(app="tributary-tests", master="local[4]", shuffle_partitions=4)
    yield s
    s.stop()


@pytest.fixture
def parse(spark):
    from tributary.operators import envelope

    def _parse(values):
        df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "value string, seq long")
        return {r["seq"]: r for r in envelope.parse_dms(df).collect()}
    return _parse
