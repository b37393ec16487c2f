import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from residua import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("residua-tests", cores=8, shuffle_partitions=4)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def planted(spark):
    """Benign rows on a plane, malicious rows off it, two categories; deterministic."""
    import numpy as np

    rng = np.random.default_rng(7)
    rows = []
    for i in range(3000):
        bad = i % 10 == 0
        a, b = rng.normal(size=2)
        c = a + b + (rng.normal(scale=4.0) + 6.0 if bad else rng.normal(scale=0.05))
        rows.append((i, "Malicious" if bad else "Benign", "scan" if bad else "-", float(a), float(b), float(c), "tcp" if i % 3 else "udp"))
    schema = "record_index long, label string, detailed_label string, a double, b double, c double, proto string"
    return spark.createDataFrame(rows, schema)
