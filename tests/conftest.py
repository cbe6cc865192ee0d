from __future__ import annotations

import pytest

from folioflow.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", "folioflow-tests", **{"spark.sql.shuffle.partitions": "4"})
    yield session
    session.stop()
