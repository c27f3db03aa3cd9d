from __future__ import annotations

import os
import sys
import uuid

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lakeshore.context import PipelineContext  # noqa: E402
from lakeshore.session import local_test_session  # noqa: E402

SF_SMOKE = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    session = local_test_session(partitions=4)
    yield session
    session.stop()


@pytest.fixture
def ctx():
    """A fresh company name per test, so namespaces never collide."""
    return PipelineContext(company=f"t{uuid.uuid4().hex[:10]}", env="dev")


def rows(df, *cols):
    """Collected rows as sorted tuples (order-insensitive comparison)."""
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()), key=repr)
