from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from ledgerline.session import create_session

    from ledgerline.session import shared_root

    session = create_session("ledgerline-tests", master="local[*]", shuffle_partitions=8)
    shared_root(session)  # sets a local checkpoint dir only when none is configured
    yield session
    session.stop()


@pytest.fixture
def fresh_dir(spark):
    from ledgerline.session import work_path

    def make(name: str = "t") -> str:
        return work_path(spark, name)

    return make
