from __future__ import annotations

import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, os.path.dirname(HERE))
sys.path.insert(0, HERE)

from tablecraft.session import local_session  # noqa: E402

TESTDATA = os.environ.get("TABLECRAFT_TESTDATA", "/root/testdata")


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "tablecraft-tests", **{"spark.ui.showConsoleProgress": "false"})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return f"{TESTDATA}/sf0.001"


@pytest.fixture(scope="session")
def tables(spark, folder):
    from tablecraft.plans.registry import Tables

    return Tables(spark, folder)
