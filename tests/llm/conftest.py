from __future__ import annotations

import sys
from pathlib import Path

import pytest
from corpora import ODD, documents

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from mercato.llm.tables import ship_package  # noqa: E402

@pytest.fixture(scope="session")
def llm(spark):
    return ship_package(spark)


@pytest.fixture(scope="session")
def odd(llm):
    return documents(llm, ODD)


@pytest.fixture(scope="session")
def nothing(llm):
    return documents(llm, [])
