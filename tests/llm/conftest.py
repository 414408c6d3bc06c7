from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import pytest


@pytest.fixture(autouse=True)
def _workers(request):
    """Python workers get the package whatever folder they start in."""
    if "spark" in request.fixturenames:
        from riskmart.llm.common import ship

        ship(request.getfixturevalue("spark"))
