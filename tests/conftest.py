from __future__ import annotations

import pathlib
import sys

import pytest

ROOT = pathlib.Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from clickscore.contract import SESSION  # noqa: E402
from clickscore.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return local_session(4)


@pytest.fixture(scope="session")
def sessions(spark):
    from catalog import queries

    return queries.sessions(spark, SMALL)


@pytest.fixture(scope="session")
def unique(spark):
    from catalog import queries

    return queries.unique_sessions(spark, SMALL)


@pytest.fixture(scope="session")
def training(spark):
    from catalog import queries

    return queries.training_rows(spark, SMALL)


@pytest.fixture(scope="session")
def linear(spark):
    from catalog import queries

    return queries.fitted(spark, SMALL, "linear")


@pytest.fixture(scope="session")
def trees(spark):
    from catalog import queries

    return queries.fitted(spark, SMALL, "trees")


TYPICAL = {
    "Administrative": 2, "Administrative_Duration": 59.5, "Informational": 0,
    "Informational_Duration": 0.0, "ProductRelated": 29, "ProductRelated_Duration": 1136.5,
    "BounceRates": 0.0, "ExitRates": 0.0145, "PageValues": 22.5, "SpecialDay": 0.0,
    "Month": "Nov", "VisitorType": "Returning_Visitor", "Weekend": False,
    "OperatingSystems": 2, "Browser": 2, "Region": 1, "TrafficType": 2, "Revenue": True,
}


def frame(spark, *changes: dict, contract=SESSION):
    """Sessions that differ from a typical one in the given fields."""
    rows = [tuple({**TYPICAL, **c}[n] for n in contract.columns) for c in changes]
    ids = [(*r, i) for i, r in enumerate(rows)]
    schema = ", ".join(f"{n} {dict(contract.types)[n].simpleString()}" for n in contract.columns)
    return spark.createDataFrame(ids, f"{schema}, row_id bigint")
