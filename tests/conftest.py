from __future__ import annotations

import os
import sys
import uuid

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from riskflow.schema import INTAKE  # noqa: E402
from riskflow.session import local_session  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    scratch = str(tmp_path_factory.mktemp("scratch"))
    session = local_session(8, "riskflow-tests", **{"spark.checkpoint.dir": scratch})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture
def folder(tmp_path):
    """A path that does not exist yet."""
    return str(tmp_path / uuid.uuid4().hex)


GOOD = {
    "gender": "Female",
    "age": 61,
    "hypertension": 0,
    "heart_disease": 1,
    "ever_married": "Yes",
    "work_type": "Private",
    "Residence_type": "Urban",
    "avg_glucose_level": 95.5,
    "bmi": 28.1,
    "smoking_status": "smokes",
    "id": 7,
}


@pytest.fixture
def records(spark):
    """Builds a typed frame from changes to one good record."""

    def build(*changes: dict):
        rows = [tuple({**GOOD, **change}[name] for name in INTAKE.names) for change in changes]
        return spark.createDataFrame(rows, INTAKE)

    return build


@pytest.fixture
def submissions(spark):
    """The same as submitted text."""

    def build(*changes: dict):
        schema = ", ".join(f"{name} string" for name in INTAKE.names)
        rows = [
            tuple(
                None if value is None else str(value)
                for value in ({**GOOD, **change}[name] for name in INTAKE.names)
            )
            for change in changes
        ]
        return spark.createDataFrame(rows, schema)

    return build
