from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from weatherloom.session import CHECKPOINT_SETTING, build_session

    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    if not session.conf.get(CHECKPOINT_SETTING, None):
        session.conf.set(CHECKPOINT_SETTING, str(tmp_path_factory.mktemp("shared")))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SMALL


SEED = [
    # sensor_id, temperature, humidity, pressure, location
    ("TEMP_001", 23.5, 65.2, 1013.25, "Oficina Principal"),
    ("TEMP_002", 21.8, 58.7, 1012.85, "Sala de Servidores"),
    ("TEMP_003", 25.1, 72.3, 1014.10, "Almacén"),
    ("TEMP_004", 19.6, 45.8, 1011.95, "Exterior"),
    ("TEMP_005", 22.3, 62.1, 1013.50, "Laboratorio"),
]


@pytest.fixture(scope="session")
def seed(spark):
    """Five readings whose results can be worked out by hand."""
    return spark.createDataFrame(SEED, "sensor_id string, temperature double, humidity double, pressure double, location string")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="session")
def as_rows():
    return rows


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="session")
def plan():
    return plan_of
