from __future__ import annotations

import uuid

import pytest

from chatlake.session import build_session
from chatlake.sources.store import MessageStore

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = build_session(
        app="chatlake-tests",
        master="local[8]",
        **{
            "spark_sql_shuffle_partitions": "4",
            "spark_default_parallelism": "3",
            "spark_ui_enabled": "false",
            "spark_sql_warehouse_dir": str(base / "warehouse"),
            "spark_checkpoint_dir": str(base / "checkpoint"),
            "spark_driver_host": "127.0.0.1",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def store(spark, tmp_path):
    made = MessageStore(spark, f"log_{uuid.uuid4().hex[:12]}", str(tmp_path / "store"))
    made.create()
    return made


@pytest.fixture
def derived(spark):
    from chatlake.sources.derived import derived_source

    return derived_source(spark, FOLDER)
