from __future__ import annotations

import sys
from datetime import date, datetime
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from storefront_analytics.plans.storefront import RunSettings, Storefront  # noqa: E402
from storefront_analytics.session import local_session  # noqa: E402
from storefront_analytics.sources.raw_tables import RAW_SCHEMAS, raw_schema  # noqa: E402


@pytest.fixture(scope="session")
def shared_dir(tmp_path_factory):
    return tmp_path_factory.mktemp("shared")


@pytest.fixture(scope="session")
def spark(shared_dir):
    settings = {"spark.sql.shuffle.partitions": "4", "spark.checkpoint.dir": f"file://{shared_dir}/"}
    session = local_session(4, "storefront-tests", **settings)
    yield session
    session.stop()


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)


@pytest.fixture
def raw_table(spark):
    """Raw table from partial rows; columns not given are null."""

    def build(name: str, rows: list[dict]):
        columns = raw_schema(name).names
        return spark.createDataFrame([tuple(r.get(c) for c in columns) for r in rows], raw_schema(name))

    return build


@pytest.fixture
def shop(raw_table):
    """Storefront over hand-made rows."""

    def build(**tables):
        raw = {name: raw_table(name, tables.get(name, [])) for name in RAW_SCHEMAS}
        return Storefront(raw, RunSettings(as_of=date(2024, 1, 25), run_at=datetime(2024, 6, 1)))

    return build


def rows(frame, *order: str) -> list[dict]:
    if order:
        frame = frame.orderBy(*order)
    return [r.asDict() for r in frame.collect()]
