from __future__ import annotations

import datetime as dt
import tempfile

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import SparkSession

from sluicegate import IngestSettings, Landing, RunLog
from sluicegate.queries.staging import new_layout

SF_DIR = "/root/testdata/sf0.001"
DAY = dt.date(2026, 2, 10)


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="run-"))
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="run-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def layout(spark):
    return new_layout(spark)


@pytest.fixture
def log(spark, layout):
    return RunLog("tests", "unit", layout.table("ua", "logs"), spark, source="tests")


class Box:
    """A landing and an archive directory to put small files into."""

    def __init__(self, spark, layout, root):
        self.spark = spark
        self.layout = layout
        self.landing_dir = root / "landing"
        self.archive_dir = root / "archive"
        self.landing_dir.mkdir()
        self.archive_dir.mkdir()

    @property
    def landing(self) -> Landing:
        return Landing(self.spark, str(self.landing_dir))

    def put(self, name: str, data: dict | pa.Table) -> str:
        path = self.landing_dir / name
        pq.write_table(data if isinstance(data, pa.Table) else pa.table(data), path)
        return str(path)

    def meta(self, table: str, values: dict) -> str:
        return self.put(f"{table}.meta", {"test_name": list(values), "value": list(values.values())})

    def settings(self, **changes) -> IngestSettings:
        base = {"layout": self.layout, "landing_path": str(self.landing_dir),
                "archive_path": str(self.archive_dir), "archive_day": DAY}
        return IngestSettings(**(base | changes))

    def landed(self) -> list[str]:
        return sorted(p.name for p in self.landing_dir.iterdir() if not p.name.startswith("."))

    def archived(self) -> list[str]:
        return sorted(p.name for p in self.archive_dir.iterdir() if not p.name.startswith("."))


@pytest.fixture
def box(spark, layout, tmp_path):
    return Box(spark, layout, tmp_path)
