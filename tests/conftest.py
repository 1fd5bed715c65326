import pytest

from screenmart.catalog import Catalog, Options
from screenmart.session import get_session
from screenmart.sources.schemas import TABLES, struct_type

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_session(
        "screenmart-tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "6g",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def make_catalog(spark):
    """Catalog over given rows; tables that are not given are empty."""

    def make(options: Options | None = None, **tables) -> Catalog:
        def reader(name):
            schema = struct_type(name)

            def read():
                rows = [tuple(row.get(f.name) for f in schema) for row in tables.get(name, [])]
                return spark.createDataFrame(rows, schema)

            return read

        return Catalog(spark, {name: reader(name) for name in TABLES}, options or Options())

    return make


def param(key, value):
    """An event parameter in the field its type belongs to."""
    kinds = {str: 0, int: 1, float: 2}
    record = [None, None, None]
    record[kinds[type(value)]] = value
    return (key, tuple(record))


def event(name, ts=1_700_000_000_000_000, day="20260801", user="u1", items=(), batch=0, **params):
    return {
        "event_date": day,
        "event_timestamp": ts,
        "event_name": name,
        "user_pseudo_id": user,
        "event_bundle_sequence_id": 1,
        "batch_event_index": batch,
        "event_params": [param(k, v) for k, v in params.items() if v is not None],
        "items": [tuple(i) for i in items],
    }
