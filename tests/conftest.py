import csv
import json
import pathlib

import pytest

from millrace.session import local_session
from millrace.sources.lake import Lake


@pytest.fixture(scope="session")
def spark():
    return local_session(8, memory="6g", app="millrace-tests")


@pytest.fixture()
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"))


@pytest.fixture()
def load_fixture(spark):
    """CSV cells as the text they are (an empty one is ``''``), or a JSON list of objects."""

    def load(name: str):
        path = pathlib.Path(__file__).parent / "fixtures" / name
        if path.suffix == ".json":
            return spark.createDataFrame(json.loads(path.read_text()))
        if path.suffix == ".csv":
            with path.open(newline="") as f:
                return spark.createDataFrame(list(csv.DictReader(f)))
        raise ValueError(f"no fixture loader for {name}")

    return load


@pytest.fixture()
def rows():
    """Collected rows as sorted tuples."""

    def collect(df, *columns):
        chosen = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in chosen.collect()), key=lambda r: [str(v) for v in r])

    return collect
