import json
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from marketspark.session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    spark = session(
        "tests", "local[8]", spark__ui__enabled="false", spark__sql__shuffle__partitions="4",
        spark__ui__showConsoleProgress="false", spark__checkpoint__dir=str(folder / "shared"),
        spark__sql__warehouse__dir=str(folder / "warehouse"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@pytest.fixture
def documents(tmp_path):
    """Write one JSON file per value below a dated path; a str is written as it is."""
    def write(*values, root="docs"):
        for i, value in enumerate(values):
            file = tmp_path / root / "2026" / "08" / "24" / f"r{i:03d}.json"
            file.parent.mkdir(parents=True, exist_ok=True)
            file.write_text(value if isinstance(value, str) else json.dumps(value, indent=2))
        return str(tmp_path / root)
    return write
