import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"
DATA = Path("/root/testdata")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from threadmill.session import session

    shared = tmp_path_factory.mktemp("shared")
    s = session("local[4]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false", spark__ui__showConsoleProgress="false", spark__driver__memory="6g", spark__checkpoint__dir=f"file://{shared}", spark__sql__warehouse__dir=f"{shared}/warehouse")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return str(DATA / "sf0.001")


@pytest.fixture(scope="session")
def duck(sf):
    import duckdb

    con = duckdb.connect()
    for p in sorted(Path(sf).glob("*.parquet")):
        con.execute(f"create view {p.stem} as select * from '{p}'")
    return con
