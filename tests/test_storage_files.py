"""Files that a query writes and reads back: as many as the rows need, none that grows with the table."""

import glob

import pytest

from threadmill.plans import storage


@pytest.fixture
def folders(monkeypatch):
    made = []
    real = storage.scratch
    monkeypatch.setattr(storage, "scratch", lambda s, kind: made.append(real(s, kind)) or made[-1])
    return made


def files(path):
    return [f for f in glob.glob(path.removeprefix("file://") + "/**/part-*", recursive=True)]


def test_threads_share_files(spark, sf, folders):
    n = spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id").distinct().count()
    for query in (storage.scan_jsonl_file_atomic, storage.scan_json_dir):
        query(spark, sf)
        assert 1 <= len(files(folders[-1])) <= 10 < n


def test_documents_read_as_a_whole_stay_small(spark, sf, folders, monkeypatch):
    monkeypatch.setattr(storage, "LOG_STEPS", 100)
    monkeypatch.setattr(storage, "FILE_ROWS", 20)
    got = storage.scan_trainer_state(spark, sf)
    assert len(files(folders[-1])) >= 10 and got.count() == got.select("step").distinct().count() == 1000
    got = storage.scan_manifest(spark, sf)
    assert len(files(folders[-1])) >= 4 and got.count() == spark.read.parquet(f"{sf}/conversations.parquet").count()
