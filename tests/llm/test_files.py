"""Folders in the schemes that Spark has, without a server: the file system is looked up only."""

import pytest
from pyarrow import fs

from farebox.llm import files


@pytest.fixture
def asked(monkeypatch):
    """What Arrow is asked to open."""
    seen = []

    class Fake:
        @staticmethod
        def from_uri(uri):
            seen.append(uri)
            return "system", uri

    monkeypatch.setattr(files.fs, "FileSystem", Fake)
    return seen


@pytest.mark.parametrize(
    ("folder", "opened"),
    [
        ("s3a://bucket/a/b", "s3://bucket/a/b"), ("s3n://bucket/a", "s3://bucket/a"),
        ("s3://bucket/a", "s3://bucket/a"), ("dbfs:/mnt/a", "/dbfs/mnt/a"),
        ("dbfs:///mnt/a", "/dbfs/mnt/a"), ("hdfs://host:9000/a", "hdfs://host:9000/a"),
        ("file:///a/b", "/a/b"), ("file:/a/b", "/a/b"), ("/a/b", "/a/b"), ("gs://b/a", "gs://b/a"),
    ],
)
def test_schemes(asked, folder, opened):
    files.opened(folder)
    assert asked == [opened]


def test_local_folder(tmp_path):
    system, path = files.opened(f"file://{tmp_path}")
    assert isinstance(system, fs.LocalFileSystem) and path == str(tmp_path)
