import sys

import pytest

from martloom import __main__ as cli
from martloom.sources import paths
from tests.test_pipeline import FILES, write_files


def run(monkeypatch, *args):
    monkeypatch.setattr(sys, "argv", ["martloom", *args])
    cli.main()


def test_run_and_report(spark, tmp_path, monkeypatch, capsys):
    raw, storage = write_files(tmp_path / "raw", FILES), str(tmp_path / "storage")
    run(monkeypatch, "run", "--raw", raw, "--storage", storage)
    assert capsys.readouterr().out.strip().endswith("SUCCESS")
    run(monkeypatch, "report", "summary", "--storage", storage)
    assert "65.25" in capsys.readouterr().out
    run(monkeypatch, "report", "top_products", "--storage", storage, "--limit", "1")
    assert "books" in capsys.readouterr().out
    run(monkeypatch, "report", "reject_reasons", "--storage", storage, "--table", "orders")
    assert "null_order_id" in capsys.readouterr().out


def test_prune_names_the_deleted_runs(spark, tmp_path, monkeypatch, capsys):
    raw, storage = write_files(tmp_path / "raw", FILES), str(tmp_path / "storage")
    done = []
    for _ in range(2):
        run(monkeypatch, "run", "--raw", raw, "--storage", storage)
        done.append(capsys.readouterr().out.split()[0])
    run(monkeypatch, "prune", "--storage", storage)
    assert capsys.readouterr().out.split() == done[:1]
    run(monkeypatch, "report", "summary", "--storage", storage)
    assert "65.25" in capsys.readouterr().out


def test_a_report_that_needs_a_table_says_so(monkeypatch, capsys, tmp_path):
    with pytest.raises(SystemExit):
        run(monkeypatch, "report", "rejected", "--storage", str(tmp_path))
    assert "needs --table" in capsys.readouterr().err


def test_a_failing_run_exits_with_an_error(spark, tmp_path, monkeypatch):
    with pytest.raises(FileNotFoundError):
        run(monkeypatch, "run", "--raw", str(tmp_path / "no"), "--storage", str(tmp_path / "s"))


class Session:
    """Just the settings that decide where shared data goes."""

    def __init__(self, master, folder=None):
        self.conf = {"spark.checkpoint.dir": folder} if folder else {}
        self.sparkContext = self
        self.master = master
        self.applicationId = "app"


def test_shared_folder_follows_the_cluster_setting():
    a = paths.shared_folder(Session("yarn", "hdfs://shared/check"))
    b = paths.shared_folder(Session("yarn", "hdfs://shared/check"))
    assert a.startswith("hdfs://shared/check/martloom/") and a != b
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        paths.shared_folder(Session("yarn"))
    assert paths.shared_folder(Session("local[2]")).startswith("/")


def test_joining_paths():
    assert paths.join("s3a://bucket/x/", "/a/", "b") == "s3a://bucket/x/a/b"
    assert paths.join("/", "tmp") == "/tmp"
