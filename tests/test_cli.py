"""Command-line entry point."""

from tickforge.__main__ import main


def test_list_jobs(capsys):
    assert main(["list"]) == 0
    out = capsys.readouterr().out.split()
    assert "ltp" in out and "historical_for_requests" in out and "stream_bars" in out


def test_unknown_job(capsys):
    assert main(["run", "nope", "--data", "/nowhere", "--out", "/nowhere"]) == 2
