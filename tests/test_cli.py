"""Command line entry."""

from carestar.__main__ import main


def test_list_prints_every_key(capsys):
    assert main(["list"]) == 0
    keys = capsys.readouterr().out.split()
    assert "kpi_top_diseases" in keys and "stream_bed_occupancy" in keys and len(keys) >= 100
