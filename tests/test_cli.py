"""The command-line entry (list and sql; ``run`` builds its own session)."""

from __future__ import annotations

from lakemart.__main__ import main


def test_list_and_sql(capsys):
    assert main(["list"]) == 0
    listed = capsys.readouterr().out.split("\n")
    assert any(line.split()[-1:] == ["region_category_revenue"] for line in listed if line.strip())
    assert main(["sql", "day_filter"]) == 0
    assert "o_orderdate >= TIMESTAMP '1995-01-14'" in capsys.readouterr().out
    assert main(["sql", "no_such_key"]) == 2
