"""The command line: load files, then print the page."""

from conftest import SF_SMALL
from usagelens import cli
from usagelens.operators.envelopes import encode_facts, pack_envelopes, write_envelopes
from usagelens.sources.employees import write_employee_csv
from usagelens.sources.standin import standin_tables


def test_load_then_page(spark, scratch, capsys):
    t = standin_tables(spark, SF_SMALL)
    write_envelopes(pack_envelopes(encode_facts(t)), f"{scratch}/logs")
    write_employee_csv(t.employees, f"{scratch}/emp")
    root = f"{scratch}/db"
    assert cli.main(["load", "--root", root, "--telemetry", f"{scratch}/logs", "--employees", f"{scratch}/emp"]) == 0
    out = capsys.readouterr().out
    assert "total_events    :        1,000" in out and "malformed_lines :            0" in out
    assert cli.main(["page", "--root", root, "--shared", "--only", "kpi", "top_engineers"]) == 0
    out = capsys.readouterr().out
    assert "== kpi" in out and "total_api_calls" in out and "== top_engineers" in out
    assert cli.main(["page", "--root", root, "--options"]) == 0
    assert "min_date" in capsys.readouterr().out
