"""The scheduled-job entry points: refresh twice, then the questions over gold."""

from strata import cli
from strata.sources.tables import read_layer
from test_refresh import write_batch


def test_cli_refresh_and_questions(spark, tmp_path, capsys):
    write_batch(tmp_path / "src", 1)
    root = str(tmp_path / "wh")
    assert cli.main(["refresh", "--src", str(tmp_path / "src"), "--root", root,
                     "--batch-ts", "2024-01-01T04:00:00", "--version", "v1"]) == 0
    assert cli.main(["refresh", "--src", str(tmp_path / "src"), "--root", root,
                     "--batch-ts", "2024-01-02T04:00:00", "--version", "v2"]) == 0
    # the same batch again changes nothing: keys and stamps stay as loaded first
    patients = read_layer(spark, root, "silver", "patients").collect()
    assert {r.updated_at.day for r in patients} == {1}
    assert cli.main(["questions", "--root", root]) == 0
    out = capsys.readouterr().out
    assert "q01_per_year" in out and "q10_most_readmissions" in out
