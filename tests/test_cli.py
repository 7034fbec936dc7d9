import pytest

from ledgerlake.__main__ import main, parse
from tests.conftest import claims_file


def test_parse_requires_months():
    with pytest.raises(SystemExit):
        parse(["silver", "--base", "/x"])


def test_labels_needs_one_kind_of_input():
    for more in ([], ["--label-file", "f", "--code-lists", "a", "--lexicon", "b", "--complements", "c"], ["--code-lists", "a"]):
        with pytest.raises(SystemExit):
            parse(["labels", "--base", "/x", *more])


def test_label_build_job(spark, tmp_path, capsys):
    from ledgerlake.sources.claims_labels import LABEL_MAP

    for _, _, kind, place in LABEL_MAP:
        (tmp_path / kind).mkdir(exist_ok=True)
        header = f"{place[1]};{place[2]}" if kind == "list" else "CODE;LABEL"
        (tmp_path / kind / f"{place[0]}.csv").write_text(f"{header}\n7;seven\n")
    (tmp_path / "c.csv").write_text("column;code;label;why\nPRS_NAT;8;old;x\nPRS_NAT;08;eight;x\n")
    args = ["--code-lists", str(tmp_path / "list"), "--lexicon", str(tmp_path / "sheet"), "--complements", str(tmp_path / "c.csv")]
    assert main(["labels", "--base", str(tmp_path / "lake"), *args], spark) == 0
    assert capsys.readouterr().out == "labels=39\n  no label for any code of TOP_PS5_TRG\n"


def test_jobs_in_sequence(spark, tmp_path, capsys):
    base = tmp_path / "lake"
    claims_file(base / "raw", {"PRS_NAT": "3134"}, {"PRS_NAT": "3134"})
    labels = tmp_path / "labels.csv"
    labels.write_text("code_column;code;libelle;source\nPRS_NAT;3134;X;list\n")
    assert main(["bronze", "--base", str(base), "--months", "202503", "--spread", "2"], spark) == 0
    assert main(["silver", "--base", str(base), "--months", "202503"], spark) == 0
    assert main(["labels", "--base", str(base), "--label-file", str(labels)], spark) == 0
    assert main(["gold", "--base", str(base), "--warn-only"], spark) == 0
    out = capsys.readouterr().out
    assert "202503=2" in out
    assert "bronze=2 silver=2 quarantine=0" in out
    assert "labels=1" in out
    assert "missing_labels" in out
