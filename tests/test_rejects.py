"""CSV files with bad lines: good rows, named rejects, nothing lost."""

import uuid

import pytest

from idweave import versions as v
from idweave.sources import RejectedRows, scan_csv_checked

SCHEMA = "sec_id string, file_eff_dt int, d date"
MIXED = '''d,sec_id,more,file_eff_dt
2024-01-03,A,x,20240103
2024-01-03,"B, ""b""",,20240104
not a day,C,x,20240105
2024-01-04,D,x
2024-01-05,E,x,abc
also bad,F,x,1e99
2024-01-06,G,x,20240106,one more
,"",,
2024-01-07,H,"y,z",7
'''


def test_a_mixed_file(spark, tmp_path):
    (tmp_path / "a.csv").write_text(MIXED)
    (tmp_path / "b.csv").write_text("d,sec_id,more,file_eff_dt\n2024-02-01,I,,8\nx,J\n")
    name = f"idweave_rejects_{uuid.uuid4().hex}"
    scan = scan_csv_checked(spark, str(tmp_path), SCHEMA, quarantine=name)
    assert scan.rows.dtypes == [("sec_id", "string"), ("file_eff_dt", "int"), ("d", "date")]
    assert sorted(r.sec_id for r in scan.rows.collect()) == ["", "A", 'B, "b"', "H", "I"]
    assert scan.rows.where("sec_id = ''").first().d is None
    got = {(r.file.rsplit("/", 1)[1], r.line): r.reason for r in scan.rejects.collect()}
    assert got == {
        ("a.csv", "not a day,C,x,20240105"): "d: not a day is no date",
        ("a.csv", "2024-01-04,D,x"): "not the 4 fields of the header",
        ("a.csv", "2024-01-05,E,x,abc"): "file_eff_dt: abc is no int",
        ("a.csv", "also bad,F,x,1e99"): "file_eff_dt: 1e99 is no int; d: also bad is no date",
        ("a.csv", "2024-01-06,G,x,20240106,one more"): "not the 4 fields of the header",
        ("b.csv", "x,J"): "not the 4 fields of the header"}
    assert scan.counts == {"rows": 5, "rejects": 6}
    assert spark.table(name).count() == 6
    scan_csv_checked(spark, str(tmp_path / "b.csv"), SCHEMA, quarantine=name)
    assert spark.table(name).count() == 7
    with pytest.raises(RejectedRows, match="6 bad lines, 2 allowed"):
        scan_csv_checked(spark, str(tmp_path), SCHEMA, quarantine=name, max_rejects=2)
    assert spark.table(name).count() == 13
    v.drop_versions(spark, name)


def test_good_files_have_no_rejects(spark, tmp_path):
    (tmp_path / "a.csv").write_text("sec_id,file_eff_dt,d\nA,1,2024-01-01\n")
    scan = scan_csv_checked(spark, str(tmp_path), SCHEMA, max_rejects=0)
    assert scan.counts == {"rows": 1, "rejects": 0} and scan.rejects.count() == 0
    (tmp_path / "a.csv").write_text("sec_id,file_eff_dt,d\n")
    assert scan_csv_checked(spark, str(tmp_path), SCHEMA, max_rejects=0).counts == {"rows": 0, "rejects": 0}


def test_missing_files_and_other_headers_fail_loudly(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        scan_csv_checked(spark, str(tmp_path / "none"), SCHEMA)
    (tmp_path / "a.csv").write_text("sec_id,d\nA,2024-01-01\n")
    with pytest.raises(ValueError, match="lacks file_eff_dt"):
        scan_csv_checked(spark, str(tmp_path), SCHEMA)
    (tmp_path / "a.csv").write_text("sec_id,file_eff_dt,d\nA,1,2024-01-01\n")
    (tmp_path / "b.csv").write_text("file_eff_dt,sec_id,d\n1,A,2024-01-01\n")
    with pytest.raises(Exception, match="(?i)header"):
        scan_csv_checked(spark, str(tmp_path), SCHEMA)
