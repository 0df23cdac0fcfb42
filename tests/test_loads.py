"""Checked CSV loads: what is kept, what is set aside and why."""

from __future__ import annotations

import datetime as dt

import pytest

from refrain.sources import files, schemas

HEADER = ",".join(schemas.USER_LOGS.names)


def load(spark, tmp_path, *lines, header=HEADER):
    (tmp_path / "logs.csv").write_text("\n".join([header, *lines]) + "\n")
    return files.load_csv(spark, str(tmp_path / "logs.csv"), schemas.USER_LOGS, str(tmp_path / "table"), days=("date",))


def test_bad_lines_are_set_aside_with_their_reason(spark, tmp_path):
    good = ["a,20160131,1,2,3,4,5,6,7.5", "b,,1,,3,4,5,6,", ",20160229,0,0,0,0,0,0,0"]
    bad = {
        "a,20160131,1,2,3,4,5,6": "not 9 fields",
        "a,20160131,1,2,3,4,5,6,7.5,8": "not 9 fields",
        "a,20160131,x,2,3,4,5,6,7.5": "no int in num_25",
        "a,today,1,2,3,y,5,6,7.5": "no int in date",
        "a,20160131,1,2,3,4,5,6,much": "no double in total_secs",
        "a,20160131,1,2,3,4,5,99999999999,7.5": "no int in num_unq",
        "a,20160230,1,2,3,4,5,6,7.5": "no such day in date",
    }
    got = load(spark, tmp_path, *good, *bad)
    rows = sorted((tuple(r) for r in got.rows.collect()), key=str)
    assert rows == sorted(
        [
            ("a", dt.date(2016, 1, 31), 1, 2, 3, 4, 5, 6, 7.5),
            ("b", None, 1, None, 3, 4, 5, 6, None),
            (None, dt.date(2016, 2, 29), 0, 0, 0, 0, 0, 0, 0.0),
        ],
        key=str,
    )
    assert {r.line: r.reason for r in got.rejects.collect()} == bad
    assert all(r.file.endswith("logs.csv") for r in got.rejects.collect())


def test_a_file_without_bad_lines_has_no_rejects(spark, tmp_path):
    got = load(spark, tmp_path, "a,20160131,1,2,3,4,5,6,7.5")
    assert got.rows.count() == 1 and got.rejects.count() == 0


def test_an_empty_file_gives_no_rows(spark, tmp_path):
    got = load(spark, tmp_path)
    assert got.rows.count() == 0 and got.rejects.count() == 0


def test_another_header_still_ends_the_load(spark, tmp_path):
    with pytest.raises(Exception, match="header"):
        load(spark, tmp_path, "a,1,1,2,3,4,5,6,7.5", header=HEADER.replace("num_25,num_50", "num_50,num_25"))


def test_one_column_of_the_rows_counts_like_all(spark, tmp_path):
    """Rejection must not depend on the columns a reader asks for."""
    got = load(spark, tmp_path, "a,20160131,x,2,3,4,5,6,7.5", "b,20160131,1,2,3,4,5,6,7.5")
    assert [r.msno for r in got.rows.select("msno").collect()] == ["b"]
