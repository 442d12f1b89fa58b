"""Several files in one directory, each with its own order of columns."""

from __future__ import annotations

from marketlake.sources import readers


def test_files_of_a_directory_keep_their_own_headers(spark, tmp_path):
    folder = tmp_path / "city=Paris" / "year=2025" / "month=9"
    folder.mkdir(parents=True)
    (folder / "part-0.csv").write_text("id,name\n1,one\n")
    (folder / "part-1.csv").write_text("name,extra,id\ntwo,x,2\n")
    (folder / "part-2.csv").write_text("id,name\n3,three\n")
    (folder / "part-3.csv").write_text("")
    got = readers.read_bronze(spark, str(tmp_path), "part-*.csv").select("id", "name", "extra").collect()
    assert sorted(map(tuple, got)) == [("1", "one", None), ("2", "two", "x"), ("3", "three", None)]
