from __future__ import annotations

import pytest

from starmill.sources import (
    current_version,
    prune_versions,
    read_delimited,
    read_table,
    replace_table,
    scratch_root,
    spread,
    write_delimited,
    write_table,
)

SCHEMA = "id int, name string, day date"


@pytest.mark.parametrize("sep", [",", ";"])
def test_columns_are_found_by_header(spark, tmp_path, sep):
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "a.csv").write_text(
        sep.join(["extra", "NAME", "Day", "Id"]) + "\n" + sep.join(["x", "one", "2016-01-02", "1"]) + "\n"
    )
    df = read_delimited(spark, str(tmp_path / "raw"), SCHEMA, sep)
    assert [(n, t) for n, t in df.dtypes] == [("id", "int"), ("name", "string"), ("day", "date")]
    assert [(r.id, r.name, str(r.day)) for r in df.collect()] == [(1, "one", "2016-01-02")]


def test_other_date_format_and_quotes(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text('id,name,day\n1,"Adak, AK: Field",31/12/2016\n2,,\n')
    df = read_delimited(spark, str(path), SCHEMA, date_format="dd/MM/yyyy")
    assert [(r.id, r.name, r.day and str(r.day)) for r in df.collect()] == [
        (1, "Adak, AK: Field", "2016-12-31"),
        (2, None, None),
    ]


def test_files_with_other_headers_are_refused(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "a.csv").write_text("id,name,day\n1,one,2016-01-02\n")
    (tmp_path / "raw" / "b.csv").write_text("name,id,day\ntwo,2,2016-01-02\n")
    with pytest.raises(Exception, match="CSV header does not conform"):
        read_delimited(spark, str(tmp_path / "raw"), SCHEMA).collect()


def test_missing_column_is_refused(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("id,name\n1,one\n")
    with pytest.raises(Exception, match="day"):
        read_delimited(spark, str(path), SCHEMA)


def test_delimited_round_trip(spark, tmp_path, rows):
    df = spark.createDataFrame([(1, "a;b"), (2, None)], "id int, name string")
    write_delimited(df, str(tmp_path / "out"), sep=";")
    assert rows(read_delimited(spark, str(tmp_path / "out"), "id int, name string", ";")) == rows(df)


def test_partitioned_table(spark, tmp_path, rows):
    df = spark.range(100).selectExpr("cast(id % 3 as int) as part", "id")
    write_table(df, str(tmp_path / "t"), partition_by=["part"])
    assert rows(spark.read.parquet(str(tmp_path / "t")), "part", "id") == rows(df)
    assert len(list((tmp_path / "t" / "part=1").glob("*.parquet"))) == 1


def test_a_table_may_be_replaced_from_itself(spark, tmp_path):
    root = str(tmp_path / "t")
    assert current_version(spark, root) is None
    with pytest.raises(FileNotFoundError):
        read_table(spark, root)
    first = replace_table(spark.range(3), root)
    replace_table(read_table(spark, root).selectExpr("id + 10 as id"), root)
    assert sorted(r.id for r in read_table(spark, root).collect()) == [10, 11, 12]
    assert sorted(r.id for r in first.collect()) == [0, 1, 2]
    assert current_version(spark, root) == 2


def test_an_unfinished_version_is_never_read(spark, tmp_path):
    root = str(tmp_path / "t")
    replace_table(spark.range(3), root)
    half = tmp_path / "t" / "v0000000002"
    half.mkdir()
    (half / "part-0.parquet").write_text("torn")
    assert read_table(spark, root).count() == 3
    replace_table(spark.range(5), root)
    assert (current_version(spark, root), read_table(spark, root).count()) == (3, 5)


def test_old_versions_can_be_removed(spark, tmp_path):
    root = str(tmp_path / "t")
    for n in range(1, 5):
        replace_table(spark.range(n), root)
    (tmp_path / "t" / "v0000000005").mkdir()
    assert prune_versions(spark, root) == [1, 2]
    assert sorted(p.name[-1] for p in (tmp_path / "t").iterdir()) == ["3", "4", "5"]
    assert read_table(spark, root).count() == 4
    with pytest.raises(ValueError, match="current version"):
        prune_versions(spark, root, keep=0)


def test_scratch_lies_in_the_shared_folder(spark):
    one, two = scratch_root(spark), scratch_root(spark)
    assert one != two
    shared = spark.conf.get("spark.checkpoint.dir", None)
    assert shared is None or one.startswith(shared.rstrip("/") + "/")


def test_spread_only_helps_inputs_in_few_pieces(spark, rows):
    few = spark.range(0, 100, 1, 1)
    assert spread(few, "id").rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert rows(spread(few, "id")) == rows(few)
    many = spark.range(0, 100, 1, 8)
    assert spread(many, "id") is many
