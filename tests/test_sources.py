import pytest

from riskframe.operators import rows as D
from riskframe.sources import contract as C
from riskframe.sources import sinks as S
from riskframe.sources import tables as T


def test_missing_sources_are_named(spark, tmp_path):
    there = str(tmp_path / "a.parquet")
    spark.range(3).write.parquet(there)
    paths = {"a": there, "b": str(tmp_path / "b.parquet"), "c": f"file://{tmp_path}/c"}
    assert T.missing_sources(spark, paths) == ["b", "c"]
    assert T.missing_sources(spark, {"a": f"file://{there}"}) == []
    with pytest.raises(T.MissingSourceError, match="b, c"):
        T.assert_sources_exist(spark, paths)


def test_csv_nan_becomes_null(spark, tmp_path):
    path = str(tmp_path / "x.csv")
    (tmp_path / "x.csv").write_text("id,v\n1,2.5\n2,\n3,NaN\n")
    got = T.read_csv(spark, path, "id long, v double", ["v"])
    assert got.columns == ["v"] and got.count() == 3


def test_malformed_csv_lines_are_kept_apart(spark, tmp_path):
    lines = ["1,2.5,a", "2,,b", "3,NaN,", "x,1.0,c", "4,1.0", "5,1.0,d,e", "6,-1e3,f g"]
    (tmp_path / "x.csv").write_text("id,v,s\n" + "\n".join(lines) + "\n")
    good, bad = T.read_csv_apart(spark, str(tmp_path / "x.csv"), "id long, v double, s string")
    assert good.columns == ["id", "v", "s"]
    assert sorted(r["id"] for r in good.collect()) == [1, 2, 3, 6] == sorted(r["id"] for r in good.select("id").collect())
    assert sorted(r["line"] for r in bad.collect()) == sorted(lines[3:6])
    assert (good.count(), bad.count()) == (4, 3)


def test_feature_set_checks_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], "id int, a int, TARGET int")
    assert D.feature_set(df, ["a"], keep=["id"], forbidden=["TARGET"]).columns == ["id", "a"]
    with pytest.raises(D.RowRuleError):
        D.feature_set(df, ["TARGET"], forbidden=["TARGET"])
    with pytest.raises(D.RowRuleError):
        D.feature_set(df, ["b"])


def test_modules_have_their_entry_points():
    assert callable(C.dup_keys) and S.__doc__
