"""Change sets applied to the partitions that they touch."""

import pytest

from regline.layout import EMPRESAS
from regline.operators import releases
from regline.sinks.commits import Commits
from regline.sinks.tables import read_partitioned, write_partitioned


def recs(spark, rows):
    schema = ", ".join(f"`{c}` string" for c in EMPRESAS.names)
    return spark.createDataFrame([tuple(r.get(c) for c in EMPRESAS.names) for r in rows], schema)


def of(*rows):
    return [dict(zip(("cnpj", "uf", "razao_social"), r)) for r in rows]


OLD = of(("1", "AA", "a"), ("2", "AA", "b"), ("3", "BB", "c"), ("4", "CC", "d"), ("5", None, "e"), ("6", "D D", "f"), ("7", "EE", "g"))
# 1 is renamed, 3 leaves the only place in BB for a new state, 5 moves out of none, 6 is deleted, 8 comes.
NEW = of(("1", "AA", "A"), ("2", "AA", "b"), ("3", "F/F", "c"), ("4", "CC", "d"), ("5", "AA", "e"), ("7", "EE", "g"), ("8", None, "h"))


def files(path):
    return {p.parent.name: {p.name} for p in path.rglob("part-*.parquet")}


def test_only_touched_partitions_are_written(spark, tmp_path):
    path = str(tmp_path / "snapshot")
    write_partitioned(recs(spark, OLD), path)
    before = files(tmp_path / "snapshot")
    changed = releases.changes(releases.release_diff(recs(spark, OLD), recs(spark, NEW)))
    changed.write.parquet(str(tmp_path / "changes"))
    changed = spark.read.parquet(str(tmp_path / "changes"))
    touched = releases.apply_in_place(spark, path, changed)
    assert touched == ["AA", "BB", "D D", "F/F", None]
    after = files(tmp_path / "snapshot")
    for same in ("uf=CC", "uf=EE"):
        assert after[same] == before[same]
    assert after["uf=AA"] != before["uf=AA"] and "uf=BB" not in after and "uf=D D" not in after
    want = sorted(map(tuple, recs(spark, NEW).collect()))
    assert sorted(map(tuple, read_partitioned(spark, path).collect())) == want
    # As after a failure: once more, with the same result.
    releases.apply_in_place(spark, path, changed)
    assert sorted(map(tuple, read_partitioned(spark, path).collect())) == want


def test_nothing_to_apply_writes_nothing(spark, tmp_path):
    path = str(tmp_path / "snapshot")
    write_partitioned(recs(spark, OLD), path)
    before = files(tmp_path / "snapshot")
    diff = releases.release_diff(recs(spark, OLD), recs(spark, OLD))
    assert releases.apply_in_place(spark, path, diff) == [] and files(tmp_path / "snapshot") == before


def test_a_table_of_commits_is_refused(spark, tmp_path):
    Commits(str(tmp_path / "table")).begin("x")
    with pytest.raises(ValueError, match="committed loads"):
        releases.apply_in_place(spark, str(tmp_path / "table"), releases.release_diff(recs(spark, OLD), recs(spark, NEW)))
