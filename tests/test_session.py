"""The shared folder: who names it, and that what was written there can be taken away."""

from types import SimpleNamespace

import pytest

from tidelattice import session


def fake(master, named=None, set_to=None):
    option = SimpleNamespace(isDefined=lambda: set_to is not None, get=lambda: set_to)
    calls = []
    context = SimpleNamespace(master=master, _jsc=SimpleNamespace(sc=lambda: SimpleNamespace(getCheckpointDir=lambda: option)), setCheckpointDir=calls.append)
    conf = {"spark.checkpoint.dir": named} if named else {}
    return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=conf.get, set=conf.__setitem__)), calls


def test_a_cluster_must_name_its_folder():
    spark, calls = fake("spark://host:7077")
    with pytest.raises(RuntimeError):
        session.shared_dir(spark)
    assert calls == []


def test_named_folders_are_used():
    spark, calls = fake("spark://host:7077", named="hdfs://x/y")
    assert session.shared_dir(spark) == "hdfs://x/y" and calls == ["hdfs://x/y"]
    spark, calls = fake("yarn", set_to="hdfs://x/z/1")
    assert session.shared_dir(spark) == "hdfs://x/z/1" and calls == []
    spark, calls = fake("local[2]")
    assert session.shared_dir(spark).startswith("file:///") and session.shared_dir(spark) == calls[0]


def test_stored_and_released(spark):
    df = session.stored(spark.range(5), "numbers")
    assert sorted(r.id for r in df.collect()) == list(range(5))
    odd = spark.sql("select 1 as a, 2 as A, null as n")
    assert session.stored(odd, "odd").count() == 1
    path = session.scratch(spark, "other")
    spark.range(3).write.parquet(path)
    p, fs = session._hadoop(spark, path)
    assert fs.exists(p)
    session.release(spark)
    assert not fs.exists(p)
