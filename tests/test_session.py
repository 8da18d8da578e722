import pytest

from tidemark import session


def test_shuffles_grow_with_the_input(spark, data, monkeypatch):
    lines = spark.read.parquet(f"{data}/lineitem.parquet")
    size = session.input_bytes(lines.distinct())
    assert size > 500_000
    assert session.shuffle_partitions(lines) == 8
    monkeypatch.setattr(session, "SHUFFLE_BYTES", 10_000)
    assert session.shuffle_partitions(lines) == -(-session.input_bytes(lines) // 10_000) > 50


def test_unknown_size_keeps_the_setting(spark):
    df = spark.createDataFrame([(1,)], "a int")
    assert session.shuffle_partitions(df) == 8


def test_settings_are_put_back(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with pytest.raises(RuntimeError):
        with session.session_setting(spark, "spark.sql.shuffle.partitions", "77"):
            assert spark.conf.get("spark.sql.shuffle.partitions") == "77"
            raise RuntimeError
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_stage_and_discard(spark):
    path = session.scratch_path(spark, "x")
    assert path.startswith(session.shared_folder(spark))
    staged = session.stage_at(spark.range(10).toDF("a"), path)
    assert sorted(r["a"] for r in staged.collect()) == list(range(10))
    session.discard(spark, path)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)
    with pytest.raises(ValueError, match="not staged"):
        session.discard(spark, "/somewhere/else")


def test_shuffles_are_sized_for_a_block(spark, monkeypatch, data):
    from tidemark import session

    df = spark.read.parquet(f"{data}/lineitem.parquet").groupBy("l_partkey").count()
    before = spark.conf.get("spark.sql.shuffle.partitions")
    monkeypatch.setattr(session, "SHUFFLE_BYTES", 20_000)
    with session.sized_shuffles(df) as parts:
        assert parts > int(before)
        assert spark.conf.get("spark.sql.shuffle.partitions") == str(parts)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_staging_deletes_on_success_and_error(spark):
    from pathlib import Path

    from tidemark.session import scratch_path, staging

    made = []

    def write(name):
        path = scratch_path(spark, name)
        spark.range(3).write.parquet(path)
        made.append(Path(path.removeprefix("file:")))

    with staging(spark, keep="wanted"):
        write("wanted")
        write("passing")
    assert made[0].exists() and not made[1].exists()
    with pytest.raises(ZeroDivisionError), staging(spark):
        write("broken")
        1 / 0
    assert not made[2].exists()
