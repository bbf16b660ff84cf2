"""Published tables: what a reader sees while a writer works, dies, or meets another one."""

import pytest
from pyspark.sql import functions as F

from titleweave.sources import versions, writers


def ids(df):
    return sorted(r.id for r in df.collect())


def table(spark, n):
    return spark.range(n).withColumn("month", F.when(F.col("id") < 2, "2024-01").otherwise("2024-02"))


def die(*_, **__):
    raise RuntimeError("writer died")


@pytest.mark.parametrize("step", ["commit", "retire"])
def test_a_writer_that_dies_leaves_one_whole_version(spark, tmp_path, monkeypatch, step):
    path = str(tmp_path / "merged")
    writers.write_merged(spark.range(3), path)
    writers.write_merged(spark.range(4), path)
    with monkeypatch.context() as m:
        m.setattr(versions, step, die)
        with pytest.raises(RuntimeError):
            writers.write_merged(spark.range(7), path)
    assert ids(versions.read(spark, path)) == list(range(4 if step == "commit" else 7))
    writers.write_merged(spark.range(5), path)
    assert ids(versions.read(spark, path)) == list(range(5))


def test_a_hidden_version_file_is_no_version(spark, tmp_path):
    path = str(tmp_path / "t")
    versions.publish(spark.range(2), path)
    (tmp_path / "t" / "versions" / ".half").write_text('{"": "data/nowhere"')
    assert ids(versions.read(spark, path)) == [0, 1]


def test_a_reader_keeps_its_version_while_the_next_is_published(spark, tmp_path):
    path = str(tmp_path / "t")
    versions.publish(spark.range(3), path)
    before = versions.read(spark, path)
    versions.publish(spark.range(9), path)
    assert ids(before) == [0, 1, 2]
    versions.publish(before.where("id > 0"), path)  # a table made from itself
    assert ids(versions.read(spark, path)) == [1, 2]
    assert len(list((tmp_path / "t" / "data").iterdir())) == 2  # the first is retired by now


def test_two_writers_cannot_take_one_number(spark, tmp_path):
    path = str(tmp_path / "t")
    versions.publish(spark.range(3), path)
    with pytest.raises(Exception, match="[Ee]xist"):
        versions.commit(spark, path, 1, {versions.WHOLE: "data/other"})
    assert ids(versions.read(spark, path)) == [0, 1, 2]


def test_parts_are_replaced_dropped_and_taken_over(spark, tmp_path):
    path = str(tmp_path / "t")
    months = [f"2024-{m:02d}" for m in (1, 2, 3)]
    table(spark, 4).write.partitionBy("month").parquet(path)  # written before the first version

    def listed(*names):
        return spark.createDataFrame([(n,) for n in names], "month string")

    new = spark.createDataFrame([(10, months[2])], "id long, month string")
    versions.publish_parts(new, path, F.col("month"), listed(months[2]))
    assert ids(versions.read(spark, path, "id long")) == [0, 1, 2, 3, 10]
    # January is rebuilt and has no rows any more, February is rebuilt from its own rows.
    own = versions.read(spark, path, "id long").where("id = 2").withColumn("month", F.lit(months[1]))
    versions.publish_parts(own, path, F.col("month"), listed(*months[:2]))
    assert ids(versions.read(spark, path, "id long")) == [2, 10]
    versions.publish_parts(own.where("false"), path, F.col("month"), listed(*months))
    assert ids(versions.read(spark, path, "id long")) == []


def test_a_published_crosswalk_is_written_as_a_version(spark, tmp_path):
    path = str(tmp_path / "t")
    names = ["date", "rp_story_id", "nw_source_url", "fuzzy_score"]

    def links(*rows):
        return spark.createDataFrame([(d, s, u, 100.0) for d, s, u in rows], names).withColumn("date", F.to_date("date"))

    def stored():
        return [r.nw_source_url for r in writers.combine_crosswalk(spark, path).collect()]

    writers.write_crosswalk(links(("2024-01-05", "a", "u1"), ("2024-02-05", "b", "u2")), path)
    months = spark.sql("select date'2024-01-01' as month")
    writers.replace_crosswalk_months(links(("2024-01-06", "a", "u3")), months, path)
    assert stored() == ["u3", "u2"]
    writers.write_crosswalk(links(("2024-02-07", "b", "u4")), path)
    assert stored() == ["u3", "u4"]


def test_nothing_published(spark, tmp_path):
    assert versions.read(spark, str(tmp_path / "none"), "id long").count() == 0
    with pytest.raises(FileNotFoundError):
        versions.read(spark, str(tmp_path / "none"))
