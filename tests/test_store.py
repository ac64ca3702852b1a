"""Intermediates: reuse by name, removal, failures."""

import pytest
from pyspark.sql import functions as F

from orderlore.sources.tables import discard, fingerprint, materialise, materialise_at, reused, scratch, shared_folder


def _exists(spark, path):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(place)


def test_results_with_a_name_are_read_again(spark):
    source = shared_folder(spark, "test")
    spark.range(5).write.parquet(source)
    built = []

    def build():
        built.append(1)
        return materialise(spark.read.parquet(source).select(F.sum("id").alias("s")), "inner")

    name = fingerprint(spark, [source], "sum")
    assert reused(spark, "sums", name, build).first().s == 10
    assert fingerprint(spark, [source], "sum") == name and fingerprint(spark, [source], "other") != name
    other = spark.newSession()
    assert reused(other, "sums", fingerprint(other, [source], "sum"), build).first().s == 10 and len(built) == 1
    spark.range(7, 8).write.mode("append").parquet(source)
    changed = fingerprint(spark, [source], "sum")
    assert changed != name and reused(spark, "sums", changed, build).first().s == 17 and len(built) == 2


def test_a_failed_build_leaves_nothing(spark):
    paths = []

    def build():
        df, path = materialise_at(spark.range(3), "inner")
        paths.append(path)
        return df.select(F.raise_error(F.lit("broken")).alias("x"))

    for _ in range(2):
        with pytest.raises(Exception, match="broken"):
            reused(spark, "broken", "broken", build).collect()
    assert len(paths) == 2 and not any(_exists(spark, p) for p in paths)
    assert reused(spark, "broken", "broken", lambda: spark.range(2)).count() == 2


def test_scratch_removes_all_but_what_is_kept(spark):
    with scratch(spark) as outer:
        kept_df, kept = materialise_at(spark.range(4), "kept")
        outer(kept)
        with scratch(spark) as inner:
            _, gone = materialise_at(spark.range(4), "gone")
            passed_df, passed = materialise_at(spark.range(3), "passed")
            inner(passed)
        assert not _exists(spark, gone) and passed_df.count() == 3
    assert not _exists(spark, passed) and kept_df.count() == 4
    with pytest.raises(ZeroDivisionError), scratch(spark):
        _, lost = materialise_at(spark.range(4), "lost")
        raise ZeroDivisionError
    assert not _exists(spark, lost)
    discard(spark, lost)  # no error
