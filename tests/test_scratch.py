import pytest

from riskmart.sources import scratch


class Unset:
    """A session without the setting."""

    class conf:
        @staticmethod
        def get(key, default):
            return default


def test_a_session_without_a_shared_folder_is_told_so():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch.scratch_root(Unset)


def test_a_table_reads_back_as_written(spark):
    rows = spark.range(5).withColumnRenamed("id", "n")
    stored = scratch.materialize(rows, "numbers")
    assert sorted(r.n for r in stored.collect()) == [0, 1, 2, 3, 4]
