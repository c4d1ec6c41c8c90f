"""The checkpoint folder comes from the session; it is only set where unset."""

from tessera.session import checkpoint_dir, cut_lineage


def test_checkpoint_dir_is_read_from_the_session(spark):
    before = spark.sparkContext.getCheckpointDir()
    assert before  # configured (cluster setting or the test fixture)
    assert checkpoint_dir(spark) == before
    assert spark.sparkContext.getCheckpointDir() == before  # not replaced


def test_cut_lineage_is_reliable(spark):
    df = spark.range(0, 100).selectExpr("id", "id * 2 AS twice")
    cut = cut_lineage(df)
    assert cut.count() == 100
    assert cut._jdf.queryExecution().optimizedPlan().toString().startswith("LogicalRDD")  # lineage cut


def test_unset_folder_is_an_error_on_a_cluster():
    import pytest

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext, conf = Context(), {}

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(Session())
