from postolake.session import ensure_checkpoint_dir, scale_conf, shared_work_dir


def test_scale_conf_partitions():
    conf = scale_conf(100 * 10**12, executor_cores=8, executors=1000)
    assert int(conf["spark.sql.shuffle.partitions"]) == -(-100 * 10**12 // (512 << 20))
    small = scale_conf(10 << 20, executor_cores=8, executors=10)
    assert int(small["spark.sql.shuffle.partitions"]) == 240  # three waves of 80 cores
    assert conf["spark.sql.files.maxPartitionBytes"] == str(256 << 20)


def test_checkpoint_dir_is_read_from_the_session(spark):
    first = ensure_checkpoint_dir(spark)
    assert ensure_checkpoint_dir(spark) == first
    assert shared_work_dir(spark, "x").startswith(first.rstrip("/"))
