import pytest

from quarry.session import scratch_path, shared_dir


class _Conf(dict):
    def get(self, k, default=None):
        return dict.get(self, k, default)


class _SC:
    def __init__(self, master, conf):
        self.master, self._conf, self.applicationId, self.ckpt = master, _Conf(conf), "app-1", None

    def getConf(self):
        return self._conf

    def getCheckpointDir(self):
        return self.ckpt

    def setCheckpointDir(self, d):
        self.ckpt = d


class _Spark:
    def __init__(self, master, conf):
        self.sparkContext = _SC(master, conf)
        self.conf = _Conf()


def test_reads_the_setting():
    s = _Spark("yarn", {"spark.checkpoint.dir": "hdfs://nn/shared/"})
    assert shared_dir(s) == "hdfs://nn/shared"
    assert scratch_path(s, "x").startswith("hdfs://nn/shared/quarry/x/")


def test_cluster_without_setting_fails():
    with pytest.raises(RuntimeError):
        shared_dir(_Spark("yarn", {}))


def test_local_without_setting_gets_one_folder():
    s = _Spark("local[2]", {})
    a, b = shared_dir(s), shared_dir(s)
    assert a == b and s.sparkContext.ckpt == a


def test_real_session_uses_configured_folder(spark):
    assert shared_dir(spark).startswith(("/", "file:"))


def test_session_without_context_reads_conf():
    class NoContext:
        conf = _Conf({"spark.checkpoint.dir": "s3a://bucket/shared"})

        @property
        def sparkContext(self):
            raise RuntimeError("not available")

    assert shared_dir(NoContext()) == "s3a://bucket/shared"
