"""Intermediate tables never go to a folder that only one machine can read."""

from types import SimpleNamespace

import pytest

from markfield.operators.skew import shared_folder


class Context(SimpleNamespace):
    folder = None

    def getConf(self):
        return {}

    def setCheckpointDir(self, folder):
        self.folder = folder

    def getCheckpointDir(self):
        return self.folder


def session(master, **conf):
    return SimpleNamespace(sparkContext=Context(master=master), conf=conf)


def test_a_cluster_must_name_its_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(session("spark://host:7077"))
    assert shared_folder(session("spark://host:7077", **{"spark.checkpoint.dir": "hdfs://x/y/"})) == "hdfs://x/y"
    assert shared_folder(session("local[2]")).startswith("/")


def test_the_session_names_it(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
