"""Checkpoint folder rules and written tables."""
import os

import pytest

from tokenmill import session
from tokenmill.validation import TokenmillError


class _Conf:
    def get(self, key, default=None):
        return default


class _Context:
    master = "spark://host:7077"

    def getCheckpointDir(self):
        return None

    def getConf(self):
        return _Conf()


class _Session:
    conf, sparkContext = _Conf(), _Context()


def test_a_cluster_needs_a_shared_folder():
    with pytest.raises(TokenmillError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(_Session())


def test_written_tables_are_dropped(spark):
    w = session.Written(spark.range(5), "five")
    assert w.df.count() == 5 and session.path_exists(spark, w.path)
    w.drop()
    assert not session.path_exists(spark, w.path)


def test_executor_functions_need_no_installed_package(spark):
    from pyspark import cloudpickle
    import tokenmill.operators.tokenizer as t
    data = cloudpickle.dumps(t.merge_once)
    code = ("import pickle, sys, os; sys.path = [p for p in sys.path if p not in ('', os.getcwd())]; "
            f"f = pickle.loads({data!r}); print(f([1, 1, 1], {{(1, 1): 2}}))")
    import subprocess
    import sys
    out = subprocess.run([sys.executable, "-c", code], cwd="/tmp", capture_output=True, text=True,
                         env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})
    assert out.stdout.strip() == "[2, 1]", out.stderr
