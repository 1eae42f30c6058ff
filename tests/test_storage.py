"""Where stages are stored, and when stored stages are used again."""

import shutil

import pyarrow.parquet as pq
import pytest

from trolley import session
from trolley.sources.basket import SOURCES, load_basket, source_digest, table_path

SF = "/root/testdata/sf0.001"


class _Conf:
    def __init__(self, path):
        self.path = path

    def get(self, key, default=None):
        return self.path if key == "spark.checkpoint.dir" else default

    def set(self, key, value):
        raise RuntimeError("a core setting")


class _Context:
    def __init__(self, master):
        self.master, self.dir = master, None

    def getCheckpointDir(self):
        return self.dir

    def setCheckpointDir(self, path):
        self.dir = path


class _Session:
    def __init__(self, master, path=None):
        self.sparkContext, self.conf = _Context(master), _Conf(path)


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "local-cluster[2,1,1024]", "k8s://x"])
def test_no_machine_local_folder_on_a_cluster(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(_Session(master))
    assert session.ensure_checkpoint_dir(_Session(master, "hdfs://shared/x")) == "hdfs://shared/x"


def test_local_master_gets_a_folder():
    assert session.ensure_checkpoint_dir(_Session("local[4]"))


def test_changed_sources_are_derived_anew(spark, tmp_path):
    for n in SOURCES:
        shutil.copyfile(table_path(SF, n), table_path(str(tmp_path), n))
    first = load_basket(spark, str(tmp_path))
    assert load_basket(spark, str(tmp_path)) is first
    before = source_digest(spark, [table_path(str(tmp_path), "orders")])
    src = pq.read_table(table_path(SF, "orders")).slice(0, 700)
    pq.write_table(src, table_path(str(tmp_path), "orders"))
    assert source_digest(spark, [table_path(str(tmp_path), "orders")]) != before
    again = load_basket(spark, str(tmp_path))
    assert again is not first and again.orders.count() == 700
