import types

import pytest

from tripmart.frames import empty_frame, literal_rows
from tripmart.schemas import PAYMENT_TYPES
from tripmart.session import BROADCAST_LIMIT_BYTES, broadcast_if_small, estimated_bytes, work_folder


def fake(master, folder):
    settings = {"spark.checkpoint.dir": folder}
    conf = types.SimpleNamespace(get=lambda k, d=None: settings.get(k, d), set=settings.__setitem__)
    return types.SimpleNamespace(conf=conf, sparkContext=types.SimpleNamespace(master=master))


def test_work_folders_are_shared_and_fresh():
    cluster = fake("spark://host:7077", "hdfs://shared/work")
    first, second = work_folder(cluster, "a"), work_folder(cluster, "a")
    assert first != second and first.startswith("hdfs://shared/work/a-")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        work_folder(fake("spark://host:7077", None), "a")
    local = fake("local[2]", None)
    base = work_folder(local, "a").rsplit("/", 1)[0]
    assert work_folder(local, "b").startswith(base)


def test_size_check(spark):
    known = literal_rows(spark, [(1, "a")], PAYMENT_TYPES)
    unknown = spark.createDataFrame([(1, "a")], PAYMENT_TYPES)
    assert estimated_bytes(known) < 1000 < BROADCAST_LIMIT_BYTES < estimated_bytes(unknown)
    assert broadcast_if_small(unknown) is unknown
    assert broadcast_if_small(known) is not known
    assert empty_frame(spark, PAYMENT_TYPES).schema == PAYMENT_TYPES
