import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tablegrad.session import get_session
    s = get_session("local[4]", app="tablegrad-tests", shuffle_partitions=8)
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tg-ckpt-"))
    yield s
    s.stop()


def rows(spark, data, id_col="row_id", vec_col="vec"):
    """Small R-layout tensor from a list of lists (row ids 0..m-1)."""
    return spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(data)],
                                 f"{id_col} bigint, {vec_col} array<double>")


def collect_rows(df, vec_col="vec", id_col="row_id"):
    return [list(r[vec_col]) for r in df.orderBy(id_col).collect()]
