import json
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from quire.session import checkpoint_dir, get_spark

    s = get_spark("quire-tests", master="local[4]", shuffle_partitions=8)
    # Tests only: the shared checkpoint folder is unset here, so use a fresh scratch folder.
    checkpoint_dir(s, fallback=tempfile.mkdtemp(prefix="quire-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="quire-test-")


def responses(spark, docs: dict):
    """``{doc_id: response dict}`` -> DataFrame ``(doc_id, response json)``."""
    return spark.createDataFrame([(k, json.dumps(v)) for k, v in docs.items()], "doc_id long, response string")
