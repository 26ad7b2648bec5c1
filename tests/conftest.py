import os
import sys

# Many small products: threads of the linear algebra library only get in each other's way.
os.environ.setdefault("OMP_NUM_THREADS", "1")
os.environ.setdefault("OPENBLAS_NUM_THREADS", "1")

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

from ledgerline.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = str(tmp_path_factory.mktemp("shared"))
    s = local_session("*", shuffle_partitions=8, app="ledgerline-tests", extra={"spark.checkpoint.dir": shared})
    yield s
    s.stop()
