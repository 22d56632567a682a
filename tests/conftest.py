import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from trackline.session import build_session, checkpoint_root

    s = build_session("local[4]", app="trackline-tests", shuffle_partitions=8)
    checkpoint_root(s, str(tmp_path_factory.mktemp("ckpt")))
    yield s
    s.stop()


def rows(df, order=None):
    """Collected rows as plain tuples, sorted."""
    out = [tuple(r) for r in df.collect()]
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r)) if order is None else out
