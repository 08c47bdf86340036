import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMOKE = "/root/testdata/sf0.001"
SMALL = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from scorelake.session import checkpoint_dir, local_session
    s = local_session(cores="*", shuffle_partitions=8, app="scorelake-tests")
    checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def smoke_cards(spark):
    """The lazy layers over raw cards that were landed once."""
    import uuid

    from scorelake.plans.layers import Scorecards
    from scorelake.plans.refresh import land_fixture
    root = f"{spark.conf.get('spark.checkpoint.dir')}/landed-{uuid.uuid4().hex}"
    return Scorecards.from_raw(spark, land_fixture(spark, SMOKE, root))
