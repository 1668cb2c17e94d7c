from __future__ import annotations

import pytest

from promptmill.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    return local_session("4", shuffle_partitions=4, **{"spark.checkpoint.dir": str(shared)})
