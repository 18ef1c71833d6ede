import os
import sys
from pathlib import Path

REPO = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(REPO))
os.environ["PYTHONPATH"] = os.pathsep.join([str(REPO), os.environ.get("PYTHONPATH", "")])

import pytest  # noqa: E402

from tessera.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = local_session(4, 4, **{
        "spark__checkpoint__dir": f"file://{shared}",
        "spark__sql__warehouse__dir": str(shared / "warehouse"),
    })
    yield session
    session.stop()


@pytest.fixture
def shuffled(spark):
    """A function: the bytes that the stages of run() write for others to read."""
    sc = spark.sparkContext
    store, none = sc._jsc.sc().statusStore(), sc._gateway.new_array(sc._jvm.double, 0)

    def stages():
        sc._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        found = store.stageList(None, False, False, none, sc._jvm.java.util.ArrayList())
        return {x.stageId(): x.shuffleWriteBytes() for x in (found.apply(k) for k in range(found.size()))}

    def measure(run) -> int:
        before = stages()
        run()
        return sum(n for k, n in stages().items() if k not in before)

    return measure
