import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = (
        SparkSession.builder.master("local[4]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


@pytest.fixture
def shuffled(spark):
    """A function: the records that the tasks of an action send to others."""

    def of(action) -> int:
        sc = spark.sparkContext._jsc.sc()

        def stages() -> dict[int, int]:
            sc.listenerBus().waitUntilEmpty()
            held = sc.statusStore().stageList(None, False, False, spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.double, 0), None)
            return {held.apply(i).stageId(): held.apply(i).shuffleWriteRecords() for i in range(held.size())}

        last = max(stages(), default=-1)
        action()
        return sum(n for i, n in stages().items() if i > last)

    return of
