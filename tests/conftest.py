import os

os.environ.setdefault("SPARK_LOCAL_IP", "127.0.0.1")

import pytest

from pagecraft.session import session

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    conf = {"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g", "spark.ui.showConsoleProgress": "false"}
    s = session("local[4]", **conf)
    s.sparkContext.setLogLevel("ERROR")
    return s
