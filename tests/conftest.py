import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from tidemark.session import ensure_checkpoint_dir
    s = (SparkSession.builder.master("local[*]")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.maxMetadataStringLength", "2000")     # plans name whole paths, however long pytest's folder is
         .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="tidemark-wh-"))
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s)
    yield s


@pytest.fixture(scope="module", autouse=True)
def views_end_with_their_module():
    """SHOW TABLES lists temporary views in every database, so those of one module would show up in another."""
    yield
    from pyspark.sql import SparkSession
    s = SparkSession.getActiveSession()
    for t in s.catalog.listTables("default") if s else ():
        if t.isTemporary:
            s.catalog.dropTempView(t.name)


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)
