import os
import sys
import tempfile

import duckdb
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from furlong.session import build_session  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


@pytest.fixture(scope="session")
def spark():
    ckpt = tempfile.mkdtemp(prefix="furlong-test-ckpt-")
    s = build_session("local[*]", shuffle_partitions=8,
                      extra={"spark.checkpoint.dir": ckpt, "spark.ui.showConsoleProgress": "false",
                             "spark.driver.memory": "8g"})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    def run(sql, sf_dir=SF01):
        con = duckdb.connect()
        for t in TABLES:
            con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
        rel = con.sql(sql)
        types = [str(t) for t in rel.types]
        return rel.columns, rel.fetchall(), types
    return run


def rows_of(df, cols=None):
    """Collected rows as sorted tuples (order-insensitive comparison)."""
    cols = cols or df.columns
    return sorted((tuple(r[c] for c in cols) for r in df.select(*cols).collect()), key=repr)
