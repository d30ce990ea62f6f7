import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

from playgraph import schema as S  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from playgraph.session import build_session

    s = build_session(
        "local[*]",
        app="playgraph-tests",
        conf={
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
            "spark.local.dir": tempfile.mkdtemp(prefix="playgraph-test-local-"),
        },
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def tmpdir_fresh():
    return tempfile.mkdtemp(prefix="playgraph-test-")


def library_df(spark, rows):
    """rows: (account_id, pos, appid, name, playtime_min)."""
    return spark.createDataFrame(rows, S.LIBRARY)


def edges_df(spark, rows):
    """rows: (account_id, pos, friend_id)."""
    return spark.createDataFrame(rows, S.FRIEND_EDGE)


def profile_df(spark, rows):
    """rows: (account_id, player_found, persona, country, timecreated)."""
    return spark.createDataFrame(rows, S.PROFILE)


def found_profiles(spark, ids, names=None):
    names = names or {}
    return profile_df(spark, [(i, True, names.get(i, f"p{i}"), "US", 1) for i in ids])
