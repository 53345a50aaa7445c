import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from critica.session import get_spark, local_heap

    ckpt = tempfile.mkdtemp(prefix="critica-test-ckpt-")
    s = get_spark(master="local[*]", shuffle_partitions=8, extra={"spark.checkpoint.dir": ckpt},
                  driver_memory=local_heap(cap_gb=8))
    s.sparkContext.setCheckpointDir(ckpt)
    yield s
    s.stop()


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)


def review_row(**kw):
    """A flat review row with the defaults of the reference's row factory (FIXTURES F2)."""
    import datetime as _dt

    row = dict(recommendationid="r1", steamid="user1", playtime_forever=1000, playtime_at_review=500, num_reviews=1,
               language="english", review="Good game", timestamp_created=1000000, timestamp_updated=1000000,
               voted_up=True, votes_up=10, votes_funny=1, weighted_vote_score=0.8, comment_count=0,
               steam_purchase=True, received_for_free=False, written_during_early_access=False, appid=730,
               dt=_dt.date(2024, 1, 1))
    row.update(kw)
    return row


def flat_df(spark, rows):
    from critica.schemas import FLAT_SCHEMA

    return spark.createDataFrame([tuple(r[f.name] for f in FLAT_SCHEMA.fields) for r in rows], FLAT_SCHEMA)
