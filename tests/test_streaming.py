"""The streamed long table, windowed, equals the batch one."""

import os
import shutil
import tempfile
import uuid

from wardflow.sources import analogues as an
from wardflow.sources.tables import load
from wardflow.streaming import refresh

SF = "/root/testdata/sf0.001"
COLS = ["event_id", "icustay_id", "tw_1hr", "tw_24hr", "hour_diff", "valuenum"]


def test_stream_refresh_matches_batch(spark):
    events = load(spark, SF, "events")
    landing = tempfile.mkdtemp(prefix="landing-", dir="/tmp")   # a landing folder of new files
    shutil.copy(os.path.join(SF, "events.parquet"), os.path.join(landing, "part-0.parquet"))
    name = f"events_long_test_{uuid.uuid4().hex[:8]}"   # fresh checkpoint per run
    q = refresh.refresh_events(spark, landing, name=name)
    q.awaitTermination(300)
    assert q.exception() is None

    def rows(stays):
        return sorted(tuple(r) for r in refresh.windowed_table(spark, name, stays).select(COLS).collect())

    want = sorted(tuple(r) for r in an.events_windowed(spark, SF).select(COLS).collect())
    stays = an.event_spans(events)
    # events whose stay was not known when they landed appear once it is
    early = rows(stays.where("icustay_id % 2 = 0"))
    assert 0 < len(early) < len(want)
    assert rows(stays) == want
