"""The feed watcher runs one pipeline batch per complete drop, exactly once."""

import os
import tempfile

from star_cases import SF_SMALL
from vitrine.plans.pipeline import RunOptions
from vitrine.sources import fixtures as FX
from vitrine.sources import ingest as I
from vitrine.streaming.feed_watch import MARKER, watch_feeds


def _drop(spark, landing, name):
    d = os.path.join(landing, name)
    I.export_feeds(FX.staging(spark, SF_SMALL), d)
    with open(os.path.join(d, MARKER), "w") as f:
        f.write(name)


def test_each_drop_loaded_once(spark, tmp_root):
    landing = tempfile.mkdtemp(prefix="landing-")
    ckpt = tempfile.mkdtemp(prefix="watch-ckpt-")
    opts = RunOptions(as_of=FX.FIXTURE_AS_OF)
    os.makedirs(os.path.join(landing, "half-written"))  # no marker yet: ignored
    _drop(spark, landing, "drop-1")
    watch_feeds(spark, landing, tmp_root, ckpt, opts)
    from vitrine.plans.pipeline import Pipeline

    p = Pipeline(spark, tmp_root, opts)
    assert [r.batch_id for r in p.log.batches().collect()] == [1]
    orders_1 = p.wh.read("fact_orders").count()
    assert orders_1 > 0
    # nothing new: no batch; a new drop: one more batch, no duplicate facts
    watch_feeds(spark, landing, tmp_root, ckpt, opts)
    _drop(spark, landing, "drop-2")
    watch_feeds(spark, landing, tmp_root, ckpt, opts)
    batches = sorted(r.batch_id for r in p.log.batches().collect())
    assert batches == [1, 2]
    assert p.wh.read("fact_orders").count() == orders_1
    assert all(r.status == "SUCCESS" for r in p.log.batches().collect())
