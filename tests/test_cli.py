"""The command line runs a scheduled refresh, a streaming refresh and reports on a warehouse folder."""

import tempfile

from compare import SF_SMALL
from ridepulse.__main__ import main
from ridepulse.plans import catalog, jobs
from ridepulse.streaming import stream


def test_refresh_stream_and_report(spark):
    t = catalog.Tables(spark, SF_SMALL)
    base = tempfile.mkdtemp(prefix="rp-cli-")
    landing = f"{base}/landing"
    stream.land_feed(t.feed, landing, 4)
    main(["refresh", "--landing", landing, "--root", f"{base}/wh"])
    main(["report", "delays", "--root", f"{base}/wh", "--as-of", catalog.AS_OF, "--out", f"{base}/delays"])
    assert spark.read.parquet(f"{base}/delays").count() == 75
    main(["report", "trip_history", "--trip", "7_view", "--root", f"{base}/wh", "--as-of", catalog.AS_OF,
          "--out", f"{base}/trip"])
    assert 0 < spark.read.parquet(f"{base}/trip").count() <= 20
    main(["report", "worst_routes", "--day", "1", "--limit", "3", "--root", f"{base}/wh", "--as-of", catalog.AS_OF,
          "--out", f"{base}/worst"])
    assert spark.read.parquet(f"{base}/worst").count() <= 3
    main(["report", "network_health", "--root", f"{base}/wh", "--as-of", catalog.AS_OF, "--out", f"{base}/net"])
    assert spark.read.parquet(f"{base}/net").count() == spark.read.parquet(jobs.Warehouse(f"{base}/wh").network).count()

    before = spark.read.parquet(jobs.Warehouse(f"{base}/wh").fact).count()
    main(["compact", "--root", f"{base}/wh", "--date", "2024-01-02", "--date", "2024-01-03"])
    assert spark.read.parquet(jobs.Warehouse(f"{base}/wh").fact).count() == before

    main(["stream", "--landing", landing, "--root", f"{base}/wh2", "--checkpoint", f"{base}/ckpt"])
    main(["stream", "--landing", landing, "--root", f"{base}/wh2", "--checkpoint", f"{base}/ckpt"])   # no new files
    w1, w2 = jobs.Warehouse(f"{base}/wh"), jobs.Warehouse(f"{base}/wh2")
    for path in ("hourly", "silver_trips", "bronze_trips"):
        a = spark.read.parquet(getattr(w1, path))
        b = spark.read.parquet(getattr(w2, path)).select(*a.columns)
        assert a.count() == b.count() and a.exceptAll(b).count() == 0, path
