"""The command-line jobs end to end: file ingest per stream -> build -> drift -> report."""

import os

from fleetlake import cli
from fleetlake.schemas import STREAMS
from fleetlake.sources import bindings
from fleetlake.sources.events import encode_events
from fleetlake.sources.tables import read_table

SF = "/root/testdata/sf0.001"


def test_cli_jobs(spark, scratch, capsys):
    base = ["--shuffle-partitions", "4"]
    for name, spec in STREAMS.items():
        landing = os.path.join(scratch, "landing", name)
        encode_events(bindings.stream(spark, SF, name), spec).select("value").write.text(landing)
        assert cli.main(base + ["ingest", "--stream", name, "--files", landing,
                                "--bronze", f"{scratch}/bronze", "--rejects", f"{scratch}/rejects",
                                "--checkpoint", f"{scratch}/ckpt/{name}", "--once"]) == 0
    tables = ["--out", f"{scratch}/tables"]
    assert cli.main(base + ["build", "--bronze", f"{scratch}/bronze", *tables, "--late-data", "--register", "--mixed"]) == 0
    assert cli.main(base + ["refresh-mart", "--out", f"{scratch}/tables"]) == 0
    assert cli.main(base + ["drift", "--out", f"{scratch}/tables", "--alerts", f"{scratch}/alerts"]) == 0
    assert cli.main(base + ["report", "--out", f"{scratch}/tables", "--name", "fleet_kpis"]) == 0
    out = capsys.readouterr().out
    assert "drift alerts" in out and "devices" in out
    before = read_table(spark, f"{scratch}/tables", "device_reliability_mart")
    rows = sorted(map(tuple, before.collect()))
    assert rows
    # everything again as late rows: all dates are rewritten, no row changes
    assert cli.main(base + ["late", "--stream", "health", "--bronze", f"{scratch}/bronze", *tables, "--since", "2000-01-01", "--register"]) == 0
    assert sorted(map(tuple, read_table(spark, f"{scratch}/tables", "device_reliability_mart").select(*before.columns).collect())) == rows
    assert sorted(map(tuple, spark.table("gold.device_reliability_mart").select(*before.columns).collect())) == rows
    assert cli.main(base + ["drift", "--state", f"{scratch}/drift"]) == 0
    out = out.split()[out.split().index("drift") - 1] + " " + capsys.readouterr().out
    assert out.split()[0] in out.split()[1:]  # as many alerts as the whole run wrote
    spark.conf.set("spark.sql.shuffle.partitions", "4")
