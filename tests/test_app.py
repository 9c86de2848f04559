"""The command-line entry: batch backfill via bronze, streaming run, reports."""

import contextlib
import io
import json
import os

from eventlens import app
from eventlens.sources.files import write_messages
from eventlens.sources.messages import stored_topic
from tests.conftest import SF_SMALL


def test_batch_stream_and_report(spark, tmp_dir):
    topic = os.path.join(tmp_dir, "topic")
    write_messages(stored_topic(spark, SF_SMALL), topic, "text")
    assert app.main(["batch", "--files", topic, "--out", f"{tmp_dir}/tables", "--bronze", f"{tmp_dir}/bronze"]) == 0
    assert app.main([
        "stream", "--files", topic, "--out", f"{tmp_dir}/st", "--checkpoints", f"{tmp_dir}/ck",
        "--available-now", "--tables", "device_stats",
    ]) == 0
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        assert app.main(["report", "--tables", f"{tmp_dir}/tables", "--panel", "rpt_device_total"]) == 0
    panel = json.loads(buf.getvalue().strip())
    batch_total = panel["row"]["total_transactions"]
    with contextlib.redirect_stdout(io.StringIO()):
        assert app.main(["report", "--tables", f"{tmp_dir}/tables", "--out", f"{tmp_dir}/panels", "--panel", "rpt_device_total"]) == 0
    assert spark.read.parquet(f"{tmp_dir}/panels/rpt_device_total").first().total_transactions == batch_total
    assert batch_total == spark.read.parquet(f"{tmp_dir}/tables/raw_transactions").count()
    streamed = spark.read.parquet(f"{tmp_dir}/st/device_stats").count()
    assert 0 < streamed <= spark.read.parquet(f"{tmp_dir}/tables/device_stats").count()
