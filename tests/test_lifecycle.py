"""The listener of the trigger stream: progress, counts and errors."""

import os

import pytest

from linecast.plans import jobs
from linecast.sources.triggers import read_trigger_files
from linecast.streaming.lifecycle import Lifecycle
from linecast.streaming.runner import start
from tests.conftest import SF_SMALL

GO = '{{"job_type": "prop_bet_analysis", "timestamp": "2024-01-0{}T00:00:00Z"}}'


def _write(path, name, lines):
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/{name}", "w") as fh:
        fh.write("\n".join(lines) + "\n")


@pytest.fixture()
def lifecycle(spark):
    listener = Lifecycle(keep=2)
    listener.attach(spark)
    yield listener
    listener.detach(spark)


def test_progress_rejected_counts_and_the_failing_batch(spark, tmp_dir, lifecycle):
    src, target, ckpt = f"{tmp_dir}/in", f"{tmp_dir}/predictions", f"{tmp_dir}/ckpt"
    inputs = jobs.fixture_inputs(spark, SF_SMALL)
    fails = []

    def analysis(ts, run_id):
        if fails:
            raise ValueError("no statistics today")
        return jobs.locks_job(inputs, run_ts=ts)

    def run():
        return start(spark, read_trigger_files(spark, src), analysis, target, ckpt, available_now=True, lifecycle=lifecycle)

    assert lifecycle.state == "new"
    _write(src, "a.json", [GO.format(2), "{broken", '{"job_type": "other"}', GO.format(3)])
    q = run()
    q.awaitTermination()
    assert lifecycle.wait(30) and lifecycle.state == "ended" and lifecycle.error is None
    assert lifecycle.totals == {"batches": 1, "messages": 4, "accepted": 2, "rejected": 2}
    assert lifecycle.progress[-1]["batch_id"] == 0 and lifecycle.progress[-1]["rejected"] == 2

    fails.append(True)
    _write(src, "b.json", [GO.format(4)])
    with pytest.raises(Exception, match="no statistics today"):
        run().awaitTermination()
    assert lifecycle.wait(30) and lifecycle.state == "failed" and lifecycle.failed_batch == 1
    assert "no statistics today" in lifecycle.error

    # The batch was not committed: the next start works on it again.
    fails.clear()
    q = run()
    q.awaitTermination()
    assert lifecycle.wait(30) and lifecycle.state == "ended" and lifecycle.failed_batch is None
    assert lifecycle.totals["accepted"] == 3 and lifecycle.totals["batches"] == 2


def test_other_streams_are_not_followed(spark, tmp_dir, lifecycle):
    src = f"{tmp_dir}/in"
    _write(src, "a.json", ['{"job_type": "other"}'])
    q = start(spark, read_trigger_files(spark, src), lambda ts, run_id: None, f"{tmp_dir}/p", f"{tmp_dir}/c", available_now=True)
    q.awaitTermination()
    assert lifecycle.state == "new" and not lifecycle.progress
