"""The event-log summary used by bench.py."""

import json

from tools.stage_times import summarize


def test_summarize_groups_stages_by_job_group(tmp_path):
    events = [
        {"Event": "SparkListenerJobStart", "Job ID": 0, "Stage IDs": [0, 1],
         "Properties": {"spark.jobGroup.id": "q1"}},
        {"Event": "SparkListenerStageCompleted", "Stage Info": {
            "Stage ID": 0, "Number of Tasks": 4, "Submission Time": 1000, "Completion Time": 1500,
            "Accumulables": [{"Name": "internal.metrics.shuffle.write.bytesWritten", "Value": 2 * 2**20}]}},
        {"Event": "SparkListenerStageCompleted", "Stage Info": {
            "Stage ID": 1, "Number of Tasks": 2, "Submission Time": 1500, "Completion Time": 1700,
            "Accumulables": [{"Name": "internal.metrics.diskBytesSpilled", "Value": 2**20}]}},
    ]
    log = tmp_path / "events_1_app"
    log.write_text("\n".join(json.dumps(e) for e in events) + "\n")
    s = summarize(str(tmp_path))
    assert s["q1"]["jobs"] == 1 and s["q1"]["stages"] == 2 and s["q1"]["tasks"] == 6
    assert s["q1"]["stage_ms"] == 700 and s["q1"]["shuffle_mb"] == 2.0 and s["q1"]["spill_mb"] == 1.0


def test_session_conf_never_overrides_a_submitted_master():
    from quire.session import session_conf
    submitted = session_conf(master=None, shuffle_partitions=None)
    assert "spark.master" not in submitted and "spark.sql.shuffle.partitions" not in submitted
    assert "spark.driver.memory" not in submitted and submitted["spark.sql.adaptive.enabled"] == "true"
    local = session_conf("local[4]", 4, {"spark.sql.shuffle.partitions": "2"})
    assert local["spark.master"] == "local[4]" and local["spark.sql.shuffle.partitions"] == "2"
    assert local["spark.ui.enabled"] == "false"
