"""Summarise a Spark event log: per job group (bench query), the number of
jobs, stages and tasks, summed stage time, shuffle write and spill.

usage: python tools/stage_times.py <event log file or folder>
"""

from __future__ import annotations

import io
import json
import os
import sys
from collections import defaultdict

import zstandard


def events(path):
    """Events of a log file, or of every log file under a folder (rolling logs
    are folders of parts)."""
    if os.path.isdir(path):
        files = sorted(os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs
                       if not f.startswith(".") and not f.startswith("appstatus"))
    else:
        files = [path]
    for f in files:
        with open(f, "rb") as raw:
            stream = zstandard.ZstdDecompressor().stream_reader(raw) if f.endswith(".zstd") else raw
            for line in io.TextIOWrapper(stream, encoding="utf-8"):
                if line.strip():
                    yield json.loads(line)


def summarize(path) -> dict:
    """{job group: {jobs, stages, tasks, stage_ms, shuffle_mb, spill_mb}}."""
    job_group, stage_job = {}, {}
    agg = defaultdict(lambda: {"jobs": 0, "stages": 0, "tasks": 0, "stage_ms": 0, "shuffle_mb": 0.0, "spill_mb": 0.0})
    for e in events(path):
        kind = e.get("Event")
        if kind == "SparkListenerJobStart":
            group = (e.get("Properties") or {}).get("spark.jobGroup.id", "-")
            job_group[e["Job ID"]] = group
            agg[group]["jobs"] += 1
            for sid in e.get("Stage IDs", []):
                stage_job[sid] = e["Job ID"]
        elif kind == "SparkListenerStageCompleted":
            info = e["Stage Info"]
            group = job_group.get(stage_job.get(info["Stage ID"]), "-")
            a = agg[group]
            a["stages"] += 1
            a["tasks"] += info.get("Number of Tasks", 0)
            if info.get("Completion Time") and info.get("Submission Time"):
                a["stage_ms"] += info["Completion Time"] - info["Submission Time"]
            for acc in info.get("Accumulables", []):
                name, value = acc.get("Name", ""), acc.get("Value", 0)
                try:
                    value = float(value)
                except (TypeError, ValueError):
                    continue
                if name == "internal.metrics.shuffle.write.bytesWritten":
                    a["shuffle_mb"] += value / 2**20
                elif name in ("internal.metrics.memoryBytesSpilled", "internal.metrics.diskBytesSpilled"):
                    a["spill_mb"] += value / 2**20
    return dict(agg)


def main() -> None:
    agg = summarize(sys.argv[1])
    print(f"{'query':28s} {'jobs':>4s} {'stages':>6s} {'tasks':>6s} {'stage s':>8s} {'shuffle MB':>10s} {'spill MB':>8s}")
    for group, a in sorted(agg.items(), key=lambda kv: -kv[1]["stage_ms"]):
        print(f"{group:28s} {a['jobs']:4d} {a['stages']:6d} {a['tasks']:6d} {a['stage_ms'] / 1000:8.2f} "
              f"{a['shuffle_mb']:10.1f} {a['spill_mb']:8.1f}")


if __name__ == "__main__":
    try:
        main()
    except BrokenPipeError:  # output piped into head
        pass
