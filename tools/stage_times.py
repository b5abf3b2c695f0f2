"""Summarise a Spark event log: per job, its stages with duration, task count,
input and shuffle bytes (the UI is off; this reads the log file instead).

    BENCH_EVENT_LOG=1 BENCH_QUERIES=inverted_index python bench.py
    python tools/stage_times.py /tmp/quarry-bench-*/events/<eventlog folder or file>
"""

from __future__ import annotations

import glob
import json
import os
import sys
from collections import defaultdict


def _lines(path: str):
    """Lines of an event log: one file, or a rolling-log folder of
    ``events_<n>_...`` files read in order."""
    if os.path.isdir(path):
        files = sorted(
            glob.glob(os.path.join(path, "events_*")),
            key=lambda f: int(os.path.basename(f).split("_")[1]),
        )
    else:
        files = [path]
    for f in files:
        with open(f, encoding="utf-8") as fh:
            yield from fh


def main() -> None:
    path = sys.argv[1]
    stages: dict[int, dict] = {}
    metrics: dict[int, dict] = defaultdict(lambda: defaultdict(int))
    job_stages: dict[int, list[int]] = {}
    job_desc: dict[int, str] = {}
    for line in _lines(path):
        ev = json.loads(line)
        kind = ev.get("Event")
        if kind == "SparkListenerJobStart":
            job_stages[ev["Job ID"]] = ev.get("Stage IDs", [])
            props = ev.get("Properties") or {}
            job_desc[ev["Job ID"]] = props.get("spark.job.description", "")[:60]
        elif kind == "SparkListenerStageCompleted":
            info = ev["Stage Info"]
            stages[info["Stage ID"]] = info
        elif kind == "SparkListenerTaskEnd":
            m = ev.get("Task Metrics") or {}
            agg = metrics[ev["Stage ID"]]
            agg["tasks"] += 1
            agg["input"] += (m.get("Input Metrics") or {}).get("Bytes Read", 0)
            sr = m.get("Shuffle Read Metrics") or {}
            agg["shuffle_read"] += sr.get("Remote Bytes Read", 0) + sr.get("Local Bytes Read", 0)
            agg["shuffle_write"] += (m.get("Shuffle Write Metrics") or {}).get(
                "Shuffle Bytes Written", 0
            )
            agg["spill"] += m.get("Disk Bytes Spilled", 0)
    for job, sids in sorted(job_stages.items()):
        done = [stages[s] for s in sids if s in stages]
        if not done:
            continue
        print(f"job {job} {job_desc.get(job, '')}")
        for st in done:
            sid = st["Stage ID"]
            dur = (st.get("Completion Time", 0) - st.get("Submission Time", 0)) / 1000
            m = metrics[sid]
            print(
                f"  stage {sid:4d} {dur:7.3f}s tasks={m['tasks']:4d} "
                f"in={m['input'] / 2**20:8.1f}MiB shuf_r={m['shuffle_read'] / 2**20:8.1f}MiB "
                f"shuf_w={m['shuffle_write'] / 2**20:8.1f}MiB spill={m['spill'] / 2**20:6.1f}MiB "
                f"{st.get('Stage Name', '')[:40]}"
            )


if __name__ == "__main__":
    main()
