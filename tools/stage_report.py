"""Summarise a Spark event log written by ``BENCH_EVENT_LOG=1 python bench.py``:
jobs, stages, stage time (sum of stage wall times) and task time per query key."""

from __future__ import annotations

import glob
import json
import sys
from collections import defaultdict


def main(path: str) -> None:
    import os
    # Spark 4 writes rolling logs: <dir>/eventlog_v2_<app>/events_<n>_<app>; older: one file per app
    apps = sorted(glob.glob(f"{path.rstrip('/')}/*"), key=os.path.getmtime)
    if not apps:
        raise SystemExit(f"no event log under {path}")
    last = apps[-1]
    files = sorted(glob.glob(f"{last}/events_*"), key=lambda f: int(os.path.basename(f).split("_")[1])) \
        if os.path.isdir(last) else [last]
    job_group, stage_job = {}, {}
    jobs, stages = defaultdict(int), defaultdict(int)
    stage_ms, task_ms = defaultdict(float), defaultdict(float)
    def read(f):
        if f.endswith(".zstd"):
            import io
            import zstandard
            with open(f, "rb") as fh:
                return io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(fh), encoding="utf-8").read()\
                    .splitlines()
        return open(f, encoding="utf-8").read().splitlines()

    lines = (ln for f in files for ln in read(f) if ln.strip())
    for line in lines:
        e = json.loads(line)
        ev = e.get("Event")
        if ev == "SparkListenerJobStart":
            g = (e.get("Properties") or {}).get("spark.jobGroup.id", "?")
            job_group[e["Job ID"]] = g
            jobs[g] += 1
            for sid in e.get("Stage IDs", []):
                stage_job[sid] = g
        elif ev == "SparkListenerStageCompleted":
            info = e["Stage Info"]
            g = stage_job.get(info["Stage ID"], "?")
            if "Completion Time" in info and "Submission Time" in info:
                stages[g] += 1
                stage_ms[g] += info["Completion Time"] - info["Submission Time"]
        elif ev == "SparkListenerTaskEnd":
            g = stage_job.get(e.get("Stage ID"), "?")
            ti = e.get("Task Info", {})
            if "Finish Time" in ti and "Launch Time" in ti:
                task_ms[g] += ti["Finish Time"] - ti["Launch Time"]
    print(f"{'query':36s} {'jobs':>5s} {'stages':>7s} {'stage s':>8s} {'task s':>8s}")
    for g in sorted(jobs, key=lambda k: -stage_ms[k]):
        print(f"{g:36s} {jobs[g]:5d} {stages[g]:7d} {stage_ms[g] / 1000:8.2f} {task_ms[g] / 1000:8.2f}")


if __name__ == "__main__":
    main(sys.argv[1])
