"""Summarise a Spark event log: jobs, stages, tasks per stage and where the time goes.

    python -m tools.event_log_summary <event-log folder or file>

Write the log with `spark.eventLog.enabled=true` and `spark.eventLog.dir=<a scratch folder>`
(the Spark UI stays off). Reads plain or zstd-compressed logs.
"""

from __future__ import annotations

import collections
import glob
import io
import json
import os
import sys


def _lines(path: str):
    with open(path, "rb") as fh:
        if path.endswith(".zstd") or path.endswith(".zst"):
            import zstandard

            yield from io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(fh), encoding="utf-8")
        else:
            yield from io.TextIOWrapper(fh, encoding="utf-8")


def summarise(path: str) -> dict:
    files = sorted(glob.glob(os.path.join(path, "**", "events_*"), recursive=True)) if os.path.isdir(path) else [path]
    jobs: dict[int, list] = {}
    stages = []
    for f in files:
        for line in _lines(f):
            e = json.loads(line)
            kind = e.get("Event")
            if kind == "SparkListenerJobStart":
                infos = e.get("Stage Infos", [])
                jobs[e["Job ID"]] = [e["Submission Time"], None, infos[-1]["Stage Name"] if infos else "?"]
            elif kind == "SparkListenerJobEnd" and e["Job ID"] in jobs:
                jobs[e["Job ID"]][1] = e["Completion Time"]
            elif kind == "SparkListenerStageCompleted":
                si = e["Stage Info"]
                stages.append((si["Completion Time"] - si["Submission Time"], si["Number of Tasks"], si["Stage Name"]))
    by_site = collections.Counter()
    count = collections.Counter()
    for start, end, name in jobs.values():
        site = name.split(" at ")[-1]
        by_site[site] += (end or start) - start
        count[site] += 1
    return {
        "jobs": len(jobs),
        "stages": len(stages),
        "mean_tasks_per_stage": round(sum(s[1] for s in stages) / max(len(stages), 1), 2),
        "job_ms_by_call_site": [(site, ms, count[site]) for site, ms in by_site.most_common(15)],
        "slowest_stages": sorted(stages, reverse=True)[:10],
    }


if __name__ == "__main__":
    print(json.dumps(summarise(sys.argv[1]), indent=1))
