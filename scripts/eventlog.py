"""Summarize a Spark event log (written with BENCH_EVENTLOG=<folder> python bench.py ...).

usage: python scripts/eventlog.py <event-log folder> [top]
Prints the job / stage counts, the summed stage time and the slowest stages.
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys


def events(folder: str):
    files = sorted(glob.glob(os.path.join(folder, "**", "events_*"), recursive=True))
    for f in files:
        with open(f, "rb") as fh:
            if f.endswith(".zstd"):
                import zstandard
                text = io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(fh), encoding="utf-8")
            else:
                text = io.TextIOWrapper(fh, encoding="utf-8")
            for line in text:
                yield json.loads(line)


def main() -> None:
    folder = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 10
    stages, jobs = {}, 0
    for e in events(folder):
        if e["Event"] == "SparkListenerJobStart":
            jobs += 1
        elif e["Event"] == "SparkListenerStageCompleted":
            i = e["Stage Info"]
            secs = (i.get("Completion Time", 0) - i.get("Submission Time", 0)) / 1000
            stages[i["Stage ID"]] = (secs, i["Number of Tasks"], i["Stage Name"][:70])
    print(f"jobs {jobs}  stages {len(stages)}  summed stage seconds {sum(v[0] for v in stages.values()):.2f}")
    for sid, (secs, tasks, name) in sorted(stages.items(), key=lambda kv: -kv[1][0])[:top]:
        print(f"  stage {sid:5d}  {secs:6.2f}s  tasks={tasks:5d}  {name}")


if __name__ == "__main__":
    main()
