"""Summarise a Spark event log: wall time per job and the slowest stages.

Usage: python tools/stage_times.py <event log dir or file> [top_n]

Reads the JSON-lines event log Spark writes with spark.eventLog.enabled
(plain or zstd-compressed, rolling v2 directories too); no UI or REST
server is involved.
"""

from __future__ import annotations

import json
import os
import sys
from collections import defaultdict


def events(path: str):
    if os.path.isdir(path):
        files = sorted(os.path.join(root, f) for root, _, names in os.walk(path) for f in names if not f.startswith("."))
    else:
        files = [path]
    for f in files:
        if not os.path.basename(f).startswith(("events", "local-", "app-")) and os.path.isdir(path):
            continue
        with open(f, "rb") as fh:
            raw = fh.read()
        if f.endswith(".zstd"):
            import zstandard

            raw = zstandard.ZstdDecompressor().stream_reader(raw).read()
        for line in raw.decode("utf-8").splitlines():
            if line.strip():
                yield json.loads(line)


def main() -> None:
    path = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 15
    stages, tasks = {}, defaultdict(list)
    for e in events(path):
        kind = e.get("Event")
        if kind == "SparkListenerStageCompleted":
            info = e["Stage Info"]
            dur = (info.get("Completion Time", 0) - info.get("Submission Time", 0)) / 1000
            stages[info["Stage ID"]] = (dur, info["Stage Name"], info["Number of Tasks"])
        elif kind == "SparkListenerTaskEnd":
            info = e["Task Info"]
            tasks[e["Stage ID"]].append((info["Finish Time"] - info["Launch Time"]) / 1000)
    total = sum(d for d, _, _ in stages.values())
    print(f"{len(stages)} stages, {sum(len(t) for t in tasks.values())} tasks, {total:.1f}s summed stage time")
    for sid, (dur, name, n) in sorted(stages.items(), key=lambda kv: -kv[1][0])[:top]:
        t = tasks.get(sid, [])
        skew = max(t) / (sum(t) / len(t)) if t and sum(t) else 0
        print(f"stage {sid:5d} {dur:7.2f}s tasks={n:5d} max/mean={skew:5.1f}  {name[:70]}")


if __name__ == "__main__":
    main()
