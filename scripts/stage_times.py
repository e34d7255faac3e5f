"""Summarise a Spark event log: wall time per job and the slowest stages.

Usage: python scripts/stage_times.py <event-log file or folder> [top_n]
"""

from __future__ import annotations

import io
import json
import os
import sys


def _lines(path: str):
    """Event-log lines from a file or a rolling event-log folder (zstd or plain)."""
    files = ([os.path.join(path, n) for n in sorted(os.listdir(path)) if n.startswith("events_")]
             if os.path.isdir(path) else [path])
    for f in files:
        if f.endswith(".zstd"):
            import zstandard
            with open(f, "rb") as fh:
                reader = zstandard.ZstdDecompressor().stream_reader(fh, read_across_frames=True)
                yield from io.TextIOWrapper(reader, encoding="utf-8")
        else:
            yield from open(f, encoding="utf-8")


def main(argv):
    path = argv[1]
    top = int(argv[2]) if len(argv) > 2 else 15
    stages, jobs = {}, {}
    for line in _lines(path):
        e = json.loads(line)
        ev = e.get("Event")
        if ev == "SparkListenerStageCompleted":
            info = e["Stage Info"]
            sub, done = info.get("Submission Time"), info.get("Completion Time")
            if sub and done:
                stages[info["Stage ID"]] = (done - sub, info["Stage Name"][:70],
                                            info["Number of Tasks"])
        elif ev == "SparkListenerJobStart":
            jobs[e["Job ID"]] = [e["Submission Time"], None]
        elif ev == "SparkListenerJobEnd":
            jobs[e["Job ID"]][1] = e["Completion Time"]
    total_stage = sum(v[0] for v in stages.values())
    total_job = sum((b - a) for a, b in jobs.values() if b)
    print(f"jobs {len(jobs)}  job wall ms {total_job}  stages {len(stages)}  "
          f"stage ms {total_stage}")
    for sid, (ms, name, n) in sorted(stages.items(), key=lambda kv: -kv[1][0])[:top]:
        print(f"stage {sid:5d} {ms:7d} ms  tasks {n:4d}  {name}")


if __name__ == "__main__":
    main(sys.argv)
