"""Summarise stage times from a Spark event log folder (written with BENCH_EVENT_LOG_DIR).

usage: python tools/stage_times.py <event-log-dir> [top_n]
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys


def _lines(path):
    if path.endswith(".zstd"):
        import zstandard
        with open(path, "rb") as fh:
            reader = zstandard.ZstdDecompressor().stream_reader(fh, read_across_frames=True)
            yield from io.TextIOWrapper(reader, encoding="utf-8", errors="replace")
    else:
        with open(path, errors="replace") as fh:
            yield from fh


def main() -> None:
    folder = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 15
    stages = []
    for path in glob.glob(os.path.join(folder, "**", "*"), recursive=True):
        if os.path.isdir(path) or os.path.basename(path).startswith((".", "appstatus")):
            continue
        for line in _lines(path):
            if '"SparkListenerStageCompleted"' not in line:
                continue
            info = json.loads(line)["Stage Info"]
            start, end = info.get("Submission Time"), info.get("Completion Time")
            if start and end:
                stages.append((end - start, info["Stage ID"], info["Number of Tasks"],
                               info["Stage Name"][:70]))
    stages.sort(reverse=True)
    total = sum(s[0] for s in stages)
    print(f"{len(stages)} stages, {total / 1000:.1f} s of stage time")
    for ms, sid, tasks, name in stages[:top]:
        print(f"{ms / 1000:8.2f} s  stage {sid:5d}  tasks {tasks:5d}  {name}")


if __name__ == "__main__":
    main()
