"""Summarise stage times from a Spark event log (written by ``BENCH_EVENT_LOG=1``).

    python tools/stage_times.py /tmp/run-eventlog-XXXX [top_n]

Prints the slowest stages with their task count, shuffle read/write bytes
and the job description, read straight from the JSON event lines.
"""

from __future__ import annotations

import glob
import json
import os
import sys


def _num(v) -> int:
    try:
        return int(v)
    except (TypeError, ValueError):
        return 0


def _open(f: str):
    if f.endswith(".zstd") or f.endswith(".zst"):
        import io

        import zstandard
        return io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(open(f, "rb")), encoding="utf-8")
    return open(f, encoding="utf-8")


def main(path: str, top: int = 20) -> None:
    files = [path] if os.path.isfile(path) else sorted(
        f for f in glob.glob(os.path.join(path, "**", "*"), recursive=True) if os.path.isfile(f))
    stages = []
    for f in files:
        with _open(f) as fh:
            for line in fh:
                ev = json.loads(line)
                if ev.get("Event") != "SparkListenerStageCompleted":
                    continue
                info = ev["Stage Info"]
                start, end = info.get("Submission Time"), info.get("Completion Time")
                if start is None or end is None:
                    continue
                acc = {a.get("Name"): _num(a.get("Value")) for a in info.get("Accumulables", [])}
                stages.append((end - start, info["Stage ID"], info.get("Number of Tasks"),
                               acc.get("internal.metrics.shuffle.read.remoteBytesRead", 0)
                               + acc.get("internal.metrics.shuffle.read.localBytesRead", 0),
                               acc.get("internal.metrics.shuffle.write.bytesWritten", 0),
                               info.get("Stage Name", "")[:70]))
    stages.sort(reverse=True)
    total = sum(s[0] for s in stages)
    print(f"{len(stages)} stages, {total / 1000:.1f} s of stage time")
    for ms, sid, tasks, rd, wr, name in stages[:top]:
        print(f"{ms / 1000:7.2f}s stage {sid:5d} tasks {tasks:5d} shuffle r/w {rd / 1e6:8.1f}/{wr / 1e6:8.1f} MB  {name}")


if __name__ == "__main__":
    main(sys.argv[1], int(sys.argv[2]) if len(sys.argv) > 2 else 20)
