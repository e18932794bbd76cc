"""Sum task metrics per query from a Spark event log written by ``bench.py --event-log DIR``.

    python tools/stage_times.py DIR

Jobs carry the query key as their description; for each key this prints task time,
shuffle bytes written / read, bytes spilled (memory, disk) and input bytes, summed over
every run of the query (warm-up included).
"""

from __future__ import annotations

import collections
import glob
import io
import json
import os
import sys


def _read_lines(path: str) -> list[str]:
    """Event files are zstd-compressed by default in Spark 4 (``spark.eventLog.compress``)."""
    with open(path, "rb") as f:
        raw = f.read()
    if raw[:4] == b"\x28\xb5\x2f\xfd":
        import zstandard

        raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read()
    return raw.decode("utf-8").splitlines()


def _event_files(d: str) -> list[str]:
    """The newest application log; Spark 4 writes a rolling log (a directory of parts)."""
    apps = sorted(glob.glob(os.path.join(d, "*")), key=os.path.getmtime)
    if not apps:
        raise SystemExit(f"no event log in {d}")
    last = apps[-1]
    if not os.path.isdir(last):
        return [last]
    parts = glob.glob(os.path.join(last, "events_*"))
    return sorted(parts, key=lambda x: int(os.path.basename(x).split("_")[1]))


def main(d: str) -> None:
    stage_key: dict[int, str] = {}
    agg: dict[str, collections.Counter] = collections.defaultdict(collections.Counter)
    for path in _event_files(d):
        for line in _read_lines(path):
            e = json.loads(line)
            ev = e.get("Event")
            if ev == "SparkListenerJobStart":
                key = (e.get("Properties") or {}).get("spark.job.description", "?")
                for sid in e.get("Stage IDs", []):
                    stage_key[sid] = key
            elif ev == "SparkListenerTaskEnd":
                m = e.get("Task Metrics") or {}
                c = agg[stage_key.get(e.get("Stage ID"), "?")]
                c["tasks"] += 1
                c["task_ms"] += m.get("Executor Run Time", 0)
                c["shuffle_write"] += (m.get("Shuffle Write Metrics") or {}).get("Shuffle Bytes Written", 0)
                r = m.get("Shuffle Read Metrics") or {}
                c["shuffle_read"] += r.get("Remote Bytes Read", 0) + r.get("Local Bytes Read", 0)
                c["spill_mem"] += m.get("Memory Bytes Spilled", 0)
                c["spill_disk"] += m.get("Disk Bytes Spilled", 0)
                c["input"] += (m.get("Input Metrics") or {}).get("Bytes Read", 0)
    mb = 1024 * 1024
    print(f"{'query':30s} {'tasks':>6s} {'task_s':>8s} {'in_MB':>8s} {'shufW_MB':>9s} {'shufR_MB':>9s} "
          f"{'spillM_MB':>9s} {'spillD_MB':>9s}")
    for k, c in sorted(agg.items()):
        print(f"{k:30s} {c['tasks']:6d} {c['task_ms'] / 1000:8.1f} {c['input'] / mb:8.1f} "
              f"{c['shuffle_write'] / mb:9.2f} {c['shuffle_read'] / mb:9.2f} {c['spill_mem'] / mb:9.2f} "
              f"{c['spill_disk'] / mb:9.2f}")


if __name__ == "__main__":
    main(sys.argv[1])
