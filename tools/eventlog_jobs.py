"""Print a job timeline (start offset, duration, stages x tasks) from a Spark
event log folder written with spark.eventLog.dir.

usage: python tools/eventlog_jobs.py <eventlog dir>
"""

import glob
import io
import json
import sys

import zstandard


def lines(path):
    if path.endswith(".zstd"):
        with open(path, "rb") as fh:
            data = zstandard.ZstdDecompressor().stream_reader(fh)
            yield from io.TextIOWrapper(data, encoding="utf-8")
    else:
        yield from open(path, encoding="utf-8")


def main(root):
    jobs, stages = {}, {}
    for f in sorted(glob.glob(f"{root}/**/events_*", recursive=True)) + sorted(glob.glob(f"{root}/*.zstd")):
        for line in lines(f):
            e = json.loads(line)
            ev = e["Event"]
            if ev == "SparkListenerJobStart":
                p = e.get("Properties", {})
                jobs[e["Job ID"]] = [e["Submission Time"], None, p.get("callSite.short", "")[:50],
                                     [s["Stage ID"] for s in e["Stage Infos"]]]
            elif ev == "SparkListenerJobEnd":
                jobs[e["Job ID"]][1] = e["Completion Time"]
            elif ev == "SparkListenerStageCompleted":
                si = e["Stage Info"]
                stages[si["Stage ID"]] = (si["Number of Tasks"],
                                          round((si.get("Completion Time", 0) - si.get("Submission Time", 0)) / 1000, 2))
    t0 = min(v[0] for v in jobs.values())
    for j, (s, en, d, st) in sorted(jobs.items()):
        run = [stages[x] for x in st if x in stages]
        print(j, round((s - t0) / 1000, 2), round(((en or s) - s) / 1000, 2), d, run)


if __name__ == "__main__":
    main(sys.argv[1])
