"""Job durations from a Spark event log (no UI needed).

Run a job with
    spark.eventLog.enabled=true, spark.eventLog.dir=<scratch folder>,
    spark.eventLog.compress=false
then: python scripts/job_times.py <event log file or folder>

Prints one line per job: id, milliseconds, and the job description that
``tablepipe`` sets for each step of a load ("tablepipe: write to staging ...").
"""

from __future__ import annotations

import glob
import json
import os
import sys


def main() -> None:
    path = sys.argv[1]
    if os.path.isdir(path):
        files = [p for p in glob.glob(os.path.join(path, "**"), recursive=True) if os.path.isfile(p)]
        path = max(files, key=os.path.getsize)
    starts = {}
    with open(path, encoding="utf-8") as fh:
        for line in fh:
            e = json.loads(line)
            if e.get("Event") == "SparkListenerJobStart":
                props = e.get("Properties") or {}
                desc = props.get("spark.job.description") or props.get("callSite.short", "")
                starts[e["Job ID"]] = (e["Submission Time"], desc)
            elif e.get("Event") == "SparkListenerJobEnd" and e["Job ID"] in starts:
                t0, desc = starts[e["Job ID"]]
                print(f"{e['Job ID']:>5} {e['Completion Time'] - t0:>8} ms  {desc[:100]}")


if __name__ == "__main__":
    main()
