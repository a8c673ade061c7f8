"""Print per-stage wall time from a Spark event log folder (``spark.eventLog.dir``).
usage: python tools/stage_times.py <eventlog dir>"""

import glob
import io
import json
import sys

import zstandard


def lines(path):
    raw = open(path, "rb").read()
    if path.endswith(".zstd"):
        raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read()
    return raw.decode("utf-8", "replace").splitlines()


for f in sorted(glob.glob(sys.argv[1] + "/**/*", recursive=True)):
    if not ("events" in f or "eventlog" in f) or f.endswith("/"):
        continue
    try:
        ls = lines(f)
    except (IsADirectoryError, zstandard.ZstdError):
        continue
    for line in ls:
        e = json.loads(line)
        if e["Event"] == "SparkListenerStageCompleted":
            i = e["Stage Info"]
            print(i["Stage ID"], i["Number of Tasks"], round((i["Completion Time"] - i["Submission Time"]) / 1000, 2),
                  i["Stage Name"][:60])
