"""Time every registered query: N full passes in registry order, each with a fresh context (so each
pass recomputes and re-materialises every stage), after one warm-up pass on sf0.001. Prints a
markdown table of rows out, the median seconds per query and the shuffle bytes written by the
query's jobs in the first pass (from Spark's event log, written to a scratch folder; no UI).

    python tools/baseline_table.py /root/testdata/sf0.1 3
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cohortkit.plans import catalog  # noqa: E402
from cohortkit.session import local_session  # noqa: E402


def one_pass(spark, sf_dir, tag=""):
    ctx = catalog.Ctx(spark, sf_dir)
    times, rows = {}, {}
    for name, fn in catalog.REGISTRY.items():
        spark.sparkContext.setJobGroup(f"{tag}{name}", name)
        t = time.perf_counter()
        df = fn(ctx)
        df.write.format("noop").mode("overwrite").save()
        times[name] = time.perf_counter() - t
        rows[name] = df.count()
    return times, rows


def shuffle_bytes(log_dir: str, tag: str) -> dict[str, int]:
    """Shuffle bytes written per job group ``<tag><query>`` from the event log."""
    job_group, stage_job, out = {}, {}, {}
    paths = sorted(p for p in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True) if os.path.isfile(p))
    for path in paths:
        with open(path) as fh:
            for line in fh:
                try:
                    ev = json.loads(line)
                except ValueError:
                    continue
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    g = (ev.get("Properties") or {}).get("spark.jobGroup.id", "")
                    job_group[ev["Job ID"]] = g
                    for sid in ev.get("Stage IDs", []):
                        stage_job[sid] = ev["Job ID"]
                elif kind == "SparkListenerTaskEnd":
                    m = (ev.get("Task Metrics") or {}).get("Shuffle Write Metrics") or {}
                    g = job_group.get(stage_job.get(ev.get("Stage ID")), "")
                    if g.startswith(tag):
                        out[g[len(tag):]] = out.get(g[len(tag):], 0) + int(m.get("Shuffle Bytes Written", 0))
    return out


def _fmt(n: int) -> str:
    for unit in ("B", "KB", "MB", "GB"):
        if n < 1024:
            return f"{n:.0f} {unit}"
        n /= 1024
    return f"{n:.1f} TB"


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    n = int(sys.argv[2]) if len(sys.argv) > 2 else 3
    log_dir = tempfile.mkdtemp(prefix="run-eventlog-", dir="/tmp")
    spark = local_session(extra_conf={"spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file://{log_dir}",
                                     "spark.eventLog.compress": "false"})
    one_pass(spark, "/root/testdata/sf0.001", "warm:")
    runs = [one_pass(spark, sf, f"p{i}:") for i in range(n)]
    spark.stop()
    sb = shuffle_bytes(log_dir, "p0:")
    print("| query | rows out | seconds (median of %d) | shuffle bytes written (pass 1) |" % n)
    print("| --- | --- | --- | --- |")
    total = 0.0
    for name in catalog.REGISTRY:
        med = statistics.median(r[0][name] for r in runs)
        total += med
        print(f"| {name} | {runs[0][1][name]} | {med:.2f} | {_fmt(sb.get(name, 0))} |")
    print(f"| **all {len(catalog.REGISTRY)} queries, one pass** | | **{total:.1f}** | **{_fmt(sum(sb.values()))}** |")


if __name__ == "__main__":
    main()
