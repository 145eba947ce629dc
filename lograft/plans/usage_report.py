"""The cluster-usage job end to end: timeline, cluster summary, stats, distribution data.

The logs are scanned once: the application timeline (one row per
application) is checkpointed in the shared folder, and every other output is
derived from it.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lograft.functions.parse import ensure_parsed
from lograft.operators import distribution, timeline
from lograft.session import cut_lineage
from lograft.sources.logs import with_file_identity
from lograft.sinks import write_csv, write_report, write_single_csv

TS_FORMAT = "yyyy-MM-dd HH:mm:ss"


# The labels below are those of the published report (fixed values).
def stats_text(total_clusters: int, total_apps: int, avg: float, top: list[tuple[str, int]]) -> str:
    lines = [
        f"Total unique clusters: {total_clusters}",
        f"Total applications: {total_apps}",
        f"Average applications per cluster: {avg:.2f}",
        "",
        "Most heavily used clusters:",
    ]
    lines += [f"  Cluster {cid}: {n} applications" for cid, n in top]
    return "\n".join(lines) + "\n"


def run_usage_report(
    spark: SparkSession, lines: DataFrame, out_dir: str, top_k: int = 5, identity: str = "mention"
) -> dict:
    """``identity='mention'``: an application spans the lines that name it (the
    original job's rule); ``'file'``: every line of its container files counts
    (needs a ``path`` column, e.g. ``read_log_lines(..., with_path=True)``)."""
    if identity == "file":
        tl = timeline.timeline_by_file(ensure_parsed(with_file_identity(lines)))
    else:
        tl = timeline.app_timeline(ensure_parsed(lines))
    tl = cut_lineage(tl)
    summary = cut_lineage(timeline.cluster_summary(tl))

    # one row per application: written by many tasks, each a range of the order
    write_csv(
        tl.select("cluster_id", "application_id", "app_number", "start_time", "end_time").orderBy(
            "cluster_id", "start_time", "application_id"
        ),
        os.path.join(out_dir, "app_timeline.csv"),
        TS_FORMAT,
    )
    write_single_csv(
        summary,
        os.path.join(out_dir, "cluster_summary.csv"),
        [F.desc("num_applications"), F.asc("cluster_id")],
        TS_FORMAT,
    )
    stats = timeline.cluster_stats(summary).first()
    top = [(r["cluster_id"], r["num_applications"]) for r in timeline.most_used_clusters(summary, top_k).collect()]
    text = stats_text(stats["total_clusters"], stats["total_applications"], stats["avg_apps_per_cluster"], top)
    write_report(spark, text, os.path.join(out_dir, "usage_stats.txt"))

    durations = distribution.top_cluster_durations(tl, summary)
    write_single_csv(distribution.histogram(durations, 30), os.path.join(out_dir, "duration_histogram.csv"), ["bin"])
    write_single_csv(distribution.density(durations), os.path.join(out_dir, "duration_density.csv"), ["point"])
    return {
        "total_clusters": stats["total_clusters"],
        "total_applications": stats["total_applications"],
        "avg_apps_per_cluster": stats["avg_apps_per_cluster"],
        "top_clusters": top,
        "stats": text,
    }
