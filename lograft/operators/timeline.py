"""Application timelines and cluster usage (AGG4-5, AGG11-12, AGG16-17, W2, W3, W5, J1, J6)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lograft.functions.parse import app_number, cluster_start
from lograft.operators.ordered import previous_row, running_totals
from lograft.session import materialize


def app_timeline(parsed: DataFrame) -> DataFrame:
    """First and last mention of each application (AGG4), plus ``app_number``.

    Partial aggregation collapses each input split to one row per application
    before the shuffle, so a cluster holding most applications is no hot spot.
    ``min``/``max`` skip NULL times, so grouping first and then dropping the
    ``''`` application and all-NULL groups equals filtering lines first, with
    each regex evaluated once per line.
    """
    return (
        parsed.groupBy("cluster_id", "application_id")
        .agg(F.min("event_time").alias("start_time"), F.max("event_time").alias("end_time"))
        .filter((F.col("application_id") != "") & F.col("start_time").isNotNull())
        .withColumn("app_number", app_number("application_id"))
    )


def with_duration(timeline: DataFrame) -> DataFrame:
    """``duration_sec`` = whole seconds from start to end."""
    return timeline.withColumn("duration_sec", F.expr("timestampdiff(SECOND, start_time, end_time)"))


def timeline_by_file(parsed_with_files: DataFrame) -> DataFrame:
    """Path-based identity: every line of a container file belongs to its application.

    Expects ``file_application_id`` (from ``file_identity``) and ``event_time``.
    """
    return (
        parsed_with_files.groupBy(F.col("file_application_id").alias("application_id"))
        .agg(F.min("event_time").alias("start_time"), F.max("event_time").alias("end_time"))
        .filter((F.col("application_id") != "") & F.col("start_time").isNotNull())
        .withColumn("cluster_id", F.regexp_extract("application_id", r"application_(\d+)_\d+", 1))
        .withColumn("app_number", app_number("application_id"))
    )


def cluster_summary(timeline: DataFrame) -> DataFrame:
    """Applications, first start and last end per cluster (AGG5)."""
    return timeline.groupBy("cluster_id").agg(
        F.count(F.lit(1)).alias("num_applications"),
        F.min("start_time").alias("cluster_first_app"),
        F.max("end_time").alias("cluster_last_app"),
    )


def cluster_stats(summary: DataFrame) -> DataFrame:
    """Totals and mean applications per cluster, 0 for no clusters (AGG11)."""
    clusters = F.count(F.lit(1))
    apps = F.coalesce(F.sum("num_applications"), F.lit(0)).cast("bigint")
    return summary.agg(
        clusters.alias("total_clusters"),
        apps.alias("total_applications"),
        F.coalesce(F.try_divide(apps.cast("double"), clusters), F.lit(0.0)).alias("avg_apps_per_cluster"),
    )


def cluster_rank(summary: DataFrame) -> DataFrame:
    """Rank of clusters by number of applications, ties sharing a rank (W5, AGG12).

    ``rank = 1 + #clusters with more applications``, taken from the histogram
    of distinct application counts: distinct positive counts that sum to at
    most the number of applications N are at most sqrt(2N) values, so the one
    ordered window runs over a provably small table, not over all clusters.
    """
    hist = summary.groupBy("num_applications").agg(F.count(F.lit(1)).alias("_c"))
    above = Window.orderBy(F.desc("num_applications")).rowsBetween(Window.unboundedPreceding, -1)
    ranks = hist.select(
        "num_applications",
        (F.lit(1) + F.coalesce(F.sum("_c").over(above), F.lit(0))).cast("int").alias("usage_rank"),
    )
    # at most sqrt(2N) rows, whatever share of the clusters one count holds
    return summary.join(F.broadcast(ranks), "num_applications").select("cluster_id", "num_applications", "usage_rank")


def most_used_clusters(summary: DataFrame, k: int = 5) -> DataFrame:
    """The "most heavily used clusters" list of the stats report (AGG12, SRT9)."""
    return summary.orderBy(F.desc("num_applications"), F.asc("cluster_id")).limit(k)


# Order buckets of the skew-safe windows, fine to coarse: no task holds more of a
# cluster than one minute's rows, or one day's minutes.
UNITS = {"_minute": "minute", "_day": "day"}


def _buckets(col: str, units: dict[str, str]) -> dict[str, F.Column]:
    return {name: F.date_trunc(unit, F.col(col)) for name, unit in units.items()}


def app_gaps(timeline: DataFrame, units: dict[str, str] = UNITS) -> DataFrame:
    """Idle time between consecutive applications of a cluster.

    ``gap_sec`` = this start minus the previous application's end (negative
    when they overlap), ordered by ``(start_time, application_id)``. Computed
    per ``(cluster, minute)`` with a carry from what came before, so a cluster
    that runs most applications does not land in one task.
    """
    rows = timeline.withColumns(_buckets("start_time", units))
    prev = previous_row(
        rows, ["cluster_id"], ["start_time", "application_id"], list(units), ["application_id", "end_time"]
    )
    return prev.select(
        "cluster_id",
        "application_id",
        "start_time",
        F.col("prev_application_id").alias("prev_application_id"),
        F.col("prev_end_time").alias("prev_end_time"),
        F.expr("timestampdiff(SECOND, prev_end_time, start_time)").alias("gap_sec"),
    )


def peak_concurrency(timeline: DataFrame, units: dict[str, str] = UNITS) -> DataFrame:
    """Largest number of applications running at once per cluster, and when.

    Sweep: +1 at every start, -1 at every end, running sum in time order;
    intervals are closed, so a start at the same instant as an end counts as
    overlapping (+1 before -1). The running sum uses the bucketed prefix sum.
    """
    events = timeline.select(
        "cluster_id",
        F.explode(
            F.array(
                F.struct(F.col("start_time").alias("t"), F.lit(1).alias("delta")),
                F.struct(F.col("end_time").alias("t"), F.lit(-1).alias("delta")),
            )
        ).alias("ev"),
    ).select("cluster_id", "ev.t", "ev.delta").withColumns(_buckets("t", units))
    swept = running_totals(events, ["cluster_id"], [F.col("t"), F.desc("delta")], list(units), {"running": "delta"})
    return swept.groupBy("cluster_id").agg(
        F.max("running").alias("peak_concurrency"),
        F.min_by("t", F.struct(F.negative("running"), F.col("t"))).alias("peak_at"),
    )


def app_overlap_counts(timeline: DataFrame, units: dict[str, str] = UNITS) -> DataFrame:
    """For each application, how many other applications of its cluster overlap it.

    Overlap of closed intervals: ``b.start <= a.end AND a.start <= b.end``. The
    count is ``#starts <= a.end - #ends < a.start - 1``, both counts come from one
    sweep over start/end/query points, so no pair of applications is ever
    materialised (the interval self-join would emit O(n^2) rows on a busy cluster).
    """
    # prio orders points at one instant: start < query(ends before) < query(starts up to) < end
    def point(t, prio, s, e, app):
        return F.struct(
            F.col(t).alias("t"), F.lit(prio).alias("prio"), F.lit(s).alias("s"), F.lit(e).alias("e"),
            (F.col("application_id") if app else F.lit(None).cast("string")).alias("q_app"),
        )

    pts = timeline.select(
        "cluster_id",
        F.explode(
            F.array(
                point("start_time", 0, 1, 0, False),
                point("end_time", 3, 0, 1, False),
                point("start_time", 1, 0, 0, True),
                point("end_time", 2, 0, 0, True),
            )
        ).alias("p"),
    ).select("cluster_id", "p.*").withColumns(_buckets("t", units))
    order = [F.col("t"), F.col("prio"), F.col("q_app")]
    swept = running_totals(pts, ["cluster_id"], order, list(units), {"starts_upto": "s", "ends_upto": "e"})
    q = swept.filter(F.col("q_app").isNotNull())
    counts = q.groupBy("cluster_id", F.col("q_app").alias("application_id")).agg(
        F.max(F.when(F.col("prio") == 2, F.col("starts_upto"))).alias("_starts_le_end"),
        F.max(F.when(F.col("prio") == 1, F.col("ends_upto"))).alias("_ends_lt_start"),
    )
    return counts.select(
        "cluster_id",
        "application_id",
        (F.col("_starts_le_end") - F.col("_ends_lt_start") - 1).cast("bigint").alias("overlapping_apps"),
    )


# Order buckets of epoch seconds and of their negatives, fine to coarse.
SECONDS = {"_minute": 60, "_day": 86_400}


def _swept_best(points: DataFrame, keys: list[str], widths: dict[str, int]) -> DataFrame:
    """The query points of a sweep with ``best``: the least ``val`` among the data points before them.
    ``points``: ``keys, t`` (whole number), ``prio`` (order at one ``t``), ``val`` (null for a query), ``q`` (null for data)."""
    rows = points.withColumns({name: F.floor(F.col("t") / F.lit(w)).cast("bigint") for name, w in widths.items()})
    order = [F.col("t"), F.col("prio"), F.col("q.application_id")]
    return running_totals(rows, keys, order, list(widths), {"best": "val"}, "min").filter("q is not null")


def longest_overlap(timeline: DataFrame, widths: dict[str, int] = SECONDS) -> DataFrame:
    """For each application, the other one of its cluster that overlaps it longest (J6): ``partner_id,
    overlap_sec``, both NULL where none does.

    Intervals are closed (one common instant is an overlap of 0 seconds); of equal overlaps the partner
    that ends last wins, then the least id. For an application ``a`` the others fall into three cases, each
    answered by the best one before a point of a sweep, so that no pair of applications is ever made:

    * ``b.start <= a.start``: the latest ``b.end`` in the order of starts;
    * ``b.start > a.start`` and ``b.end > a.end``: the earliest ``b.start`` in the reverse order of ends;
    * ``b`` inside ``a``: the longest ``b``. Its start lies in ``(a.start, a.end]``, which is cut into at
      most two dyadic intervals of each size; ``b`` stands in one of each size. Within one such interval
      it is the longest ``b`` in the order of ends. An application has so some ``3 log2(longest duration)``
      points, however many others it overlaps.

    The sweeps are bucketed (``ordered.running_totals``): no task holds more than a minute's points of a
    cluster or of a dyadic interval. Times are whole seconds, as in the log format.
    """
    seconds = lambda c: F.unix_seconds(F.col(c).cast("timestamp")).cast("bigint")
    apps = materialize(
        timeline.select("cluster_id", "application_id", seconds("start_time").alias("s"), seconds("end_time").alias("e"))
    )
    me = F.struct("application_id", "s", "e")
    nobody = F.lit(None).cast("struct<application_id:string,s:bigint,e:bigint>")

    def data(val):
        return val.alias("val"), nobody.alias("q")

    def candidates(found, partner, overlap, end, where):
        """Of each query its candidate: the longest first, then the latest end, then the id."""
        best = F.struct((-overlap).alias("less"), (-end).alias("early"), partner.alias("id"))
        return found.filter(where).select("cluster_id", "q.application_id", best.alias("found"))

    # b.start < a.start; those that start in the same second apart, without a itself
    ends_last = F.struct((-F.col("e")).alias("early"), F.col("application_id").alias("id"))
    none = F.lit(None).cast("struct<early:bigint,id:string>")
    points = apps.select("cluster_id", F.col("s").alias("t"), F.lit(1).alias("prio"), *data(ends_last)).unionByName(
        apps.select("cluster_id", F.col("s").alias("t"), F.lit(0).alias("prio"), none.alias("val"), me.alias("q"))
    )
    end = -F.col("best.early")
    before = candidates(
        _swept_best(points, ["cluster_id"], widths), F.col("best.id"), F.least("q.e", end) - F.col("q.s"), end, end >= F.col("q.s")
    )
    together = Window.partitionBy("cluster_id", "s").orderBy(F.desc("e"), F.asc("application_id"))
    first, second = F.first(ends_last).over(together), F.lead(ends_last).over(together)
    same = apps.withColumn("best", F.when(F.row_number().over(together) == 1, second).otherwise(first)).withColumn("q", me)
    same = candidates(same, F.col("best.id"), F.least("q.e", end) - F.col("q.s"), end, F.col("best").isNotNull())

    # b.end > a.end and a.start < b.start <= a.end
    starts_first = F.struct("s", (-F.col("e")).alias("early"), F.col("application_id").alias("id"))
    none = F.lit(None).cast("struct<s:bigint,early:bigint,id:string>")
    points = apps.select("cluster_id", (-F.col("e")).alias("t"), F.lit(1).alias("prio"), *data(starts_first)).unionByName(
        apps.select("cluster_id", (-F.col("e")).alias("t"), F.lit(0).alias("prio"), none.alias("val"), me.alias("q"))
    )
    start = F.col("best.s")
    after = candidates(
        _swept_best(points, ["cluster_id"], widths), F.col("best.id"), F.col("q.e") - start, -F.col("best.early"),
        (start > F.col("q.s")) & (start <= F.col("q.e")),
    )

    # a.start < b.start and b.end <= a.end
    longest = apps.agg(F.max(F.col("e") - F.col("s"))).first()[0] or 0
    level = F.explode(F.sequence(F.lit(0), F.lit(max(1, int(longest).bit_length())))).alias("level")
    length = F.struct((F.col("s") - F.col("e")).alias("less"), (-F.col("e")).alias("early"), F.col("application_id").alias("id"))
    none = F.lit(None).cast("struct<less:bigint,early:bigint,id:string>")
    inside = apps.select("cluster_id", F.col("s"), F.col("e").alias("t"), F.lit(0).alias("prio"), *data(length), level)
    inside = inside.withColumn("node", F.expr("shiftright(s, level)")).drop("s")
    asked = apps.select("cluster_id", F.col("e").alias("t"), F.lit(1).alias("prio"), none.alias("val"), me.alias("q"), level)
    # the part of (start, end] that is cut into whole intervals of a size: from lo up to hi, without hi
    asked = asked.withColumns({"lo": F.expr("-shiftright(-(q.s + 1), level)"), "hi": F.expr("shiftright(q.e + 1, level)")})
    odd = lambda c: F.when((F.col(c) % 2 != 0) & (F.col("lo") < F.col("hi")), F.col(c) - (1 if c == "hi" else 0))
    asked = asked.withColumn("node", F.explode(F.array_compact(F.array(odd("lo"), odd("hi"))))).drop("lo", "hi")
    found = _swept_best(inside.unionByName(asked), ["cluster_id", "level", "node"], widths)
    within = candidates(found, F.col("best.id"), -F.col("best.less"), -F.col("best.early"), F.col("best").isNotNull())

    every = before.unionByName(same).unionByName(after).unionByName(within)
    best = every.groupBy("cluster_id", "application_id").agg(F.min("found").alias("found"))
    return apps.select("cluster_id", "application_id").join(best, ["cluster_id", "application_id"], "left").select(
        "cluster_id", "application_id", F.col("found.id").alias("partner_id"), (-F.col("found.less")).alias("overlap_sec")
    )


def with_cluster_lookup(timeline: DataFrame, summary: DataFrame) -> DataFrame:
    """Join each application to its cluster's facts.

    The lookup side has one row per cluster; it is not hinted: adaptive
    execution measures it at runtime and broadcasts it when it is below
    ``spark.sql.adaptive.autoBroadcastJoinThreshold``, and keeps the shuffle
    join when a deployment has more clusters than that allows.
    """
    dim = summary.select(
        "cluster_id", "num_applications", cluster_start("cluster_id").alias("cluster_start")
    )
    return timeline.join(dim, "cluster_id", "left").select(
        "cluster_id",
        "application_id",
        "cluster_start",
        "num_applications",
        F.expr("timestampdiff(MILLISECOND, cluster_start, start_time)").alias("start_offset_ms"),
    )


def app_file_counts(files: DataFrame, k: int | None = 5) -> DataFrame:
    """Log files per application, largest first (AGG16, AGG17).

    ``files`` has ``file_application_id`` and ``path`` (one row per line or per file).
    """
    out = files.groupBy(F.col("file_application_id").alias("application_id")).agg(
        F.count_distinct("path").alias("num_files")
    )
    out = out.orderBy(F.desc("num_files"), F.asc("application_id"))
    return out.limit(k) if k else out
