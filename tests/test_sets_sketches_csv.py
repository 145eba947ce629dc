"""File sets with gaps and drift, inventories, pruning, sketches and CSV text against plain models."""

import datetime as dt
import math
import os
import random
import subprocess
import tempfile

import numpy as np
import pytest
from conftest import SF0001
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lograft.functions import csv_text
from lograft.operators import sketches
from lograft.sources import sets, tables
from lograft.sources.logs import file_inventory, inventory_totals, read_application


def folder(name):
    return tempfile.mkdtemp(prefix=f"lograft-{name}-", dir="/tmp")


# ---------------------------------------------------------------- inventory and pruning
@pytest.fixture(scope="module")
def log_tree():
    root = folder("tree")
    for k in range(194):
        app = f"application_1485248649253_{k:04d}"
        os.makedirs(f"{root}/{app}")
        for c in range(1 + k % 3):
            with open(f"{root}/{app}/container_1485248649253_{k:04d}_01_{c + 1:06d}.log", "w") as f:
                if (k + c) % 5:
                    f.write("17/03/29 10:04:41 INFO X: a\n" * (1 + c))
    os.makedirs(f"{root}/application_1485248649253_9999")
    with open(f"{root}/application_1485248649253_9999/container_1485248649253_9999_01_000001.log", "w"):
        pass
    with open(f"{root}/notes.txt", "w") as f:
        f.write("x\n")
    return root


def test_inventory_counts_as_the_shell_does(spark, log_tree):
    shell = lambda c: int(subprocess.run(c, shell=True, capture_output=True, text=True, check=True).stdout)
    files = file_inventory(spark, log_tree)
    got = inventory_totals(files).first().asDict()
    assert got["log_files"] == shell(f"find {log_tree} -name '*.log' | wc -l")
    assert got["applications"] == shell(f"ls -d {log_tree}/application_* | wc -l") == 195
    assert got["empty_files"] == shell(f"find {log_tree} -name '*.log' -size 0 | wc -l") > 0
    assert got["lines"] == shell(f"cat {log_tree}/*/*.log | wc -l") and got["unread_files"] == 0
    plan = files._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan
    assert inventory_totals(files.limit(0)).first()["log_files"] == 0


def test_a_file_that_cannot_be_read_still_counts(spark):
    root = folder("unread")
    app = f"{root}/application_1_0001"
    os.makedirs(app)
    with open(f"{app}/container_1_0001_01_000001.log", "w") as f:
        f.write("a\nb\n")
    with open(f"{app}/container_1_0001_01_000002.log.gz", "wb") as f:
        f.write(b"this is no gzip stream")
    got = {os.path.basename(r["path"]): (r["length"], r["lines"]) for r in file_inventory(spark, root, None).collect()}
    assert got == {"container_1_0001_01_000001.log": (4, 2), "container_1_0001_01_000002.log.gz": (22, None)}
    assert inventory_totals(file_inventory(spark, root, None)).first()["unread_files"] == 1


def test_one_application_reads_its_own_files_only(spark, log_tree):
    app = "application_1485248649253_0002"
    rows = read_application(spark, log_tree, app)
    assert len(rows.inputFiles()) == 3 and all(app in f for f in rows.inputFiles())
    assert {os.path.basename(os.path.dirname(r["path"])) for r in rows.collect()} == {app}
    with pytest.raises(ValueError):
        read_application(spark, log_tree, "application_*")


def test_few_keys_prune_partitions_at_run_time(spark):
    root = folder("prune") + "/trips"
    spark.range(4000).selectExpr("id", "CAST(2000 + id % 40 AS INT) AS yyyy").write.partitionBy("yyyy").parquet(root)
    years = folder("years") + "/years"
    spark.createDataFrame([(2001, "x"), (2002, "y"), (2003, "x")], "yyyy int, kind string").write.parquet(years)
    keys = spark.read.parquet(years).where("kind = 'x'")
    found = tables.rows_of_keys(tables.partitioned_parquet(spark, root), keys, "yyyy")
    assert sorted({r["yyyy"] for r in found.collect()}) == [2001, 2003] and found.count() == 200
    assert "dynamicpruning" in found._jdf.queryExecution().optimizedPlan().toString().lower()


# ---------------------------------------------------------------- files that are missing, corrupt or different
def test_months_that_are_missing_or_corrupt(spark):
    root = folder("months")
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("fare", T.DoubleType())])
    names = [f"trips_2021-{m:02d}.parquet" for m in range(1, 8)]

    def put(name, n, half="0.5D"):
        path = f"{folder('one')}/x"
        spark.range(n).selectExpr("id", f"id * {half} AS fare").coalesce(1).write.parquet(path)
        part = next(f for f in os.listdir(path) if f.endswith(".parquet"))
        with open(f"{path}/{part}", "rb") as f:
            data = f.read()
        with open(f"{root}/{name}", "wb") as f:
            f.write(data)
        return len(data)

    put(names[0], 10)
    size = put(names[1], 500)
    with open(f"{root}/{names[1]}", "r+b") as f:
        f.truncate(size // 2)
    put(names[2], 0)
    put(names[4], 7)
    with open(f"{root}/{names[5]}", "w") as f:
        f.write("no parquet")
    put(names[6], 5, "0.5")  # decimals, which can't be read as doubles
    rows, report = sets.read_available(spark, root, names, schema)
    assert rows.where("fare is not null").count() == 17 and rows.agg(F.sum("fare")).first()[0] == 22.5 + 10.5
    got = {r["name"]: (r["outcome"], r["rows"]) for r in report.collect()}
    assert got == {names[0]: ("read", 10), names[1]: ("corrupt", None), names[2]: ("read", 0), names[3]: ("missing", None),
                   names[4]: ("read", 7), names[5]: ("corrupt", None), names[6]: ("partial", 0)}
    rows, report = sets.read_available(spark, root, ["nope.parquet"], schema)
    assert rows.count() == 0 and [tuple(r) for r in report.collect()] == [("nope.parquet", "missing", None)]


KINDS = ["tinyint", "smallint", "int", "bigint", "float", "double", "timestamp", "timestamp_ntz", "date", "string", "boolean"]
WIDER = {frozenset(p): w for *p, w in [
    ("tinyint", "smallint", "smallint"), ("tinyint", "int", "int"), ("tinyint", "bigint", "bigint"), ("smallint", "int", "int"),
    ("smallint", "bigint", "bigint"), ("int", "bigint", "bigint"), ("tinyint", "float", "float"), ("smallint", "float", "float"),
    ("int", "float", "double"), ("bigint", "float", "double"), ("tinyint", "double", "double"), ("smallint", "double", "double"),
    ("int", "double", "double"), ("bigint", "double", "double"), ("float", "double", "double"),
    ("timestamp", "timestamp_ntz", "timestamp_ntz"), ("timestamp", "date", "timestamp_ntz"), ("timestamp_ntz", "date", "timestamp_ntz")]}


def test_types_widen_or_are_refused():
    make = lambda k: T._parse_datatype_string(k)
    for a in KINDS:
        for b in KINDS:
            got = sets.wider(make(a), make(b))
            want = a if a == b else WIDER.get(frozenset((a, b)))
            assert (got.simpleString() if got else None) == want, (a, b)


def test_files_of_different_schemas(spark):
    root = folder("drift")
    spark.sql("SELECT 1 AS id, CAST(2 AS INT) AS n, CAST('2021-01-02 03:04:05' AS TIMESTAMP) AS at, 'x' AS old").write.parquet(f"{root}/a")
    spark.sql("SELECT 2 AS id, CAST(3000000000 AS BIGINT) AS n, TIMESTAMP_NTZ '2021-01-02 03:04:06.5' AS at").write.parquet(f"{root}/b")
    spark.sql("SELECT 1.5D AS n, 3 AS id, true AS new").write.parquet(f"{root}/c")
    spark.sql("SELECT 'no' AS n").write.parquet(f"{root}/d")
    with pytest.raises(Exception):  # noqa: B017 what Spark's own merge refuses
        spark.read.option("mergeSchema", "true").parquet(f"{root}/a", f"{root}/b", f"{root}/c").count()
    for zone in ("UTC", "America/New_York"):
        old = spark.conf.get("spark.sql.session.timeZone")
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            got = sets.union_by_name(spark, [f"{root}/a", f"{root}/b", f"{root}/c"])
            assert dict(got.dtypes) == {"id": "int", "n": "double", "at": "timestamp_ntz", "old": "string", "new": "boolean"}
            rows = {r["id"]: tuple(r)[1:] for r in got.collect()}
        finally:
            spark.conf.set("spark.sql.session.timeZone", old)
        assert rows[1] == (2.0, dt.datetime(2021, 1, 2, 3, 4, 5), "x", None)
        assert rows[2] == (3e9, dt.datetime(2021, 1, 2, 3, 4, 6, 500_000), None, None) and rows[3] == (1.5, None, None, True)
    with pytest.raises(sets.SchemaConflict, match="n: .*string"):
        sets.union_by_name(spark, [f"{root}/a", f"{root}/d"])
    plan = sets.union_by_name(spark, [f"{root}/a", f"{root}/b"]).where("id = 2").select("n")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("EqualTo(id,2)") >= 2 and "old" not in plan
    with pytest.raises(ValueError):
        sets.union_by_name(spark, [])


# ---------------------------------------------------------------- sketches
def priced(spark, n=6000, seed=3):
    rnd = random.Random(seed)
    rows = [(2020 + k % 2, 1 + k % 3, k % 28, rnd.choice([None, 0.0, rnd.uniform(-50, 50), rnd.lognormvariate(5, 2)])) for k in range(n)]
    return rows, spark.createDataFrame(rows, "dt_year int, dt_month int, dt_day int, v double").repartition(5)


DAY = ["dt_year", "dt_month", "dt_day"]


def test_merged_value_sketches_equal_those_of_all_rows(spark):
    rows, frame = priced(spark)
    path = folder("sketch")
    days = sketches.value_sketches(frame, DAY, "v")
    days.where("dt_day < 14").write.parquet(f"{path}/s")
    days.where("dt_day >= 14").write.mode("append").parquet(f"{path}/s")  # new days add rows
    stored = spark.read.parquet(f"{path}/s")
    as_rows = lambda df: {tuple(r[c] for c in df.columns if c != "sketch") + (tuple(sorted(r["sketch"].items())),) for r in df.collect()}
    months = sketches.merge_values(stored, ["dt_year", "dt_month"])
    assert as_rows(months) == as_rows(sketches.value_sketches(frame, ["dt_year", "dt_month"], "v"))
    assert as_rows(sketches.merge_values(months, [])) == as_rows(sketches.value_sketches(frame, [], "v"))
    for p in (0.0, 0.01, 0.5, 0.95, 1.0):
        low, high = sketches.value_bounds(p)
        got = {(r["dt_year"], r["dt_month"]): (r["low"], r["high"]) for r in months.select("*", low.alias("low"), high.alias("high")).collect()}
        for (y, m), (a, b) in got.items():
            own = sorted(v for yy, mm, _, v in rows if (yy, mm) == (y, m) and v is not None)
            exact = round(own[max(1, math.ceil(p * len(own))) - 1], 2)
            assert a - 1e-9 <= exact <= b + 1e-9
            assert b - a <= max(abs(a), abs(b)) * 2 ** (1 - sketches.BITS) + 1e-9
    assert sketches.value_sketches(frame.limit(0), DAY, "v").count() == 0


def test_merged_rank_sketches_stay_within_their_error(spark):
    rng = np.random.default_rng(1)
    values = rng.normal(size=40_000)
    frame = spark.createDataFrame([(int(k % 20), float(v)) for k, v in enumerate(values)], "day int, v double").repartition(6)
    days = sketches.rank_sketches(frame, ["day"], "v")
    path = folder("ranks")
    days.write.parquet(f"{path}/s")
    stored = spark.read.parquet(f"{path}/s").withColumn("half", F.col("day") < 10)
    halves = sketches.merge_ranks(stored, ["half"])
    merged, whole = sketches.merge_ranks(halves, []), sketches.rank_sketches(frame, [], "v")
    order = np.sort(values)
    for p in (0.05, 0.5, 0.95):
        for frame_ in (merged, whole):
            estimate = frame_.select(sketches.rank_quantile(p).alias("q")).first()["q"]
            assert abs(np.searchsorted(order, estimate) / len(order) - p) < 0.02


def test_merged_distinct_sketches_stay_within_their_error(spark):
    frame = spark.range(120_000).selectExpr("id % 30 AS day", "id % 45000 AS user", "'x' AS other").repartition(6)
    days = sketches.distinct_sketches(frame, ["day"], "user")
    halves = sketches.merge_distinct(days.withColumn("half", F.col("day") < 15), ["half"])
    total = sketches.merge_distinct(halves, []).select(sketches.distinct_estimate().alias("n")).first()["n"]
    assert abs(total - 45_000) <= sketches.distinct_error() * 45_000
    again = sketches.merge_distinct(days.unionByName(days), []).select(sketches.distinct_estimate().alias("n")).first()["n"]
    assert again == total  # what is merged twice counts once
    exact = {r["day"]: r["n"] for r in frame.groupBy("day").agg(F.count_distinct("user").alias("n")).collect()}
    for r in days.select("day", sketches.distinct_estimate().alias("n")).collect():
        assert abs(r["n"] - exact[r["day"]]) <= sketches.distinct_error() * exact[r["day"]]


def test_a_days_sketch_is_stored_once(spark):
    """Months and the whole are made from the stored rows: the facts are scanned by the first job only."""
    from lograft.plans.catalog import QUERIES

    plan = QUERIES["fare_quantiles"](spark, SF0001)._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in plan and "Scan ExistingRDD" in plan


# ---------------------------------------------------------------- CSV text
FIELDS = [None, "", " lead", "trail ", "a,b", 'say "x"', '"', '""', "two\nlines", "back\\slash", "\\", "ü,ß", "plain", ",", "'", "\ttab"]


def test_csv_lines_come_back_as_they_were(spark):
    rnd = random.Random(2)
    rows = [(k, rnd.choice(FIELDS), rnd.choice([None, 1.5, -2.0]), rnd.choice(FIELDS),
             rnd.choice([None, dt.datetime(2021, 3, 4, 5, 6, 7, 89_000)]), rnd.choice([None, True, False])) for k in range(300)]
    schema = T._parse_datatype_string("k bigint, a string, x double, b string, at timestamp, yes boolean")
    frame = spark.createDataFrame(rows, schema)
    lines = frame.select(csv_text.csv_line(*schema.names).alias("value"))
    back = csv_text.csv_rows(lines, schema)
    assert back.where(f"{csv_text.MALFORMED} is not null").count() == 0
    assert sorted(map(tuple, back.drop(csv_text.MALFORMED).collect()), key=str) == sorted(map(tuple, frame.collect()), key=str)
    assert csv_text.header(frame) == "k,a,x,b,at,yes"


def test_csv_form(spark):
    row = spark.sql("SELECT 'a' AS a, TIMESTAMP '2016-07-27 19:45:33' AS t, TIMESTAMP_NTZ '2016-07-27 19:45:33' AS n, 'x \"y\", z' AS q, '' AS e, CAST(NULL AS STRING) AS z")
    assert row.select(csv_text.csv_line(*row.columns)).first()[0] == 'a,2016-07-27T19:45:33.000Z,2016-07-27T19:45:33.000,"x ""y"", z","",'
    assert row.select(csv_text.csv_line("t", "n", timestamp_format="yyyy-MM-dd HH:mm:ss")).first()[0] == "2016-07-27 19:45:33,2016-07-27 19:45:33"


def test_broken_lines_are_kept_apart(spark):
    schema = T._parse_datatype_string("k bigint, name string, at timestamp")
    lines = ["1,a,2016-07-27T19:45:33.000Z", "2,b", "3,c,2016-07-27T19:45:33.000Z,more", "x,d,2016-07-27T19:45:33.000Z", "5,e,yesterday", ",,"]
    got = csv_text.csv_rows(spark.createDataFrame([(x,) for x in lines], "value string"), schema)
    rows = {r[csv_text.MALFORMED]: r for r in got.collect()}
    assert set(rows) == {None, *lines[1:5]} and got.where(f"{csv_text.MALFORMED} is null").count() == 2


def test_lines_equal_the_files_that_the_writer_makes(spark):
    """A line of text in the engine is the line that the CSV writer puts into a file."""
    frame = spark.createDataFrame([(1, "a,b"), (2, 'q "x"'), (3, "plain"), (4, None)], "k bigint, s string")
    out = folder("csv") + "/x"
    frame.coalesce(1).write.option("escape", '"').csv(out)
    written = sorted(r[0] for r in spark.read.text(out).collect())
    assert sorted(r[0] for r in frame.select(csv_text.csv_line("k", "s")).collect()) == written
