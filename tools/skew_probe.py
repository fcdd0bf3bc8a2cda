"""Skew probe for the walking-distance join (a development tool, not a query).

Points: the stops of ``sf_dir`` replicated ``--copies`` times with small
offsets, then a third of all rows moved into one dense spot (a single grid
cell). Centres: one per school plus one at the dense spot. The join runs two
ways and reports wall time, result checksum, and the slowest vs median task
of the largest stage (from the event log in a scratch folder):

  whole          both sides joined on the cell; adaptive skew splitting only
  split          as above with crowded cells split by place and hash

and, separately, the (suburb, month) price aggregation with a third of all
(replicated) price rows in one suburb.

usage: python tools/skew_probe.py [sf_dir] [--copies N] [--cell-points N]
"""

from __future__ import annotations

import argparse
import glob
import io
import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def _events(log_dir):
    for path in sorted(glob.glob(os.path.join(log_dir, "**", "events_*"), recursive=True)):
        import zstandard
        raw = zstandard.ZstdDecompressor().stream_reader(open(path, "rb")) if path.endswith(".zstd") \
            else open(path, "rb")
        with io.TextIOWrapper(raw, encoding="utf-8") as f:
            for line in f:
                yield json.loads(line)


def stage_skew(log_dir):
    """group -> (max task s, median task s, tasks) of its straggler stage: among
    stages with more than one task, the one whose slowest task is slowest."""
    stage_group, tasks = {}, {}
    for ev in _events(log_dir):
        if ev.get("Event") == "SparkListenerJobStart":
            g = (ev.get("Properties") or {}).get("spark.jobGroup.id")
            for sid in ev.get("Stage IDs", []):
                stage_group[sid] = g
        elif ev.get("Event") == "SparkListenerTaskEnd":
            info = ev.get("Task Info") or {}
            dur = (info.get("Finish Time", 0) - info.get("Launch Time", 0)) / 1000.0
            tasks.setdefault(ev.get("Stage ID"), []).append(dur)
    out = {}
    for sid, durs in tasks.items():
        g = stage_group.get(sid)
        if not g or len(durs) < 2:
            continue
        if g not in out or max(durs) > out[g][3]:
            out[g] = (round(max(durs), 3), round(statistics.median(durs), 3), len(durs), max(durs))
    return {g: v[:3] for g, v in out.items()}


def shuffle_records(log_dir):
    """group -> shuffle records written by each of its shuffle-writing stages, in order."""
    stage_group, per_stage = {}, {}
    for ev in _events(log_dir):
        if ev.get("Event") == "SparkListenerJobStart":
            for sid in ev.get("Stage IDs", []):
                stage_group[sid] = (ev.get("Properties") or {}).get("spark.jobGroup.id")
        elif ev.get("Event") == "SparkListenerTaskEnd":
            m = (ev.get("Task Metrics") or {}).get("Shuffle Write Metrics") or {}
            sid = ev.get("Stage ID")
            per_stage[sid] = per_stage.get(sid, 0) + m.get("Shuffle Records Written", 0)
    out = {}
    for sid in sorted(per_stage):
        g = stage_group.get(sid)
        if g and per_stage[sid]:
            out.setdefault(g, []).append(per_stage[sid])
    return out


def stage_tasks(log_dir):
    stage_group, tasks = {}, {}
    for ev in _events(log_dir):
        if ev.get("Event") == "SparkListenerJobStart":
            for sid in ev.get("Stage IDs", []):
                stage_group[sid] = (ev.get("Properties") or {}).get("spark.jobGroup.id")
        elif ev.get("Event") == "SparkListenerTaskEnd":
            info = ev.get("Task Info") or {}
            tasks.setdefault(ev.get("Stage ID"), []).append((info.get("Finish Time", 0) - info.get("Launch Time", 0)) / 1000.0)
    return {sid: (stage_group.get(sid), d) for sid, d in tasks.items()}


def main():
    from pyspark.sql import functions as F

    from tussock.operators.spatial import count_within_distance
    from tussock.plans import staging as stg
    from tussock.session import get_spark

    ap = argparse.ArgumentParser()
    ap.add_argument("sf_dir", nargs="?", default="/root/testdata/sf0.1")
    ap.add_argument("--copies", type=int, default=10)
    ap.add_argument("--cell-points", type=int, default=20_000)
    args = ap.parse_args()

    log_dir = tempfile.mkdtemp(prefix="tussock-skew-", dir="/tmp")
    spark = get_spark("local[8]", app_name="tussock-skew", shuffle_partitions=32,
                      extra_conf={"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
                                  "spark.driver.memory": "16g"})
    land = stg.Landing.from_testdata(spark, args.sf_dir)
    stops = stg.stg_stops(land.stops).select("stop_id", "lat", "lon")
    copies = stops.select(F.explode(F.sequence(F.lit(0), F.lit(args.copies - 1))).alias("copy"), "*")
    hot = (F.xxhash64("stop_id", "copy") % 3) == 0                      # a third of all rows
    points = copies.select(
        (F.col("stop_id") * args.copies + F.col("copy")).alias("pid"),
        F.when(hot, F.lit(-36.85) + (F.col("stop_id") % 100) * 1e-6)
         .otherwise(F.col("lat") + F.col("copy") * 1e-5).alias("lat"),
        F.when(hot, F.lit(174.76)).otherwise(F.col("lon")).alias("lon"),
    )
    schools = stg.stg_schools(land.schools).filter(F.col("lat").isNotNull() & F.col("lon").isNotNull())
    centres = schools.select(F.col("school_id").cast("string").alias("cid"),
                             F.col("lat").alias("centroid_lat"), F.col("lon").alias("centroid_lon"))
    centres = centres.unionByName(spark.createDataFrame([("dense", -36.85, 174.76)],
                                                        "cid string, centroid_lat double, centroid_lon double"))
    variants = {"whole": {"cell_points": 1 << 60}, "split": {"cell_points": args.cell_points}}
    result = {"points": None}
    for attempt in ("warm", "timed"):       # the first pass only warms the JVM
        for name, kw in variants.items():
            spark.sparkContext.setJobGroup(f"{name}-{attempt}", name)
            t0 = time.perf_counter()
            df = count_within_distance(centres, points, 0.8, "cid", "pid", "n", **kw)
            total = df.agg(F.sum("n").alias("s"), F.count(F.lit(1)).alias("c")).first()
            result[name] = {"sec": round(time.perf_counter() - t0, 2), "pairs": total.s, "centres": total.c}
    result["points"] = points.count()

    # Hot suburb: a third of all price rows (prices replicated --copies times)
    # in one suburb; the (suburb, month) aggregation combines map-side first.
    from tussock.plans.marts import property_by_suburb_month
    prices = stg.stg_prices(land.prices)
    many = prices.select(F.explode(F.sequence(F.lit(0), F.lit(args.copies - 1))).alias("copy"), "*")
    hot_suburb = (F.xxhash64("district", "report_date", "avg_sale_price", "copy") % 3) == 0
    many = many.withColumn("suburb", F.when(hot_suburb, F.lit("Hot Suburb")).otherwise(F.col("suburb"))).drop("copy")
    many = many.repartition(16)           # stands in for 16 input files (the test table is one file)
    for attempt in ("warm", "timed"):
        spark.sparkContext.setJobGroup(f"hot_suburb_aggregate-{attempt}", "hot suburb")
        t0 = time.perf_counter()
        agg = property_by_suburb_month(many)
        n = agg.count()
        result["hot_suburb_aggregate"] = {"sec": round(time.perf_counter() - t0, 2), "groups": n,
                                          "price_rows": None}
    result["hot_suburb_aggregate"]["price_rows"] = many.count()
    spark.stop()
    written = shuffle_records(log_dir)
    # [rows redistributed into 16 splits, rows leaving the partial aggregation, count()]
    result["hot_suburb_aggregate"]["shuffle_records_by_stage"] = written.get("hot_suburb_aggregate-timed")
    for group, (mx, med, n) in stage_skew(log_dir).items():
        name = group.rsplit("-", 1)[0]
        if group.endswith("-timed") and name in result:
            result[name].update({"slowest_task_s": mx, "median_task_s": med, "tasks": n})
    print(json.dumps(result))
    if os.environ.get("SKEW_PROBE_STAGES"):
        for sid, (g, durs) in sorted(stage_tasks(log_dir).items()):
            print(g, sid, len(durs), round(max(durs), 3), round(statistics.median(durs), 3), file=sys.stderr)


if __name__ == "__main__":
    main()
