"""Skew check: a third of the rows share one key; no task may take them all.

Builds samples from ``lineitem`` (sf0.1: 600,000 rows) where every third row
has the same URL, runs the hot-key paths (resolve, find_missing, last-wins
dedupe, row numbers within shard, the shard writer), and reads Spark's event
log (written to a fresh scratch folder) to report, per stage, the largest
share of the stage's records that one task processed.

AQE's skew thresholds are lowered in proportion to the data (the production
defaults of 256 MB apply to production-sized partitions).

Usage: python tools/skew_check.py [--sf DIR]
"""

from __future__ import annotations

import argparse
import glob
import io
import json
import os
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def stage_shares(log_dir: str) -> dict[int, tuple[str, int, float]]:
    import zstandard
    tasks: dict[int, list[int]] = {}
    names: dict[int, str] = {}
    for f in sorted(glob.glob(f"{log_dir}/*/events_*")):
        with open(f, "rb") as fh:
            stream = fh if not f.endswith(".zstd") else io.TextIOWrapper(
                zstandard.ZstdDecompressor().stream_reader(fh), encoding="utf-8")
            for line in stream:
                e = json.loads(line)
                if e["Event"] == "SparkListenerTaskEnd" and e.get("Task Metrics"):
                    # shuffle reads only: a one-row-group input file is one scan
                    # task by construction and says nothing about skew
                    m = e["Task Metrics"]
                    n = m.get("Shuffle Read Metrics", {}).get("Total Records Read", 0)
                    tasks.setdefault(e["Stage ID"], []).append(n)
                elif e["Event"] == "SparkListenerStageCompleted":
                    names[e["Stage Info"]["Stage ID"]] = e["Stage Info"]["Stage Name"]
    out = {}
    for sid, recs in tasks.items():
        total = sum(recs)
        if total:
            out[sid] = (names.get(sid, "?"), total, max(recs) / total)
    return out


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.1")
    a = ap.parse_args()
    from pyspark.sql import SparkSession
    from pyspark.sql import functions as F

    from corpusprep.operators import features as FE
    from corpusprep.operators import media as M
    from corpusprep.operators import resolve as R
    from corpusprep.operators import samples as S
    from corpusprep.operators.windows import row_number_within
    from corpusprep.session import SCALE_CONF, ensure_checkpoint_dir
    from corpusprep.sinks import writers as W

    log_dir = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    b = (SparkSession.builder.master("local[8]").appName("skew-check")
         .config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "16")
         .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", log_dir)
         .config("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "256k")
         .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
         .config("spark.sql.autoBroadcastJoinThreshold", "-1"))
    for k, v in SCALE_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)

    li = spark.read.parquet(f"{a.sf}/lineitem.parquet").repartition(16)
    url = F.when(F.col("l_orderkey") % 3 == 0, F.lit("http://hot/one.jpg")) \
        .otherwise(F.concat(F.lit("http://h/"), F.col("l_orderkey").cast("string"), F.lit("-"),
                            F.col("l_linenumber").cast("string"), F.lit("-"), F.col("l_partkey").cast("string")))
    raw = li.select(url.alias("downloadurl"), F.lit(0).alias("marker"), F.lit("png").alias("ext"),
                    (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("src"))
    samples = S.create_samples(raw)
    hot_key = samples.where("downloadurl = 'http://hot/one.jpg'").select("key").first().key
    store = samples.where(F.col("src") % 2 == 0).select(
        F.concat(F.lit("data/images/"), F.substring("key", 1, 3), F.lit("/"), F.substring("key", 4, 3),
                 F.lit("/"), F.col("key"), F.lit(".jpg")).alias("object_key"),
        F.lit("payload").alias("data")).distinct()
    archive = store.select(F.substring(F.regexp_extract("object_key", r"([^/]*)$", 1), 1, 3).alias("shard"),
                           F.col("object_key").alias("name")).where(F.col("name").contains(hot_key[:6]))

    runs = {
        "resolve_objects": lambda: R.resolve_objects(samples, store),
        "find_missing": lambda: R.find_missing(samples, archive, store),
        "dedupe_last": lambda: S.dedupe_last(samples.select("key", "src", "ext"), "key", "src"),
        # a third of the archive members are copies of one member
        "join_metadata_blobs": lambda: M.join_metadata_blobs(
            samples.select("shard", "key", "marker", F.col("src").alias("src_order")),
            samples.select("shard", F.concat(F.col("key"), F.lit(".jpg")).alias("name"),
                           F.col("src").cast("int").alias("ord"), F.lit("x").alias("data"))),
        "pending_features": lambda: FE.pending_features(
            samples.select("key", "src"), samples.where(F.col("src") % 5 == 0).select("key")),
        "row_number_within": lambda: row_number_within(samples.select("shard", "key", "src"), ["shard"], ["src"]),
    }
    report = {}
    for name, fn in runs.items():
        spark.sparkContext.setJobGroup(name, name)
        fn().write.format("noop").mode("overwrite").save()
    spark.sparkContext.setJobGroup("write_shard_jsonl", "write_shard_jsonl")
    W.write_shard_jsonl(samples.select("key", "shard", "src"), W.scratch_path(spark, "skew-k1"))
    spark.stop()

    shares = stage_shares(log_dir)
    worst = max(s for _, _, s in shares.values())
    big = {sid: v for sid, v in shares.items() if v[1] >= 100000}  # stages that shuffle real data
    report = {"stages": len(shares), "stages_over_100k_records": len(big),
              "max_task_share_in_big_stages": round(max(s for _, _, s in big.values()), 3) if big else None,
              "max_task_share_any_stage": round(worst, 3), "hot_key_share": 1 / 3}
    for sid, (n, tot, s) in sorted(big.items()):
        print(f"stage {sid:3d} records={tot:8d} max_task_share={s:.3f} {n[:60]}")
    print(json.dumps(report))


if __name__ == "__main__":
    main()
