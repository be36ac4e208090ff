"""Skew check: run the keyed operators on inputs where one key holds a third
of all rows, and report, per operator, the largest task's share of the rows
read by its stages (from Spark's event log in a fresh scratch folder).

usage: python tools/skew_report.py [sf_dir] [out.md]
"""

from __future__ import annotations

import glob
import json
import sys
import tempfile
from collections import defaultdict
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from quarry.operators import accounts as A  # noqa: E402
from quarry.operators.keyed import (  # noqa: E402
    char_distribution,
    char_occurrence_counts,
    char_occurrence_lists,
    lookup_penalty,
    lookup_with_default,
    sum_by_key,
    sum_by_key_gathered,
)
from quarry.operators.ordering import with_row_index  # noqa: E402
from quarry.plans import standins as S  # noqa: E402
from quarry.sources.tables import read_table  # noqa: E402


def session(log_dir: str) -> SparkSession:
    mb = 1024 * 1024
    return (
        SparkSession.builder.master("local[8]").appName("quarry-skew")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.dir", log_dir)
        .config("spark.eventLog.compress", "false")
        .config("spark.eventLog.rolling.enabled", "false")
        .config("spark.sql.shuffle.partitions", "32")
        .config("spark.sql.adaptive.enabled", "true")
        # scaled-down thresholds so this small input behaves like a big one
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(mb))
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", str(mb // 4))
        .config("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", str(mb))
        .config("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "2")
        .config("spark.sql.autoBroadcastJoinThreshold", "-1")
        .getOrCreate()
    )


def hot(col: str, other: F.Column, hot_value) -> F.Column:
    """A third of the rows (by a hash of ``col``) get ``hot_value``."""
    return F.when(F.abs(F.xxhash64(col)) % 3 == 0, F.lit(hot_value)).otherwise(other)


def workloads(spark: SparkSession, d: str):
    orders = read_table(spark, d, "orders")
    accounts = S.accounts_from_orders(orders).withColumn(
        "person_id", hot("id", F.col("person_id"), "0"))
    persons = S.persons_from_customer(read_table(spark, d, "customer"))
    li = read_table(spark, d, "lineitem")
    pairs = S.pairs_from_lineitem(li).withColumn("key", hot("value", F.col("key"), 0))
    qty = li.select(F.col("l_quantity").cast("int").alias("i"), "l_orderkey")
    tied = li.select(hot("l_orderkey", F.col("l_orderkey"), -1).alias("k"))
    return {
        "account_profile (hot person)": lambda: A.account_profile(accounts),
        "person_accounts (hot person)": lambda: A.person_accounts(persons, accounts),
        "account_positions (hot person)": lambda: A.account_positions(accounts),
        "with_account_type semi (hot person)": lambda: A.with_account_type(persons, accounts, "CHEQUING"),
        "sum_by_key (hot key)": lambda: sum_by_key(pairs, "key", "value"),
        "sum_by_key_gathered (hot key)": lambda: sum_by_key_gathered(pairs, "key", "value"),
        "lookup_with_default, shuffled (50 keys)": lambda: lookup_with_default(
            qty, "i", read_table(spark, d, "part"), "p_partkey", "p_size", join_hint="merge"),
        "lookup_penalty (50 keys)": lambda: lookup_penalty(
            qty.select("i"), "i", read_table(spark, d, "part"), "p_partkey", "p_size"),
        "with_row_index (hot tied key)": lambda: with_row_index(tied, ["k"], "idx"),
        "char_distribution (skewed characters)": lambda: char_distribution(read_table(spark, d, "documents"), "text"),
        "char_occurrence_lists (skewed characters)": lambda: char_occurrence_counts(
            char_occurrence_lists(read_table(spark, d, "documents"), "text", "doc_id")),
    }


def task_shares(log_dir: str) -> dict[str, list[tuple[int, int, int, int]]]:
    """group -> [(stage, tasks, total records, max task records)]"""
    stage_group: dict[int, str] = {}
    recs: dict[int, list[int]] = defaultdict(list)
    for path in glob.glob(f"{log_dir}/**/*", recursive=True):
        if not Path(path).is_file() or path.endswith((".crc", ".inprogress.crc")):
            continue
        for line in open(path):
            e = json.loads(line)
            ev = e.get("Event")
            if ev == "SparkListenerJobStart":
                g = (e.get("Properties") or {}).get("spark.jobGroup.id")
                if g:
                    for sid in e.get("Stage IDs", []):
                        stage_group[sid] = g
            elif ev == "SparkListenerTaskEnd":
                m = e.get("Task Metrics") or {}
                n = (m.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
                recs[e["Stage ID"]].append(n)
    out: dict[str, list] = defaultdict(list)
    for sid, r in sorted(recs.items()):
        g = stage_group.get(sid)
        if g and sum(r) > 0:
            out[g].append((sid, len(r), sum(r), max(r)))
    return out


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    out = Path(sys.argv[2] if len(sys.argv) > 2 else Path(__file__).resolve().parents[1] / "SKEW.md")
    log_dir = tempfile.mkdtemp(prefix="quarry-eventlog-", dir="/tmp")
    spark = session(log_dir)
    spark.sparkContext.setLogLevel("ERROR")
    for name, build in workloads(spark, sf_dir).items():
        spark.sparkContext.setJobGroup(name, name)
        build().write.format("noop").mode("overwrite").save()
    spark.stop()
    shares = task_shares(log_dir)
    lines = [
        "# Skew check",
        "",
        f"Inputs from `{sf_dir}` where one key holds a third of the rows (accounts of one person, "
        "pairs of one key, one tied sort key); lookups probe 50 distinct keys. local[8], 32 shuffle "
        "partitions, AQE with thresholds scaled down to 1 MB so the small input behaves like a big one; "
        "broadcasts off. Per stage that reads a shuffle: tasks, shuffled rows read and the largest task's "
        "share. A stage whose largest task reads a third or more of the rows would mean a hot key went to "
        "one task; stages of a few rows (partial aggregates, per-partition counts) are expected to sit in one "
        "task. Scan stages are left out: every test table is a single row group, read by one task. "
        "Written by `tools/skew_report.py` from Spark's event log.",
        "",
        "| operator | stage | tasks | shuffled rows read | largest task | share |",
        "| --- | --- | --- | --- | --- | --- |",
    ]
    for name in shares:
        for sid, ntasks, total, mx in shares[name]:
            lines.append(f"| {name} | {sid} | {ntasks} | {total} | {mx} | {mx / total:.1%} |")
    out.write_text("\n".join(lines) + "\n")
    print(f"wrote {out} (event log in {log_dir})")


if __name__ == "__main__":
    main()
