"""Run a job on file inputs and show its outputs.

    python -m quarry.cli time-usage --survey survey.csv
    python -m quarry.cli trades --lines trades.txt [--table events_table]
    python -m quarry.cli accounts --persons person.csv --accounts account.csv
    python -m quarry.cli chars --text docs.txt
    python -m quarry.cli trial --rows rows.csv          (place,placename,amount)
    python -m quarry.cli bykey --pairs pairs.csv        (key,value)
    python -m quarry.cli lookup --values values.csv --map map.csv   (i) and (key,value)
    python -m quarry.cli metrics --values values.csv --out written/  (v)
    python -m quarry.cli messages --source msgs/ --sink out/ --checkpoint ckpt/ [--every "1 second"]

Each ``run_*`` function returns its outputs as named DataFrames (lazy,
except where a job writes), so the same jobs can be called from code.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.columns import bucket, row_sum
from quarry.operators import accounts as A
from quarry.operators.keyed import (
    char_distribution,
    char_totals,
    lookup_penalty,
    lookup_with_default,
    sum_by_key,
    sum_by_key_gathered,
    write_with_metrics,
)
from quarry.operators.ordering import top_k_by_key
from quarry.plans import jobs
from quarry.plans.jobs import SMALL_AMOUNT_LIMIT
from quarry.plans import person_accounts as P
from quarry.plans import time_usage as TU
from quarry.functions.text import jvm_trim
from quarry.sources.csv import read_headed_csv, read_lines
from quarry.sources.records import parse_accounts, parse_persons
from quarry.streaming.messages import start_message_stream


def run_time_usage(spark: SparkSession, survey_path: str) -> dict[str, DataFrame]:
    _, survey = read_headed_csv(
        spark, survey_path, where=TU.in_labour_force(), where_cols=["telfs"], check_dropped=True)
    res = jobs.time_usage_job(spark, survey)
    return {"summary": res.shared, **res.outputs}


def run_trades(spark: SparkSession, lines_path: str, table: str | None = None) -> dict[str, DataFrame]:
    """Lines of a text file, numbered in file order (file, then line offset);
    blank lines are skipped."""
    lines = read_lines(spark, lines_path).select(
        F.col("value").alias("line"),
        F.input_file_name().alias("_file"),
        F.monotonically_increasing_id().alias("_n"),
    ).where(F.length(jvm_trim("line")) > 0)  # blank lines carry no events
    ordered = lines.select("line", F.struct("_file", "_n").alias("line_no"))
    res = jobs.trade_job(spark, ordered, table)
    return {"events": res.shared, **res.outputs}


def run_accounts(spark: SparkSession, persons_path: str, accounts_path: str) -> dict[str, DataFrame]:
    persons = parse_persons(read_lines(spark, persons_path))
    accounts = parse_accounts(read_lines(spark, accounts_path))
    res = jobs.person_accounts_job(persons, accounts)
    return {
        "accounts_by_person": A.account_positions(accounts),
        "person_accounts": res.shared.select(*P.PERSON_COLS, "n_accounts", "total_balance"),
        **res.outputs,
    }


def run_chars(spark: SparkSession, text_path: str) -> dict[str, DataFrame]:
    text = spark.read.text(text_path, wholetext=True).select(F.col("value").alias("text"))
    return {"totals": char_totals(text, "text"), "distribution": char_distribution(text, "text")}


def _csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("mode", "FAILFAST").option("ignoreLeadingWhiteSpace", True) \
        .option("ignoreTrailingWhiteSpace", True).csv(path)


def run_trial(spark: SparkSession, rows_path: str) -> dict[str, DataFrame]:
    """Computed columns over ``place, placename, amount`` rows."""
    t = _csv(spark, rows_path, "place int, placename string, amount int")
    return {"computed": t.select(
        (F.col("place") + F.col("amount")).alias("place_plus_amount"),
        bucket("amount", [(lambda x: x < SMALL_AMOUNT_LIMIT, "small")], "big").alias("size"),
        row_sum(["place", "amount"]).alias("sum_by_name"),
        row_sum([F.col("place"), F.col("amount")]).alias("sum_by_column"),
    )}


def run_bykey(spark: SparkSession, pairs_path: str, k: int = 10) -> dict[str, DataFrame]:
    """Sums per key, gathered and combined, first ``k`` keys."""
    pairs = _csv(spark, pairs_path, "key string, value int")
    return {
        "gathered": top_k_by_key(sum_by_key_gathered(pairs, "key", "value"), "key", k),
        "combined": top_k_by_key(sum_by_key(pairs, "key", "value"), "key", k),
    }


def run_lookup(spark: SparkSession, values_path: str, map_path: str) -> dict[str, DataFrame]:
    """Lookup with default 0 and the per-key penalty sums."""
    values = _csv(spark, values_path, "i int")
    lookup = _csv(spark, map_path, "key int, value int")
    return {
        "looked_up": lookup_with_default(values, "i", lookup, "key", "value", 0, "m"),
        "penalty": lookup_penalty(values, "i", lookup, "key", "value"),
    }


def run_metrics(spark: SparkSession, values_path: str, out_path: str) -> dict[str, DataFrame]:
    """Write the values and collect count / sum / average during the write."""
    values = _csv(spark, values_path, "v long")
    m = write_with_metrics(values, "v", out_path)
    return {"metrics": spark.createDataFrame([(m["n"], m["total"], m["mean"])], "n long, total long, mean double")}


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="quarry")
    sub = ap.add_subparsers(dest="job", required=True)
    sub.add_parser("time-usage").add_argument("--survey", required=True)
    t = sub.add_parser("trades")
    t.add_argument("--lines", required=True)
    t.add_argument("--table")
    a = sub.add_parser("accounts")
    a.add_argument("--persons", required=True)
    a.add_argument("--accounts", required=True)
    sub.add_parser("chars").add_argument("--text", required=True)
    sub.add_parser("trial").add_argument("--rows", required=True)
    sub.add_parser("bykey").add_argument("--pairs", required=True)
    lk = sub.add_parser("lookup")
    lk.add_argument("--values", required=True)
    lk.add_argument("--map", required=True)
    mt = sub.add_parser("metrics")
    mt.add_argument("--values", required=True)
    mt.add_argument("--out", required=True)
    m = sub.add_parser("messages")
    for opt in ("--source", "--sink", "--checkpoint"):
        m.add_argument(opt, required=True)
    m.add_argument("--every", help="processing-time trigger, e.g. '1 second'; default: available now")
    args = ap.parse_args(argv)
    spark = SparkSession.builder.appName(f"quarry-{args.job}").getOrCreate()
    if args.job == "messages":
        q = start_message_stream(spark, args.source, args.sink, args.checkpoint,
                                 available_now=args.every is None, processing_time=args.every or "1 second")
        q.awaitTermination()
        return 0
    outputs = {
        "time-usage": lambda: run_time_usage(spark, args.survey),
        "trades": lambda: run_trades(spark, args.lines, args.table),
        "accounts": lambda: run_accounts(spark, args.persons, args.accounts),
        "chars": lambda: run_chars(spark, args.text),
        "trial": lambda: run_trial(spark, args.rows),
        "bykey": lambda: run_bykey(spark, args.pairs),
        "lookup": lambda: run_lookup(spark, args.values, args.map),
        "metrics": lambda: run_metrics(spark, args.values, args.out),
    }[args.job]()
    for name, df in outputs.items():
        print(f"== {name}")
        df.show(20, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
