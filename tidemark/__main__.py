"""Run one layer: ``spark-submit … -m tidemark <step>`` or ``python -m tidemark <step>``."""

from __future__ import annotations

import argparse
from dataclasses import replace

from tidemark.config import TABLE_NAMES, LakeConfig, build_session, size_shuffles
from tidemark.operators import sinks
from tidemark.operators.aggregates import layer_counts
from tidemark.operators.upsert import VersionedTable
from tidemark.plans import bronze, features, gold, silver, training, validation
from tidemark.sources.messages import read_folder, read_topic
from tidemark.sources.tables import read_if_present, read_table

STEPS = ("bronze", "stream", "silver", "gold", "features", "train", "validate", "register", "counts")


def _versioned(spark, lake: LakeConfig) -> dict[str, VersionedTable]:
    """The tables that are replaced partition by partition."""
    feature_sets = ("hourly_weather", "daily_weather", "training_data")
    return {"silver_weather_clean": silver.table(spark, lake)} | {
        name: features.table(spark, lake, name) for name in feature_sets
    }


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tidemark")
    parser.add_argument("step", choices=STEPS)
    parser.add_argument("--root", help="lake folder (default: LAKE_ROOT)")
    parser.add_argument("--topic", help="stream: topic name")
    parser.add_argument("--servers", help="stream: broker addresses")
    parser.add_argument("--folder", help="stream: folder of message files instead of a topic")
    parser.add_argument("--once", action="store_true", help="stream: stop when all is read")
    parser.add_argument("--full", action="store_true", help="silver: read all of bronze again")
    args = parser.parse_args(argv)

    lake = LakeConfig.from_env()
    if args.root:
        lake = replace(lake, root=args.root.rstrip("/"))
    spark = build_session(f"tidemark {args.step}")
    inputs = {
        "silver": [lake.table("bronze_weather_batch"), lake.table("bronze_weather_streaming")],
        "gold": [lake.table("silver_weather_clean")],
        "features": [lake.table("silver_weather_clean")],
        "train": [lake.table("training_data")],
    }
    if args.step in inputs:
        size_shuffles(spark, *inputs[args.step])
    if args.step == "bronze":
        print(bronze.run_batch(spark, lake), "rows ingested")
    elif args.step == "stream":
        messages = (
            read_folder(spark, args.folder)
            if args.folder
            else read_topic(spark, args.servers, args.topic)
        )
        bronze.run_stream(messages, lake, args.once).awaitTermination()
    elif args.step == "silver":
        refresh = silver.run if args.full else silver.run_new
        print("silver version", refresh(spark, lake))
        silver.table(spark, lake).expire()
    elif args.step == "gold":
        gold.run(spark, lake, silver.table(spark, lake))
        gold.cube_table(spark, lake).expire()
    elif args.step == "features":
        print("days written", len(features.run(spark, lake, silver.table(spark, lake))))
        for table in _versioned(spark, lake).values():
            table.expire()
    elif args.step == "train":
        print(training.run(spark, lake))
    elif args.step == "validate":
        stream = read_if_present(spark, lake.table("bronze_weather_streaming"))
        batch = read_if_present(spark, lake.table("bronze_weather_batch"))
        for warning in validation.bronze(stream, batch)[1]:
            print("warning:", warning)
        current = silver.table(spark, lake).read()
        mapped = {
            "bronze_weather_streaming": None if stream is None else silver.map_stream(stream),
            "bronze_weather_batch": None if batch is None else silver.map_batch(batch),
            "silver_weather_clean": current,
        }
        if any(df is not None for df in mapped.values()):
            report = validation.summary(mapped).persist()
            report.show(truncate=False)
            for row in validation.stale(report).collect():
                print("warning:", row["layer"], "has nothing newer than", row["latest_ingested"])
            report.unpersist()
        if current is not None:
            validation.silver(current)
            daily = read_table(spark, lake.table("fact_weather_daily_stats"))
            validation.gold(daily, current)
    elif args.step == "register":
        versioned = _versioned(spark, lake)
        done = sinks.register(spark, {n: lake.table(n) for n in TABLE_NAMES if n not in versioned})
        print(done | {name: table.register(name) for name, table in versioned.items()})
    elif args.step == "counts":
        versioned = _versioned(spark, lake)
        layers = {n: read_if_present(spark, lake.table(n)) for n in TABLE_NAMES if n not in versioned}
        layers |= {name: table.read() for name, table in versioned.items()}
        if any(df is not None for df in layers.values()):
            layer_counts(layers).show(truncate=False)


if __name__ == "__main__":
    main()
