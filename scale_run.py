"""Time cleaning, the star schema and the marts on made-up skewed rides.

    python scale_run.py FOLDER [--rows N] [--users N] [--hot SHARE] [--nameless SHARE]

Writes a raw zone and every table below FOLDER, which has to be new and is left to the
caller to remove, and prints one JSON line of seconds per step, writing included.
``--hot`` of the rides are by one user, and ``--nameless`` of them by none.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import os
import time
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farebox.operators.staging import clean
from farebox.plans.star import SCHEMAS, Star
from farebox.schemas import MONEY, RAW, conform
from farebox.session import local_session
from farebox.sources.raw import read_raw
from farebox.sources.tables import write_table

ROUTES, VEHICLES = 1_000, 20_000
START = dt.datetime(2024, 1, 1)


def raw_zone(
    spark: SparkSession, rows: int, users: int, hot: float, nameless: float
) -> dict[str, DataFrame]:
    """The raw entities, every value following from the number of its row."""
    n, text = F.col("id"), F.col("id").cast("string")

    def spread(over: int, seed: int):
        return F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(over)).cast("int")

    def moment(seconds):
        return F.timestamp_add("SECOND", seconds.cast("int"), F.lit(START))

    place = spread(1_000_000, 1) / 1_000_000
    rider = F.when(place < hot, 1).when(place >= hot + nameless, 1 + spread(users, 2))
    start = moment(spread(90 * 86_400, 3))
    fare = (spread(10_000, 4) / 100).cast(MONEY)
    kind = F.element_at(F.array(F.lit("bus"), F.lit("tram"), F.lit("metro")), 1 + spread(3, 5))
    method = F.element_at(F.array(F.lit("card"), F.lit("cash")), 1 + spread(2, 6))
    columns = {
        "users": [n.alias("user_id"), text.alias("name"), text.alias("email"),
                  spread(50, 7).cast("string").alias("city"), start.alias("created_at")],
        "routes": [n.alias("route_id"), text.alias("route_number"), kind.alias("vehicle_type"),
                   fare.alias("base_fare")],
        "vehicles": [n.alias("vehicle_id"), (1 + spread(ROUTES, 8)).alias("route_id"),
                     text.alias("license_plate"), spread(200, 9).alias("capacity")],
        "rides": [text.alias("ride_id"), rider.alias("user_id"),
                  (1 + spread(ROUTES, 8)).alias("route_id"),
                  (1 + spread(VEHICLES, 10)).alias("vehicle_id"), start.alias("start_time"),
                  F.timestamp_add("MINUTE", 1 + spread(90, 11), start).alias("end_time"),
                  fare.alias("fare_amount")],
        "payments": [text.alias("payment_id"), text.alias("ride_id"), rider.alias("user_id"),
                     fare.alias("amount"), method.alias("payment_method"),
                     F.lit("success").alias("status"), start.alias("created_at")],
        "vehicle_positions": [text.alias("event_id"), (1 + spread(VEHICLES, 10)).alias("vehicle_id"),
                              (1 + spread(ROUTES, 8)).cast("string").alias("route_number"),
                              start.alias("event_time"), place.alias("latitude"),
                              place.alias("longitude"), place.alias("speed_kmh"),
                              spread(80, 12).alias("passengers_estimated")],
    }
    sizes = {"users": users, "routes": ROUTES, "vehicles": VEHICLES}
    return {
        name: conform(spark.range(1, 1 + sizes.get(name, rows)).select(*chosen), RAW[name])
        for name, chosen in columns.items()
    }


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("folder")
    parser.add_argument("--rows", type=int, default=1_000_000)
    parser.add_argument("--users", type=int, default=100_000)
    parser.add_argument("--hot", type=float, default=1 / 3)
    parser.add_argument("--nameless", type=float, default=0.1)
    chosen = parser.parse_args()
    root = Path(chosen.folder).absolute()
    root.mkdir(parents=True)

    spark = local_session(
        "farebox-scale", os.environ.get("BENCH_CPUS", "8"), memory="16g", folder=f"{root}/checkpoints"
    )
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}

    def timed(name: str, df: DataFrame, schema, folder: str) -> DataFrame:
        began = time.perf_counter()
        write_table(df, f"{folder}/{name}", schema)
        times[name] = round(time.perf_counter() - began, 1)
        return spark.read.parquet(f"{folder}/{name}")

    sizes = (chosen.rows, chosen.users, chosen.hot, chosen.nameless)
    for entity, df in raw_zone(spark, *sizes).items():
        write_table(df, f"{root}/raw/{entity}", RAW[entity])
    silver = {
        entity: timed(
            f"silver_{entity}", clean(read_raw(spark, f"{root}/raw", entity), entity),
            RAW[entity], str(root),
        )
        for entity in RAW
    }
    star = Star(
        silver.__getitem__,
        lambda name, df: timed(name, df, SCHEMAS[name], str(root)),
        as_of=START.date(),
        cleaned=True,
    )
    for name in SCHEMAS:
        star.table(name)
    print(json.dumps({"rows": chosen.rows, "seconds": times}))


if __name__ == "__main__":
    main()
