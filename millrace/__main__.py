"""Run a pipeline from the command line or through spark-submit.

    python -m millrace sales         --input sales.csv --warehouse DIR
    python -m millrace prices        --input landed.json --warehouse DIR [--keys bitcoin,solana]
    python -m millrace weblog        --input access.log --warehouse DIR --run-id ID [--append]
    python -m millrace subscriptions --input SEED_DIR --as-of 2024-01-01
    python -m millrace readings      --input landed.json --warehouse DIR --run-id ID [--keys Jakarta,Medan]

The exit code is 1 if the run failed. Nothing is published then, except that the subscription models are saved before
they are tested.
"""

from __future__ import annotations

import argparse
import logging
import sys
from collections.abc import Sequence
from datetime import date

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from millrace import schemas
from millrace.operators.quality import DataQualityError, enforce
from millrace.plans import prices, readings, sales, subscriptions, weblog
from millrace.session import build_session
from millrace.sources import files
from millrace.sources.warehouse import Warehouse

log = logging.getLogger("millrace")


def run_sales(spark: SparkSession, args: argparse.Namespace) -> None:
    sales.load_star(Warehouse(spark, args.warehouse), files.read_sales_csv(spark, args.input))


def run_prices(spark: SparkSession, args: argparse.Namespace) -> None:
    warehouse = Warehouse(spark, args.warehouse)
    landed = files.read_landed_json(spark, args.input, schemas.LANDED_PRICES)
    warehouse.commit(*prices.load_landed(warehouse, landed))
    prices.run_increment(warehouse, args.keys)


def run_weblog(spark: SparkSession, args: argparse.Namespace) -> None:
    warehouse = Warehouse(spark, args.warehouse)
    lines = files.read_log_lines(spark, args.input)
    source = args.input.rstrip("/").rsplit("/", 1)[-1]
    run_at = F.current_timestamp()
    warehouse.commit(*weblog.ingest(warehouse, lines, args.run_id, run_at, source, refresh=not args.append))


def run_subscriptions(spark: SparkSession, args: argparse.Namespace) -> None:
    seeds = {
        "raw_customers": schemas.RAW_CUSTOMERS,
        "raw_subscriptions": schemas.RAW_SUBSCRIPTIONS,
        "raw_payments": schemas.RAW_PAYMENTS,
    }
    raw = {name: files.read_seed_csv(spark, f"{args.input}/{name}.csv", schema) for name, schema in seeds.items()}
    enforce(subscriptions.check_models(subscriptions.save_models(raw, args.as_of)))


def run_readings(spark: SparkSession, args: argparse.Namespace) -> None:
    warehouse = Warehouse(spark, args.warehouse)
    landed = files.read_landed_json(spark, args.input, schemas.LANDED_READINGS)
    requested = readings.requested_cities(spark, args.run_id, args.keys)
    warehouse.commit(*readings.ingest(warehouse, readings.match_requests(landed, requested)))


RUNS = {
    "sales": run_sales,
    "prices": run_prices,
    "weblog": run_weblog,
    "subscriptions": run_subscriptions,
    "readings": run_readings,
}


def main(argv: Sequence[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="millrace", description=__doc__, formatter_class=argparse.RawTextHelpFormatter)
    parser.add_argument("pipeline", choices=RUNS)
    parser.add_argument("--input", required=True)
    parser.add_argument("--warehouse", default="warehouse")
    parser.add_argument("--run-id", default="run")
    parser.add_argument("--keys", type=lambda text: text.split(","), help="default: the pipeline's own list")
    parser.add_argument("--as-of", type=date.fromisoformat, default=date.today())
    parser.add_argument("--append", action="store_true", help="keep the log tables of earlier runs")
    args = parser.parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="[%(levelname)s] %(asctime)s %(name)s: %(message)s")
    try:
        RUNS[args.pipeline](build_session(), args)
    except DataQualityError as error:
        log.error("%s stopped: %s", args.pipeline, error)
        return 1
    except Exception:
        log.exception("%s failed", args.pipeline)
        return 1
    log.info("%s finished", args.pipeline)
    return 0


if __name__ == "__main__":
    sys.exit(main())
