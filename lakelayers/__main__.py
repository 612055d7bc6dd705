"""Run a layer from the command line: ``python -m lakelayers bronze --source …``."""

from __future__ import annotations

import argparse
import json
from datetime import datetime

from pyspark.sql import SparkSession

from lakelayers.names import SESSION_CATALOG
from lakelayers.operators.landing import LandingRun
from lakelayers.plans.chain import Entity, run_chain, run_layer, run_raw
from lakelayers.scratch import scratch_space


def parse_arguments(arguments: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="lakelayers")
    parser.add_argument("layer", choices=["raw", "bronze", "silver", "gold", "chain"])
    parser.add_argument("--source", required=True)
    parser.add_argument("--entity", required=True)
    parser.add_argument("--raw-root", required=True, help="folder above {source}/{entity}/")
    parser.add_argument("--id-field", default="id")
    parser.add_argument("--payload-schema", help="type of the payload, e.g. 'struct<id: string>'")
    parser.add_argument("--catalog", default=SESSION_CATALOG)
    parser.add_argument("--table-format", default="parquet")
    parser.add_argument("--mode", choices=["append", "overwrite"], default="append")
    parser.add_argument(
        "--no-quarantine", dest="quarantine", action="store_false", help="malformed lines stay in bronze"
    )
    parser.add_argument("--bodies", help="folder of text files, a response body each, to land first")
    parser.add_argument("--batch-size", type=int, default=500)
    parser.add_argument("--run-ts", type=datetime.fromisoformat, help="audit timestamp, UTC unless it has an offset")
    parser.add_argument("--json-options", type=json.loads, default={}, help="JSON object for the JSON writer")
    parser.add_argument("--load-id", help="a partition of its own, replaced if the load is repeated")
    parser.add_argument("--no-create-tables", dest="create_tables", action="store_false")
    return parser.parse_args(arguments)


def main(arguments: list[str] | None = None) -> None:
    options = vars(parse_arguments(arguments))
    layer, folder, batch_size = (options.pop(name) for name in ("layer", "bodies", "batch_size"))
    if layer == "raw" and not folder:
        raise SystemExit("raw needs --bodies")
    spec = Entity(**options)
    spark = SparkSession.builder.appName(f"{spec.source}_{spec.entity}_{layer}").getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    run = LandingRun(spec.source, spec.entity, started=spec.run_ts, batch_size=batch_size)
    bodies = spark.read.option("wholetext", "true").text(folder).toDF("body") if folder else None
    with scratch_space(spark):
        if layer == "chain":
            runs = run_chain(spark, spec, bodies=bodies, run=run)
        elif layer == "raw":
            runs = [run_raw(spark, spec, bodies, run)]
        else:
            runs = [run_layer(spark, spec, layer)]
    for run in runs:
        print(json.dumps({"layer": run.layer, **run.metrics}))


if __name__ == "__main__":
    main()
