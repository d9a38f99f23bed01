"""Run the whole job: ``spark-submit build_warehouse.py <inputs.json> <output path> [--check-only]``.

``inputs.json`` holds the paths of ``stellate.plans.warehouse.Inputs`` by field name; it may lie on any file system that
Spark reads. Set ``spark.checkpoint.dir`` to a folder that all executors share.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from stellate.plans.warehouse import Inputs, build_warehouse, check_warehouse


def main(argv: list[str] | None = None) -> list[str]:
    parser = argparse.ArgumentParser(description="Build and check the star schema.")
    parser.add_argument("inputs", help="JSON file with the input paths")
    parser.add_argument("out", help="folder of the published tables")
    parser.add_argument("--check-only", action="store_true", help="check the published tables and stop")
    args = parser.parse_args(argv)
    spark = SparkSession.builder.appName("build_warehouse").getOrCreate()
    if args.check_only:
        return check_warehouse(spark, args.out)
    text = spark.read.text(args.inputs, wholetext=True).first().value
    return build_warehouse(spark, Inputs(**json.loads(text)), args.out)


if __name__ == "__main__":
    print("\n".join(main()))
