"""Builds every table of the model.

    spark-submit run.py csv  <folder of extracts> <target folder> [tables with line breaks ...]
    spark-submit run.py load <folder of extracts> <target folder>    # past bad lines
    spark-submit run.py star <folder of star tables> <target folder>
"""

from __future__ import annotations

import sys

from pyspark.sql import SparkSession

from schoolyard.plans import pipeline
from schoolyard.session import STARTUP, prepare
from schoolyard.sources.load import load_all
from schoolyard.sources.raw import read_csv_all
from schoolyard.sources.star import StarSource
from schoolyard.sources.tables import Store


def main() -> None:
    kind, source, target, *multiline = sys.argv[1:]
    spark = prepare(SparkSession.builder.appName("schoolyard").config(map=STARTUP).getOrCreate())
    store = Store(spark, target)
    if kind == "load":
        raw = load_all(spark, source, store)
    else:
        raw = read_csv_all(spark, source, multiline) if kind == "csv" else StarSource(spark, source)
    pipeline.run(raw, store)


if __name__ == "__main__":
    main()
