"""Print the physical plan of registered queries.

    python -m histmart.plans.explain u1_fraud_mart [sf_dir] [--final]

Without ``--final`` the formatted plan before execution is printed; with it
the query runs (through the ``noop`` sink) and the final adaptive plan is
shown, with AQE's runtime choices (broadcasts, reused exchanges).
"""

from __future__ import annotations

import sys

from pyspark.sql import functions as F

from ..session import build_session
from . import catalog


def main(argv=None) -> None:
    args = list(sys.argv[1:] if argv is None else argv)
    final = "--final" in args
    args = [a for a in args if a != "--final"]
    names = [a for a in args if a in catalog.QUERIES] or list(catalog.QUERIES)
    dirs = [a for a in args if a not in catalog.QUERIES]
    sf_dir = dirs[0] if dirs else "/root/testdata/sf0.01"
    spark = build_session("local[*]", app="histmart-explain",
                          extra={"spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    for name in names:
        df = catalog.QUERIES[name](spark, sf_dir)
        print(f"==== {name}")
        if final:
            # the final adaptive plan of a write that returns one row: no result reaches the driver
            counted = df.select(F.xxhash64(*df.columns).alias("h")).agg(F.bit_xor("h"))
            counted.collect()
            print(counted._jdf.queryExecution().executedPlan().toString())
        else:
            df.explain("formatted")


if __name__ == "__main__":
    main()
