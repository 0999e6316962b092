"""Command line: run one daily batch, or the landing pick-up stream.

    python -m histmart run --warehouse W --landing L --date 03032021 \\
        --source accounts=/extracts/accounts --source cards=... --source clients=...
    python -m histmart run ... --jdbc-url URL --jdbc-option user=... \\
        --source accounts=bank.accounts ...            # sources read over JDBC
    ... --jdbc-option accounts.partition_column=account_no --jdbc-option accounts.lower=0 \\
        --jdbc-option accounts.upper=900000000         # parallel slices of one table
    python -m histmart stream --warehouse W --landing L --archive A --checkpoint C ...
    python -m histmart backfill --warehouse W --landing L --from 01032021 ...

Submitted with spark-submit the session comes from the cluster; the shared
``spark.checkpoint.dir`` must be set there.
"""

from __future__ import annotations

import argparse
from datetime import datetime

from .plans.batch import SOURCE_SCHEMAS, BatchConfig, run_batch
from .session import build_session
from .sources.extract import jdbc_table


def _sources(spark, args) -> dict:
    """Sources by name; a JDBC option ``table.key=value`` is for that source only."""
    out = {}
    options = [o.split("=", 1) for o in args.jdbc_option]
    for item in args.source:
        name, where = item.split("=", 1)
        if args.jdbc_url:
            own = {k: v for k, v in options if k.split(".")[0] not in SOURCE_SCHEMAS}
            own |= {k.removeprefix(f"{name}."): v for k, v in options if k.startswith(f"{name}.")}
            out[name] = jdbc_table(spark, args.jdbc_url, where, **own)
        else:
            out[name] = spark.read.parquet(where)
    return out


def _config(spark, args) -> BatchConfig:
    return BatchConfig(warehouse=args.warehouse, landing=args.landing,
                       sources=_sources(spark, args), schema_name=args.schema_name)


def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="histmart")
    sub = p.add_subparsers(dest="cmd", required=True)
    for name in ("run", "stream", "backfill"):
        s = sub.add_parser(name)
        s.add_argument("--warehouse", required=True)
        s.add_argument("--landing", required=True)
        s.add_argument("--source", action="append", default=[],
                       help="name=path (Parquet) or name=table (with --jdbc-url)")
        s.add_argument("--jdbc-url")
        s.add_argument("--jdbc-option", action="append", default=[], help="key=value")
        s.add_argument("--schema-name", default="dwh")
        s.add_argument("--master")
    r = sub.choices["run"]
    r.add_argument("--date", required=True, help="batch date DDMMYYYY")
    r.add_argument("--run-ts", help="yyyy-MM-dd HH:mm:ss (default: now)")
    bf = sub.choices["backfill"]
    bf.add_argument("--from", dest="start", required=True, help="first batch date DDMMYYYY")
    st = sub.choices["stream"]
    st.add_argument("--checkpoint", required=True)
    st.add_argument("--archive")
    args = p.parse_args(argv)

    spark = build_session(args.master)
    cfg = _config(spark, args)
    if args.cmd == "run":
        day = datetime.strptime(args.date, "%d%m%Y").date()
        run_ts = (datetime.strptime(args.run_ts, "%Y-%m-%d %H:%M:%S") if args.run_ts
                  else datetime.now().replace(microsecond=0))
        print(run_batch(spark, cfg, day, run_ts))
    elif args.cmd == "backfill":
        from .plans.batch import run_backfill
        print(run_backfill(spark, cfg, datetime.strptime(args.start, "%d%m%Y").date()))
    else:
        from .streaming.landing import landing_stream
        landing_stream(spark, cfg, args.checkpoint, args.archive).awaitTermination()


if __name__ == "__main__":
    main()
