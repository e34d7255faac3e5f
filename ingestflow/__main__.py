"""Command line: run one step over files (``python -m ingestflow <step> ...``).

    stage   --requests R --manifest M --stage-root DIR --out OUT
    load    --stage-dir DIR --pipe NAME --format csv|json|parquet --schema DDL
            [--on-error CONTINUE|SKIP_FILE|ABORT_STATEMENT] [--option NAME=VALUE ...]
            --rows OUT --history OUT
    report  --history H --pipe NAME --trailing-minutes N --out OUT [--now ISO]
    await   --pending P --history H --max-age-minutes N --out OUT [--now ISO]

Input paths ending in ``.json``/``.jsonl`` are read as JSON lines, anything
else as Parquet.  Routed outputs are written partitioned by
route.  ``--now`` defaults to the current UTC time.  The session comes from
``spark-submit``/the environment; checkpoints use ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import argparse
import datetime as _dt
import sys

from pyspark.sql import DataFrame, SparkSession

from ingestflow.operators.history import pipe_history, write_history_document
from ingestflow.operators.load import PipeSpec, as_history, claim_run, load_once
from ingestflow.operators.reconcile import await_results
from ingestflow.plans.flow import manifest_additions, stage_step
from ingestflow.schemas import HISTORY, MANIFEST, PENDING, STAGE_REQUEST_RAW
from ingestflow.session import build_session
from ingestflow.sinks.routes import write_routes


def _read(spark: SparkSession, path: str, schema) -> DataFrame:
    p = path.rstrip("/")
    if p.endswith((".json", ".jsonl")):
        return spark.read.schema(schema).json(path)
    return spark.read.parquet(path)


def _history_if_exists(spark: SparkSession, path: str) -> DataFrame | None:
    """The existing history table, if any (so a re-run skips loaded files).

    The DataFrame lists its files when created, so this run's own append to
    the same table afterwards does not change what it reads.
    """
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return spark.read.parquet(path) if fs.exists(hpath) else None


def _now(value: str | None) -> _dt.datetime:
    if value:
        return _dt.datetime.fromisoformat(value)
    return _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    ap = argparse.ArgumentParser(prog="python -m ingestflow")
    sub = ap.add_subparsers(dest="step", required=True)
    st = sub.add_parser("stage")
    st.add_argument("--requests", required=True)
    st.add_argument("--manifest", required=True)
    st.add_argument("--stage-root", required=True)
    st.add_argument("--out", required=True)
    st.add_argument("--parallel", type=int)
    ld = sub.add_parser("load")
    ld.add_argument("--stage-dir", required=True)
    ld.add_argument("--pipe", required=True)
    ld.add_argument("--format", default="csv")
    ld.add_argument("--schema", required=True)
    ld.add_argument("--on-error", default="CONTINUE")
    ld.add_argument("--option", action="append", default=[], metavar="NAME=VALUE",
                    help="format option, such as header=true or multiLine=true")
    ld.add_argument("--rows", required=True)
    ld.add_argument("--history", required=True)
    ld.add_argument("--now")
    rp = sub.add_parser("report")
    rp.add_argument("--history", required=True)
    rp.add_argument("--pipe", required=True)
    rp.add_argument("--trailing-minutes", type=int, required=True)
    rp.add_argument("--out", required=True)
    rp.add_argument("--now")
    aw = sub.add_parser("await")
    aw.add_argument("--pending", required=True)
    aw.add_argument("--history", required=True)
    aw.add_argument("--max-age-minutes", type=int, required=True)
    aw.add_argument("--out", required=True)
    aw.add_argument("--now")
    args = ap.parse_args(argv)
    spark = spark or build_session()

    if args.step == "stage":
        routed = stage_step(_read(spark, args.requests, STAGE_REQUEST_RAW),
                            _read(spark, args.manifest, MANIFEST), args.stage_root, args.parallel)
        write_routes(routed, args.out, mode="overwrite")
        added = manifest_additions(spark.read.parquet(args.out))
        if args.manifest.rstrip("/").endswith((".json", ".jsonl")):
            added.write.mode("append").json(args.manifest)
        else:
            added.write.mode("append").parquet(args.manifest)
    elif args.step == "load":
        spec = PipeSpec(name=args.pipe, format=args.format, schema_ddl=args.schema,
                        on_error=args.on_error, options=dict(o.split("=", 1) for o in args.option))
        prior = _history_if_exists(spark, args.history)
        # Runs at the same time get numbers of their own.  The rows go to the run's own folder and
        # the history, written last, ends the run: one that was cut short has no entries, so its
        # rows do not count (``load.rows_of_runs``) and its files are loaded again.
        run = claim_run(spark, f"{args.rows.rstrip('/')}/_runs", prior)
        rows, stats = load_once(spark, spec, args.stage_dir, history=prior)
        rows.write.mode("overwrite").parquet(f"{args.rows.rstrip('/')}/run={run}")
        as_history(stats, _now(args.now), run).write.mode("append").parquet(args.history)
    elif args.step == "report":
        entries = pipe_history(_read(spark, args.history, HISTORY), args.pipe,
                               args.trailing_minutes, _now(args.now))
        written = write_history_document(entries, args.out)
        print("written" if written else "empty window: nothing written")
    elif args.step == "await":
        routed = await_results(_read(spark, args.pending, PENDING),
                               _read(spark, args.history, HISTORY), args.max_age_minutes,
                               _now(args.now))
        write_routes(routed, args.out, mode="overwrite")
    return 0


if __name__ == "__main__":
    sys.exit(main())
