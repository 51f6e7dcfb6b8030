"""The analyses as jobs over landed files: ``python -m seatwise.jobs <job> --help``.

Run through spark-submit on a cluster. Every job reads folders and writes a new
folder; a job that fails raises, it never leaves an empty result behind.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from seatwise.functions.sql import register_sql_functions
from seatwise.operators import access, enrich, foldable, groups, laid_out, usage
from seatwise.schemas import USAGE
from seatwise.session import build_session
from seatwise.sinks import files, publish
from seatwise.sources import directory, usage_files, usage_table, user_list


#: Where instances are asked for and none is listed, no profile is known.
NO_STORE = ""

#: Stands in a result folder of several parts once all of them are written.
DONE = "finished"


def _usage(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    """A folder of converted files, or ``table:NAME`` for a table of the catalog."""
    kind, _, name = args.usage.partition("table:")
    return spark.table(name) if name and not kind else spark.read.parquet(args.usage)


def _laid_out(spark: SparkSession, args: argparse.Namespace) -> usage_table.UsageTable | None:
    """``laid-out:NAME`` for a table laid out by user."""
    kind, _, name = args.usage.partition("laid-out:")
    return usage_table.usage_table(spark, name) if name and not kind else None


def _assignments(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    if not args.by_token:
        pages = directory.assignment_pages(spark, args.assignments, args.application)
        directory.require_complete(pages, "application_arn")
    return directory.read_assignments(
        spark, args.assignments, args.application, args.by_token
    )


def _memberships(
    spark: SparkSession, args: argparse.Namespace, store: str | None
) -> DataFrame:
    if not args.by_token:
        pages = directory.membership_pages(spark, args.memberships, store)
        directory.require_complete(pages, "GroupId")
    return directory.read_memberships(spark, args.memberships, store, args.by_token)


def _store(spark: SparkSession, args: argparse.Namespace) -> str | None:
    """One identity store for all snapshots of the job: named, or the first listed.

    With neither, every snapshot has to come from a single store.
    """
    if args.store:
        return args.store
    if args.instances:
        return directory.first_store(spark, args.instances) or NO_STORE
    return None


def _schema(ddl: str | None) -> T.StructType:
    return T.StructType.fromDDL(ddl) if ddl else USAGE


def _write(
    result: DataFrame,
    args: argparse.Namespace,
    writer: Callable[[DataFrame, str], object] = files.write_csv,
) -> None:
    """The result in a new folder, or published where ``--publish`` asks for it."""
    if args.publish:
        publish.publish(result, args.out, writer)
    else:
        writer(result, args.out)


def convert_usage(spark: SparkSession, args: argparse.Namespace) -> None:
    """Converts all files, or with ``--append`` those not converted before."""
    usage_files.convert_files(
        spark, args.text, args.out, _schema(args.schema), args.append, args.count_losses
    )


def usage_rollup(spark: SparkSession, args: argparse.Namespace) -> None:
    table = _laid_out(spark, args)
    if table:
        _write(laid_out.usage_rollup(table, args.day_col), args)
    else:
        _write(usage.usage_rollup(_usage(spark, args), args.day_col), args)


def lay_out_usage(spark: SparkSession, args: argparse.Namespace) -> None:
    """Usage rows as a table of the catalog by user, ``--out`` is its name."""
    usage_table.write_usage_table(_usage(spark, args), args.out, args.buckets, args.folder)


def update_rollup(spark: SparkSession, args: argparse.Namespace) -> None:
    """Adds new rows to the states kept, and writes the rollup of all batches."""
    state = foldable.usage_state(_usage(spark, args), args.day_col)
    foldable.write_state(state, args.state, args.batch)
    merged = foldable.merged(foldable.read_state(spark, args.state))
    _write(foldable.rollup_of(merged), args)


def latest_activity(spark: SparkSession, args: argparse.Namespace) -> None:
    table = _laid_out(spark, args)
    if table:
        latest = laid_out.latest_activity(table, args.day_col, args.on_bad_date)
        _write(latest, args)
        return
    latest = usage.latest_activity(
        _usage(spark, args), args.day_col, args.normalize, args.on_bad_date
    )
    _write(latest, args)


def activity_with_profile(spark: SparkSession, args: argparse.Namespace) -> None:
    users = directory.read_users(spark, args.users, _store(spark, args), args.as_of)
    table = _laid_out(spark, args)
    if table:
        activity = laid_out.activity_with_profile(
            table, users, day_col=args.day_col, on_bad_date=args.on_bad_date
        )
        _write(activity, args, files.export_activity)
        return
    activity = enrich.activity_with_profile(
        _usage(spark, args),
        users,
        args.day_col,
        normalize=args.normalize,
        on_bad_date=args.on_bad_date,
    )
    _write(activity, args, files.export_activity)


def enrich_activity(spark: SparkSession, args: argparse.Namespace) -> None:
    users = directory.read_users(spark, args.users, _store(spark, args), args.as_of)
    listed = user_list.read_user_list(spark, args.list, args.multi_line)
    _write(enrich.enrich_activity(listed, users, args.keep_date), args, files.export_activity)


def direct_users(spark: SparkSession, args: argparse.Namespace) -> None:
    users = directory.read_users(spark, args.users, _store(spark, args), args.as_of)
    files.export_users(
        access.direct_users(_assignments(spark, args), users), args.out, args.name
    )


def effective_users(spark: SparkSession, args: argparse.Namespace) -> None:
    store = _store(spark, args)
    result = access.effective_users(
        _assignments(spark, args),
        _memberships(spark, args, store),
        directory.read_users(spark, args.users, store, args.as_of),
    )
    _write(result, args)


def group_access(spark: SparkSession, args: argparse.Namespace) -> None:
    """Five results from one roster, which stays beside them as a table.

    The roster is computed once and written first, so that neither a lost
    executor nor the next result starts over. A second run after a failure
    replaces what the first one left, and nothing else may stand in the folder.
    """
    store = _store(spark, args)
    assignments = _assignments(spark, args)
    profiles = directory.read_groups(spark, args.groups, store, args.as_of)
    computed = groups.roster_in_order(
        assignments,
        _memberships(spark, args, store),
        profiles,
        directory.read_users(spark, args.users, store, args.as_of),
        args.dedupe,
    )
    out = args.out.rstrip("/")
    _claim(spark, out)
    computed.write.mode("overwrite").parquet(f"{out}/roster.parquet")
    roster = spark.read.schema(computed.schema).parquet(f"{out}/roster.parquet")
    listed = groups.assigned_groups(assignments, profiles, args.dedupe)
    files.write_csv(groups.summary_of(listed, roster), f"{out}/summary", "overwrite")
    files.write_csv(groups.totals(roster), f"{out}/totals", "overwrite")
    files.write_csv(
        roster.drop("member_page", "member_pos"), f"{out}/roster", "overwrite"
    )
    groups.nested(listed, roster).write.mode("overwrite").json(f"{out}/nested")
    files.write_report(groups.report(listed, roster), f"{out}/report", "overwrite")
    _mark(spark, f"{out}/{DONE}")


def _claim(spark: SparkSession, out: str) -> None:
    """A finished result is never overwritten; an unfinished one may be."""
    if _exists(spark, f"{out}/{DONE}"):
        raise ValueError(f"PATH_ALREADY_EXISTS: {out} holds a finished result")


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        return spark.read.text(path) is not None
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise


def _mark(spark: SparkSession, path: str) -> None:
    spark.range(1).selectExpr("'finished' AS line").write.text(path)


def query(spark: SparkSession, args: argparse.Namespace) -> None:
    """Any SQL over usage text, its result as CSV."""
    schemas = dict(s.split("=", 1) for s in args.schema)
    for view in args.view:
        name, _, path = view.partition("=")
        usage_files.register_usage_text(spark, path, name, _schema(schemas.get(name)))
    register_sql_functions(spark)
    files.write_csv(spark.sql(args.sql.strip().removesuffix(";")), args.out)


#: Jobs of one result, which can be published in place of the one before.
_PUBLISHED = (
    "usage-rollup",
    "update-rollup",
    "latest-activity",
    "activity-with-profile",
    "enrich-activity",
    "effective-users",
)
_DIRECTORY = ("assignments", "application", "users")
_JOBS = {
    "convert-usage": (convert_usage, ("text",)),
    "usage-rollup": (usage_rollup, ("usage",)),
    "lay-out-usage": (lay_out_usage, ("usage",)),
    "update-rollup": (update_rollup, ("usage", "state", "batch")),
    "latest-activity": (latest_activity, ("usage",)),
    "activity-with-profile": (activity_with_profile, ("usage", "users")),
    "enrich-activity": (enrich_activity, ("list", "users")),
    "direct-users": (direct_users, _DIRECTORY),
    "effective-users": (effective_users, (*_DIRECTORY, "memberships")),
    "group-access": (group_access, (*_DIRECTORY, "memberships", "groups")),
    "query": (query, ("sql",)),
}


def parser() -> argparse.ArgumentParser:
    root = argparse.ArgumentParser(prog="seatwise")
    jobs = root.add_subparsers(dest="job", required=True)
    for name, (_, inputs) in _JOBS.items():
        job = jobs.add_parser(name)
        for option in (*inputs, "out"):
            job.add_argument(f"--{option}", required=True)
        if name == "convert-usage":
            job.add_argument("--append", action="store_true", help="add newly landed files")
            job.add_argument("--schema", help="columns in file order, as in CREATE TABLE")
            job.add_argument("--count-losses", action="store_true", help="beside the table")
        if "usage" in inputs:
            job.add_argument("--day-col", default="act_date")
        if name in ("latest-activity", "activity-with-profile"):
            job.add_argument("--normalize", action="store_true")
            job.add_argument("--on-bad-date", choices=("raise", "null"), default="raise")
        if name == "lay-out-usage":
            job.add_argument("--buckets", type=int, help="default: the shuffle partitions")
            job.add_argument("--folder", help="where, if not the warehouse")
        if name in _PUBLISHED:
            job.add_argument("--publish", action="store_true", help="replace what readers see")
        if "users" in inputs:
            job.add_argument("--as-of", metavar="DAY", help="profiles as they stood on a day")
            job.add_argument("--store", help="identity store; needed where several are landed")
            job.add_argument("--instances", help="landed instance list, whose first store counts")
        if "assignments" in inputs:
            job.add_argument("--by-token", action="store_true", help="pages carry no numbers")
        if name == "enrich-activity":
            job.add_argument("--keep-date", action="store_true")
            job.add_argument("--multi-line", action="store_true", help="line breaks in quotes")
        if name == "group-access":
            job.add_argument("--dedupe", action="store_true", help="list a group once")
        if name == "query":
            job.add_argument("--view", action="append", default=[], metavar="NAME=FOLDER")
            job.add_argument("--schema", action="append", default=[], metavar="NAME=COLUMNS")
        if name == "direct-users":
            job.add_argument("--name", help="export name; default: one with a time stamp")
    return root


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parser().parse_args(argv)
    run, _ = _JOBS[args.job]
    run(spark or build_session(), args)


if __name__ == "__main__":
    main()
