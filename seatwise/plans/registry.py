"""Every analysis as a query over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seatwise.functions.emails import first_or_null, primary_or_blank
from seatwise.functions.sql import register_sql_functions
from seatwise.functions.text import clean_user_id, export_stamp, uri_bucket, uri_key
from seatwise.operators import access, applications, enrich, foldable, groups, laid_out, usage
from seatwise.plans import driver_tables as tables
from seatwise.schemas import ACTIVITY_LOG, MEMBERSHIP_PAGE, USAGE, USER_PROFILE
from seatwise.session import scratch_path
from seatwise.sinks import files, places, publish
from seatwise.sources import directory, page_order, snapshots, usage_files, usage_table, user_list

Query = Callable[[SparkSession, str], DataFrame]

APPLICATION = "arn:test:application/main"
OTHER_APPLICATION = "arn:test:application/other"
STORE = "d-1"


def _on_usage(analysis: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: analysis(tables.usage(spark, sf_dir))


def _on_directory(analysis: Callable[..., DataFrame]) -> Query:
    return lambda spark, sf_dir: analysis(*tables.directory(spark, sf_dir))


def _latest_activity_lenient(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = tables.activity_log(spark, sf_dir)
    return usage.latest_activity(log, "data", on_bad_date="null")


def _bad_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return usage.bad_days(tables.activity_log(spark, sf_dir), "data")


def _usage_rollup_folded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three uneven batches, one of them written twice, folded out of order."""
    rows = tables.usage(spark, sf_dir)
    day = F.substring("act_date", 4, 2).cast("int")
    batches = {"c": day.isNull(), "a": day <= 9, "b": day > 9}
    path = scratch_path(spark, "usage-state")
    for batch in ("b", "c", "a", "c"):
        foldable.write_state(foldable.usage_state(rows.where(batches[batch])), path, batch)
    return foldable.rollup_of(foldable.merged(foldable.read_state(spark, path)))


def _laid_out(spark: SparkSession, sf_dir: str) -> usage_table.UsageTable:
    folder = scratch_path(spark, "usage-table")
    name = "usage_" + folder.rpartition("-")[2]
    usage_table.write_usage_table(tables.usage(spark, sf_dir), name, folder=folder)
    return usage_table.usage_table(spark, name)


def _usage_rollup_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return laid_out.usage_rollup(_laid_out(spark, sf_dir))


def _latest_activity_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return laid_out.latest_activity(_laid_out(spark, sf_dir))


def _activity_with_profile_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return laid_out.activity_with_profile(_laid_out(spark, sf_dir), tables.users(spark, sf_dir))


def _conversion_losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    text, out = scratch_path(spark, "usage-text"), scratch_path(spark, "usage-parquet")
    usage_files.write_lines(tables.faulty_usage_lines(spark, sf_dir), text)
    schema = type(USAGE)(USAGE.fields[:6])
    rows = usage_files.read_usage_text(spark, text, schema, with_lost=True)
    usage_files.write_usage_parquet(rows, out)
    return usage_files.read_losses(spark, out)


def _latest_activity_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    register_sql_functions(spark)
    return spark.sql(
        """
        SELECT DISTINCT replace(userid, '"', '') AS user_id, latest_activity_date
        FROM (SELECT userid, max(parse_datetime(act_date, 'MM-dd-YYYY')) AS latest_activity_date
              FROM {usage} GROUP BY userid)
        ORDER BY latest_activity_date DESC NULLS LAST, user_id
        """,
        usage=tables.usage(spark, sf_dir),
    )


def _sample_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which rows come is open; how many come and that the table holds them is not.

    The table is looked through for the digests of the sample, 100 at most, and no
    row of it moves.
    """
    table = tables.usage(spark, sf_dir)
    digest = F.sha2(F.to_json(F.struct(*table.columns)), 256).alias("digest")
    sample = usage.sample_rows(table).select(digest)
    held = table.select(digest).join(F.broadcast(sample.distinct()), "digest", "left_semi").distinct()
    known = sample.join(F.broadcast(held.withColumn("held", F.lit(True))), "digest", "left")
    return known.agg(
        F.count("*").alias("returned"), F.count_if(F.col("held").isNull()).alias("foreign")
    )


def _parsed_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    register_sql_functions(spark)
    return spark.sql(
        """
        SELECT event_id,
               parse_datetime(date_format(ts, 'yyyyMMdd'), 'YYYYMMdd') AS packed,
               parse_datetime(date_format(ts, 'MMM-dd-yyyy'), 'MMM-dd-YYYY') AS short_name,
               parse_datetime(date_format(ts, 'MMMM d yyyy'), 'MMMM dd YYYY') AS long_name,
               parse_datetime(date_format(ts, 'M/d/yyyy HH:mm:ss'), 'MM/dd/YYYY HH:mm:ss') AS exact,
               parse_datetime(date_format(ts, 'yyyy-M-d H:m'), 'YYYY-MM-dd HH:mm') AS one_digit,
               parse_datetime(date_format(ts, 'd MMM yyyy h:mm:ss a'),
                              'dd MMM YYYY hh:mm:ss a') AS half_days,
               parse_datetime(date_format(ts, "'Y'yyyy'at'HHmm DDD"),
                              "'Y'YYYY'at'HHmm DDD") AS quoted
        FROM {events}
        """,
        events=tables.table(spark, sf_dir, "events"),
    )


def _incomplete_landings(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "membership-pages")
    tables.membership_landing(spark, sf_dir).write.json(path)
    pages = spark.read.schema(MEMBERSHIP_PAGE).json(path)
    return directory.incomplete_landings(pages, "GroupId")


def _token_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-pages")
    tables.token_landing(spark, sf_dir).drop("members").write.json(path)
    return spark.read.schema(MEMBERSHIP_PAGE).json(path)


def _page_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_order.page_order(_token_pages(spark, sf_dir), "GroupId")


def _chain_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_order.chain_problems(_token_pages(spark, sf_dir), "GroupId")


def _src_memberships_by_token(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members of the groups whose chain of pages is whole, numbered along it."""
    path = scratch_path(spark, "memberships")
    members = tables.memberships(spark, sf_dir)
    entry = F.struct("pos", F.struct(F.col("user_id").alias("UserId")).alias("MemberId"))
    token = F.substring(F.sha2(F.concat_ws("/", "GroupId", "page"), 256), 1, 10)
    pages = Window.partitionBy("GroupId").orderBy("page")
    (
        members.groupBy(F.col("group_id").alias("GroupId"), "page")
        .agg(_in_order(entry, "MemberId").alias("GroupMemberships"))
        .withColumn("own", token)
        .withColumn("NextToken", F.coalesce(F.lead("own").over(pages), F.lit("")))
        .withColumn("Token", F.when(F.row_number().over(pages) > 1, F.col("own")))
        .withColumn("identity_store_id", F.lit(STORE))
        .drop("page", "own")
        .write.partitionBy("identity_store_id")
        .json(path)
    )
    return directory.read_memberships(spark, path, STORE, by_token=True)


def _direct_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return access.direct_users(tables.assignments(spark, sf_dir), tables.users(spark, sf_dir))


def _direct_user_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return access.direct_user_count(tables.assignments(spark, sf_dir), tables.users(spark, sf_dir))


def _effective_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    assignments, memberships, _, users = tables.directory(spark, sf_dir)
    return access.effective_users(assignments, memberships, users)


def _enrich_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = tables.usage(spark, sf_dir).select(
        clean_user_id(F.col("userid")).alias("user_id"),
        F.col("act_date").alias("last_activity_date"),
    )
    return enrich.enrich_activity(listed, tables.users(spark, sf_dir))


def _activity_with_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.activity_with_profile(tables.usage(spark, sf_dir), tables.users(spark, sf_dir))


def _group_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Few pages to a row, so that groups come in several rows at every size.
    nested = groups.group_nested(*tables.directory(spark, sf_dir), pages_per_row=4)
    # As text, so that any engine compares the lists alike.
    return nested.withColumn("users", F.to_json("users", {"ignoreNullFields": "false"}))


def _email_primary(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = tables.users(spark, sf_dir)
    return users.select("user_id", primary_or_blank(F.col("emails")).alias("email"))


def _email_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return access.short_profiles(tables.users(spark, sf_dir)).select("user_id", "email")


def _uri_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    uri = F.regexp_replace("url", "^https?://", "s3://")
    return tables.table(spark, sf_dir, "pages").select(
        "page_id", uri_bucket(uri).alias("bucket"), uri_key(uri).alias("key")
    )


def _export_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.table(spark, sf_dir, "events").select(
        "event_id", export_stamp(F.col("ts")).alias("stamp")
    )


def _src_usage_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "usage-text")
    usage_files.write_usage_text(tables.usage(spark, sf_dir), path)
    return usage_files.read_usage_text(spark, path)


def _src_activity_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "activity-text")
    usage_files.write_usage_text(tables.activity_log(spark, sf_dir), path)
    return usage_files.read_usage_text(spark, path, ACTIVITY_LOG)


def _src_usage_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "usage-parquet")
    usage_files.write_usage_parquet(tables.usage(spark, sf_dir), path)
    return spark.read.parquet(path)


def _src_user_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "user-list")
    padded = tables.usage(spark, sf_dir).select(
        F.concat(F.lit("\t "), F.col("userid"), F.lit("  ")).alias("id"),
        F.replace("act_date", F.lit("-"), F.lit(', "')).alias("day"),
    )
    files.write_csv(padded, path)
    return user_list.read_user_list(spark, path)


def _src_user_list_multiline(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "user-list")
    broken = tables.table(spark, sf_dir, "events").selectExpr(
        "concat('u', user_id, if(event_id % 3 = 0, '\n\n', ''), 'x\"y') AS id",
        "if(event_id % 4 <> 0, concat(date_format(ts, 'MM-dd-yyyy'),"
        " if(event_id % 5 = 0, '\n\"late\",\n', '')), NULL) AS day",
    )
    files.write_csv(broken, path)
    return user_list.read_user_list(spark, path)


def _src_assignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "assignments")
    entry = F.struct(
        "pos",
        F.col("principal_type").alias("PrincipalType"),
        F.col("principal_id").alias("PrincipalId"),
    )
    # A place occurs once per page, so a landed page holds at most 100 entries.
    landed = (
        tables.assignments(spark, sf_dir)
        .groupBy(
            F.when(F.col("page") == 2, OTHER_APPLICATION)
            .otherwise(APPLICATION)
            .alias("application_arn"),
            (F.floor(F.col("pos") / 100) * 10 + F.col("page")).cast("int").alias("page"),
        )
        .agg(_in_order(entry, "PrincipalType", "PrincipalId").alias("ApplicationAssignments"))
    )
    landed.write.partitionBy("application_arn").json(path)
    return directory.read_assignments(spark, path, APPLICATION)


def _src_memberships(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "memberships")
    entry = F.struct("pos", F.struct(F.col("user_id").alias("UserId")).alias("MemberId"))
    landed = (
        tables.memberships(spark, sf_dir)
        .groupBy(F.col("group_id").alias("GroupId"), "page")
        .agg(_in_order(entry, "MemberId").alias("GroupMemberships"))
        .withColumn("identity_store_id", F.when(F.col("page") % 5 == 0, "d-2").otherwise(STORE))
    )
    landed.write.partitionBy("identity_store_id").json(path)
    return directory.read_memberships(spark, path, STORE)


def _in_order(entry, *fields: str):
    """The entries of one landed page by their place, which itself is not landed."""
    ordered = F.sort_array(F.collect_list(entry))
    return F.transform(ordered, lambda e: F.struct(*(e[f].alias(f) for f in fields)))


def _src_directory(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "users")
    number = F.substring("user_id", 2, 20).cast("bigint")
    landed = tables.users(spark, sf_dir).select(
        F.concat(F.lit("d-"), (number % 3).cast("string")).alias("identity_store_id"),
        F.col("user_id").alias("UserId"),
        F.col("user_name").alias("UserName"),
        F.col("display_name").alias("DisplayName"),
        F.col("name").alias("Name"),
        F.col("emails").alias("Emails"),
    )
    landed.write.partitionBy("identity_store_id").json(path)
    return directory.read_users(spark, path, "d-0").select(
        "user_id",
        "user_name",
        "display_name",
        F.col("name.GivenName").alias("first_name"),
        F.col("name.FamilyName").alias("last_name"),
        F.array_size("emails").alias("emails"),
        first_or_null(F.col("emails")).alias("first_email"),
        primary_or_blank(F.col("emails")).alias("primary_email"),
    )


def _src_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "groups")
    landed = tables.groups(spark, sf_dir).select(
        F.lit(STORE).alias("identity_store_id"),
        F.col("group_id").alias("GroupId"),
        F.struct(F.col("group_name").alias("DisplayName")).alias("Group"),
    )
    landed.write.partitionBy("identity_store_id").json(path)
    return directory.read_groups(spark, path, STORE)


def _directory_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "landings")
    tables.user_landings(spark, sf_dir).write.partitionBy("kind", "landed").json(path)
    return directory.read_users(spark, path, STORE, as_of="2025-03-06").select(
        "user_id", "user_name", "display_name", F.array_size("emails").alias("emails")
    )


def _directory_landings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many users stand after each landing."""
    path = scratch_path(spark, "landings")
    tables.user_landings(spark, sf_dir).write.partitionBy("kind", "landed").json(path)
    rows = spark.read.schema(snapshots.with_landing(USER_PROFILE)).json(path)
    days = ("2025-03-01", "2025-03-03", "2025-03-05", "2025-03-07", "2025-03-09")
    counts = [
        snapshots.as_of(rows, "UserId", day).agg(
            F.lit(day).alias("day"),
            F.count("*").alias("users"),
            F.count_if(F.col("UserName").like("%@%")).alias("renamed"),
        )
        for day in days
    ]
    return reduce(DataFrame.unionByName, counts)


def _first_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "instances")
    tables.instance_pages(spark, sf_dir).write.json(path)
    return spark.range(1).select(
        F.lit(directory.first_store(spark, path)).alias("identity_store_id")
    )


def _snk_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published twice; what readers see is the second."""
    out = scratch_path(spark, "published")
    latest = usage.latest_activity(tables.usage(spark, sf_dir))
    publish.publish(latest.where("latest_activity_date IS NOT NULL"), out)
    publish.publish(latest, out)
    folder = publish.published_folder(spark, out, verify=True)
    return _read_export(spark, folder, "user_id string, latest_activity_date date")


def _publish_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and bytes of two published versions, as their manifests tell them."""
    out = scratch_path(spark, "published")
    lines = groups.group_report(*tables.directory(spark, sf_dir))
    publish.publish(lines.where("line LIKE '- %'"), out, files.write_report)
    publish.publish(lines, out, files.write_report)
    return publish.manifests(spark, out).groupBy("version").agg(
        F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes")
    )


def _group_report_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = groups.group_report(*tables.directory(spark, sf_dir))
    return places.with_places(report, [c for c in report.columns if c != "line"])


def _effective_users_by_application(spark: SparkSession, sf_dir: str) -> DataFrame:
    assignments, memberships, _, users = tables.directory(spark, sf_dir)
    path = scratch_path(spark, "memberships")
    applications.write_memberships(memberships, path, buckets=16)
    return applications.effective_users(
        tables.application_assignments(assignments),
        spark.read.parquet(path),
        users,
        ["app2", "app3"],
        buckets=16,
    )


def _read_export(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).option("escape", '"').csv(path)


def _snk_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = usage.latest_activity(tables.usage(spark, sf_dir))
    path = files.write_csv(latest, scratch_path(spark, "latest-activity"))
    return _read_export(spark, path, "user_id string, latest_activity_date date")


def _snk_user_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = files.export_users(_direct_users(spark, sf_dir), scratch_path(spark, "direct-users"))
    columns = ", ".join(f"{name} string" for name in files.USER_EXPORT.values())
    return _read_export(spark, path, columns)


def _snk_activity_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    activity = _activity_with_profile(spark, sf_dir)
    path = files.export_activity(activity, scratch_path(spark, "activity"))
    columns = ", ".join(f"{name} string" for name in files.ACTIVITY_EXPORT.values())
    return _read_export(spark, path, columns)


def _snk_report_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = groups.group_report(*tables.directory(spark, sf_dir))
    path = files.write_report(report, scratch_path(spark, "report"))
    return spark.read.text(path).select(F.col("value").alias("line"))


QUERIES: dict[str, Query] = {
    "usage_rollup": _on_usage(usage.usage_rollup),
    "usage_rollup_folded": _usage_rollup_folded,
    "usage_rollup_table": _usage_rollup_table,
    "latest_activity_table": _latest_activity_table,
    "activity_with_profile_table": _activity_with_profile_table,
    "conversion_losses": _conversion_losses,
    "active_days": _on_usage(usage.active_days),
    "usage_pair_sums": _on_usage(usage.usage_pair_sums),
    "acceptance_ratio": _on_usage(usage.acceptance_ratio),
    "acceptance_fraction": _on_usage(usage.acceptance_fraction),
    "latest_activity": _on_usage(usage.latest_activity),
    "latest_activity_normalized": _on_usage(lambda u: usage.latest_activity(u, normalize=True)),
    "latest_activity_lenient": _latest_activity_lenient,
    "latest_activity_sql": _latest_activity_sql,
    "bad_days": _bad_days,
    "sample_rows": _sample_rows,
    "parsed_patterns": _parsed_patterns,
    "incomplete_landings": _incomplete_landings,
    "page_order": _page_order,
    "chain_problems": _chain_problems,
    "direct_users": _direct_users,
    "direct_user_count": _direct_user_count,
    "enrich_activity": _enrich_activity,
    "activity_with_profile": _activity_with_profile,
    "effective_users": _effective_users,
    "group_roster": _on_directory(groups.group_roster),
    "group_summary": _on_directory(groups.group_summary),
    "group_totals": _on_directory(groups.group_totals),
    "group_nested": _group_nested,
    "group_report": _on_directory(groups.group_report),
    "email_primary": _email_primary,
    "email_first": _email_first,
    "uri_parts": _uri_parts,
    "export_stamp": _export_stamp,
    "src_usage_text": _src_usage_text,
    "src_activity_text": _src_activity_text,
    "src_usage_parquet": _src_usage_parquet,
    "src_user_list": _src_user_list,
    "src_user_list_multiline": _src_user_list_multiline,
    "src_assignments": _src_assignments,
    "src_memberships": _src_memberships,
    "src_memberships_by_token": _src_memberships_by_token,
    "src_directory": _src_directory,
    "src_groups": _src_groups,
    "snk_csv_roundtrip": _snk_csv_roundtrip,
    "snk_user_export": _snk_user_export,
    "snk_activity_export": _snk_activity_export,
    "snk_report_text": _snk_report_text,
    "directory_as_of": _directory_as_of,
    "directory_landings": _directory_landings,
    "first_store": _first_store,
    "snk_published": _snk_published,
    "publish_manifest": _publish_manifest,
    "group_report_places": _group_report_places,
    "effective_users_by_application": _effective_users_by_application,
}
