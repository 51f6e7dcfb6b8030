"""The generated test tables seen as the engine's inputs (see FIXTURES.md)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seatwise.schemas import COUNTERS

#: Numbers beyond every customer's.
UNKNOWN_FROM = 1_000_000_000_000

# The columns used, so that no footer has to be read for planning.
SCHEMAS = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, props string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "pages": "page_id bigint, url string",
}


def _user(key: str) -> str:
    """The user of a number; every tenth one is nobody the directory knows."""
    return f"concat('u', if({key} % 10 = 0, {key} + {UNKNOWN_FROM}, {key}))"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = table(spark, sf_dir, "events").selectExpr(
        f"{_user('user_id')} AS name",
        "event_id % 2 = 0 AS quoted",
        "if(event_id % 97 <> 0, date_format(ts, 'MM-dd-yyyy'), NULL) AS act_date",
        "cast(event_id % 7 AS int) AS gap",
        "user_id % 25 <> 0 AS generates",
        "cast(get_json_object(props, '$.k') AS int) AS k",
    )
    return inputs.selectExpr(
        "if(quoted, concat('\"', name, '\"'), name) AS userid",
        "act_date",
        *(_counter(i, c) for i, c in enumerate(COUNTERS, 1)),
    )


def activity_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second usage table: the day is called ``data``, and some are no days."""
    name = _user("user_id")
    return table(spark, sf_dir, "events").selectExpr(
        f"if(event_id % 2 = 0, concat('\"', {name}, '\"'), {name}) AS userid",
        """CASE WHEN event_id % 97 = 0 THEN NULL
                WHEN event_id % 89 = 0 THEN concat('13-', date_format(ts, 'dd-yyyy'))
                WHEN event_id % 83 = 0 THEN ''
                ELSE date_format(ts, 'M-d-yyyy') END AS data""",
    )


def _counter(i: int, name: str) -> str:
    value = f"k * {i} % 50"
    if name.endswith(("generatedlines", "generatedtests")):
        value = f"if(generates, {value}, 0 * k)"
    # NULL where event_id + i is a multiple of seven.
    return f"if(gap <> {-i % 7}, {value}, NULL) AS {name}"


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    plain = "named_struct('Value', concat('a', key, '@x.test'), 'Primary', false)"
    primary = "named_struct('Value', concat('b', key, '@x.test'), 'Primary', true)"
    customer = table(spark, sf_dir, "customer")
    return customer.selectExpr("*", "cast(c_custkey AS string) AS key").selectExpr(
        "concat('u', key) AS user_id",
        "c_name AS user_name",
        "if(c_custkey % 13 <> 0, concat(c_mktsegment, ' ', c_name), NULL) AS display_name",
        "named_struct('GivenName', split_part(c_name, '#', 1),"
        " 'FamilyName', split_part(c_name, '#', 2)) AS name",
        f"""CASE c_custkey % 4
              WHEN 1 THEN cast(array() AS array<struct<Value:string,Primary:boolean>>)
              WHEN 2 THEN array({plain})
              WHEN 3 THEN array({plain}, {primary})
            END AS emails""",
    )


def groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    nations = nation.selectExpr("concat('n', n_nationkey) AS group_id", "n_name AS group_name")
    segments = (
        table(spark, sf_dir, "customer")
        .select("c_mktsegment")
        .distinct()
        .selectExpr("concat('s', c_mktsegment) AS group_id", "c_mktsegment AS group_name")
    )
    nobody = nation.where("n_nationkey = 0").selectExpr(
        "'empty' AS group_id", "'EMPTY' AS group_name"
    )
    return nations.unionByName(segments).unionByName(nobody)


def memberships(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    place = (
        "cast(floor(c_custkey / 100) AS int) AS page",
        "cast(c_custkey % 100 AS int) AS pos",
        f"{_user('c_custkey')} AS user_id",
    )
    by_nation = customer.where("c_mktsegment <> 'MACHINERY'").selectExpr(
        "concat('n', c_nationkey) AS group_id", *place
    )
    return by_nation.unionByName(
        customer.selectExpr("concat('s', c_mktsegment) AS group_id", *place)
    )


def assignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    # Page 1 holds every BUILDING customer, page 2 every third of them again.
    direct = (
        table(spark, sf_dir, "customer")
        .where("c_mktsegment = 'BUILDING'")
        .selectExpr(
            "explode(if(c_custkey % 3 = 0, array(1, 2), array(1))) AS page",
            "cast(c_custkey AS int) AS pos",
            "'USER' AS principal_type",
            f"{_user('c_custkey')} AS principal_id",
        )
    )
    by_nation = nation.where("n_regionkey IN (1, 2)").selectExpr(
        "3 AS page",
        "n_nationkey AS pos",
        "'GROUP' AS principal_type",
        "concat('n', n_nationkey) AS principal_id",
    )
    named = (
        nation.where("n_regionkey = 1")
        .selectExpr("concat('n', min(n_nationkey)) AS lowest")
        .selectExpr("posexplode(array('sHOUSEHOLD', 'empty', lowest)) AS (pos, principal_id)")
        .selectExpr("4 AS page", "pos", "'GROUP' AS principal_type", "principal_id")
    )
    return direct.unionByName(by_nation).unionByName(named)


def directory(
    spark: SparkSession, sf_dir: str
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Assignments, memberships, group profiles and users, as the group analyses take them."""
    return (
        assignments(spark, sf_dir),
        memberships(spark, sf_dir),
        groups(spark, sf_dir),
        users(spark, sf_dir),
    )


def membership_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headers of landed membership pages, of which some groups lack one or a token."""
    pages = memberships(spark, sf_dir).select("group_id", "page").distinct()
    last = Window.partitionBy("group_id")
    number = F.pmod(F.length("group_id") + F.ascii(F.substring("group_id", 2, 1)), F.lit(5))
    token = F.when(F.col("page") < F.col("last"), F.lit("t"))
    return (
        pages.withColumn("last", F.max("page").over(last))
        .withColumn("kind", number)
        .where("NOT (kind = 1 AND page = 0) AND NOT (kind = 2 AND page = last)")
        .withColumn("copies", F.when(F.expr("kind = 3 AND page = 1"), 2).otherwise(1))
        .withColumn("NextToken", token)
        .select(
            F.col("group_id").alias("GroupId"),
            "page",
            F.explode(F.array_repeat("NextToken", F.col("copies"))).alias("NextToken"),
        )
    )


def token_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Membership pages with tokens and no numbers, one kind of fault for most groups.

    By kind: 0 whole, 1 first page missing, 2 a page missing, 3 one landed twice,
    4 one landed with two next tokens, 5 the last leads back to the third, 6 three
    pages that lead to each other only.
    """
    pages = memberships(spark, sf_dir).groupBy("group_id", "page").agg(F.count("*").alias("members"))
    number = F.length("group_id") * 3 + F.ascii(F.substring("group_id", 2, 1))
    name = "substring(sha2(concat(group_id, '/', {}), 256), 1, 12)"
    follows = f"""CASE WHEN kind = 5 AND page = last THEN {name.format(2)}
        WHEN kind = 6 AND page = 5 THEN {name.format(3)} WHEN kind = 6 AND page = 2 THEN NULL
        WHEN page < last THEN {name.format("page + 1")} END"""
    return (
        pages.withColumn("last", F.max("page").over(Window.partitionBy("group_id")))
        .withColumn("kind", F.pmod(number, F.lit(7)))
        .withColumn("again", F.expr("explode(if(kind IN (3, 4) AND page = 4, array(0, 1), array(0)))"))
        .where("NOT (kind = 1 AND page = 0) AND NOT (kind = 2 AND page = 5)")
        .selectExpr(
            "group_id AS GroupId",
            f"if(page = 0, NULL, {name.format('page')}) AS Token",
            f"if(kind = 4 AND again = 1, {name.format(9)}, {follows}) AS NextToken",
            "members",
        )
        .repartition(4, "NextToken")
    )


def faulty_usage_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Usage text lines of which some are short, long, or hold no number."""
    fields = usage(spark, sf_dir).select(
        "userid", "act_date", *(F.col(c).cast("string") for c in COUNTERS[:4])
    )
    numbered = fields.withColumn("n", F.substring(F.replace("userid", F.lit('"'), F.lit("")), 2, 20))
    text = [F.coalesce(F.col(c), F.lit("\\N")) for c in fields.columns]
    number = F.col("n").cast("bigint")
    text[2] = F.when(number % 5 == 0, "many").otherwise(text[2])
    text[5] = F.when(number % 7 == 0, "99999999999").when(number % 7 == 1, "").otherwise(text[5])
    line = F.concat_ws(",", *text)
    return numbered.select(
        F.when(number % 11 == 0, F.concat_ws(",", *text[:3]))
        .when(number % 13 == 0, F.concat(line, F.lit(",7,8")))
        .otherwise(line)
        .alias("userid,act_date,a,b,c,d")
    )


def user_landings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User profiles landed whole on two days, and their changes on four others."""
    rows = users(spark, sf_dir).withColumn("n", F.substring("user_id", 2, 20).cast("bigint"))
    # Whom each landing holds, and what it says of them.
    landings = [
        ("full", "2025-03-01", "n % 10 <> 9", "false", "user_name"),
        ("changes", "2025-03-02", "n % 3 = 0", "false", "concat(user_name, '@2')"),
        ("changes", "2025-03-03", "n % 7 = 0", "true", "NULL"),
        ("changes", "2025-03-04", "n % 21 = 0", "false", "concat(user_name, '@4')"),
        ("full", "2025-03-05", "n % 11 <> 0", "false", "user_name"),
        ("changes", "2025-03-05", "n % 5 = 0", "false", "concat(user_name, '@5')"),
        ("changes", "2025-03-06", "n % 10 = 0", "n % 20 = 0", "concat(user_name, '@6')"),
        ("changes", "2025-03-08", "n % 2 = 0", "true", "NULL"),
    ]
    parts = [
        rows.where(held).selectExpr(
            f"'{kind}' AS kind",
            f"'{day}' AS landed",
            f"{gone} AS Removed",
            "'d-1' AS IdentityStoreId",
            "user_id AS UserId",
            f"{name} AS UserName",
            "display_name AS DisplayName",
            "name AS Name",
            "emails AS Emails",
        )
        for kind, day, held, gone, name in landings
    ]
    return reduce(DataFrame.unionByName, parts)


def instance_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The listed identity instances: a page for each region, a store for each nation."""
    store = F.concat(F.lit("d-"), F.lpad((97 - F.col("n_nationkey")).cast("string"), 3, "0"))
    entry = F.struct("n_nationkey", F.struct(store.alias("IdentityStoreId")).alias("entry"))
    listed = F.sort_array(F.collect_list(entry))
    return (
        table(spark, sf_dir, "nation")
        .groupBy((4 - F.col("n_regionkey")).alias("page"))
        .agg(F.transform(listed, lambda e: e["entry"]).alias("Instances"))
    )


def application_assignments(assignments: DataFrame) -> DataFrame:
    """The assignments dealt out to applications by page; some belong to two."""
    return assignments.withColumn("application_arn", F.concat(F.lit("app"), F.col("page"))).unionByName(
        assignments.where("principal_type = 'GROUP' AND pos % 2 = 0").withColumn(
            "application_arn", F.lit("app2")
        )
    )
