"""The order of landed pages that carry tokens and no numbers.

A page knows the token it was asked for with and the token of the next one; the
first was asked for without. Following a chain from page to page would take as
many steps as it has pages. Here every page holds a pointer back, at first to the
page before it, and all pointers double their reach in each round, so a chain of a
million pages takes twenty rounds however the pages are spread.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seatwise.session import scratch_path

#: The token that the first page was asked for with.
FIRST = ""


def _token(name: str) -> Column:
    return F.coalesce(F.trim(name), F.lit(FIRST))


def _written(df: DataFrame) -> DataFrame:
    path = scratch_path(df.sparkSession, "page-order")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _pages(pages: DataFrame, key: str) -> DataFrame:
    """``(key, token, following, landed)`` of each distinct landed page."""
    return (
        pages.select(F.col(key), _token("Token").alias("token"), _token("NextToken").alias("following"))
        .groupBy(key, "token", "following")
        .agg(F.count("*").alias("landed"))
    )


def _ranked(pages: DataFrame, key: str) -> DataFrame:
    """``(key, token, start, steps, ended)``: where each page's way back ends, how far off.

    Of several pages that lead to one, the one of smallest token counts. ``ended`` is
    false for pages whose way back goes round in a circle.
    """
    before = (
        pages.where(F.col("following") != FIRST)
        .groupBy(key, F.col("following").alias("token"))
        .agg(F.min("token").alias("before"))
    )
    known = pages.select(key, "token").distinct().join(before, [key, "token"], "left")
    alone = F.col("before").isNull() | (F.col("token") == FIRST)
    ranked = _written(
        known.select(
            key,
            "token",
            F.when(alone, F.col("token")).otherwise(F.col("before")).alias("back"),
            F.when(alone, 0).otherwise(1).cast("long").alias("steps"),
            alone.alias("ended"),
        )
    )
    # A way back without a circle is shorter than the number of pages.
    for _ in range(ranked.count().bit_length() + 1):
        if ranked.where("NOT ended").isEmpty():
            break
        there = ranked.select(
            key,
            F.col("token").alias("back"),
            F.col("back").alias("beyond"),
            F.col("steps").alias("more"),
            F.col("ended").alias("there"),
        )
        moved = (
            ranked.where("NOT ended")
            .join(there, [key, "back"])
            .select(
                key,
                "token",
                F.col("beyond").alias("back"),
                (F.col("steps") + F.col("more")).alias("steps"),
                F.col("there").alias("ended"),
            )
        )
        ranked = _written(ranked.where("ended").unionByName(moved))
    return ranked.withColumnRenamed("back", "start")


def page_order(pages: DataFrame, key: str) -> DataFrame:
    """``(key, token, page)``: the number, from 1, of each page that the first leads to."""
    ranked = _ranked(_written(_pages(pages, key)), key)
    return ranked.where(F.col("ended") & (F.col("start") == FIRST)).select(
        key, "token", (F.col("steps") + 1).cast("int").alias("page")
    )


def chain_problems(pages: DataFrame, key: str) -> DataFrame:
    """``(key, problem, token, pages)``: what keeps chains from being whole.

    One row for each key and kind, with the smallest token concerned and how many
    tokens are: ``first page missing``; ``page repeated``, landed more than once
    alike; ``fork``, landed with different next tokens; ``token repeated``, named
    next by several pages; ``gap``, named next and not landed; ``cut off``, named
    next by no page; ``cycle``, on a way that comes back to itself or behind one.
    """
    landed = _written(_pages(pages, key))
    ranked = _ranked(landed, key)
    nodes = landed.groupBy(key, "token").agg(
        F.count("*").alias("ways"), F.max("landed").alias("most")
    )
    named = (
        landed.where(F.col("following") != FIRST)
        .groupBy(key, F.col("following").alias("token"))
        .agg(F.count_distinct("token").alias("by"))
    )
    gaps = named.join(nodes, [key, "token"], "left_anti").select(key, "token", F.lit("gap").alias("problem"))
    kinds = F.array_compact(
        F.array(
            F.when(F.col("most") > 1, "page repeated"),
            F.when(F.col("ways") > 1, "fork"),
        )
    )
    found = (
        nodes.select(key, "token", F.explode(kinds).alias("problem"))
        .unionByName(named.where("by > 1").select(key, "token", F.lit("token repeated").alias("problem")))
        .unionByName(gaps)
        .unionByName(
            ranked.where(F.col("ended") & (F.col("steps") == 0) & (F.col("token") != FIRST)).select(
                key, "token", F.lit("cut off").alias("problem")
            )
        )
        .unionByName(ranked.where("NOT ended").select(key, "token", F.lit("cycle").alias("problem")))
    )
    headless = (
        nodes.groupBy(key)
        .agg(F.min("token").alias("token"))
        .where(F.col("token") != FIRST)
        .select(key, "token", F.lit("first page missing").alias("problem"))
    )
    return (
        found.unionByName(headless)
        .groupBy(key, "problem")
        .agg(F.min("token").alias("token"), F.count("*").alias("pages"))
    )


def in_token_order(pages: DataFrame, key: str) -> DataFrame:
    """The pages with ``page`` numbered along their tokens.

    Fails naming an application or group whose pages are no whole chain.
    """
    problem = chain_problems(pages, key).orderBy(key, "problem").first()
    if problem is not None:
        raise ValueError(
            f"incomplete landing of {problem[key]}: {problem['problem']} at token "
            f"{problem['token']!r}, {problem['pages']} in all"
        )
    order = page_order(pages, key).withColumnRenamed("token", "_token")
    kept = pages.drop("page").withColumn("_token", _token("Token"))
    return kept.join(order, [key, "_token"]).drop("_token").select(*pages.columns)
