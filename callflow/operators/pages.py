"""Whether a fetch is whole: gaps in page numbers, and chains of pages that name their next one."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callflow.operators.export import number_rows
from callflow.session import written


def _same(left: list[str], right: list[str]) -> Column:
    """Equal column by column, null to null."""
    return reduce(Column.__and__, [F.col(a).eqNullSafe(F.col(b)) for a, b in zip(left, right, strict=True)], F.lit(True))


def page_gaps(pages: DataFrame, number: str, fetch: list[str] | None = None, first: int = 1) -> DataFrame:
    """``first_missing, last_missing, n`` of each run of missing page numbers of each ``fetch``.

    Numbers count from ``first`` to the highest one seen; pages seen twice count once, a null number
    not at all. A number less its place among all rows is the same throughout a run, so runs come
    from one grouping, and each meets the run before it by its place: no fetch, however many of the
    pages it has, gathers in one task.
    """
    fetch = fetch or []
    numbers = pages.select(*fetch, F.col(number).cast("long").alias("_number")).filter("_number IS NOT NULL").distinct()
    placed = number_rows(numbers, *fetch, "_number")
    runs = placed.groupBy(*fetch, (F.col("_number") - F.col("row_index")).alias("_run")).agg(
        F.min("_number").alias("_first"),
        F.max("_number").alias("_last"),
        F.min("row_index").alias("_from"),
        F.max("row_index").alias("_to"),
    )
    runs = written(runs, "runs")
    names = [f"_{k}_{c}" for k, c in enumerate(fetch)]
    earlier = runs.select(
        *[F.col(c).alias(n) for c, n in zip(fetch, names, strict=True)],
        (F.col("_to") + 1).alias("_next"),
        F.col("_last").alias("_before"),
    )
    met = runs.join(earlier, (F.col("_from") == F.col("_next")) & _same(fetch, names), "left")
    start = F.coalesce("_before", F.lit(first - 1)) + 1
    return met.filter(F.col("_first") > start).select(
        *fetch, start.alias("first_missing"), (F.col("_first") - 1).alias("last_missing"), (F.col("_first") - start).alias("n")
    )


def _ranked(pointers: DataFrame, number: int) -> tuple[DataFrame, DataFrame]:
    """``(id, head, place)`` of nodes that a list's head leads to, and ``(id, low)`` of those on loops.

    ``pointers(id, before)`` has one row per node, null ``before`` for heads; no two nodes have the
    same ``before``. In each round a node that has not found its head takes over the pointer of the
    node it points to: distances double, and as pointers stay distinct no node is asked by many.
    ``low`` is the smallest id of the loop.
    """
    done = pointers.filter("before IS NULL").select("id", F.col("id").alias("head"), F.lit(0).cast("long").alias("place"))
    live = pointers.filter("before IS NOT NULL").select(
        "id", F.col("before").alias("at"), F.lit(1).cast("long").alias("far"), F.least("id", "before").alias("low")
    )
    live, reach = written(live, "live"), 1
    done = written(done, "done")
    while reach < 2 * number and not live.isEmpty():
        asked = done.select(
            F.col("id").alias("_id"), F.col("head").alias("_at"), F.col("place").alias("_far"),
            F.lit(None).cast("long").alias("_low"), F.lit(True).alias("_found"),
        ).unionByName(live.select(
            F.col("id").alias("_id"), F.col("at").alias("_at"), F.col("far").alias("_far"), F.col("low").alias("_low"),
            F.lit(False).alias("_found"),
        ))
        step = written(
            live.join(asked, F.col("at") == F.col("_id")).select(
                "id", F.col("_at").alias("at"), (F.col("far") + F.col("_far")).alias("far"),
                F.least("low", "_low").alias("low"), "_found",
            ),
            "step",
        )
        done = done.unionByName(step.filter("_found").select("id", F.col("at").alias("head"), F.col("far").alias("place")))
        live, reach = step.filter("NOT _found").drop("_found"), 2 * reach
    return done, live.select("id", "low")


def cursor_chains(pages: DataFrame, page: str, following: str, fetch: list[str] | None = None) -> DataFrame:
    """The chain of each page and its place there from 0: ``fetch, page, chain, place, ends``.

    ``following`` is the page that a page names as its next one, null or empty on the last. A chain
    is named by its first page: one that no landed page names, or, on a loop, the smallest. Where
    several pages name one, the smallest of them leads to it and the others' chains end there.
    ``ends`` is null for a page that leads on in its chain, otherwise ``end`` (no next page),
    ``open`` (the next page has not landed), ``joined`` (it belongs to another chain) or ``loop``
    (it is the chain's own first page). A fetch is whole if it has one chain and that ends. Of a page
    that landed twice in a fetch the greater cursor counts. Chains are ranked by pointer jumping, in
    as many rounds as the number of pages has binary digits.
    """
    fetch = fetch or []
    keyed = pages.select(*fetch, F.col(page).alias("page"), F.nullif(F.col(following), F.lit("")).alias("_next"))
    nodes = keyed.filter("page IS NOT NULL").groupBy(*fetch, "page").agg(F.max("_next").alias("_next"))
    nodes = written(number_rows(nodes, *fetch, "page").withColumnRenamed("row_index", "id"), "nodes")
    names = [f"_{k}_{c}" for k, c in enumerate(fetch)]
    targets = nodes.select(
        *[F.col(c).alias(n) for c, n in zip(fetch, names, strict=True)], F.col("page").alias("_page"), F.col("id").alias("_to")
    )
    links = nodes.filter("_next IS NOT NULL").join(targets, (F.col("_next") == F.col("_page")) & _same(fetch, names))
    links = written(links.select("id", "_to"), "links")
    leads = written(links.groupBy("_to").agg(F.min("id").alias("before")), "leads")
    pointers = nodes.select("id").join(leads, F.col("id") == F.col("_to"), "left").select("id", "before")
    number = nodes.count()
    listed, loops = _ranked(pointers, number)
    if not loops.isEmpty():
        # Cut before its smallest page, a loop is a list.
        loops = written(loops, "loops")
        cut = loops.join(leads, F.col("id") == F.col("_to")).select(
            "id", F.when(F.col("id") != F.col("low"), F.col("before")).alias("before")
        )
        listed = listed.unionByName(_ranked(written(cut, "cut"), number)[0])
    placed = written(listed, "placed")
    chosen = links.join(leads.withColumnRenamed("_to", "_led"), F.col("_to") == F.col("_led")).select(
        F.col("id").alias("_from"), "_to", (F.col("id") == F.col("before")).alias("_leads")
    )
    heads = nodes.select(F.col("id").alias("_head"), F.col("page").alias("chain"))
    ends = (
        F.when(F.col("_next").isNull(), "end")
        .when(F.col("_to").isNull(), "open")
        .when(~F.col("_leads"), "joined")
        .when(F.col("_to") == F.col("head"), "loop")
    )
    return (
        nodes.join(placed, "id")
        .join(heads, F.col("head") == F.col("_head"))
        .join(chosen, F.col("id") == F.col("_from"), "left")
        .select(*fetch, "page", "chain", "place", ends.alias("ends"))
    )


def fetch_report(chains: DataFrame, fetch: list[str]) -> DataFrame:
    """``pages, chains, whole`` of each fetch: whole if its pages are one chain that ends."""
    return chains.groupBy(*fetch).agg(
        F.count(F.lit(1)).alias("pages"),
        F.count(F.when(F.col("place") == 0, 1)).alias("chains"),
        ((F.count(F.when(F.col("place") == 0, 1)) == 1) & (F.count(F.when(F.col("ends") == "end", 1)) == 1)).alias("whole"),
    )
