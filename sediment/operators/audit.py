"""Look-ups over the append-only run, rule, result and lineage tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sediment.config import SpecError
from sediment.operators.dedup import keep_latest, page
from sediment.operators.joins import effective_lookup
from sediment.session import materialize


def pipeline_runs(runs: DataFrame, pipeline_id: str | int, skip: int = 0, limit: int = 100) -> DataFrame:
    """A page of one pipeline's runs, in run order."""
    return page(runs.filter(F.col("pipeline_id") == pipeline_id), ["start_time", "run_id"], skip, limit)


def run_results(runs: DataFrame, results: DataFrame, run_id: str = "run_id") -> DataFrame:
    """Runs with their quality results (or errors, or metrics)."""
    return runs.join(results, run_id)


def current_runs(states: DataFrame, run_id: str = "run_id", recorded_at: str = "recorded_at") -> DataFrame:
    """State rows are appended, never changed; a run is its latest state row."""
    return keep_latest(states, [run_id], recorded_at, [c for c in states.columns if c not in (run_id, recorded_at)])


def close_run(
    runs: DataFrame, status: Column, end_time: Column, error_message: Column, recorded_at: Column
) -> DataFrame:
    """Closing state rows to append: status, end, duration and error."""
    seconds = end_time.cast("timestamp").cast("long") - F.col("start_time").cast("timestamp").cast("long")
    return runs.withColumns(
        {
            "status": status,
            "end_time": end_time,
            "duration_seconds": seconds,
            "error_message": error_message,
            "recorded_at": recorded_at,
        }
    )


def rules_of_mappings(rule_mappings: DataFrame, rules: DataFrame) -> DataFrame:
    """Enabled rule mappings with the rule they refer to."""
    return rule_mappings.filter(F.col("enabled")).join(rules, "rule_id")


def active_mappings(requests: DataFrame, mappings: DataFrame, keys: Sequence[str], at: str) -> DataFrame:
    """The layer mapping in force at each requested time."""
    return effective_lookup(requests, mappings, keys, at)


def retry_history(attempts: DataFrame, error_id: str = "error_id") -> DataFrame:
    """Attempts per error and the outcome of the last one."""
    return attempts.groupBy(error_id).agg(
        F.max("attempt_number").alias("attempts"),
        F.max_by("status", "attempt_number").alias("last_status"),
        F.max_by("end_time", "attempt_number").alias("last_end_time"),
    )


def version_chain(versions: DataFrame, version_id: str, previous_id: str) -> DataFrame:
    """Every version with the first of its chain (``root_id``) and its distance (``depth``).

    Each round joins a version with what its ancestor already knows, so the distance covered
    doubles and a chain of n versions takes log2(n) rounds. A chain that never ends is an error.
    """
    links = materialize(
        versions.select(
            F.col(version_id).alias("id"),
            F.col(previous_id).alias("up"),
            F.col(version_id).alias("root_id"),
            F.lit(0).cast("long").alias("depth"),
        ),
        "chain",
    )
    rounds = max(links.count(), 2).bit_length() + 1
    for _ in range(rounds):
        # Finished chains wait aside: their empty link would gather them in one join task.
        done = links.filter(F.col("up").isNull())
        pending = links.filter(F.col("up").isNotNull())
        if pending.isEmpty():
            return links.select(F.col("id").alias(version_id), "root_id", "depth")
        above = links.select(
            F.col("id").alias("a_id"),
            F.col("up").alias("a_up"),
            F.col("root_id").alias("a_root"),
            F.col("depth").alias("a_depth"),
        )
        # The link itself is one step; an ancestor that is missing ends the chain.
        known = F.col("a_id").isNotNull()
        moved = pending.join(above, F.col("up") == F.col("a_id"), "left").select(
            "id",
            F.when(known, F.col("a_up")).alias("up"),
            F.when(known, F.col("a_root")).otherwise(F.col("root_id")).alias("root_id"),
            F.when(known, F.col("depth") + 1 + F.col("a_depth")).otherwise(F.col("depth")).alias("depth"),
        )
        links = materialize(done.unionByName(moved), "chain")
    raise SpecError("version chain holds a cycle")


# Edges for which there is a task of their own where pairs are made distinct: memory of a task does not grow with the table.
LINEAGE_TASK_ROWS = 200_000


def lineage_closure(edges: DataFrame, table: str = "table_name", parent: str = "depends_on", cycles: str = "error") -> DataFrame:
    """All (table, ancestor) pairs with their smallest distance.

    Rounds go over the tables that are ancestors themselves. Once all their pairs up to a distance are known, those
    up to twice of it end in one of exactly that distance, so a layering of depth n takes log2(n) rounds, and a round
    writes only pairs that are new: none gets shorter later. All other tables, often most, then take what their
    parents have, in one join. A table that is its own ancestor is an error, or with ``cycles='keep'`` a row, for
    :func:`lineage_cycles`."""
    first = edges.filter(F.col(table).isNotNull() & F.col(parent).isNotNull()).select(F.col(table).alias("t"), F.col(parent).alias("a"))
    tasks = max(edges.sparkSession.sparkContext.defaultParallelism, -(-first.count() // LINEAGE_TASK_ROWS))
    ancestors = first.select(F.col("a").alias("t")).distinct().withColumn("inner", F.lit(True))
    direct = materialize(first.repartition(tasks, "t", "a").distinct().join(ancestors, "t", "left").withColumn("d", F.lit(1)), "lineage")
    found = new = direct.filter("inner").select("t", "a", "d")
    reach = 1
    while True:
        if cycles == "error" and not new.filter("t = a").isEmpty():
            raise SpecError("lineage holds a cycle")
        low = new.filter(F.col("d") == reach).select(F.col("t").alias("m"), "a", F.col("d").alias("e"))
        if low.isEmpty():
            break
        high = found.select("t", F.col("a").alias("m"), "d")
        reached = high.join(low, "m").groupBy("t", "a").agg(F.min(F.col("d") + F.col("e")).alias("d"))
        new = materialize(reached.join(found, ["t", "a"], "left_anti"), "lineage")
        found = found.unionByName(new)
        reach *= 2
    outer = direct.filter("inner is null").select("t", "a", "d")
    above = found.select(F.col("t").alias("m"), "a", (F.col("d") + 1).alias("d"))
    behind = outer.select("t", F.col("a").alias("m")).join(above, "m").select("t", "a", "d")
    own = outer.unionByName(behind).repartition(tasks, "t", "a").groupBy("t", "a").agg(F.min("d").alias("d"))
    return found.unionByName(own).select(F.col("t").alias(table), F.col("a").alias("ancestor"), F.col("d").alias("depth"))


def _classes_by_closure(edges: DataFrame) -> DataFrame:
    """``v`` and ``root`` of the vertices of edges ``s``, ``t`` that lie on cycles, from all pairs that reach each other."""
    closure = lineage_closure(edges, "s", "t", cycles="keep").select(F.col("s").alias("v"), F.col("ancestor").alias("a"))
    back = closure.select(F.col("v").alias("a"), F.col("a").alias("v"))
    return closure.join(back, ["v", "a"], "left_semi").groupBy("v").agg(F.min("a").alias("root"))


# Rounds that together must halve the edges, or contraction has come to its end.
CONTRACTION_ROUNDS = 8


def _contracted(edges: DataFrame, number: int) -> DataFrame:
    """Edges ``s``, ``t`` after a round: vertices with no way in or no way out are gone, and some with one way in or
    out are merged into its other end, no two of them neighbours. An edge moved so names the merged vertex as ``v``."""
    rank = lambda c: F.xxhash64(c, F.lit(number))
    none = F.lit(None).cast("long")
    ends = edges.select(F.col("s").alias("v"), F.col("t").alias("to"), none.alias("by")).unionByName(
        edges.select(F.col("t").alias("v"), none.alias("to"), F.col("s").alias("by"))
    )
    top = F.max(rank(F.coalesce("to", "by")))
    seen = ends.groupBy("v").agg(*[f(c).alias(f"{n}_{c}") for c in ("to", "by") for n, f in (("lo", F.min), ("hi", F.max))], top.alias("top"))
    idle, on, back = F.expr("lo_to is null or lo_by is null"), F.expr("lo_to = hi_to"), F.expr("lo_by = hi_by")
    merged = seen.filter(idle | ((on | back) & (rank("v") > F.col("top")))).select(
        "v", on.alias("on"), F.when(~idle, F.when(on, F.col("lo_to")).otherwise(F.col("lo_by"))).alias("into")
    )
    first, second = (merged.select(*[F.col(c).alias(f"{side}_{c}") for c in merged.columns]) for side in "st")
    met = edges.join(first, F.col("s") == F.col("s_v"), "left").join(second, F.col("t") == F.col("t_v"), "left")
    # An end that is merged leaves the edge over which it was merged.
    kept = F.expr("(s_v is null or (s_into is not null and not s_on)) and (t_v is null or (t_into is not null and t_on))")
    return met.filter(kept).select(F.coalesce("s_into", "s").alias("s"), F.coalesce("t_into", "t").alias("t"), F.coalesce("s_v", "t_v").alias("v"))


def _strong_classes(edges: DataFrame) -> DataFrame:
    """``v`` and ``root`` of the vertices of edges ``s``, ``t`` (long, s <> t) that lie on cycles; ``root`` is the
    same for those that reach each other.

    Paths and trees vanish by contraction, a share of what is left in each round, so all rounds together move a few
    times the edges. What is left without vertices of one way in or out is settled by its closure. Then, last round
    first, a merged vertex joins the class of the ends of an edge moved from it, if these are of one class."""
    rounds: list[DataFrame] = []
    left, sizes = edges, [edges.count()]
    while sizes[-1] and (len(sizes) <= CONTRACTION_ROUNDS or 2 * sizes[-1] <= sizes[-1 - CONTRACTION_ROUNDS]):
        rounds.append(materialize(_contracted(left, len(rounds)), "contracted"))
        left = rounds[-1].filter("s <> t").select("s", "t")
        sizes.append(left.count())
    classes = materialize(_classes_by_closure(left), "classes") if sizes[-1] else left.selectExpr("s as v", "t as root").limit(0)
    for moved in reversed(rounds):
        of = lambda end: classes.select(F.col("v").alias(f"{end}_v"), F.col("root").alias(f"{end}_root"))
        met = moved.filter("v is not null").join(of("s"), F.col("s") == F.col("s_v"), "left").join(of("t"), F.col("t") == F.col("t_v"), "left")
        closed = met.withColumn("root", F.coalesce("s_root", "s")).filter(F.col("root") == F.coalesce("t_root", "t"))
        # The ends have no class yet where the cycle closes with this vertex: they are one vertex then.
        new = F.array(F.col("v"), F.when(F.col("s_root").isNull(), F.col("s")))
        found = closed.select(F.explode(new).alias("v"), "root").filter("v is not null").distinct()
        classes = materialize(classes.unionByName(found), "classes")
    return classes


def lineage_cycles(edges: DataFrame, table: str = "table_name", parent: str = "ancestor") -> DataFrame:
    """``cycle`` and ``table``: the tables of each cycle, which reach each other, under the least name of them.
    ``edges`` are direct dependencies or any closure of them; no closure is worked out (:func:`_strong_classes`)."""
    known = edges.filter(F.col(table).isNotNull() & F.col(parent).isNotNull()).select(F.col(table).alias("t"), F.col(parent).alias("a"))
    names = known.select("t").union(known.select("a")).distinct().select(F.col("t").alias("name"), F.monotonically_increasing_id().alias("id"))
    names = materialize(names, "names")
    number = lambda c, i: names.select(F.col("name").alias(c), F.col("id").alias(i))
    numbered = materialize(known.join(number("t", "s"), "t").join(number("a", "n"), "a").select("s", F.col("n").alias("t")), "edges")
    classes = _strong_classes(numbered.filter("s <> t"))
    own = numbered.filter("s = t").select(F.col("s").alias("v")).distinct().join(classes, "v", "left_anti")
    members = classes.unionByName(own.select("v", F.col("v").alias("root"))).join(number("name", "v"), "v")
    least = members.groupBy("root").agg(F.min("name").alias("cycle"))
    return members.join(least, "root").select("cycle", F.col("name").alias(table))
