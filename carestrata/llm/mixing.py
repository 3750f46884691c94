"""Sources mixed to target weights: a min-cost flow over membership patterns."""

from __future__ import annotations

from dataclasses import dataclass
from heapq import heappop, heappush

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from carestrata.runtime import broadcast_when_small, materialise

#: Weights of the sources in the order of their names, repeating.
WEIGHTS = (5, 2, 1)
#: Hex digits of a key that name its cell, round by round.
_DIGITS = (2, 4, 6)


@dataclass
class _Edge:
    to: int
    room: int
    cost: int
    back: int


def min_cost_flow(capacity: dict, members: dict, quota: dict, epochs: int) -> dict:
    """Units taken from each pattern, so that the quotas are met at the least cost.

    A pattern gives its capacity once for nothing and again at a cost that rises by
    one per epoch, at most ``epochs`` times in all; its units may serve any source
    it belongs to. Flow is sent along cheapest paths until none is left.
    """
    patterns, sources = list(capacity), list(quota)
    start, end = 0, 1
    place = {("p", p): i + 2 for i, p in enumerate(patterns)}
    place |= {("s", s): i + 2 + len(patterns) for i, s in enumerate(sources)}
    graph: list[list[_Edge]] = [[] for _ in range(len(place) + 2)]

    def link(a: int, b: int, room: int, cost: int) -> None:
        graph[a].append(_Edge(b, room, cost, len(graph[b])))
        graph[b].append(_Edge(a, 0, -cost, len(graph[a]) - 1))

    for p in patterns:
        for epoch in range(epochs):
            link(start, place["p", p], capacity[p], epoch)
        for s in members[p]:
            if s in quota:
                link(place["p", p], place["s", s], epochs * capacity[p], 0)
    for s in sources:
        link(place["s", s], end, quota[s], 0)
    height = [0] * len(graph)
    while True:
        cost = [float("inf")] * len(graph)
        via: list[tuple[int, int] | None] = [None] * len(graph)
        cost[start] = 0
        heap = [(0, start)]
        while heap:
            c, a = heappop(heap)
            if c > cost[a]:
                continue
            for i, e in enumerate(graph[a]):
                step = c + e.cost + height[a] - height[e.to]
                if e.room > 0 and step < cost[e.to]:
                    cost[e.to], via[e.to] = step, (a, i)
                    heappush(heap, (step, e.to))
        if via[end] is None:
            break
        reached = max(c for c in cost if c < float("inf"))
        height = [h + min(c, reached) for h, c in zip(height, cost, strict=True)]
        path, at = [], end
        while at != start:
            a, i = via[at]
            path.append(graph[a][i])
            at = a
        flow = min(e.room for e in path)
        for e in path:
            e.room -= flow
            graph[e.to][e.back].room += flow
    return {p: sum(e.room for e in graph[place["p", p]] if e.to == start) for p in patterns}


def capped_targets(sizes: list[int], total: float, most: float) -> list[float]:
    """Targets by :data:`WEIGHTS` that share ``total``, none above ``most`` times its source's size.

    What exceeds that is shared out again by weight among the others.
    """
    weight = [WEIGHTS[i % len(WEIGHTS)] for i in range(len(sizes))]
    capped: set[int] = set()
    while True:
        rest = total - sum(most * sizes[i] for i in capped)
        open_weight = sum(w for i, w in enumerate(weight) if i not in capped)
        targets = [most * sizes[i] if i in capped else rest * w / open_weight for i, w in enumerate(weight)]
        over = {i for i in range(len(sizes)) if i not in capped and targets[i] > most * sizes[i]}
        if not over:
            return targets
        capped |= over
        if len(capped) == len(sizes):
            return [most * s for s in sizes]


def word_count(text: Column) -> Column:
    """Runs of characters other than ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def selection_key(id_col: str, text_col: str, seed: str) -> Column:
    """A seeded order of documents: 16 hex digits that depend on id and text."""
    parts = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (id_col, text_col))
    return F.substring(F.md5(F.concat_ws(":", F.lit(seed), *parts).cast("binary")), 1, 16)


def measured(docs: DataFrame, source_col: str = "source", id_col: str = "doc_id", text_col: str = "text", seed: str = "mix") -> DataFrame:
    """The documents with their ``_source``, ``_size`` in words and ``_key``.

    A source column may hold one name or an array of them: then ``_source`` is the
    membership pattern and ``_members`` its names; null and empty arrays are alike.
    """
    source = F.col(source_col)
    if isinstance(docs.schema[source_col].dataType, ArrayType):
        members = F.array_sort(F.array_distinct(F.array_compact(F.coalesce(source.cast("array<string>"), F.array().cast("array<string>")))))
        docs = docs.withColumn("_members", members)
        source = F.when(F.size("_members") > 0, F.to_json("_members"))
    return docs.withColumns(
        {"_source": source.cast("string"), "_size": word_count(F.col(text_col)), "_key": selection_key(id_col, text_col, seed)}
    )


def mixing_plan(units: DataFrame, share: float = 1.5, epochs: int = 2) -> DataFrame:
    """One row per membership pattern: what every document of it gives to the mix.

    ``units`` has ``_source``, ``_size``, ``_key`` and, where sources overlap,
    ``_members``. Columns of the plan: _source,
    _source_size, _target, _times (whole passes), _edge (the key up to which documents
    are taken once more) and _edge_share (what those at the edge give).

    A document of one source is a pattern of one member, whose size and target are the
    source's; a pattern of several has the words it holds and those routed through it.
    Only sums per pattern reach the driver. The edge is found by one aggregate for each
    of ``_DIGITS``, over the first digits of the keys within the last one's cell: a
    pattern has at most 256 cells in any of them, so no task ranks its documents.
    """
    spark = units.sparkSession
    overlapping = "_members" in units.columns
    members = [F.first("_members").alias("m")] if overlapping else []
    sums = units.groupBy("_source").agg(F.sum("_size").alias("n"), *members).collect()
    sums.sort(key=lambda r: (r["_source"] is None, r["_source"] or ""))
    belongs = {i: (list(r["m"]) or [None]) if overlapping else [r["_source"]] for i, r in enumerate(sums)}
    capacity = {i: r["n"] for i, r in enumerate(sums)}
    sources = sorted({s for names in belongs.values() for s in names}, key=lambda s: (s is None, s or ""))
    size = {s: sum(capacity[i] for i in capacity if s in belongs[i]) for s in sources}
    shares = capped_targets([size[s] for s in sources], share * sum(capacity.values()), float(epochs))
    target = dict(zip(sources, shares, strict=True))
    taken = min_cost_flow(capacity, belongs, {s: round(t) for s, t in target.items()}, epochs)
    rows = []
    for i, r in enumerate(sums):
        times, again = divmod(taken[i], capacity[i]) if capacity[i] else (0, 0)
        alone = len(belongs[i]) == 1
        known = (size[belongs[i][0]], target[belongs[i][0]]) if alone else (capacity[i], taken[i])
        rows.append((r["_source"], known[0], float(known[1]), times, again))
    plan = spark.createDataFrame(rows, "_source string, source_size long, target double, times long, again long")

    def cell(frame: DataFrame, digits: Column, left: str) -> DataFrame:
        """The cell in which the running sum of sizes passes what is ``left``."""
        sums = frame.groupBy("_source", left, digits.alias("cell")).agg(F.sum("_size").alias("n"), F.count("*").alias("rows"))
        upto = F.sum("n").over(Window.partitionBy("_source").orderBy("cell"))
        found = sums.withColumn("upto", upto).where((F.col("upto") >= F.col(left)) & (F.col("upto") - F.col("n") < F.col(left)))
        return found.select("_source", "cell", "n", "rows", (F.col(left) - F.col("upto") + F.col("n")).alias("rest"))

    def within(found: DataFrame, digits: Column) -> DataFrame:
        narrow = broadcast_when_small(found.select(F.col("_source").alias("_s"), "cell", "rest"))
        return units.join(narrow, F.col("_source").eqNullSafe(F.col("_s")) & (digits == F.col("cell")))

    wanted = broadcast_when_small(plan.where("again > 0").select(F.col("_source").alias("_s"), "again"))
    found = cell(units.join(wanted, F.col("_source").eqNullSafe(F.col("_s"))), F.substring("_key", 1, _DIGITS[0]), "again")
    for digits, finer in zip(_DIGITS, _DIGITS[1:], strict=False):
        found = cell(within(materialise(found, "mix-cell"), F.substring("_key", 1, digits)), F.substring("_key", 1, finer), "rest")
    last = cell(within(materialise(found, "mix-cell"), F.substring("_key", 1, _DIGITS[-1])), F.col("_key"), "rest")
    edge = materialise(
        last.select(F.col("_source").alias("_s"), F.col("cell").alias("edge"), F.floor(F.col("rest") / F.col("rows")).alias("edge_share")), "mix-edge"
    )
    joined = plan.join(edge, F.col("_source").eqNullSafe(F.col("_s")), "left")
    return joined.select("_source", *(F.col(c).alias(f"_{c}") for c in ("source_size", "target", "times", "edge", "edge_share")))


def with_taken(units: DataFrame, plan: DataFrame) -> DataFrame:
    """``units`` with _source_size, _target and _taken (words, repeats counted)."""
    plan = broadcast_when_small(materialise(plan, "mix-plan").withColumnRenamed("_source", "_s"))
    again = (
        F.when(F.col("_key") < F.col("_edge"), F.col("_size"))
        .when(F.col("_key") == F.col("_edge"), F.least("_size", "_edge_share"))
        .otherwise(F.lit(0))
    )
    done = units.join(plan, F.col("_source").eqNullSafe(F.col("_s"))).withColumn("_taken", F.col("_times") * F.col("_size") + again)
    return done.drop("_s", "_times", "_edge", "_edge_share")


def mixed(docs: DataFrame, share: float = 1.5, epochs: int = 2, source_col: str = "source", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, size, source_size, target, taken) for every document.

    Sources in the order of their code points, null last, weigh 5, 2, 1, repeating,
    and share ``share`` times all words; no target exceeds ``epochs`` times its
    source. Whole passes come first; the rest is taken in a seeded order that depends
    on id and text only, the last document in part. Repeats of one row (same id and
    text) share what is left at the edge equally.

    A null text counts 0 words; null sources are a source of their own; null ids are
    ordered by their text. An empty table gives no rows. Other columns are not read.
    """
    units = measured(docs.select(id_col, text_col, source_col), source_col, id_col, text_col)
    more = [c for c in ("_members",) if c in units.columns]
    units = materialise(units.select(F.col(id_col).cast("long").alias("doc_id"), "_source", "_size", "_key", *more), "mix-units")
    done = with_taken(units, mixing_plan(units, share, epochs))
    return done.select("doc_id", *(F.col(f"_{c}").alias(c) for c in ("size", "source_size", "target", "taken")))
