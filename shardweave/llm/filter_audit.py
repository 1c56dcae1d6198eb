"""Audit of filters that are applied one after another, for every order of them.

Each document has a mask of the filters it fails. The masks are counted per part, and a
part's counts become a decision diagram: one level per filter, the branches ``pass`` and
``fail``, and at every node the weight (documents, good ones, toxic ones) of all below it.
An order of the filters is an order of the levels. Swapping two adjacent levels touches only
their nodes, and a walk through all permutations by adjacent swaps visits every order; in
each, the path that always passes has what every step keeps and removes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shardweave.llm.joins import bounded
from shardweave.staging import stage

WORD_GAP = r"[\x20\x09-\x0D]+"
DUPLICATE = "E"
RESULT = ("part string, filter_order string, step int, kept long, removed long, redundant long, "
          "unique_fails long, good_lost long, toxic_lost long, shapley long")

Weight = tuple[int, int, int]


def text_conditions(text: Column) -> dict[str, Column]:
    """Failure conditions of a text that is not null, by letter.

    A: under 100 words; B: fewer than 80 distinct words in 100; C: over a tenth of the code
    points are A-Z; D: one of ``#$%&*|`` is there.
    """
    words = F.filter(F.split(text, WORD_GAP), lambda w: w != "")
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    return {"A": F.size(words) < 100,
            "B": 100 * F.size(F.array_distinct(words)) < 80 * F.size(words),
            "C": 100 * capitals > 10 * F.length(text),
            "D": text.rlike(r"[#$%&*|]")}


def failure_counts(docs: DataFrame, labels: DataFrame,
                   conditions: Callable[[Column], dict[str, Column]] = text_conditions) -> tuple[DataFrame, str]:
    """(part, mask, n, good, toxic) and the filters' letters, the lowest bit of a mask first.

    The last filter fails a text that is identical to that of a smaller doc_id. It is decided
    on counts: per digest of a text only rows with the least doc_id pass, so copies meet as sums
    and a text that a third of all rows share is no hot key.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    fails = conditions(text)
    letters = "".join(fails) + DUPLICATE
    mask = sum((F.when(c, F.lit(1 << i)).otherwise(F.lit(0)) for i, c in enumerate(fails.values())), F.lit(0))
    rows = stage(docs.select(
        "doc_id", F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
        mask.alias("mask"), F.unhex(F.sha2(text, 256)).alias("digest")), "masks")

    said = stage(labels.filter("doc_id is not null").groupBy("doc_id").agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic")).filter("good or toxic"), "labels")
    # Null ids match no label; apart from the join they cannot crowd one of its partitions.
    none = F.lit(False)
    rows = rows.filter("doc_id is not null").join(bounded(said), "doc_id", "left").select(
        "doc_id", "part", "mask", "digest", F.coalesce("good", none).alias("good"),
        F.coalesce("toxic", none).alias("toxic")).unionByName(rows.filter("doc_id is null").select(
            "doc_id", "part", "mask", "digest", none.alias("good"), none.alias("toxic")))

    same = ["digest", "part", "mask", "good", "toxic"]
    copies = rows.groupBy("doc_id", *same).agg(F.count(F.lit(1)).alias("n"))  # repeated rows as one
    copies = copies.groupBy(*same).agg(
        F.sum("n").alias("n"), F.min("doc_id").alias("least"), F.min_by("n", "doc_id").alias("n_least"),
        F.coalesce(F.sum(F.when(F.col("doc_id").isNull(), F.col("n"))), F.lit(0)).alias("n_null"))
    first = F.min("least").over(Window.partitionBy("digest"))
    passing = F.col("n_null") + F.when(F.col("least") == F.col("first"), F.col("n_least")).otherwise(0)
    both = F.array(F.struct(F.col("mask").alias("mask"), passing.alias("n")),
                   F.struct((F.col("mask") + (1 << len(fails))).alias("mask"), (F.col("n") - passing).alias("n")))
    counted = copies.withColumn("first", first).select("part", "good", "toxic", F.explode(both).alias("e"))
    return counted.groupBy("part", F.col("e.mask").alias("mask")).agg(
        F.sum("e.n").alias("n"), F.sum(F.when(F.col("good"), F.col("e.n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), F.col("e.n")).otherwise(0)).alias("toxic")), letters


class Diagram:
    """Weights of failure masks as a decision diagram whose levels may be swapped.

    Node ``i`` has a pass and a fail branch, ``low[i]`` and ``high[i]``, and the weight below it;
    equal nodes of a level are one. Leaves are weights.
    """

    def __init__(self, weights: dict[int, Weight], letters: str):
        self.order = list(letters)
        self.low: list[int] = []
        self.high: list[int] = []
        self.weight: list[Weight] = []
        self.leaves: dict[Weight, int] = {}
        self.levels: list[dict[tuple[int, int], int]] = [{} for _ in letters]
        self.root = self._grow(weights, 0, 0)

    def _leaf(self, weight: Weight) -> int:
        if weight not in self.leaves:
            self.leaves[weight] = self._add(-1, -1, weight)
        return self.leaves[weight]

    def _add(self, low: int, high: int, weight: Weight) -> int:
        self.low.append(low)
        self.high.append(high)
        self.weight.append(weight)
        return len(self.weight) - 1

    def node(self, level: int, low: int, high: int) -> int:
        table = self.levels[level]
        if (low, high) not in table:
            total = tuple(a + b for a, b in zip(self.weight[low], self.weight[high]))
            table[low, high] = self._add(low, high, total)
        return table[low, high]

    def _grow(self, weights: dict[int, Weight], level: int, mask: int) -> int:
        if level == len(self.order):
            return self._leaf(weights.get(mask, (0, 0, 0)))
        return self.node(level, self._grow(weights, level + 1, mask),
                         self._grow(weights, level + 1, mask | 1 << level))

    def swap(self, level: int) -> None:
        """Exchange a level and the next. Upper nodes stay, as their functions do."""
        upper = list(self.levels[level].values())
        self.levels[level], self.levels[level + 1] = {}, {}
        for i in upper:
            a, b = self.low[i], self.high[i]
            self.low[i], self.high[i] = (self.node(level + 1, self.low[a], self.low[b]),
                                         self.node(level + 1, self.high[a], self.high[b]))
            self.levels[level][self.low[i], self.high[i]] = i
        self.order[level], self.order[level + 1] = self.order[level + 1], self.order[level]

    def all_pass(self) -> Iterator[tuple[str, Weight, Weight]]:
        """Filter, weight kept and weight removed of each step."""
        at = self.root
        for letter in self.order:
            yield letter, self.weight[self.low[at]], self.weight[self.high[at]]
            at = self.low[at]


def adjacent_swaps(n: int) -> Iterator[int]:
    """Places of the adjacent swaps that lead through all orders of ``n`` things, one each."""
    if n < 2:
        return
    down = True
    inner = adjacent_swaps(n - 1)
    while True:
        yield from (range(n - 2, -1, -1) if down else range(n - 1))
        place = next(inner, None)
        if place is None:
            return
        yield place + 1 if down else place
        down = not down


def audit_part(part: str, weights: dict[int, Weight], letters: str) -> list[tuple]:
    """Rows of one part: every order, every step."""
    diagram = Diagram(weights, letters)
    orders = [("".join(diagram.order), list(diagram.all_pass()))]
    for place in adjacent_swaps(len(letters)):
        diagram.swap(place)
        orders.append(("".join(diagram.order), list(diagram.all_pass())))
    failing, alone, share = {}, {}, dict.fromkeys(letters, 0)
    for _, steps in orders:
        failing[steps[0][0]] = steps[0][2][0]
        alone[steps[-1][0]] = steps[-1][2][0]
        for letter, _, removed in steps:
            share[letter] += removed[0]
    return [(part, order, step, kept[0], removed[0], failing[letter] - removed[0], alone[letter],
             removed[1], removed[2], share[letter])
            for order, steps in orders for step, (letter, kept, removed) in enumerate(steps, 1)]


def audit_filters(docs: DataFrame, labels: DataFrame,
                  conditions: Callable[[Column], dict[str, Column]] = text_conditions) -> DataFrame:
    """One row for each part, order of the filters and step.

    A part is a lang value; a null one is the empty string. ``kept`` counts documents left after
    the step, ``removed`` those it removes, ``redundant`` those that fail its filter but were
    removed earlier, ``unique_fails`` those that fail its filter alone, ``good_lost`` and
    ``toxic_lost`` the removed ones whose doc_id has a label quality = 1 or toxic = 1, and
    ``shapley`` what the filter removes, summed over all orders.

    ``conditions`` gives the filters by single letters; the identity filter ``E`` comes after
    them. There are as many orders as permutations, so few filters are meant.

    A null text is empty, and identical to other empty ones. Rows with a null doc_id are never
    copies, nor originals of others. Of rows that repeat text and doc_id none is a smaller one,
    so they pass or fail the identity filter together. Several labels of a doc_id count as one that
    has what any of them says; null labels say nothing. A table without rows gives none. Columns
    other than doc_id, text, lang, quality and toxic are not read, whatever their names.
    """
    counts, letters = failure_counts(docs, labels, conditions)
    schema = pa.schema([("part", pa.string()), ("filter_order", pa.string()), ("step", pa.int32()),
                        *((name, pa.int64()) for name in ("kept", "removed", "redundant", "unique_fails",
                                                          "good_lost", "toxic_lost", "shapley"))])

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        weights = {r["mask"]: (r["n"], r["good"], r["toxic"]) for r in rows}
        columns = zip(*audit_part(rows[0]["part"], weights, letters))
        return pa.table([pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema)

    return counts.groupBy("part").applyInArrow(run, RESULT)
