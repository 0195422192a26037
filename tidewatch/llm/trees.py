"""Binned decision trees, grown by Spark aggregations over a bounded sample or over all rows.

The rows are written once with every feature cut into bins; of all rows
(``prepare_counted``) equal ones become one with its count. Each level of a
tree is one job that adds up a histogram by node, feature and bin. A tree is a
nested tuple ``(feature, bin, low, high)`` with numbers as leaves; it becomes
a conditional Spark expression over bins (fitting) or raw values (scoring).
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.operators.joins import materialise

N_CUTS = 15
# Counted rows add up gradients as whole numbers of this unit, so that sums do not depend on the order of tasks.
_UNIT = 1 << 30
Getter = Callable[[str], Column]


@dataclass
class Model:
    """Trees over ``features`` with their cut points; ``base`` and ``rate`` scale the sum."""

    features: list[str]
    cuts: dict[str, list[float]]
    trees: list = field(default_factory=list)
    base: float = 0.0
    rate: float = 1.0
    logistic: bool = True

    def score(self, of: Getter) -> Column:
        """Probability from the raw feature values that ``of`` names."""
        return self._link(lambda f, b: of(f) > self.cuts[f][b])

    def binned_score(self) -> Column:
        return self._link(lambda f, b: F.col(f"_b_{f}") > b)

    def _link(self, above) -> Column:
        if not self.trees:
            total = F.lit(0.0)
        else:
            total = sum((_value(t, above) for t in self.trees[1:]), _value(self.trees[0], above))
        if self.logistic:
            return 1 / (1 + F.exp(-(total * self.rate + self.base)))
        return total / max(1, len(self.trees))


def _value(tree, above) -> Column:
    if not isinstance(tree, tuple):
        return F.lit(float(tree))
    f, b, low, high = tree
    return F.when(above(f, b), _value(high, above)).otherwise(_value(low, above))


def prepare(sample: DataFrame, features: list[str], keep: list[str], name: str) -> tuple[DataFrame, dict[str, list[float]]]:
    """(written table with a bin column per feature, cut points); ``sample`` is bounded."""
    table = materialise(sample.select(*keep, *(F.col(f).cast("double").alias(f) for f in features)), f"{name}-sample").coalesce(1)
    row = table.agg(*(F.percentile_approx(f, [i / (N_CUTS + 1) for i in range(1, N_CUTS + 1)], 2000).alias(f)
                      for f in features), *(F.array(F.min(f), F.max(f)).alias(f"_r_{f}") for f in features)).first()
    cuts = {f: _cuts({float(x) for x in (row[f] or [])}, *(row[f"_r_{f}"] or (None, None))) for f in features}
    return materialise(table.select(*keep, *_bins(features, cuts)), f"{name}-bins").coalesce(1), cuts


def _cuts(values: set[float], low: float | None, high: float | None) -> list[float]:
    if low is not None and high > low:
        values = values | {float(low), (float(low) + float(high)) / 2}
    return sorted(v for v in values if high is not None and v < high)


def _bins(features: list[str], cuts: dict[str, list[float]]) -> list[Column]:
    return [sum(((F.col(f) > c).cast("int") for c in cuts[f]), F.lit(0)).alias(f"_b_{f}") for f in features]


def prepare_counted(rows: DataFrame, features: list[str], keep: list[str], name: str) -> tuple[DataFrame, dict[str, list[float]]]:
    """As ``prepare`` for any number of rows: those that are equal in ``keep`` and bins are one, ``_n`` is their number.

    Cut points are exact percentiles, from the counts of each feature's values.
    """
    table = materialise(rows.select(*keep, *(F.col(f).cast("double").alias(f) for f in features)), f"{name}-rows")
    cells = table.select(F.inline(F.array(*(F.struct(F.lit(k).alias("f"), F.col(f).alias("v")) for k, f in enumerate(features))))).groupBy("f", "v").agg(
        F.count(F.lit(1)).alias("n"))
    of_f = Window.partitionBy("f")
    ranked = cells.withColumn("to", F.sum("n").over(of_f.orderBy("v"))).withColumn("all", F.sum("n").over(of_f))
    is_cut = F.exists(F.sequence(F.lit(1), F.lit(N_CUTS)), lambda i: F.ceil(i * F.col("all") / (N_CUTS + 1)).between(F.col("to") - F.col("n") + 1, F.col("to")))
    ends = {"low": F.col("to") == F.col("n"), "high": F.col("to") == F.col("all")}
    found = ranked.select("f", "v", is_cut.alias("cut"), *(c.alias(k) for k, c in ends.items())).where("cut or low or high").collect()
    cuts = {}
    for k, f in enumerate(features):
        mine = [r for r in found if r["f"] == k]
        low, high = (next((r["v"] for r in mine if r[end]), None) for end in ends)
        cuts[f] = _cuts({r["v"] for r in mine if r["cut"]}, low, high)
    binned = table.select(*keep, *_bins(features, cuts))
    return materialise(binned.groupBy(*binned.columns).agg(F.count(F.lit(1)).alias("_n")), f"{name}-bins"), cuts


def _histogram(rows: DataFrame, features: list[str], extra: list[str], unit: int = 1) -> list:
    """Sums of ``_g`` and ``_h``, given in ``unit``ths, by ``extra``, feature and bin: a bounded result."""
    cells = F.explode(F.array(*(F.struct(F.lit(k).alias("f"), F.col(f"_b_{f}").alias("b")) for k, f in enumerate(features))))
    return (rows.select(*extra, "_g", "_h", cells.alias("x")).groupBy(*extra, "x.f", "x.b")
            .agg((F.sum("_g") / unit).alias("g"), (F.sum("_h") / unit).alias("h")).collect())


def _best(cells: list, features: list[str], cuts: dict, gain, least: float, allowed=None):
    """Best split of one node: (gain, feature, bin, (g, h) low, (g, h) high)."""
    total_g = sum(r["g"] for r in cells if r["f"] == 0)
    total_h = sum(r["h"] for r in cells if r["f"] == 0)
    best = None
    for k, f in enumerate(features):
        if allowed is not None and k not in allowed:
            continue
        at = {r["b"]: (r["g"], r["h"]) for r in cells if r["f"] == k}
        g = h = 0.0
        for b in range(len(cuts[f])):
            g += at.get(b, (0.0, 0.0))[0]
            h += at.get(b, (0.0, 0.0))[1]
            if h >= least and total_h - h >= least:
                won = gain(g, h) + gain(total_g - g, total_h - h) - gain(total_g, total_h)
                if won > 1e-6 and (best is None or won > best[0]):
                    best = (won, f, b, (g, h), (total_g - g, total_h - h))
    return best


def _grow(histogram, split, leaf, depth: int):
    """Level by level: ``histogram(node column)`` gives the cells by node."""
    nodes: dict[int, tuple] = {}
    values: dict[int, float] = {}
    open_nodes = [1]
    for _ in range(depth):
        def at(n: int, above) -> Column:
            if n in nodes:
                f, b = nodes[n]
                return F.when(above(f, b), at(2 * n + 1, above)).otherwise(at(2 * n, above))
            return F.lit(n)

        cells: dict[int, list] = {}
        for r in histogram(at(1, lambda f, b: F.col(f"_b_{f}") > b)):
            cells.setdefault(r["node"], []).append(r)
        nxt = []
        for n in open_nodes:
            found = split(cells.get(n, []))
            if found is None:
                if n not in values and cells.get(n):
                    values[n] = leaf(sum(r["g"] for r in cells[n] if r["f"] == 0), sum(r["h"] for r in cells[n] if r["f"] == 0))
                continue
            _, f, b, low, high = found
            nodes[n] = (f, b)
            values[2 * n], values[2 * n + 1] = leaf(*low), leaf(*high)
            nxt += [2 * n, 2 * n + 1]
        open_nodes = nxt
        if not nxt:
            break

    def build(n: int):
        return (*nodes[n], build(2 * n), build(2 * n + 1)) if n in nodes else values.get(n, 0.0)

    return build(1)


def fit_boosted(rows: DataFrame, features: list[str], cuts: dict, label: str = "_y", rounds: int = 10, depth: int = 3,
                rate: float = 0.4, ridge: float = 1.0, counted: bool = False) -> Model | None:
    """Gradient boosting on the logistic loss; None without both classes. ``counted`` rows stand for ``_n`` rows each."""
    times = ["_n"] if counted else []
    n, p = rows.agg(*((F.sum("_n"), F.sum(F.col("_n") * F.col(label))) if counted else (F.count(F.lit(1)), F.sum(label)))).first()
    if not n or not p or p == n:
        return None
    model = Model(features, cuts, [], math.log(p / (n - p)), rate)
    binned = [F.col(f"_b_{f}") for f in features]
    now = rows.select(label, *times, *binned, F.lit(model.base).alias("_raw"))
    total = (lambda c: F.round(c * _UNIT).cast("long") * F.col("_n")) if counted else (lambda c: c)
    for _ in range(rounds):
        if model.trees:  # the sum so far is written, so each job holds one tree only
            now = now.withColumn("_raw", F.col("_raw") + rate * _value(model.trees[-1], lambda f, b: F.col(f"_b_{f}") > b))
        prob = 1 / (1 + F.exp(-F.col("_raw")))
        now = materialise(now.select(label, *times, *binned, "_raw", total(F.col(label) - prob).alias("_g"), total(prob * (1 - prob)).alias("_h")), "boosting")
        now = now if counted else now.coalesce(1)
        tree = _grow(lambda node: _histogram(now.withColumn("node", node), features, ["node"], _UNIT if counted else 1),
                     lambda cells: _best(cells, features, cuts, lambda g, h: g * g / (h + ridge), 1e-3),
                     lambda g, h: g / (h + ridge), depth)
        model.trees.append(tree)
    return model


def fit_forest(rows: DataFrame, features: list[str], cuts: dict, label: str = "_y", key: str = "_row", trees: int = 12,
               depth: int = 4, least: float = 2.0) -> Model | None:
    """Random forest of probability trees; bootstrap counts come from a hash of ``key``."""
    n, p = rows.agg(F.count(F.lit(1)), F.sum(label)).first()
    if not n or not p or p == n:
        return None
    model = Model(features, cuts, [], logistic=False)
    take = max(2, round(math.sqrt(len(features))) + 1)

    def gini(g: float, h: float) -> float:  # g positives of h: less impurity is more
        return (g * g + (h - g) * (h - g)) / h if h else 0.0

    for t in range(trees):
        u = F.pmod(F.xxhash64(F.col(key), F.lit(t)), F.lit(10_000))
        times = sum(((u >= c).cast("int") for c in (3679, 7358, 9197, 9810, 9963)), F.lit(0))  # Poisson(1)
        now = rows.withColumn("_h", times).where("_h > 0").withColumn("_g", F.col("_h") * F.col(label))
        calls = iter(range(1 << 20))

        def split(cells, t=t, calls=calls):
            c = next(calls)
            allowed = sorted(range(len(features)), key=lambda k: hash((t * 7919 + c * 104729 + k * 1299709) % 1000003))[:take]
            return _best(cells, features, cuts, gini, least, allowed)

        model.trees.append(_grow(lambda node: _histogram(now.withColumn("node", node), features, ["node"]), split,
                                 lambda g, h: (g + 0.5) / (h + 1.0), depth))
    return model
