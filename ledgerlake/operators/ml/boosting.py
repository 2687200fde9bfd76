"""Second-order gradient boosting on histograms.

Features are cut into bins at quantiles (or at given edges).  A tree grows level
by level: one pass over the binned rows sums gradients and Hessians per (node,
feature, bin) in the tasks, one aggregate adds these up, and the splits follow
from the sums by

    gain = (GL^2 / (HL + l2) + GR^2 / (HR + l2) - G^2 / (H + l2)) / 2 - gamma,

leaf weights are ``-G / (H + l2) * rate``.  Rows without a value have a bin of
their own, which goes to the side of the greater gain.  Sums are taken in whole
numbers (``2 ** -SHIFT`` of the largest gradient), so the result does not depend
on how the rows are spread.

To the driver come the sums of a level: nodes x features x bins, bounded by the
parameters.  Rows are stored as blocks of a few thousand, each with the bins by
feature, the labels and the margins as plain bytes, in parts that follow the
rows, so a level (there are rounds x depth of them) starts few tasks and turns no
row into Arrow anew.  Margins are stored again every ``STORE_EVERY`` trees, in
between a pass works out the trees since."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ...functions.ordered import exact_quantiles, materialize
from ...session import ship_package

MAX_BINS = 32
SHIFT = 24
STORE_EVERY = 8
PART_ROWS = 1 << 18      # of a stored part
_LEAST_ROWS = 1 << 14    # below that a part costs more to start than to read
BINNED = "bins binary, y binary, margin binary"      # of a block of rows


@dataclass
class Tree:
    """Nodes in breadth order: feature (-1: leaf), last bin that goes left,
    whether missing values go left, left child (the right one follows), weight
    of a leaf and gain of a split."""
    feature: list[int] = field(default_factory=list)
    bin: list[int] = field(default_factory=list)
    missing_left: list[bool] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    weight: list[float] = field(default_factory=list)
    gain: list[float] = field(default_factory=list)

    def add(self, weight: float) -> int:
        for values, x in ((self.feature, -1), (self.bin, 0), (self.missing_left, True), (self.left, -1), (self.weight, weight), (self.gain, 0.0)):
            values.append(x)
        return len(self.feature) - 1

    def leaves(self, bins: np.ndarray, missing: np.ndarray) -> np.ndarray:
        """The node that every row of ``bins`` (a row per feature, a column per
        row of data) ends in."""
        n, width = bins.shape[1], int(missing.max()) + 1
        feature = np.array(self.feature)
        # Where a node sends each bin; a leaf sends all to itself.
        after = np.repeat(np.arange(len(feature)), width).reshape(-1, width)
        depth = np.zeros(len(feature), dtype=np.int64)
        for i in np.flatnonzero(feature >= 0):       # a node is numbered before its children
            goes_left = np.arange(width) <= self.bin[i]
            goes_left[missing[feature[i]]] = self.missing_left[i]
            after[i] = self.left[i] + ~goes_left
            depth[self.left[i]] = depth[self.left[i] + 1] = depth[i] + 1
        node, rows = np.zeros(n, dtype=np.int64), np.arange(n)
        flat, after, first = bins.ravel(), after.ravel(), np.maximum(feature, 0) * n
        for _ in range(depth.max()):
            node = after[node * width + flat[first[node] + rows]]
        return node

    def margins(self, bins: np.ndarray, missing: np.ndarray) -> np.ndarray:
        return np.array(self.weight)[self.leaves(bins, missing)]


@dataclass
class Params:
    objective: str = "logistic"        # or "squared"
    rounds: int = 100
    depth: int = 6
    rate: float = 0.1
    l2: float = 1.0
    gamma: float = 0.0
    min_child: float = 1.0             # least Hessian of a child
    base: float = 0.0                  # margin before the first tree


@dataclass
class Boosted:
    columns: list[str]
    edges: list[np.ndarray]
    params: Params
    trees: list[Tree] = field(default_factory=list)

    def importances(self) -> list[tuple[str, float]]:
        """Share of the total gain per column, largest first."""
        total = dict.fromkeys(self.columns, 0.0)
        for t in self.trees:
            for f, g in zip(t.feature, t.gain):
                if f >= 0:
                    total[self.columns[f]] += g
        whole = sum(total.values()) or 1.0
        return sorted(((c, g / whole) for c, g in total.items()), key=lambda x: (-x[1], x[0]))

    def transform(self, df: DataFrame, margin: str = "margin", prediction: str = "prediction",
                  probability: str = "probability") -> DataFrame:
        """``df`` with the margin, and the class and its probability (logistic)
        or the value (squared)."""
        ship_package(df.sparkSession)
        shared = df.sparkSession.sparkContext.broadcast(self)    # the trees: a parameter's size

        @F.pandas_udf("double")
        def run(*columns):
            import pandas as pd
            m = shared.value
            bins = np.stack([to_bins(c.to_numpy(dtype=float), e) for c, e in zip(columns, m.edges)])
            out = np.full(bins.shape[1], m.params.base)
            for t in m.trees:
                out += t.margins(bins, missing_bins(m.edges))
            return pd.Series(out)

        # Else Spark works it out anew for every column made of it.
        run = run.asNondeterministic()
        out = df.withColumn(margin, run(*[F.col(c).cast("double") for c in self.columns]))
        if self.params.objective == "squared":
            return out.withColumn(prediction, F.col(margin))
        p = 1 / (1 + F.exp(-F.col(margin)))
        return out.withColumn(probability, p).withColumn(prediction, (F.col(margin) > 0).cast("double"))


# ---------------------------------------------------------------- bins

def to_bins(x: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Bin ``b`` holds values above edge ``b - 1`` up to edge ``b``; missing
    values get the bin after the last."""
    return np.where(np.isnan(x), len(edges) + 1, np.searchsorted(edges, x, side="left")).astype(np.int64)


def missing_bins(edges: Sequence[np.ndarray]) -> np.ndarray:
    return np.array([len(e) + 1 for e in edges])


def quantile_edges(df: DataFrame, columns: Sequence[str], max_bins: int = MAX_BINS) -> list[np.ndarray]:
    """Distinct quantiles of every column (exact, so the same for any layout)."""
    probs = [i / max_bins for i in range(1, max_bins)]
    found: dict[str, set] = {c: set() for c in columns}
    for r in exact_quantiles(df, list(columns), probs).collect():
        found[r["column"]].add(r["value"])
    return [np.array(sorted(found[c])) for c in columns]


def binned_rows(df: DataFrame, columns: Sequence[str], label: str, edges: Sequence[np.ndarray], base: float) -> DataFrame:
    """Blocks of rows: their bins by feature, labels and margins at ``base``."""
    n, kind = len(edges), bin_type(edges)

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                x = [batch.column(k).to_numpy(zero_copy_only=False).astype(float) for k in range(n)]
                y = batch.column(n).to_numpy(zero_copy_only=False).astype(float)
                yield _block(np.stack([to_bins(v, e) for v, e in zip(x, edges)]).astype(kind), y, np.full(len(y), base))

    ship_package(df.sparkSession)
    return df.select(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(columns)],
                     F.col(label).cast("double").alias("y")).mapInArrow(run, BINNED)


def bin_type(edges: Sequence[np.ndarray]) -> np.dtype:
    """The smallest type that holds all bins."""
    return np.min_scalar_type(int(missing_bins(edges).max()))


def _block(bins: np.ndarray, y: np.ndarray, margin: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in (bins, y, margin)], names=["bins", "y", "margin"])


def parts_of(n: int, cores: int) -> int:
    """Parts for ``n`` rows: one per core where the rows allow."""
    return max(1, -(-n // PART_ROWS), min(cores, -(-n // _LEAST_ROWS)))


# ---------------------------------------------------------------- passes

def gradients(margin: np.ndarray, y: np.ndarray, objective: str) -> tuple[np.ndarray, np.ndarray]:
    if objective == "squared":
        return margin - y, np.ones(len(y))
    p = 1 / (1 + np.exp(-margin))
    return p - y, p * (1 - p)


def _blocks(batches, edges: Sequence[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    kind = bin_type(edges)
    for batch in batches:
        for bins, y, margin in zip(*(batch.column(k) for k in range(3))):
            yield (np.frombuffer(bins.as_buffer(), dtype=kind).reshape(len(edges), -1), np.frombuffer(y.as_buffer()),
                   np.frombuffer(margin.as_buffer()))


def histograms(binned: DataFrame, edges: Sequence[np.ndarray], params: Params, trees: Sequence[Tree], growing: Tree,
               level: Sequence[int], scale: float) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Per node of ``level`` the sums of gradients and Hessians by (feature,
    bin); ``trees`` are not yet in the stored margins."""
    missing = missing_bins(edges)
    width, n, place = int(missing.max()) + 1, len(edges), {node: k for k, node in enumerate(level)}

    def run(batches):
        total = np.zeros((2, len(level), n, width), dtype=np.int64)
        places = np.array([place.get(k, -1) for k in range(len(growing.feature))])
        for bins, y, margin in _blocks(batches, edges):
            for t in trees:
                margin = margin + t.margins(bins, missing)
            at = places[growing.leaves(bins, missing)]
            # Whole numbers below 2^53 in a block: exact in doubles.
            whole = [np.round(g / scale * (1 << SHIFT)) for g in gradients(margin, y, params.objective)]
            if (at < 0).any():
                bins, at, whole = bins[:, at >= 0], at[at >= 0], [g[at >= 0] for g in whole]
            for f in range(n):
                key = at * width + bins[f]
                for k, g in enumerate(whole):
                    total[k, :, f] += np.bincount(key, g, minlength=len(level) * width).astype(np.int64).reshape(-1, width)
        total = total.reshape(2, -1)
        hit = np.flatnonzero(total.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(hit), pa.array(total[0, hit]), pa.array(total[1, hit])], names=["k", "g", "h"])

    sums = binned.mapInArrow(run, "k long, g long, h long").groupBy("k").agg(F.sum("g"), F.sum("h"))
    out = np.zeros((2, len(level) * n * width))
    for k, g, h in sums.collect():
        out[0, k], out[1, k] = g, h
    out = (out * (scale / (1 << SHIFT))).reshape(2, len(level), n, width)
    return {node: (out[0, k], out[1, k]) for node, k in place.items()}


def split_gains(g: np.ndarray, h: np.ndarray, edges: Sequence[np.ndarray], params: Params) -> list[tuple[float, int, int, bool]]:
    """(gain, feature, bin, missing left) of every allowed split of a node whose
    sums by (feature, bin) are ``g`` and ``h``."""
    out = []
    for f, e in enumerate(edges):
        last = len(e)                       # bins 0 .. last, then the missing one
        gm, hm = g[f, last + 1], h[f, last + 1]
        gl, hl = np.cumsum(g[f, :last + 1]), np.cumsum(h[f, :last + 1])
        all_g, all_h = gl[-1] + gm, hl[-1] + hm
        for missing_left in (True, False) if hm else (True,):
            a, b = (gl[:-1] + gm, hl[:-1] + hm) if missing_left else (gl[:-1], hl[:-1])
            c, d = all_g - a, all_h - b
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = (a * a / (b + params.l2) + c * c / (d + params.l2) - all_g ** 2 / (all_h + params.l2)) / 2 - params.gamma
            ok = (b >= params.min_child) & (d >= params.min_child)
            out += [(float(gain[k]), f, int(k), missing_left) for k in np.flatnonzero(ok)]
    return out


def _leaf(g: float, h: float, params: Params) -> float:
    return float(-g / (h + params.l2) * params.rate) if h + params.l2 > 0 else 0.0


def fit(df: DataFrame, columns: Sequence[str], label: str, params: Params | None = None, max_bins: int = MAX_BINS,
        edges: Sequence[Sequence[float]] | None = None) -> Boosted:
    """Boosted trees for ``label`` (0 / 1, or a number for the squared
    objective).  Rows without a label are left out; equal gains are decided by
    the first feature, then the first bin."""
    params = params or Params()
    ship_package(df.sparkSession)
    known = df.where(F.col(label).isNotNull() & ~F.isnan(F.col(label).cast("double")))
    cuts = [np.array(e, dtype=float) for e in edges] if edges is not None else quantile_edges(known, columns, max_bins)
    model = Boosted(list(columns), cuts, params)
    missing, base = missing_bins(cuts), params.base
    n, most = known.agg(F.count(F.lit(1)), F.max(F.abs(F.col(label).cast("double")))).first()
    if not n:
        return model
    spread = known.repartition(parts_of(n, df.sparkSession.sparkContext.defaultParallelism))
    binned = materialize(binned_rows(spread, columns, label, cuts, base))
    fresh: list[Tree] = []
    for _ in range(params.rounds):
        # No gradient is above 1 (logistic); residuals stay within the labels' range (squared).
        scale = 1.0 if params.objective == "logistic" else max(2 * float(most) + abs(base), 1e-300)
        tree = Tree()
        level, first = [tree.add(0.0)], True
        for _ in range(params.depth):
            sums = histograms(binned, cuts, params, fresh, tree, level, scale)
            grown = []
            for node in level:
                g, h = sums[node]
                if first:
                    tree.weight[node] = _leaf(g[0].sum(), h[0].sum(), params)
                splits = [s for s in split_gains(g, h, cuts, params) if s[0] > 0]
                if not splits:
                    continue
                gain, f, b, missing_left = max(splits, key=lambda s: (s[0], -s[1], -s[2], s[3]))
                left = np.arange(g.shape[1]) <= b
                left[missing[f]] = missing_left
                tree.feature[node], tree.bin[node], tree.missing_left[node], tree.gain[node] = f, b, missing_left, gain
                tree.left[node] = tree.add(_leaf(g[f][left].sum(), h[f][left].sum(), params))
                tree.add(_leaf(g[f][~left].sum(), h[f][~left].sum(), params))
                grown += [tree.left[node], tree.left[node] + 1]
            level, first = grown, False
            if not level:
                break
        model.trees.append(tree)
        fresh.append(tree)
        if len(fresh) == STORE_EVERY:
            binned, fresh = materialize(_with_margins(binned, cuts, fresh)), []
    return model


def _with_margins(binned: DataFrame, edges: Sequence[np.ndarray], trees: Sequence[Tree]) -> DataFrame:
    missing = missing_bins(edges)

    def run(batches):
        for bins, y, margin in _blocks(batches, edges):
            for t in trees:
                margin = margin + t.margins(bins, missing)
            yield _block(bins, y, margin)
    return binned.mapInArrow(run, BINNED)
