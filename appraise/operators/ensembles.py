"""Tree ensembles whose parts stay open: boosting that goes on where it stopped, forests scored at every
size in one scan, and bags that any task can derive again.

Every tree is an MLlib fit. What MLlib's ensembles keep closed is done around them: the margin a boosted model has
reached is a column of a written table, so the next block of rounds starts from it and no round is fitted twice; a
forest's running mean over its trees gives the error of every smaller forest; and a row's weight in a tree's bootstrap
sample is a keyed hash of (tree, row), so out-of-bag rows need neither a stored table nor a join.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from appraise.functions.hashing import keyed_hash
from appraise.operators.sampling import shuffle_column
from appraise.sources import io

PARALLEL_FITS = 4
#: Rows that numpy walks through a forest at once.
CHUNK = 2048


class Tree:
    """A fitted regression tree as arrays: split column (-1 in a leaf), threshold, left and right child, value."""

    def __init__(self, feature, threshold, left, right, value):
        self.feature, self.threshold, self.left, self.right, self.value = feature, threshold, left, right, value

    @classmethod
    def of(cls, model) -> Tree:
        """From MLlib's printed tree (``toDebugString``), whose numbers are exact."""
        feature, threshold, left, right, value, stack = [], [], [], [], [], []

        def add(f, t, v):
            at = len(feature)
            feature.append(f), threshold.append(t), left.append(at), right.append(at), value.append(v)
            if stack:
                parent, side = stack.pop()
                (left if side == "If" else right)[parent] = at
            return at

        for line in model.toDebugString.splitlines():
            line = line.strip()
            if split := re.match(r"(If|Else) \(feature (\d+) (?:<=|>) (\S+)\)", line):
                side, f, t = split.groups()
                if side == "If":
                    node = add(int(f), float(t), 0.0)
                    stack += [(node, "Else"), (node, "If")]
            elif line.startswith("Predict:"):
                add(-1, 0.0, float(line.split(":")[1]))
            elif "feature" in line and " in {" in line:
                raise ValueError("trees over categorical columns are not handled")
        return cls(np.array(feature), np.array(threshold), np.array(left), np.array(right), np.array(value))

    def predict(self, x: np.ndarray) -> np.ndarray:
        at, rows = np.zeros(len(x), np.int64), np.arange(len(x))
        while True:
            inner = self.feature[at] >= 0
            if not inner.any():
                return self.value[at]
            below = x[rows, np.maximum(self.feature[at], 0)] <= self.threshold[at]
            at = np.where(inner, np.where(below, self.left[at], self.right[at]), at)

    def column(self, features: Sequence[str], at: int = 0) -> Column:
        """The tree as an expression, for trees of a few leaves."""
        if self.feature[at] < 0:
            return F.lit(float(self.value[at]))
        low = F.col(features[self.feature[at]]).cast("double") <= float(self.threshold[at])
        return F.when(low, self.column(features, self.left[at])).otherwise(self.column(features, self.right[at]))

    def on(self, columns: Sequence[int]) -> Tree:
        """The same tree where it was fitted on a slice of the columns."""
        whole = np.append(np.asarray(columns), -1)
        return Tree(whole[self.feature], self.threshold, self.left, self.right, self.value)


def _matrix(batch: pa.RecordBatch, features: Sequence[str]) -> np.ndarray:
    return np.column_stack([batch.column(c).cast(pa.float64()).to_numpy(zero_copy_only=False) for c in features])


# ---- boosting in blocks ----------------------------------------------------------------------

@dataclass
class Boosted:
    """Boosted models side by side, one for each held-out fold (or a single one on all rows)."""
    features: Sequence[str]
    step: float
    base: float
    trees: list[list[Tree]]
    gains: list[np.ndarray]
    table: DataFrame = field(repr=False)  # the rows with a margin column for each model
    curve: list = field(default_factory=list)  # (train errors, test errors) of each round, by model
    levels: list[np.ndarray] | None = None  # the columns' upper edges, where trees are fitted on cells

    @property
    def rounds(self) -> int:
        return len(self.trees[0])

    def predict(self, df: DataFrame, out_col: str = "prediction", model: int = 0, rounds: int | None = None) -> DataFrame:
        """``df`` with the model's value after ``rounds`` rounds (all by default), one Arrow scan."""
        trees, features, step, base = self.trees[model][:rounds], list(self.features), self.step, self.base
        schema = T.StructType([*df.schema.fields, T.StructField(out_col, T.DoubleType())])

        def run(batches):
            for batch in batches:
                x, total = _matrix(batch, features), np.full(batch.num_rows, base)
                for t in trees:
                    total += step * t.predict(x)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(total)], [*batch.schema.names, out_col])

        return df.mapInArrow(run, schema)


def _drawn(salt: str, names: Sequence[str], share: float) -> list[int]:
    """The columns drawn for a tree: ceil(share of them), smallest SHA-256 of salt and name."""
    import hashlib
    order = sorted(range(len(names)), key=lambda i: hashlib.sha256(f"{salt}:{names[i]}".encode()).digest())
    return sorted(order[:max(1, math.ceil(share * len(names)))])


#: A column's levels, as MLlib's maxBins.
LEVELS = 32
#: Cells that a task takes.
CELLS = 50_000
#: Rounds whose sums are written at once.
AT_ONCE = 20


def column_levels(table: DataFrame, names: Sequence[str], at_most: int = LEVELS) -> list[np.ndarray]:
    """For each column the upper edges of its levels: its values, or quantiles where it has more than ``at_most``."""
    edges, many = [], []
    for c in names:
        few = [r[0] for r in table.select(F.col(c).cast("double")).distinct().limit(at_most + 1).collect()]
        if any(v is None or math.isnan(v) for v in few):
            raise ValueError(f"column {c} has missing cells")
        edges.append(np.array(sorted(few)))
        many += [c] if len(few) > at_most else []
    if many:
        cuts = table.select(*[F.col(c).cast("double").alias(c) for c in many]).approxQuantile(many, [(i + 1) / at_most for i in range(at_most)], 0.001)
        for c, found in zip(many, cuts):
            edges[list(names).index(c)] = np.array(sorted(set(found)))
    return edges


def _level(c: str, edges: np.ndarray) -> Column:
    """The number of the first edge that a cell does not exceed, the last level's else."""
    x = F.col(c).cast("double")
    out = F.when(x.isNull() | F.isnan(x), F.raise_error(F.lit(f"column {c} has missing cells")).cast("int"))
    for i, e in enumerate(edges[:-1]):
        out = out.when(x <= float(e), i)
    return out.otherwise(max(len(edges) - 1, 0)).cast("byte")


def _fit_cells(cells: DataFrame, n: int, min_rows: int, depth: int, seed: int):
    """A tree on rows of equal cells: their mean weighted by their number. A leaf's least rows are a share of the weight."""
    room = n >= 2 * min_rows  # otherwise no split leaves ``min_rows`` on both sides
    return DecisionTreeRegressor(labelCol="_y", featuresCol="_x", weightCol="_n", maxDepth=depth if room else 0, minInstancesPerNode=1,
                                 minWeightFractionPerNode=max(min_rows - 0.5, 0.0) / n if room else 0.0, seed=seed).fit(cells)


def boost(frame: DataFrame, features: Sequence[str], label: str, id_col: str, *, rounds: int, step: float, patience: int | None = None, folds: int = 0,
          depth: int = 2, min_rows: int = 10, row_share: float = 1.0, column_share: float = 1.0, base: float = 0.5, block: int = 20,
          seed: int = 2016, begun: Boosted | None = None, cells_over: int = 1 << 20) -> Boosted:
    """Boosting on squared error. Each round fits one tree to what the margin leaves of the label, on rows and columns
    drawn for that round (keyed hashes), and adds ``step`` times its value. After ``block`` rounds the margins are
    written, and one scan gives the mean absolute error after every round of the block on the rows of the model and
    on its held-out fold. With ``folds``, model k leaves out the rows of ``fold`` k and the rounds end once the mean held-out error has not
    fallen for ``patience`` rounds. ``begun`` goes on from an earlier result with more rounds; none of its rounds is fitted again.

    A table of more than ``cells_over`` rows has its columns cut to ``LEVELS`` levels once, and a round reads it once for all models: rows with the
    same levels of the drawn columns (and the same fold) are summed, and each model's tree is fitted on these cells, weighted by
    their rows. Squared error sees no difference; a smaller table's trees choose their own cuts from the rows. Where there may be more than
    ``cells.MLLIB_CELLS`` cells, tasks grow the trees of ``AT_ONCE`` rounds (``cells.grow_rounds``), and the table is read once for all of these."""
    from appraise.operators import cells as K  # which needs this module
    names, models = list(features), max(folds, 1)
    margins = [f"_margin{k}" for k in range(models)]
    if begun is None:
        kept = frame.select(id_col, label, *names, *(["fold"] if folds else []), *[F.lit(float(base)).alias(m) for m in margins])
        begun = Boosted(names, step, base, [[] for _ in range(models)], [np.zeros(len(names)) for _ in range(models)], io.checkpoint_table(kept, "boost"))
    made = begun
    if made.levels is None and made.table.count() > cells_over:
        made.levels = column_levels(made.table, names)
        made.table = io.checkpoint_table(made.table.withColumns({f"_level{i}": _level(c, e) for i, (c, e) in enumerate(zip(names, made.levels))}), "boost")
    many = made.levels is not None and len(names) <= 9 and K.MLLIB_CELLS < (models + 1) * math.prod(len(e) for e in made.levels)

    def stopped() -> bool:
        test = [np.mean(r[1]) for r in made.curve]
        return bool(folds and patience and test and len(test) - 1 - int(np.argmin(test)) >= patience)

    while made.rounds < rounds and not stopped():
        table, first = made.table, made.rounds
        count = min(block, rounds - first, AT_ONCE if many else rounds)

        def grow(k, table=table, first=first, count=count):
            margin, trees, gain = F.col(margins[k]), [], np.zeros(len(names))
            for r in range(first, first + count):
                drawn = _drawn(f"{seed}:{r}", names, column_share)
                rows = table.where(F.col("fold") != k) if folds else table
                if row_share < 1:
                    rows = rows.where(keyed_hash(f"boost{seed}:{r}", id_col) < int(row_share * (1 << 60)))
                rows = VectorAssembler(inputCols=[names[i] for i in drawn], outputCol="_x", handleInvalid="keep").transform(
                    rows.select(*[F.col(names[i]).cast("double").alias(names[i]) for i in drawn], (F.col(label) - margin).alias("_y")))
                fit = DecisionTreeRegressor(labelCol="_y", featuresCol="_x", maxDepth=depth, minInstancesPerNode=min_rows, seed=seed).fit(rows)
                tree = Tree.of(fit).on(drawn)
                gain[drawn] += fit.featureImportances.toArray()
                trees.append(tree)
                margin = margin + F.lit(float(step)) * tree.column(names)
            return trees, gain, margin

        def grow_on_cells(table=table, first=first, count=count):
            margin, trees, gain = [F.col(m) for m in margins], [[] for _ in range(models)], [np.zeros(len(names)) for _ in range(models)]
            for r in range(first, first + count):
                drawn = _drawn(f"{seed}:{r}", names, column_share)
                rows = table if row_share == 1 else table.where(keyed_hash(f"boost{seed}:{r}", id_col) < int(row_share * (1 << 60)))
                key = [f"_level{i}" for i in drawn]
                fold = F.col("fold") if folds else F.lit(-1)
                cells = rows.groupBy(*key, fold.alias("_fold")).agg(
                    F.count("*").cast("double").alias("_n"), *[F.avg(F.col(label) - m).alias(f"_y{k}") for k, m in enumerate(margin)])
                most = (models + 1) * math.prod(len(made.levels[i]) for i in drawn)
                if most < 10 * CELLS:  # a few tasks hold them all
                    cells = cells.coalesce(1 + most // CELLS)
                cells = VectorAssembler(inputCols=key, outputCol="_x").transform(cells).drop(*key).persist()
                sizes = {x["_fold"]: x["n"] for x in cells.groupBy("_fold").agg(F.sum("_n").alias("n")).collect()}

                def fit(k, cells=cells, sizes=sizes):
                    n = int(sum(c for f, c in sizes.items() if f is not None and f != k))
                    return _fit_cells(cells.where(F.col("_fold") != k).select("_x", "_n", F.col(f"_y{k}").alias("_y")), n, min_rows, depth, seed)

                with ThreadPoolExecutor(max_workers=PARALLEL_FITS) as pool:
                    fits = list(pool.map(fit, range(models)))
                cells.unpersist()
                for k, made_tree in enumerate(fits):
                    tree = Tree.of(made_tree).on(drawn)
                    for at in np.flatnonzero(tree.feature >= 0):  # a cut between two levels is the lower one's edge
                        tree.threshold[at] = made.levels[tree.feature[at]][int(tree.threshold[at])]
                    gain[k][drawn] += made_tree.featureImportances.toArray()
                    trees[k].append(tree)
                    margin[k] = margin[k] + F.lit(float(step)) * tree.column(names)
            return list(zip(trees, gain, margin))

        def grow_in_tasks(table=table, first=first, count=count):
            grown = K.grow_rounds(table, label, id_col, made.levels, first, count, models, folds, step, row_share, lambda r: _drawn(f"{seed}:{r}", names, column_share),
                                  depth, min_rows, seed)
            return grown and [(trees, gain, sum((F.lit(float(step)) * t.column(names) for t in trees), F.col(m))) for (trees, gain), m in zip(grown, margins)]

        grown = grow_in_tasks() if many else None
        many = bool(grown)
        if grown is None and made.levels is not None:
            grown = grow_on_cells()
        elif grown is None:
            with ThreadPoolExecutor(max_workers=PARALLEL_FITS) as pool:
                grown = list(pool.map(grow, range(models)))
        made.curve += _block_errors(table, names, label, margins, [g[0] for g in grown], step, bool(folds))
        made.table = io.checkpoint_table(table.withColumns({m: g[2] for m, g in zip(margins, grown)}), "boost")
        for k, (trees, gain, _) in enumerate(grown):
            made.trees[k] += trees
            made.gains[k] = made.gains[k] + gain
    return made


def _block_errors(table: DataFrame, names, label: str, margins, trees, step: float, folds: bool) -> list:
    """[(train errors, test errors)] by model after each round of a block, in one scan that returns a row of sums a batch."""
    models, count = len(margins), len(trees[0])

    def run(batches):
        sums = np.zeros((models, count, 2, 2))
        for batch in batches:
            x, y = _matrix(batch, names), batch.column(label).to_numpy(zero_copy_only=False)
            out = batch.column("fold").to_numpy(zero_copy_only=False) if folds else np.full(len(y), -1)
            for k in range(models):
                value, held = batch.column(margins[k]).to_numpy(zero_copy_only=False).copy(), out == k
                for j, t in enumerate(trees[k]):
                    value += step * t.predict(x)
                    off = np.abs(y - value)
                    sums[k, j] += [[off[~held].sum(), (~held).sum()], [off[held].sum(), held.sum()]]
        yield pa.RecordBatch.from_arrays([pa.array([sums.ravel().tolist()], pa.list_(pa.float64()))], ["s"])

    got = table.mapInArrow(run, "s array<double>").select(F.posexplode("s").alias("i", "v")).groupBy("i").agg(F.sum("v").alias("v")).collect()
    total = np.zeros(models * count * 4)
    for r in got:
        total[r.i] = r.v
    total = total.reshape(models, count, 2, 2)
    with np.errstate(invalid="ignore"):
        mean = total[..., 0] / total[..., 1]
    return [(mean[:, j, 0].tolist(), mean[:, j, 1].tolist()) for j in range(count)]


# ---- forests at every size ---------------------------------------------------------------------

class _Forest:
    """Trees laid end to end, walked for all rows and many trees at once."""

    def __init__(self, trees: Sequence[Tree]):
        begin = np.cumsum([0, *[len(t.feature) for t in trees]])
        self.root = begin[:-1]
        self.feature = np.concatenate([t.feature for t in trees]).astype(np.int16)
        self.threshold, self.value = (np.concatenate([getattr(t, a) for t in trees]) for a in ("threshold", "value"))
        self.left, self.right = (np.concatenate([getattr(t, a) + b for t, b in zip(trees, begin)]).astype(np.int32) for a in ("left", "right"))

    def outputs(self, x: np.ndarray) -> np.ndarray:
        """(rows, trees): each tree's value for each row."""
        at = np.repeat(self.root[None, :].astype(np.int32), len(x), axis=0)
        rows = np.arange(len(x))[:, None]
        while True:
            f = self.feature[at]
            inner = f >= 0
            if not inner.any():
                return self.value[at]
            at = np.where(inner, np.where(x[rows, np.maximum(f, 0)] <= self.threshold[at], self.left[at], self.right[at]), at)


def staged_errors(model, frame: DataFrame, features: Sequence[str], label: str, stages: Sequence[int]) -> DataFrame:
    """(num_trees, n, mae, mse) of a fitted forest cut to its first ``num_trees`` trees, for all stages in one scan:
    each row's running mean over the trees' values is read off at every stage."""
    stages, names = sorted(stages), list(features)
    forest = frame.sparkSession.sparkContext.broadcast(_Forest([Tree.of(t) for t in model.trees[:stages[-1]]]))

    def run(batches):
        total = np.zeros((len(stages), 3))
        for batch in batches:
            x, y = _matrix(batch, names), batch.column(label).to_numpy(zero_copy_only=False)
            for lo in range(0, len(y), CHUNK):
                mean = np.cumsum(forest.value.outputs(x[lo:lo + CHUNK]), axis=1)[:, np.array(stages) - 1] / np.array(stages)
                off = mean - y[lo:lo + CHUNK, None]
                total += np.stack([np.abs(off).sum(axis=0), (off ** 2).sum(axis=0), np.full(len(stages), len(off))], axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(stages, pa.int32()), *(pa.array(total[:, i]) for i in range(3))], ["num_trees", "a", "s", "n"])

    got = frame.select(label, *names).mapInArrow(run, "num_trees int, a double, s double, n double")
    return got.groupBy("num_trees").agg(F.sum("n").cast("long").alias("n"), (F.sum("a") / F.sum("n")).alias("mae"), (F.sum("s") / F.sum("n")).alias("mse"))


# ---- out-of-bag rows -----------------------------------------------------------------------------

#: Draws of 16 bits from one hash.
_DRAWS = 7
#: A 16-bit draw of at least the i-th of these has been drawn more than i times: the Poisson(1) distribution.
_POISSON = [int(65536 * math.exp(-1) * sum(1 / math.factorial(j) for j in range(i + 1))) for i in range(8)]


def bag_weight(tree, id_col, salt: str = "bag") -> Column:
    """How often a row is in a tree's bootstrap sample: Poisson(1) of a 16-bit piece of the MD5 of (tree // 7, row).
    ``tree`` is a number or a column of numbers."""
    tree = F.lit(tree) if isinstance(tree, int) else tree
    text = F.concat(F.lit(f"{salt}:"), F.floor(tree / _DRAWS).cast("string"), F.lit(":"), (F.col(id_col) if isinstance(id_col, str) else id_col).cast("string"))
    u = F.conv(F.substr(F.md5(text.cast("binary")), F.lit(1) + 4 * (tree % _DRAWS), F.lit(4)), 16, 10).cast("int")
    more = [(u >= c).cast("int") for c in _POISSON]
    return sum(more[1:], more[0])


def bag_hashes(trees: int, id_col, salt: str = "bag") -> list[Column]:
    """The MD5s that ``bag_weight`` of trees 0 and on is cut from, one for every seven trees, as 16 bytes each."""
    own = (F.col(id_col) if isinstance(id_col, str) else id_col).cast("string")
    return [F.unhex(F.md5(F.concat(F.lit(f"{salt}:{g}:"), own).cast("binary"))) for g in range(-(-trees // _DRAWS))]


def weights_of(hashes: Sequence, trees: int) -> np.ndarray:
    """(trees, rows): ``bag_weight`` from Arrow columns of ``bag_hashes``; -1 for rows without an id."""
    found = []
    for h in hashes:
        h = h.combine_chunks() if isinstance(h, pa.ChunkedArray) else h
        there = h.is_valid().to_numpy(zero_copy_only=False)
        h = h.fill_null(bytes(16)).cast(pa.binary(16))
        parts = np.frombuffer(h.buffers()[1], ">u2", 8 * len(h), 16 * h.offset).reshape(-1, 8) if len(h) else np.zeros((0, 8), np.uint16)
        found += [np.where(there, np.searchsorted(np.array(_POISSON), parts[:, i].astype(np.int64), side="right"), -1).astype(np.int8) for i in range(_DRAWS)]
    return np.stack(found[:trees])


def bag_weight_sql(tree: str, id_col: str, salt: str = "bag") -> str:
    """``bag_weight`` as DuckDB text."""
    u = f"CAST('0x' || substr(md5('{salt}:' || (({tree}) // {_DRAWS}) || ':' || {id_col}), 1 + 4 * (({tree}) % {_DRAWS}), 4) AS INTEGER)"
    return "(" + " + ".join(f"CAST({u} >= {c} AS INTEGER)" for c in _POISSON) + ")"


def bagged_forest(frame: DataFrame, features: Sequence[str], label: str, id_col: str, *, trees: int, mtry: int, depth: int, min_rows: int = 5,
                  seed: int = 2016, salt: str = "bag") -> list[Tree]:
    """A forest whose bootstrap samples are ``bag_weight``: tree t is fitted on the rows with a weight, weighted by it."""
    names = list(features)
    table = VectorAssembler(inputCols=names, outputCol="_x", handleInvalid="keep").transform(frame).select(id_col, label, "_x").cache()

    def grow(t):
        rows = table.select("_x", F.col(label).alias("_y"), bag_weight(t, id_col, salt).cast("double").alias("_w")).where("_w > 0")
        fit = RandomForestRegressor(labelCol="_y", featuresCol="_x", weightCol="_w", numTrees=1, bootstrap=False, subsamplingRate=1.0,
                                    featureSubsetStrategy=str(mtry), maxDepth=depth, minInstancesPerNode=min_rows, seed=seed + t).fit(rows)
        return Tree.of(fit.trees[0])

    with ThreadPoolExecutor(max_workers=PARALLEL_FITS) as pool:
        grown = list(pool.map(grow, range(trees)))
    table.unpersist()
    return grown


def out_of_bag(frame: DataFrame, trees: Sequence[Tree], features: Sequence[str], label: str, id_col: str, salt: str = "bag", permute: bool = True):
    """(errors, importance) of a ``bagged_forest`` from its out-of-bag rows, in one scan.

    errors: n rows that some tree left out, MAE and MSE of the mean over the trees that did. importance: for each feature
    the mean over trees of the rise of the tree's out-of-bag MSE when the feature takes another row's value, and that mean over
    its standard error (the reference's %IncMSE). The other row comes from one hash permutation of all rows, joined once for all features."""
    names, count, spark = list(features), len(trees), frame.sparkSession
    hashes = [h.alias(f"_h{g}") for g, h in enumerate(bag_hashes(count, id_col, salt))]
    kept = [f"_h{g}" for g in range(len(hashes))]
    table = frame.select(id_col, F.col(label).alias("_y"), *[F.col(c).cast("double").alias(c) for c in names]).withColumn("_own", F.struct(*names))
    if permute:
        table = shuffle_column(table, "_own", id_col, salt="oob", out_col="_other")
        table = table.select(id_col, "_y", *names, *[F.col("_other")[c].alias(f"_o{i}") for i, c in enumerate(names)])
    held = spark.sparkContext.broadcast(_Forest(trees))
    others = [f"_o{i}" for i in range(len(names))] if permute else []

    def run(batches):
        error, rise = np.zeros(3), np.zeros((len(names) + 1, count))
        for batch in batches:
            for lo in range(0, batch.num_rows, CHUNK):
                part = batch.slice(lo, CHUNK)
                x, y = _matrix(part, names), part.column("_y").to_numpy(zero_copy_only=False)
                out = weights_of([part.column(h) for h in kept], count).T == 0
                value = held.value.outputs(x)
                off = (value - y[:, None]) ** 2
                some = out.any(axis=1)
                mean = (value * out)[some].sum(axis=1) / out[some].sum(axis=1) - y[some]
                error += [np.abs(mean).sum(), (mean ** 2).sum(), some.sum()]
                rise[-1] += out.sum(axis=0)
                for i, c in enumerate(others):
                    changed = x.copy()
                    changed[:, i] = part.column(c).to_numpy(zero_copy_only=False)
                    rise[i] += (((held.value.outputs(changed) - y[:, None]) ** 2 - off) * out).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array([np.concatenate([error, rise.ravel()]).tolist()], pa.list_(pa.float64()))], ["s"])

    got = table.select("_y", *names, *others, *hashes).mapInArrow(run, "s array<double>")
    total = np.zeros(3 + (len(names) + 1) * count)
    for r in got.select(F.posexplode("s").alias("i", "v")).groupBy("i").agg(F.sum("v").alias("v")).collect():  # one row for each sum
        total[r.i] = r.v
    error, rise = total[:3], total[3:].reshape(len(names) + 1, count)
    n = error[2]
    errors = {"n_oob": int(n), "mae": float(error[0] / n) if n else None, "mse": float(error[1] / n) if n else None}
    if not permute:
        return errors, []
    with np.errstate(invalid="ignore", divide="ignore"):
        each = np.where(rise[-1] > 0, rise[:-1] / rise[-1], 0.0)
    se = each.std(axis=1, ddof=1) / math.sqrt(count) if count > 1 else np.zeros(len(names))
    importance = [(c, float(each[i].mean()), float(each[i].mean() / se[i]) if se[i] > 0 else None) for i, c in enumerate(names)]
    return errors, sorted(importance, key=lambda r: -r[1])
