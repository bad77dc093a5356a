"""Hard negatives by dual-tree search.

Candidates and anchors are cut into blocks, each with a ball tree that splits by label first and then by direction.
The inner products of two nodes lie within an interval that their centres and radii give; a pair of nodes whose interval
cannot matter to any anchor of the one is left with all that is below it, and a pair of leaves is scored exactly.  Blocks
lie in the shared folder, so a task brings one block of anchors and reads the candidate blocks that its bounds let in.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import filesystem, map_batches, materialise, shared_dir

POSITIVES, NEGATIVES = 5, 10
#: Percent of the positive's score between which a negative's lies.
FROM, TO = 30, 90
SCALE, ANCHORS_EVERY = 256, 100
#: Rows of a block and of a leaf.
CANDIDATE_BLOCK, ANCHOR_BLOCK, CANDIDATE_LEAF, ANCHOR_LEAF = 8192, 1024, 256, 16
#: Rows with the least hash, and points chosen from them, that put like vectors in like blocks; results don't hang on them.
PIVOT_SAMPLE, PIVOTS = 2048, 64
BLOCKS = "path string, first long, last long, rows long, radius double, centre array<double>"


@dataclass
class Tree:
    """A ball tree over rows ``n`` (numbers), ``ids``, ``labels`` and vectors ``x``, which its nodes hold as ranges."""

    n: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    x: np.ndarray
    start: np.ndarray
    end: np.ndarray
    left: np.ndarray  # the first of two children, or -1
    centre: np.ndarray
    radius: np.ndarray
    lengths: np.ndarray  # of the centres

    @classmethod
    def grow(cls, n: np.ndarray, ids: np.ndarray, labels: np.ndarray, x: np.ndarray, leaf: int) -> Tree:
        order, spans, left, at = np.argsort(labels, kind="stable"), [(0, len(n))], [-1], 0
        while at < len(spans):
            i, j = spans[at]
            if j - i > leaf:
                own = order[i:j]
                if labels[own[0]] != labels[own[-1]]:  # still in order of labels: cut where one begins
                    cuts = np.flatnonzero(np.diff(labels[own])) + 1
                    cut = int(cuts[np.abs(cuts - len(own) // 2).argmin()])
                else:
                    y = x[own].astype(np.float64)
                    far = y[((y - y.mean(axis=0)) ** 2).sum(axis=1).argmax()]
                    away = y[((y - far) ** 2).sum(axis=1).argmax()]
                    order[i:j] = own[np.argsort(y @ (away - far), kind="stable")]
                    cut = len(own) // 2
                left[at] = len(spans)
                spans += [(i, i + cut), (i + cut, j)]
                left += [-1, -1]
            at += 1
        x = x[order]
        centre = np.array([x[i:j].mean(axis=0) for i, j in spans])
        radius = np.array([np.sqrt(((x[i:j] - c) ** 2).sum(axis=1).max()) for (i, j), c in zip(spans, centre, strict=True)])
        start, end = np.array(spans).T
        return cls(n[order], ids[order], labels[order], x, start, end, np.array(left), centre, radius, np.sqrt((centre**2).sum(axis=1)))

    def save(self, path: str) -> None:
        """Under a name of its own first, so a task that is run again leaves no half-written block."""
        fs, at = filesystem(path)
        with fs.open_output_stream(f"{at}.part") as out:
            np.savez(out, **self.__dict__)
        fs.move(f"{at}.part", at)

    @classmethod
    def load(cls, path: str) -> Tree:
        import io

        fs, at = filesystem(path)
        with fs.open_input_stream(at) as src, np.load(io.BytesIO(src.read())) as held:
            return cls(**{k: held[k] for k in held.files})


def interval(middle, a_length, a_radius, c_length, c_radius):
    """Least and greatest inner product of a vector of one ball with one of another; ``middle`` is that of the centres.

    Wider by more than rounding can amount to.
    """
    reach = a_length * c_radius + c_length * a_radius + a_radius * c_radius
    reach = reach + 1 + 1e-9 * (a_length + a_radius) * (c_length + c_radius)
    return middle - reach, middle + reach


class Search:
    """The best candidates of each query of an anchor tree so far, within the query's bounds.

    Query q belongs to anchor row ``of[q]`` and takes scores from ``low[q]`` to ``high[q]``, of rows with the anchor's
    own label or of all others.
    """

    def __init__(self, anchors: Tree, of: np.ndarray, low: np.ndarray, high: np.ndarray, keep: int, same_label: bool):
        order = np.argsort(of, kind="stable")
        self.order, self.of, self.low, self.high = order, of[order], low[order].astype(np.float64), high[order].astype(np.float64)
        self.anchors, self.keep, self.same = anchors, keep, same_label
        q = len(of)
        self.score, self.id, self.found = np.full((q, keep), -np.inf), np.zeros((q, keep), np.int64), np.zeros((q, keep), bool)
        self.first = np.searchsorted(self.of, np.arange(len(anchors.n) + 1))  # queries of an anchor

    def wanted(self, node: int) -> tuple[float, float]:
        """Scores below the one and above the other can't matter to any query of an anchor node."""
        q = slice(self.first[self.anchors.start[node]], self.first[self.anchors.end[node]])
        if q.start == q.stop:
            return np.inf, -np.inf
        return float(np.maximum(self.low[q], self.score[q, -1]).min()), float(self.high[q].max())

    def matters(self, node: int, low: float, high: float, first: int, last: int) -> bool:
        """May candidates of labels ``first`` to ``last`` with products from ``low`` to ``high`` matter to the node?"""
        a = self.anchors
        least, most = self.wanted(node)
        mine = a.labels[a.start[node]], a.labels[a.end[node] - 1]
        of_kind = first <= mine[1] and mine[0] <= last if self.same else not first == last == mine[0] == mine[1]
        return of_kind and high >= least and low <= most

    def visit(self, candidates: Tree) -> None:
        """Best node pairs first.  A pair of leaves is scored; of other pairs the wider node is opened."""
        a, c = self.anchors, candidates
        products = a.centre @ c.centre.T
        lows, highs = interval(products, a.lengths[:, None], a.radius[:, None], c.lengths, c.radius)
        queue = [(-highs[0, 0], 0, 0)]
        while queue:
            _, i, j = heapq.heappop(queue)
            if not self.matters(i, lows[i, j], highs[i, j], c.labels[c.start[j]], c.labels[c.end[j] - 1]):
                continue
            if a.left[i] < 0 and c.left[j] < 0:
                self.score_leaves(i, c, j)
                continue
            open_anchor = c.left[j] < 0 or (a.left[i] >= 0 and a.radius[i] >= c.radius[j])
            for k in (0, 1):
                p, q = (a.left[i] + k, j) if open_anchor else (i, c.left[j] + k)
                heapq.heappush(queue, (-highs[p, q], int(p), int(q)))

    def score_leaves(self, i: int, c: Tree, j: int) -> None:
        a = self.anchors
        rows, cols = slice(a.start[i], a.end[i]), slice(c.start[j], c.end[j])
        scores = a.x[rows] @ c.x[cols].T
        alike = a.labels[rows, None] == c.labels[None, cols]
        allowed = alike & (a.n[rows, None] != c.n[None, cols]) if self.same else ~alike
        q0, q1 = self.first[a.start[i]], self.first[a.end[i]]
        row = self.of[q0:q1] - a.start[i]
        s = scores[row]
        hit = allowed[row] & (s >= np.maximum(self.low[q0:q1], self.score[q0:q1, -1])[:, None]) & (s <= self.high[q0:q1, None])
        q, k = np.nonzero(hit)
        if not len(q):
            return
        old = np.nonzero(self.found[q0:q1])
        of = np.r_[q, old[0]]
        score = np.r_[s[q, k], self.score[q0:q1][old]]
        ids = np.r_[c.ids[cols][k], self.id[q0:q1][old]]
        order = np.lexsort((ids, -score, of))
        of, score, ids = of[order], score[order], ids[order]
        rank = np.arange(len(of)) - np.searchsorted(of, of)
        best = rank < self.keep
        at = (of[best] + q0, rank[best])
        self.score[at], self.id[at], self.found[at] = score[best], ids[best], True

    def results(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Number of the query as it was given, score and id of all that was found."""
        q, k = np.nonzero(self.found)
        return self.order[q], self.score[q, k].astype(np.int64), self.id[q, k]


def prepare(vectors: DataFrame, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding") -> DataFrame:
    """``n`` (a number of the row's own), ``id``, ``label`` and ``x`` (long components) of the rows that take part.

    A row without id, label or vector, or with a null or non-finite component, takes no part.  Ids divisible by seven
    get the next label.
    """
    v = F.col(vector_col)
    usable = F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & v.isNotNull() & ~F.exists(v, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    label = F.when(F.col(id_col) % 7 == 0, (F.col(label_col) + 1) % 10).otherwise(F.col(label_col))
    x = F.transform(v, lambda e: F.floor(SCALE * e.cast("double")).cast("long"))
    rows = vectors.where(usable).select(F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"), x.alias("x"))
    return materialise(rows.select(F.monotonically_increasing_id().alias("n"), "*"), "vectors")


def pivots(rows: DataFrame, dims: int) -> np.ndarray:
    """Points that lie far from one another, of a bounded sample."""
    sample = [r.x for r in rows.orderBy(F.xxhash64("n")).select("x").limit(PIVOT_SAMPLE).collect()]
    x = np.array([v + [0] * (dims - len(v)) for v in sample], np.float64).reshape(-1, dims)
    chosen, gap = [0][: len(x)], np.full(len(x), np.inf)
    while len(chosen) < min(PIVOTS, len(x)):
        gap = np.minimum(gap, ((x - x[chosen[-1]]) ** 2).sum(axis=1))
        chosen.append(int(gap.argmax()))
    return x[chosen]


def _matrix(column: pa.ListArray, dims: int, kind) -> np.ndarray:
    """Vectors as rows; shorter ones end in zeros."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    x = np.zeros((len(column), dims), kind)
    x[np.arange(dims) < lengths[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return x


def plant(rows: DataFrame, folder: str, name: str, block: int, leaf: int, dims: int, kind, near: np.ndarray) -> str:
    """Write ball trees of at most ``block`` rows each; returns the folder of a table with a row of ``BLOCKS`` for each.

    Rows are dealt by range of (label, nearest pivot, number), so a frequent label or vector is spread like any other.
    """
    total = rows.count()

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _matrix(b.column("x"), dims, np.float64)
            cell = (x @ near.T - (near**2).sum(axis=1) / 2).argmax(axis=1) if len(near) else np.zeros(len(x))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell.astype(np.int32))], names=[*b.schema.names, "cell"])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, made, held, size = TaskContext.get().partitionId(), 0, [], 0

        def grown() -> pa.RecordBatch:
            t = pa.Table.from_batches(held).combine_chunks()
            n, ids, labels = (t[c].to_numpy() for c in ("n", "id", "label"))
            tree = Tree.grow(n, ids, labels, _matrix(t["x"].combine_chunks(), dims, kind), leaf)
            path = f"{folder}/{name}-{part}-{made}.npz"
            tree.save(path)
            row = [[path], [int(tree.labels[0])], [int(tree.labels[-1])], [len(n)], [float(tree.radius[0])], pa.array([tree.centre[0].tolist()], pa.list_(pa.float64()))]
            return pa.RecordBatch.from_arrays([pa.array(c) if isinstance(c, list) else c for c in row], names=[c.split()[0] for c in BLOCKS.split(", ")])

        for b in batches:
            at = 0
            while at < b.num_rows:
                take = min(block - size, b.num_rows - at)
                held.append(b.slice(at, take))
                at, size = at + take, size + take
                if size == block:
                    yield grown()
                    made, held, size = made + 1, [], 0
        if held:
            yield grown()

    placed = map_batches(rows, cells, "n long, id long, label long, x array<long>, cell int")
    dealt = placed.repartitionByRange(max(1, -(-total // block)), "label", "cell", "n").sortWithinPartitions("label", "cell", "n")
    map_batches(dealt, build, BLOCKS).write.parquet(f"{folder}/{name}")
    return f"{folder}/{name}"


def best(asked: DataFrame, candidates: str, keep: int, same_label: bool, parts: int, tasks: int) -> DataFrame:
    """The best ``keep`` candidates per query: ``anchor`` (row number), ``anchor_id``, ``query``, ``score``, ``id``, ``rank``.

    ``asked`` has the path of each anchor block and, if they ask within bounds, its anchors' queries, a few per anchor.
    The candidate blocks are dealt to ``parts`` tasks for each anchor block, and what those find is merged.
    """

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.dataset as ds

        for batch in batches:
            for row in batch.to_pylist():
                tree, asked = Tree.load(row["path"]), row.get("asked")
                if asked is None:
                    of, low, high, number = np.arange(len(tree.n)), np.full(len(tree.n), -np.inf), np.full(len(tree.n), np.inf), np.zeros(len(tree.n), np.int64)
                else:
                    place = np.argsort(tree.n)
                    of = place[np.searchsorted(tree.n, [q["anchor"] for q in asked], sorter=place)]
                    low, high, number = (np.array([q[c] for q in asked]) for c in ("low", "high", "query"))
                seek = Search(tree, of, low, high, keep, same_label)
                fs, at = filesystem(candidates)
                blocks = ds.dataset(at, filesystem=fs, format="parquet").to_table().sort_by("path")
                blocks = blocks.take(np.arange(row["part"], len(blocks), parts)).combine_chunks()
                paths, first, last, radius = (blocks[c].to_pylist() for c in ("path", "first", "last", "radius"))
                centres = pa.chunked_array(blocks["centre"]).combine_chunks().flatten().to_numpy().reshape(len(paths), -1) if paths else np.zeros((0, tree.x.shape[1]))
                leaves = np.flatnonzero(tree.left < 0)
                lows, highs = interval(tree.centre[leaves] @ centres.T, tree.lengths[leaves, None], tree.radius[leaves, None], np.sqrt((centres**2).sum(axis=1)), np.array(radius))
                for k in np.argsort(-highs.max(axis=0)):
                    if any(seek.matters(leaf, lows[i, k], highs[i, k], first[k], last[k]) for i, leaf in enumerate(leaves)):
                        seek.visit(Tree.load(paths[k]))
                q, score, ids = seek.results()
                columns = (tree.n[of[q]], tree.ids[of[q]], number[q], score, ids)
                for i in range(0, len(q), 10_000):
                    yield pa.RecordBatch.from_arrays([pa.array(c[i : i + 10_000].astype(np.int64)) for c in columns], names=["anchor", "anchor_id", "query", "score", "id"])

    dealt = asked.select("*", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part")).repartition(tasks)
    found = map_batches(dealt, search, "anchor long, anchor_id long, query long, score long, id long")
    rank = F.row_number().over(Window.partitionBy("anchor", "query").orderBy(F.desc("score"), "id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= keep)


def hard_negatives(vectors: DataFrame, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding") -> DataFrame:
    """Per anchor and positive the hardest negatives: ``anchor_id``, ``positive_id``, ``rank``, ``negative_id`` and scores.

    Components become floor(256 x); a score is the inner product, exact in integers.  Anchors are the rows whose id is
    divisible by 100, positives the ``POSITIVES`` other rows of its label with the highest scores, negatives the first
    ``NEGATIVES`` rows of other labels whose score lies between 30 and 90 percent of the positive's; ties go to the smaller id.
    Rows that repeat an id are rows of their own: one is another's positive, and each that is an anchor gives its rows.
    A row without id, label or vector, or with a null or non-finite component, takes no part; a shorter vector counts as if
    it ended in zeros, an empty one scores 0.  An empty table, or one without anchors, gives no rows; other columns are not read.
    Vectors whose scores might not fit a long are refused.
    """
    spark = vectors.sparkSession
    rows = prepare(vectors, id_col, label_col, vector_col)
    size = rows.agg(F.coalesce(F.max(F.size("x")), F.lit(1)), F.coalesce(F.max(F.array_max(F.transform("x", lambda e: F.abs(e)))), F.lit(1))).first()
    dims, most = max(1, size[0]), size[1]
    if dims * most**2 >= 1 << 56:
        raise ValueError(f"components of up to {most} in {dims} dimensions: scores do not fit a long")
    kind = np.float64 if dims * most**2 < 1 << 52 else np.int64  # exact either way
    folder = shared_dir(spark, "dual-tree")
    filesystem(folder)[0].create_dir(filesystem(folder)[1], recursive=True)
    near = pivots(rows, dims)
    anchors = plant(rows.where(F.col("id") % ANCHORS_EVERY == 0), folder, "anchors", ANCHOR_BLOCK, ANCHOR_LEAF, dims, kind, near)
    candidates = plant(rows, folder, "candidates", CANDIDATE_BLOCK, CANDIDATE_LEAF, dims, kind, near)
    blocks, sets = spark.read.parquet(candidates).count(), spark.read.parquet(anchors)
    parts = max(1, min(blocks, -(-2 * spark.sparkContext.defaultParallelism // max(1, sets.count()))))
    tasks = max(1, parts * sets.count())
    nearest = best(sets.select("path"), candidates, POSITIVES, True, parts, tasks)
    positives = materialise(nearest.select("anchor", F.col("rank").cast("long").alias("query"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    low, high = F.expr(f"({FROM} * positive_score + 99) div 100"), F.expr(f"({TO} * positive_score) div 100")
    wanted = positives.where("positive_score >= 0").select("anchor", "query", low.alias("low"), high.alias("high"))  # below 0 the range is empty
    home = map_batches(sets.select("path"), _rows_of, "path string, anchor long")
    asked = wanted.join(home, "anchor").groupBy("path").agg(F.collect_list(F.struct("anchor", "query", "low", "high")).alias("asked"))
    found = best(asked, candidates, NEGATIVES, False, parts, tasks)
    return found.join(positives, ["anchor", "query"]).select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def _rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of each block of anchors."""
    for batch in batches:
        for path in batch.column(0).to_pylist():
            n = Tree.load(path).n
            yield pa.RecordBatch.from_arrays([pa.array([path] * len(n)), pa.array(n)], names=["path", "anchor"])
