"""Near-duplicate vectors by NN-descent.

Equal vectors are one node with its number of copies. A first neighbour graph comes from a few passes in which the
nodes are sorted by the signs of random projections and every node finds its nearest in a block of the sorted order.
It is refined by neighbours-of-neighbours joins: the neighbours of each node, both ways, meet with their vectors, and
whatever is nearer to one of them than the last of its list enters the list. Lists whose last neighbour is above the
threshold are saturated; they are enlarged to the whole component that the threshold edges form, in which all pairs
are computed in double precision, block against block, and only those at the threshold or above are kept. After each
refinement the recall is audited: samples of nodes are compared with all nodes until they have shown enough links, and
more rounds follow until the target is reached. Where it is not, or where links are so few that the samples have come
to hold all nodes, the links of all nodes are taken from that comparison, which is exact.

Inputs: vectors that are NULL, empty or zero, or hold NULL or non-finite components, link with nothing, and neither do
vectors of different lengths. Copies link with each other. Repeated rows are copies. A NULL id counts as the largest
one. An empty table gives an empty result. Extra columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tekstmill.operators.components import connected_components

from .common import cut_lineage, read_table
from .forest import _roots


@dataclass(frozen=True)
class DescentPlan:
    threshold: float = 0.95
    # Neighbours kept per node, and those that meet in a join, each way.
    neighbours: int = 10
    joined: int = 8
    # Nodes compared with each other in a first pass, and the number of passes.
    block: int = 1024
    passes: int = 3
    signs: int = 30
    rounds: int = 5
    # Nodes of the first sample of an audit and of further ones, the links that samples must show, and the recall at
    # which refinement ends.
    audited: int = 512
    compared: int = 4096
    links: int = 200
    recall: float = 0.995


def _unit(matrix: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; each is first divided by its largest absolute component, so that neither the squares
    of huge components overflow nor those of tiny ones vanish."""
    scaled = matrix / np.abs(matrix).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _matrix(column: pa.Array, kind=np.float32) -> np.ndarray:
    """Rows of a list column whose lists are equally long."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(column), -1)


def _dims(column: pa.Array) -> np.ndarray:
    return pa.compute.list_value_length(column).to_numpy(zero_copy_only=False)


def nodes_of(vectors: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(node, copies, dim, vec) of every distinct vector that may link; ``node`` is the smallest id of its copies."""
    vec = F.col("vec")
    plain = vectors.select(F.col(vec_id).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("vec"))
    fine = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(vec, lambda x: x != 0)
    grouped = plain.filter(vec.isNotNull() & fine).groupBy("vec").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("copies"))
    # Ids may repeat or be missing, so nodes have a name of their own.
    return grouped.select(F.xxhash64("vec").alias("node"), "first", "copies", F.size("vec").alias("dim"), "vec")


def _block_pass(nodes: DataFrame, plan: DescentPlan, number: int) -> DataFrame:
    """(u, v, s): the nearest of each node within a block of one sorted order."""

    def signature(batches):
        for batch in batches:
            signs = np.zeros(batch.num_rows, np.int64)
            dims = _dims(batch.column("vec"))
            for dim in np.unique(dims):
                rows = np.flatnonzero(dims == dim)
                planes = np.random.default_rng([number, int(dim)]).standard_normal((int(dim), plan.signs))
                bits = _matrix(batch.column("vec").take(pa.array(rows)), np.float64) @ planes > 0
                signs[rows] = bits @ (1 << np.arange(plan.signs, dtype=np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(signs)], names=[*batch.schema.names, "sign"])

    base = nodes.select("node", "dim", "vec")
    order = ["dim", "sign", "node"]
    signed = base.mapInArrow(signature, "node bigint, dim int, vec array<double>, sign bigint")
    placed = signed.repartitionByRange(*order).sortWithinPartitions(*order)

    def nearest(batches):
        held: list[pa.RecordBatch] = []

        def flush(rows):
            table = pa.Table.from_batches(rows).combine_chunks()
            ids, dims = table["node"].to_numpy(), table["dim"].to_numpy()
            for dim in np.unique(dims):
                where = np.flatnonzero(dims == dim)
                x = _unit(_matrix(table["vec"].combine_chunks().take(pa.array(where)), np.float64)).astype(np.float32)
                s = x @ x.T
                np.fill_diagonal(s, -2)
                k = min(plan.neighbours, len(where) - 1)
                if k < 1:
                    continue
                best = np.argpartition(-s, k - 1, axis=1)[:, :k]
                u = np.repeat(ids[where], k)
                yield _edges(u, ids[where][best].ravel(), np.take_along_axis(s, best, 1).ravel())

        n = 0
        for batch in batches:
            low = 0
            while low < batch.num_rows:
                part = batch.slice(low, plan.block - n)
                held.append(part)
                n, low = n + part.num_rows, low + part.num_rows
                if n == plan.block:
                    yield from flush(held)
                    held, n = [], 0
        if held:
            yield from flush(held)

    return placed.mapInArrow(nearest, "u bigint, v bigint, s float")


def _edges(u, v, s) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64()), pa.array(s, pa.float32())], names=["u", "v", "s"])


def _best(edges: DataFrame, plan: DescentPlan) -> DataFrame:
    """The nearest of each list; those at the threshold stay whatever their number."""
    distinct = edges.groupBy("u", "v").agg(F.max("s").alias("s"))
    place = F.row_number().over(Window.partitionBy("u").orderBy(F.desc("s"), "v"))
    kept = distinct.withColumn("place", place).filter(
        (F.col("place") <= plan.neighbours) | (F.col("s") >= plan.threshold - 1e-4)
    )
    return kept.drop("place")


def _descend(edges: DataFrame, nodes: DataFrame, plan: DescentPlan) -> DataFrame:
    """One neighbours-of-neighbours join: ``edges`` with what it has found."""
    place = lambda by: F.row_number().over(Window.partitionBy(by).orderBy(F.desc("s"), "u", "v"))
    first = edges.withColumn("k", place("u")).filter(F.col("k") <= plan.joined)
    # Both ways; the reverse lists are cut alike, as a node may be near to very many.
    back = first.withColumn("k", place("v")).filter(F.col("k") <= plan.joined)
    own = F.col("u").alias("center"), F.col("v").alias("member")
    members = first.select(*own).union(back.select(F.col("v").alias("center"), F.col("u").alias("member"))).distinct()
    worst = edges.groupBy("u").agg(F.min("s").alias("worst"), F.count(F.lit(1)).alias("n"))
    limits = worst.select("u", F.when(F.col("n") >= plan.neighbours, F.col("worst")).otherwise(-2.0).alias("worst"))
    facts = nodes.select(F.col("node").alias("member"), F.col("vec").cast("array<float>").alias("vec")).join(
        limits.withColumnRenamed("u", "member"), "member", "left"
    )
    met = members.join(facts, "member").select("center", "member", "vec", F.coalesce("worst", F.lit(-2.0)).alias("worst"))
    met = met.repartition("center").sortWithinPartitions("center", "member")

    def join(batches):
        held, current = [], None

        def flush(parts):
            table = pa.Table.from_batches(parts)
            vecs = table["vec"].combine_chunks()
            dims = _dims(vecs)
            if len(dims) < 2 or (dims != dims[0]).any():
                return None
            x = _unit(_matrix(vecs, np.float64)).astype(np.float32)
            ids, limit = table["member"].to_numpy(), table["worst"].to_numpy()
            s = x @ x.T
            np.fill_diagonal(s, -3)
            i, j = np.nonzero(s > limit[:, None])
            return ids[i], ids[j], s[i, j]

        found: list[tuple] = []
        for batch in batches:
            centers = batch.column("center").to_numpy()
            edges_ = [0, *(np.flatnonzero(np.diff(centers)) + 1).tolist(), len(centers)]
            for low, high in zip(edges_, edges_[1:]):
                if high == low:
                    continue
                if centers[low] != current:
                    if held and (new := flush(held)):
                        found.append(new)
                    held, current = [], centers[low]
                held.append(batch.slice(low, high - low))
            if sum(len(f[0]) for f in found) > 100_000:
                yield _edges(*map(np.concatenate, zip(*found)))
                found = []
        if held and (new := flush(held)):
            found.append(new)
        if found:
            yield _edges(*map(np.concatenate, zip(*found)))

    return _best(edges.union(met.mapInArrow(join, "u bigint, v bigint, s float")), plan)


def _components(edges: DataFrame, plan: DescentPlan) -> DataFrame:
    """(node, component) of all nodes with an edge about at the threshold."""
    near = edges.filter(F.col("s") >= plan.threshold - 1e-4)
    pairs = near.select(F.greatest("u", "v").alias("src"), F.least("u", "v").alias("dst")).filter("src <> dst").distinct()
    found = connected_components(pairs).withColumnRenamed("cluster", "component")
    return cut_lineage(found, "vector-components")


def _true_links(nodes: DataFrame, plan: DescentPlan, part: int, parts: int) -> DataFrame:
    """(u, v, s): links of a part of the nodes with all nodes; the part goes to every task."""
    chosen = F.pmod(F.xxhash64(F.col("node"), F.lit(5)), F.lit(parts)) == part
    sample = nodes.filter(chosen).select("node", "dim", "vec").toArrow().combine_chunks()
    dims_ = sample["dim"].to_numpy()
    queries = {}
    for dim in np.unique(dims_).tolist():
        rows = sample.take(pa.array(np.flatnonzero(dims_ == dim)))
        queries[dim] = rows["node"].to_numpy(), _unit(_matrix(rows["vec"].combine_chunks(), np.float64))

    def compare(batches):
        for whole in batches:
            for low in range(0, whole.num_rows, 1024):
                batch = whole.slice(low, 1024)
                dims, ids = _dims(batch.column("vec")), batch.column("node").to_numpy()
                for dim in np.unique(dims).tolist():
                    if dim in queries:
                        rows = np.flatnonzero(dims == dim)
                        names, q = queries[dim]
                        s = q @ _unit(_matrix(batch.column("vec").take(pa.array(rows)), np.float64)).T
                        i, j = np.nonzero(s >= plan.threshold)
                        other = names[i] != ids[rows][j]
                        yield _edges(names[i][other], ids[rows][j][other], s[i, j][other])

    found = nodes.select("node", "vec").mapInArrow(compare, "u bigint, v bigint, s float")
    return cut_lineage(found, "vector-audit")


def audit(nodes: DataFrame, components: DataFrame, plan: DescentPlan) -> tuple[int, int, DataFrame, bool]:
    """Links and links found of samples of nodes with all nodes, the links themselves, and whether all nodes were
    compared. Samples are added until they show ``plan.links`` links."""
    ends = [components.select(F.col("node").alias(c), F.col("component").alias(f"c{c}")) for c in ("u", "v")]

    def count(true: DataFrame) -> tuple[int, int]:
        both = true.join(ends[0], "u", "left").join(ends[1], "v", "left")
        row = both.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("cu") == F.col("cv")).alias("found")).first()
        return row["n"], row["found"]

    total = nodes.count()
    true = _true_links(nodes, plan, 0, max(1, -(-total // plan.audited)))
    links, found = count(true)
    if links >= plan.links:
        return links, found, true, total <= plan.audited
    parts, true, links, found = max(1, -(-total // plan.compared)), None, 0, 0
    for part in range(parts):
        more = _true_links(nodes, plan, part, parts)
        n, seen = count(more)
        true, links, found = more if true is None else true.union(more), links + n, found + seen
        if links >= plan.links:
            break
    return links, found, true, part == parts - 1


def neighbour_graph(nodes: DataFrame, plan: DescentPlan) -> tuple[DataFrame, list[tuple[int, int]]]:
    """Components of the refined graph, which has the target recall, and the audits by round."""
    edges = _block_pass(nodes, plan, 0)
    for number in range(1, plan.passes):
        edges = edges.union(_block_pass(nodes, plan, number))
    edges = cut_lineage(_best(edges, plan), "neighbours")
    audits = []
    for number in range(plan.rounds):
        edges = cut_lineage(_descend(edges, nodes, plan), "neighbours")
        components = _components(edges, plan)
        links, found, true, whole = audit(nodes, components, plan)
        audits.append((links, found))
        if found >= plan.recall * links and (links >= plan.links or found == links):
            return components, audits
        edges = edges.union(true)
        if whole:
            return _components(edges, plan), [*audits, (links, links)]
        # More starting points for what the joins don't reach.
        edges = cut_lineage(_best(edges.union(_block_pass(nodes, plan, plan.passes + number)), plan), "neighbours")
    parts = max(1, -(-nodes.count() // plan.compared))
    true = [_true_links(nodes, plan, part, parts) for part in range(parts)]
    links = sum(t.count() for t in true)
    for more in true:
        edges = edges.union(more)
    return _components(edges, plan), [*audits, (links, links)]


def _links(nodes: DataFrame, components: DataFrame, plan: DescentPlan, block: int = 1024) -> DataFrame:
    """(node, n, root): copies of other nodes linked, per pair of blocks, and a node that links lead to."""
    members = components.join(nodes.select("node", "copies", "dim", "vec"), "node")
    sizes = components.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    dealt = members.join(sizes, "component").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    paired = dealt.select("*", other).select(
        "component", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "node",
        "copies", "dim", "vec",
    )
    keys = ["component", "low", "high"]
    paired = paired.repartition(*keys).sortWithinPartitions(*keys, "block", "node")

    def count(batches):
        def answer(key, parts):
            table = pa.Table.from_batches(parts).combine_chunks()
            ids, blocks, copies = (table[c].to_numpy() for c in ("node", "block", "copies"))
            dims, vecs = table["dim"].to_numpy(), table["vec"].combine_chunks()
            links = np.zeros((len(ids), len(ids)), bool)
            for dim in np.unique(dims):
                rows = np.flatnonzero(dims == dim)
                x = _unit(_matrix(vecs.take(pa.array(rows)), np.float64))
                links[np.ix_(rows, rows)] = x @ x.T >= plan.threshold
            np.fill_diagonal(links, False)
            if key[1] != key[2]:
                links &= blocks[:, None] != blocks[None, :]
            n = links @ copies
            has = np.flatnonzero(n)
            return ids[has], n[has], ids[_roots(links)][has]

        def table(found):
            columns = [np.concatenate(c) for c in zip(*found)]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["node", "n", "root"])

        current, held, found = None, [], []
        for batch in batches:
            names = list(zip(*[batch.column(c).to_pylist() for c in keys]))
            low = 0
            while low < len(names):
                high = low
                while high < len(names) and names[high] == names[low]:
                    high += 1
                if names[low] != current:
                    if held:
                        found.append(answer(current, held))
                    current, held = names[low], []
                held.append(batch.slice(low, high - low))
                low = high
            if len(found) > 1000:
                yield table(found)
                found = []
        if held:
            found.append(answer(current, held))
        if found:
            yield table(found)

    return cut_lineage(paired.mapInArrow(count, "node bigint, n bigint, root bigint"), "vector-links")


def near_duplicate_vectors(
    vectors: DataFrame, plan: DescentPlan = DescentPlan(), vec_id: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row."""
    nodes = cut_lineage(nodes_of(vectors, vec_id, vector), "vector-nodes")
    components, _ = neighbour_graph(nodes, plan)
    links = _links(nodes, components, plan)
    sums = links.groupBy("node").agg(F.sum("n").alias("n"))
    edges = links.filter("node <> root").select(F.greatest("node", "root").alias("src"), F.least("node", "root").alias("dst"))
    groups = connected_components(edges.distinct())
    whole = nodes.select("node", "first", "copies").join(sums, "node", "left").join(groups, "node", "left")
    whole = cut_lineage(whole.withColumn("cluster", F.coalesce("cluster", "node")), "vector-groups")
    ids = whole.groupBy("cluster").agg(F.min("first").alias("component_id"))
    answers = cut_lineage(
        whole.join(ids, "cluster").select(
            F.col("node").alias("__node"), "component_id", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links")
        ), "vector-answers",
    )
    rows = vectors.select(F.col(vec_id).alias("vec_id"), F.xxhash64(F.col(vector).cast("array<double>")).alias("__node"))
    joined = rows.join(answers, "__node", "left")
    return joined.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.coalesce("component_id", F.col("vec_id")).alias("component_id"),
    ).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op7_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_vectors(read_table(spark, sf_dir, "embeddings"))
