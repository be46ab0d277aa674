"""Near-duplicate vectors by search in a robust-pruned flat graph.

Vectors of one label are dealt to the shards of their nearest cluster centres, so that
shards overlap. In every shard each vector gets a pruned list of near neighbours; the
lists of a vector from all its shards are joined. Every vector then searches its shards'
part of the graph: best first from the medoid, and from where it has come within the
wanted range on through everything in range. What is found is verified by the exact
cosine, and the recall is audited against brute force.
"""

from __future__ import annotations

import logging
import warnings
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..storage import materialize
from .components import components

COSINE = 0.98
#: Vectors that the centres are fitted on, at most, in the order of a hash of their ids.
SAMPLE_ROWS = 20_000
#: Vectors to a centre, and most centres altogether.
PER_CENTER, MAX_CENTERS = 800, 4096
#: Shards of each vector.
OVERLAP = 2
# A shard of more vectors is worked off in pairs of blocks of half as many.
SHARD = 3000
DEGREE, POOL, ALPHA = 24, 64, 1.2
#: Vectors that each search expands at least, and how far below the wanted cosine it
#: still goes on.
BEAM, SLACK = 24, 0.05
#: The audit's queries against all vectors: the ids divisible by AUDIT_EVERY, of at most
#: AUDIT_ALL vectors all.
AUDIT_EVERY, AUDIT_ALL = 20, 20_000
#: The recall that the audit has to show; short of it, all is done again with twice the
#: overlap, beam, degree and pool, AUDIT_ROUNDS times altogether. Below LEAST_RECALL after
#: that is an error.
AUDIT_RECALL, LEAST_RECALL, AUDIT_ROUNDS = 0.95, 0.9, 5
#: Bytes of queries that go through all vectors at a time, and rows compared at a time.
AUDIT_BYTES, _AUDIT_BLOCK = 32 << 20, 2048
_QUERIES = 256
# Vectors that a step of a block of queries goes on from, and similarities at a time.
_EXPANDED, _SCORED = 50_000, 16_384
#: Vectors that the search has linked, and that are audited if the queries have no links.
AUDIT_LINKED = 2000
_log = logging.getLogger(__name__)


@dataclass
class Centers:
    """Cluster centres by label and number of dimensions."""

    by_key: dict[tuple[int, int], tuple[int, np.ndarray]]  # number of the first, centres

    def shards(self, key, vectors: np.ndarray, overlap: int) -> np.ndarray:
        """Numbers of the nearest centres of each vector, -1 where there are fewer."""
        out = np.full((len(vectors), overlap), -1, np.int64)
        first, centers = self.by_key.get(key, (None, None))
        if first is None:
            out[:, 0] = 0
            return out
        near = np.argsort(-(vectors @ centers.T), axis=1, kind="stable")[:, :overlap]
        out[:, : near.shape[1]] = first + near
        return out


def _unit(vectors: np.ndarray) -> np.ndarray:
    # Scaled first, so that squares neither overflow nor vanish.
    top = np.abs(vectors).max(axis=1, keepdims=True)
    scaled = vectors / top
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def k_means(vectors: np.ndarray, count: int, rounds: int = 8, seed: int = 1) -> np.ndarray:
    """Spherical k-means; empty clusters keep their last centre."""
    draw = np.random.default_rng(seed)
    centers = vectors[draw.choice(len(vectors), min(count, len(vectors)), replace=False)]
    for _ in range(rounds):
        nearest = (vectors @ centers.T).argmax(1)
        sums = np.zeros_like(centers)
        np.add.at(sums, nearest, vectors)
        norm = np.sqrt((sums * sums).sum(1, keepdims=True))
        centers = np.where(norm > 0, sums / np.maximum(norm, 1e-300), centers)
    return centers


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors from a binary column of doubles, all of one size."""
    return np.stack([np.frombuffer(x.as_buffer(), np.float64) for x in column])


def robust_prune(similar: np.ndarray, near: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """At most ``degree`` of each vector's ``near`` neighbours, -1 where fewer are left.

    Taken from the nearest on; each one taken removes those that are ``alpha`` times
    nearer to it than to the vector itself.
    """
    count, pool = near.shape
    out = np.full((count, degree), -1, np.int64)
    rows = np.arange(count)
    own = 1 - similar[rows[:, None], near]
    alive = np.isfinite(own) & (near != rows[:, None])
    for step in range(degree):
        any_ = alive.any(1)
        if not any_.any():
            break
        best = np.where(alive, own, np.inf).argmin(1)
        taken = near[rows, best]
        out[any_, step] = taken[any_]
        between = 1 - similar[taken[:, None], near]
        alive &= alpha * between > own
        alive[rows, best] = False
    return out


def build_graph(vectors: np.ndarray, degree: int = DEGREE, pool: int = POOL) -> np.ndarray:
    """Neighbour lists of a shard: pruned near ones, and the links back to them."""
    count = len(vectors)
    similar = (vectors @ vectors.T).astype(np.float32)
    pool = min(pool, count)
    near = np.argpartition(-similar, pool - 1, axis=1)[:, :pool] if count > pool else np.tile(
        np.arange(count), (count, 1)
    )
    # Some far vectors among the candidates keep the graph in one piece.
    draw = np.random.default_rng(count)
    near = np.concatenate([near, draw.integers(0, count, (count, 8))], axis=1)
    return robust_prune(similar, near, degree, ALPHA)


def range_search(vectors, graph, queries: np.ndarray, beam: int, radius: float):
    """Pairs (query, vector) within ``radius`` that a search from the medoid meets.

    ``graph`` has a row of neighbours (-1: none) for each vector, ``queries`` numbers of
    vectors. A query goes on from the nearest vector met; once some are within the wanted
    range, from all of these at a time, so that a group of very many near copies takes as
    many steps as the graph is deep, not as many as it has members.
    """
    count = len(vectors)
    medoid = int((vectors @ vectors.mean(0)).argmax())
    held = vectors.astype(np.float32)
    found_q, found_v = [], []
    for at in range(0, len(queries), _QUERIES):
        chosen = queries[at : at + _QUERIES]
        n = len(chosen)
        target = held[chosen]
        seen = np.full((n, count + 1), -np.inf, np.float32)
        open_ = np.full((n, count + 1), -np.inf, np.float32)
        start = target @ held[medoid]
        seen[:, medoid] = open_[:, medoid] = start
        active, step = np.arange(n), 0
        while len(active):
            held_open = open_[active]
            best = held_open.argmax(1)
            value = held_open[np.arange(len(active)), best]
            go = np.isfinite(value) & ((step < beam) | (value >= radius - SLACK))
            active, best, value = active[go], best[go], value[go]
            if not len(active):
                break
            # All that lie in range, some at a time, else the nearest.
            rows, nodes = np.nonzero(held_open[go] >= radius - SLACK)
            rows, nodes = rows[:_EXPANDED], nodes[:_EXPANDED]
            far = value < radius - SLACK
            rows, nodes = np.append(active[rows], active[far]), np.append(nodes, best[far])
            open_[rows, nodes] = -np.inf
            near = graph[nodes]
            rows = np.repeat(rows, near.shape[1])
            near = near.reshape(-1)
            fresh = (near >= 0) & ~np.isfinite(seen[rows, near])
            both = np.unique(rows[fresh] * (count + 1) + near[fresh])
            rows, near = np.divmod(both, count + 1)
            for k in range(0, len(rows), _SCORED):
                r, v = rows[k : k + _SCORED], near[k : k + _SCORED]
                seen[r, v] = open_[r, v] = np.einsum("nd,nd->n", target[r], held[v])
            step += 1
        q, v = np.nonzero(seen[:, :count] >= radius - 1e-4)
        found_q.append(chosen[q])
        found_v.append(v)
    if not found_q:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(found_q), np.concatenate(found_v)


def _clean(rows: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """id, label, dims, vector (doubles) of all rows that can link with others."""
    values = F.col(vector).cast("array<double>")
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return rows.select(
        F.col(key).cast("long").alias("id"),
        F.col(label).cast("long").alias("label"),
        F.size(values).alias("dims"),
        values.alias("vector"),
    ).filter(
        F.col("id").isNotNull()
        & F.col("label").isNotNull()
        & F.col("vector").isNotNull()
        & ~F.exists("vector", bad)
        & F.exists("vector", lambda x: x != 0)
    )


def _packed(batches):
    """Vectors as binaries of doubles, 0.0 and -0.0 alike."""
    for batch in batches:
        if not batch.num_rows:
            continue
        vector = batch.column(batch.schema.get_field_index("vector"))
        flat = vector.flatten().to_numpy(zero_copy_only=False) + 0.0
        ends = np.concatenate([[0], np.cumsum(np.diff(vector.offsets.to_numpy()))])
        data = [flat[a:b].tobytes() for a, b in zip(ends, ends[1:])]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], pa.array(data, pa.binary())], batch.schema.names
        )


def _fit_centers(classes: DataFrame) -> Centers:
    sizes = classes.groupBy("label", "dims").count()
    total = {(r["label"], r["dims"]): r["count"] for r in sizes.orderBy(F.desc("count")).limit(MAX_CENTERS // 2).collect()}
    sample = classes.orderBy(F.xxhash64("rep"), "rep").limit(SAMPLE_ROWS)
    by_key: dict = {}
    for row in sample.select("label", "dims", "vector").collect():
        by_key.setdefault((row["label"], row["dims"]), []).append(np.frombuffer(row["vector"], np.float64))
    centers, first = {}, 1
    everything = max(1, sum(total.values()))
    for key in sorted(by_key):
        if key not in total:
            continue
        share = max(1, MAX_CENTERS // 2 * total[key] // everything)
        wanted = max(1, min(-(-total[key] // PER_CENTER), share))
        found = k_means(_unit(np.stack(by_key[key])), wanted)
        centers[key] = (first, found)
        first += len(found)
    return Centers(centers)


def _deal(classes: DataFrame, centers: Centers, overlap: int) -> DataFrame:
    """rep, size, label, dims, vector and the array of its shards."""
    sent = classes.sparkSession.sparkContext.broadcast(centers)
    schema = T.StructType([*classes.schema.fields, T.StructField("shards", T.ArrayType(T.LongType()))])

    def run(batches):
        for batch in batches:
            column = lambda name: batch.column(batch.schema.get_field_index(name))
            labels, dims = column("label").to_numpy(), column("dims").to_numpy()
            shards = [None] * batch.num_rows
            for key in {*zip(labels.tolist(), dims.tolist())}:
                rows = np.flatnonzero((labels == key[0]) & (dims == key[1]))
                near = sent.value.shards(key, _unit(_matrix(column("vector").take(pa.array(rows)))), overlap)
                for row, own in zip(rows, near):
                    shards[row] = [int(s) for s in own if s >= 0]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(shards, pa.list_(pa.int64()))], schema.names
            )

    return classes.mapInArrow(run, schema)


_TASK = ["label", "dims", "shard", "i", "j"]


def _tasks(dealt: DataFrame) -> DataFrame:
    """A row for each vector and each pair of blocks of its shards that its block is in."""
    rows = dealt.withColumn("shard", F.explode("shards"))
    blocks = F.when(F.col("m") <= SHARD, 1).otherwise(F.ceil(F.col("m") / (SHARD // 2))).cast("int")
    sizes = rows.groupBy("label", "dims", "shard").agg(F.count(F.lit(1)).alias("m"))
    sizes = sizes.select("label", "dims", "shard", blocks.alias("blocks"))
    rows = rows.join(sizes, ["label", "dims", "shard"])
    rows = rows.withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return rows.withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other")).drop(
        "other", "blocks"
    )


def _build(degree: int, pool: int):
    def run(table: pa.Table) -> pa.Table:
        vectors = _unit(_matrix(table["vector"].combine_chunks()))
        reps = table["rep"].to_numpy()
        graph = build_graph(vectors, degree, pool)
        lists = [reps[row[row >= 0]].tolist() for row in graph]
        return pa.table(
            {"rep": reps, "near": pa.array(lists, pa.list_(pa.int64()))},
            schema=pa.schema([("rep", pa.int64()), ("near", pa.list_(pa.int64()))]),
        )

    return run


def _search(beam: int, cosine: float):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("rep")
        reps, size = table["rep"].to_numpy(), table["size"].to_numpy()
        block = table["block"].to_numpy()
        i, j, shard = (table[name][0].as_py() for name in ("i", "j", "shard"))
        shards = _padded(table["shards"].combine_chunks())
        vectors = _unit(_matrix(table["vector"].combine_chunks()))
        graph = _local(reps, table["near"].combine_chunks())
        q, v = range_search(vectors, graph, np.arange(len(reps)), beam, cosine)
        # Each pair once, from whichever end it was found, and only in its own task: the
        # first shard that both share, the pair of their blocks.
        low, high = np.minimum(q, v), np.maximum(q, v)
        pairs = np.unique(low * len(reps) + high)
        low, high = np.divmod(pairs, len(reps))
        keep = (low != high) & (np.minimum(block[low], block[high]) == i)
        keep &= np.maximum(block[low], block[high]) == j
        low, high = low[keep], high[keep]
        mine = _first_common(shards, low, high) == shard
        low, high = low[mine], high[mine]
        exact = np.concatenate(
            [np.zeros(0)] + [
                np.einsum("nd,nd->n", vectors[low[k : k + 4096]], vectors[high[k : k + 4096]])
                for k in range(0, len(low), 4096)
            ]
        )
        linked = exact >= cosine
        low, high = low[linked], high[linked]
        count = np.bincount(low, weights=size[high], minlength=len(reps))
        count += np.bincount(high, weights=size[low], minlength=len(reps))
        links = np.bincount(low, minlength=len(reps)) + np.bincount(high, minlength=len(reps))
        some = np.flatnonzero(count)
        a, b = _forest(low, high, len(reps))
        return pa.table(
            {
                "a": np.concatenate([reps[some], reps[a]]),
                "b": pa.array([None] * len(some) + reps[b].tolist(), pa.int64()),
                "n": np.concatenate([count[some].astype(np.int64), np.zeros(len(a), np.int64)]),
                "k": np.concatenate([links[some], np.zeros(len(a), np.int64)]),
            }
        )

    return run


def _local(reps: np.ndarray, near: pa.Array) -> np.ndarray:
    """Neighbour lists as positions in the sorted ``reps``, those elsewhere left out."""
    flat = near.flatten().to_numpy(zero_copy_only=False)
    sizes = np.diff(near.offsets.to_numpy())
    at = np.minimum(np.searchsorted(reps, flat), len(reps) - 1)
    here = reps[at] == flat
    row = np.repeat(np.arange(len(reps)), sizes)[here]
    at = at[here]
    # Links lead both ways.
    ends = np.unique(np.concatenate([row * len(reps) + at, at * len(reps) + row]))
    row, at = np.divmod(ends, len(reps))
    degree = np.bincount(row, minlength=len(reps))
    out = np.full((len(reps), max(1, int(degree.max(initial=0)))), -1, np.int64)
    out[row, np.arange(len(row)) - np.repeat(np.cumsum(degree) - degree, degree)] = at
    return out


def _padded(shards: pa.Array) -> np.ndarray:
    """Lists of numbers as rows of one width, filled up with -1."""
    sizes = np.diff(shards.offsets.to_numpy())
    out = np.full((len(shards), max(1, int(sizes.max(initial=0)))), -1, np.int64)
    at = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[np.repeat(np.arange(len(shards)), sizes), at] = shards.flatten().to_numpy()
    return out


def _first_common(shards: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The least shard that both vectors of each pair are in."""
    none = np.iinfo(np.int64).max
    out = np.full(len(low), none)
    for a in shards.T:
        for b in shards.T:
            x = a[low]
            out = np.minimum(out, np.where((x == b[high]) & (x >= 0), x, none))
    return out


def _forest(low: np.ndarray, high: np.ndarray, count: int):
    """Links of every connected vector to the least one of its component."""
    least = np.arange(count)
    while True:
        before = least.copy()
        both = np.minimum(least[low], least[high])
        np.minimum.at(least, low, both)
        np.minimum.at(least, high, both)
        least = least[least]
        if (least == before).all():
            break
    rest = np.flatnonzero(least < np.arange(count))
    return least[rest], rest


def _queries(classes: DataFrame) -> DataFrame:
    """The audit's queries: the ids divisible by ``AUDIT_EVERY``, of a small table all."""
    if classes.count() > AUDIT_ALL:
        return classes.filter(F.col("rep") % AUDIT_EVERY == 0)
    return classes


def _audited(classes: DataFrame, cosine: float, queries: DataFrame | None = None) -> DataFrame:
    """rep and the number of classes linked with it, by brute force, for those of
    ``queries``, by default the audit's, that have any.

    The queries go through all vectors in blocks of ``AUDIT_BYTES``, so that neither the
    driver nor a task holds more of them at a time.
    """
    queries = _queries(classes) if queries is None else queries
    parts, block, held = [], [], 0
    for row in queries.select("rep", "label", "dims", "vector").toLocalIterator():
        block.append(row)
        held += len(row["vector"])
        if held >= AUDIT_BYTES:
            parts.append(_true_links(classes, block, cosine))
            block, held = [], 0
    parts.append(_true_links(classes, block, cosine))
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    return every.groupBy("rep").agg(F.sum("true").alias("true"))


def _true_links(classes: DataFrame, block: list, cosine: float) -> DataFrame:
    """rep and true, the links that each query of ``block`` has in a part of the vectors."""
    queries: dict = {}
    for row in block:
        queries.setdefault((row["label"], row["dims"]), []).append(row)
    packed = {
        key: (np.array([r["rep"] for r in rows]), _unit(np.stack([np.frombuffer(r["vector"]) for r in rows])))
        for key, rows in queries.items()
    }
    sent = classes.sparkSession.sparkContext.broadcast(packed)

    def run(batches):
        for batch in batches:
            column = lambda name: batch.column(batch.schema.get_field_index(name))
            labels, dims, reps = (column(name).to_numpy() for name in ("label", "dims", "rep"))
            for key, (ids, wanted) in sent.value.items():
                rows = np.flatnonzero((labels == key[0]) & (dims == key[1]))
                true = np.zeros(len(ids), np.int64)
                for i in range(0, len(rows), _AUDIT_BLOCK):
                    some = rows[i : i + _AUDIT_BLOCK]
                    vectors = _unit(_matrix(column("vector").take(pa.array(some))))
                    rough = vectors.astype(np.float32)
                    for j in range(0, len(ids), _AUDIT_BLOCK):
                        asked = wanted[j : j + _AUDIT_BLOCK]
                        v, q = np.nonzero(rough @ asked.astype(np.float32).T >= cosine - 1e-4)
                        other = reps[some[v]] != ids[j + q]
                        v, q = v[other], q[other]
                        for k in range(0, len(v), 4096):
                            x, y = v[k : k + 4096], q[k : k + 4096]
                            linked = np.einsum("nd,nd->n", vectors[x], asked[y]) >= cosine
                            np.add.at(true, j + y[linked], 1)
                hit = np.flatnonzero(true)
                if len(hit):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids[hit]), pa.array(true[hit])], names=["rep", "true"]
                    )

    found = materialize(classes.mapInArrow(run, "rep long, true long"), "audit")
    sent.unpersist()
    return found


def measured_recall(truth: DataFrame, counts: DataFrame) -> dict[str, float] | None:
    """Recall of the audit per link, per query and per group, None if no query has a link.

    Per query every one counts the same, however many links it has; per group a query
    counts by the share that it is of itself and those it is linked with, so that a large
    group weighs no more than a pair.
    """
    share = F.least(F.coalesce("links", F.lit(0)) / F.col("true"), F.lit(1.0))
    weight = 1 / (F.col("true") + 1)
    row = truth.join(counts.select("rep", "links"), "rep", "left").agg(
        (F.sum(share * F.col("true")) / F.sum("true")).alias("link"),
        F.avg(share).alias("query"),
        (F.sum(share * weight) / F.sum(weight)).alias("group"),
    ).first()
    return None if row["link"] is None else row.asDict()


def near_duplicates(
    rows: DataFrame,
    cosine: float = COSINE,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """id, n_links, component for every row of ``rows``.

    Rows link if labels are equal and not null and the cosine, in doubles, is at least
    ``cosine``; n_links counts the other rows linked directly, component is the smallest
    id reachable. Vectors that are null, zero, empty, or hold null or non-finite
    components link with nothing, nor do those of another number of dimensions. Equal
    vectors are one node of the graph and link with each other. Rows of equal ids count
    each; rows without id have no links and no component.
    """
    named = rows.select(key, vector, label)
    clean = _clean(named, key, vector, label)
    packed = clean.mapInArrow(_packed, "id long, label long, dims int, vector binary")
    packed = materialize(packed, "vectors")
    classes = materialize(
        packed.groupBy("label", "dims", "vector").agg(
            F.min("id").alias("rep"), F.count(F.lit(1)).alias("size")
        ).groupBy("label", "dims", "rep", "vector").agg(F.sum("size").alias("size")),
        "vector-classes",
    )
    centers = _fit_centers(classes)
    truth = materialize(_audited(classes, cosine), "audit")
    measured = not truth.isEmpty()
    for step in range(AUDIT_ROUNDS):
        found = _linked(classes, centers, 2**step, cosine)
        counts = found.filter("b is null").groupBy(F.col("a").alias("rep")).agg(
            F.sum("n").alias("n"), F.sum("k").alias("links")
        )
        if not measured:
            # Near copies are rare: those that the search has met are audited in place.
            linked = materialize(
                counts.orderBy(F.xxhash64("rep")).limit(AUDIT_LINKED).select("rep"), "audit-linked"
            )
            truth = materialize(_audited(classes, cosine, classes.join(linked, "rep")), "audit")
            measured = not truth.isEmpty()
        recall = measured_recall(truth, counts)
        _log.info("recall per link, query and group: %s", recall)
        if recall is None or min(recall.values()) >= AUDIT_RECALL:
            break
    if recall is None:
        _log.info("no links: neither the audit's queries nor the search found any")
    elif min(recall.values()) < LEAST_RECALL:
        raise RuntimeError(f"recall stays below {LEAST_RECALL}: {recall}")
    elif min(recall.values()) < AUDIT_RECALL:
        warnings.warn(f"recall stays below {AUDIT_RECALL}: {recall}")
    parts = components(found.filter("b is not null"))
    summary = (
        classes.select("label", "dims", "vector", "rep", "size")
        .join(counts.drop("links"), "rep", "left")
        .join(parts.withColumnRenamed("node", "rep"), "rep", "left")
        .select(
            "label", "dims", "vector",
            (F.coalesce("n", F.lit(0)) + F.col("size") - 1).alias("n_links"),
            F.coalesce("component", "rep").alias("component"),
        )
    )
    linked = packed.join(summary, ["label", "dims", "vector"]).select("id", "n_links", "component")
    alone = _alone(named, key, vector, label).select(
        F.col(key).cast("long").alias("id"),
        F.lit(0).cast("long").alias("n_links"),
        F.col(key).cast("long").alias("component"),
    )
    return linked.unionByName(alone)


def _alone(rows: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """The rows that ``_clean`` leaves out."""
    values = F.col(vector).cast("array<double>")
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return rows.filter(
        F.col(key).isNull()
        | F.col(label).isNull()
        | F.col(vector).isNull()
        | F.coalesce(F.exists(values, bad), F.lit(True))
        | ~F.coalesce(F.exists(values, lambda x: x != 0), F.lit(False))
    )


def _linked(classes: DataFrame, centers: Centers, times: int, cosine: float) -> DataFrame:
    """Links and their numbers, by ``times`` the usual overlap, beam, degree and pool."""
    dealt = materialize(_deal(classes, centers, times * OVERLAP), "dealt")
    tasks = materialize(_tasks(dealt), "shards")
    lists = tasks.select(*_TASK, "rep", "vector").groupBy(*_TASK).applyInArrow(
        _build(times * DEGREE, times * POOL), "rep long, near array<long>"
    )
    graph = lists.groupBy("rep").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))
    found = (
        tasks.join(materialize(graph, "graph"), "rep")
        .groupBy(*_TASK)
        .applyInArrow(_search(times * BEAM, cosine), "a long, b long, n long, k long")
    )
    return materialize(found, "found")


def group_vectors(rows: DataFrame) -> DataFrame:
    """vec_id, n_links, component_id and kept for every vector."""
    found = near_duplicates(rows)
    return found.select(
        F.col("id").alias("vec_id"),
        "n_links",
        F.col("component").alias("component_id"),
        F.col("id").eqNullSafe(F.col("component")).alias("kept"),
    )
