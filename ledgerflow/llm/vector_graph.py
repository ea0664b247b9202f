"""Near-duplicate vectors through a robust-pruned flat graph.

Equal vectors of a label are one class. The classes are dealt to overlapping
shards: each belongs to its nearest centre and visits every centre of a lower
number whose vectors can lie within the threshold's angle of it, so any two
vectors that can be linked share a shard, however many centres there are. Each
shard builds a graph over its own vectors whose neighbour lists are
robust-pruned (a candidate is dropped where a chosen neighbour is closer to it
than the vector itself). A visitor whose nearest own vector is within the
threshold joins the graph by such a list; the others are done with there. Then
every vector searches its shards: greedily from the medoid to its own
neighbourhood, from there and from its list in ever wider range until no
vector within reach is new. What it meets is verified by cosine in double
precision. ``audit`` measures the recall against brute force.

A shard with more vectors than a task should hold is cut into blocks of its
own vectors and of visitors; every two blocks of which one is its own are a
task of their own. Where vectors have no clusters, a vector visits most
centres, so the visits grow with the square of a label's vectors. A visit
without a partner costs one product with the block's vectors, and no graph.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.common import join_by_key, stage
from ledgerflow.llm.components import connected

COSINE = 0.93
#: Vectors that a shard should own, and about the most that one block of it holds.
SHARD = 512
BLOCK = 1024
#: Rounding that the margin between two centres allows for.
SLACK = 1e-6
#: Centres are drawn from at most so many vectors and number at most CENTRES (256 bytes each with 64 components).
SAMPLE = 16_384
CENTRES = 4096
DEGREE = 16
CANDIDATES = 48
RANDOM_LINKS = 8
#: How much closer than the vector itself a chosen neighbour must be for a candidate to be dropped.
ALPHA = 1.2
#: The search goes on from vectors whose cosine is at least this much below the threshold.
REACH = 0.10
HOPS = 40


def _unit(vectors: list) -> np.ndarray:
    x = np.asarray(vectors, np.float64)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def usable(vectors: DataFrame, keep: bool = False) -> DataFrame:
    """(vec_id, label, dim, hi, lo, ok) per row, and the embedding with ``keep``; hi and lo are the same for equal vectors, ok tells the rows that can be linked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dim, hi, lo, ok = [], [], [], []
            for vec_id, label, v in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                fine = vec_id is not None and label is not None and bool(v) and None not in v
                x = np.asarray(v if fine else [], np.float64) + 0.0  # no negative zero
                with np.errstate(over="ignore"):
                    fine = fine and bool(np.isfinite(x).all()) and bool(x.any()) and bool(np.isfinite(x @ x)) and (x @ x) > 0
                d = xxhash.xxh3_128_digest(x.tobytes())
                dim.append(len(x))
                hi.append(int.from_bytes(d[:8], "little", signed=True))
                lo.append(int.from_bytes(d[8:], "little", signed=True))
                ok.append(fine)
            cols = [pa.array(dim, pa.int32()), pa.array(hi, pa.int64()), pa.array(lo, pa.int64()), pa.array(ok, pa.bool_())]
            names = ["vec_id", "label", "dim", "hi", "lo", "ok"]
            if keep:
                cols, names = [*cols, batch.column(2)], [*names, "embedding"]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *cols], names=names)

    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), F.col("embedding").cast("array<double>").alias("embedding"))
    return rows.mapInArrow(run, "vec_id bigint, label string, dim int, hi bigint, lo bigint, ok boolean" + (", embedding array<double>" if keep else ""))


def centres(classes: DataFrame) -> dict[tuple[str, int], np.ndarray]:
    """Unit centres per (label, dim): vectors drawn evenly by their hash, as many as the label's share of the shards."""
    sizes = {(r["label"], r["dim"]): r["n"] for r in classes.groupBy("label", "dim").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "label", "dim").limit(CENTRES).collect()}
    total = max(sum(sizes.values()), 1)
    wanted = min(total // SHARD + 1, CENTRES)
    sample = classes.orderBy(F.xxhash64("embedding"), "vec_id").limit(SAMPLE).select("vec_id", "label", "dim", "embedding").toPandas()
    out = {}
    for key, group in sample.groupby(["label", "dim"], sort=True):
        k = min(max(1, round(wanted * sizes.get(key, 0) / total)), len(group))
        x = _unit(group["embedding"].tolist())
        out[key] = _spread(x, k)
    return out


def _spread(x: np.ndarray, k: int, rounds: int = 4) -> np.ndarray:
    """Spherical k-means from k evenly taken vectors."""
    c = x[np.linspace(0, len(x) - 1, k).astype(int)]
    for _ in range(rounds):
        own = (x @ c.T).argmax(axis=1)
        for j in range(k):
            if (own == j).any():
                m = x[own == j].sum(axis=0)
                c[j] = m / max(np.linalg.norm(m), 1e-12)
    return c


def _visits(x: np.ndarray, c: np.ndarray, threshold: float) -> tuple[np.ndarray, list[list[int]]]:
    """Per unit vector the nearest centre, and the centres of lower numbers that can be nearest to a vector within the threshold.

    A vector that is nearer to centre j lies beyond the plane between j and
    the own centre, so no closer than that plane: where the angle to the plane
    exceeds the threshold's angle, j holds no partner.
    """
    reach = np.sqrt(1 - threshold**2) if threshold > 0 else np.inf
    own, visits = np.zeros(len(x), np.int64), []
    for a in range(0, len(x), 256):
        sim = x[a : a + 256] @ c.T
        best = sim.argmax(axis=1)
        own[a : a + 256] = best
        between = np.sqrt(np.maximum(2 - 2 * (c[best] @ c.T), 0.0))
        near = sim[np.arange(len(sim)), best][:, None] - sim <= reach * between + SLACK
        visits += [np.flatnonzero(n[:o]).tolist() for n, o in zip(near, best, strict=True)]
    return own, visits


def sharded(classes: DataFrame, threshold: float = COSINE) -> DataFrame:
    """``classes`` with owner, the number of the nearest centre, and shards, ascending: the owner and the centres visited."""
    held = classes.sparkSession.sparkContext.broadcast(centres(classes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = held.value
        for batch in batches:
            owners = [0] * batch.num_rows
            shards: list = [[0]] * batch.num_rows
            labels, dims, vectors = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("label", "dim", "embedding"))
            groups: dict = {}
            for i, key in enumerate(zip(labels, dims, strict=True)):
                groups.setdefault(key, []).append(i)
            for key, at in groups.items():
                if (c := known.get(key)) is not None and len(c) > 1:
                    own, visits = _visits(_unit([vectors[i] for i in at]), c, threshold)
                    for i, o, v in zip(at, own.tolist(), visits, strict=True):
                        owners[i], shards[i] = o, [*v, o]
            cols = [*batch.columns, pa.array(owners, pa.int32()), pa.array(shards, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(cols, names=[*batch.schema.names, "owner", "shards"])

    schema = "label string, dim int, vec_id bigint, copies bigint, embedding array<double>, owner int, shards array<int>"
    return classes.mapInArrow(run, schema)


def _pruned(x: np.ndarray, seed: int, q: np.ndarray | None = None) -> np.ndarray:
    """Neighbour lists among ``x`` (rows of DEGREE, -1 where shorter) of each vector in ``q``, or in ``x`` itself: its candidates from near to far, less those that a chosen one covers."""
    itself = q is None
    q = x if q is None else q
    n = len(x)
    out = np.full((len(q), DEGREE), -1, np.int64)
    near = min(CANDIDATES, n - itself)
    if near < 1:
        return out
    rng = np.random.RandomState(seed % (2**32))
    for a in range(0, len(q), 512):
        rows = np.arange(a, min(a + 512, len(q)))
        sim = q[rows] @ x.T
        if itself:
            sim[np.arange(len(rows)), rows] = -np.inf
        top = np.argpartition(-sim, near - 1, axis=1)[:, :near]
        top = np.concatenate([top, rng.randint(0, n, (len(rows), RANDOM_LINKS))], axis=1)
        value = np.take_along_axis(sim, top, 1)
        order = np.argsort(-value, axis=1, kind="stable")
        top, value = np.take_along_axis(top, order, 1), np.take_along_axis(value, order, 1)
        y = x[top]
        covers = ALPHA * (1 - y @ y.transpose(0, 2, 1)) <= 1 - value[:, None, :]  # by row: candidate, candidate after it
        covers |= top[:, :, None] == top[:, None, :]
        picked = np.zeros(top.shape, bool)
        for r in range(top.shape[1]):
            picked[:, r] = ~(picked & covers[:, :, r]).any(axis=1) & (picked.sum(axis=1) < DEGREE) & np.isfinite(value[:, r])
        row, r = np.nonzero(picked)
        out[rows[row], picked.cumsum(axis=1)[row, r] - 1] = top[row, r]
    return out


def _both_ways(x: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Directed edges (from, to) of the pruned graph over ``x``, both ways, each once."""
    edges = _pruned(x, seed)
    a, k = np.nonzero(edges >= 0)
    b = edges[a, k]
    pair = np.unique(np.concatenate([a * len(x) + b, b * len(x) + a]))
    return pair // max(len(x), 1), pair % max(len(x), 1)


def build_block(part: pd.DataFrame) -> pd.DataFrame:
    """Lists (vec_id, neighbours) of the graph over one block of a shard's own vectors."""
    part = part.sort_values("vec_id", kind="stable")
    ids = part["vec_id"].to_numpy()
    a, b = _both_ways(_unit(part["embedding"].tolist()), int(part["shard"].iloc[0]) + 1)
    if not len(a):
        return pd.DataFrame({"vec_id": np.zeros(0, np.int64), "neighbours": np.zeros(0, object)})
    return pd.DataFrame({"vec_id": ids, "neighbours": np.split(ids[b], np.searchsorted(a, np.arange(1, len(ids))))})


def _cosines(y: np.ndarray, q: np.ndarray, x: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Of every pair (q, v), the cosine of vector q in ``y`` and vector v in ``x``."""
    steps = range(0, len(q), 50_000)
    return np.concatenate([np.einsum("ij,ij->i", y[q[a : a + 50_000]], x[v[a : a + 50_000]]) for a in steps] or [np.zeros(0)])


def _listed(ends: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the list entries of the nodes ``of`` (node i's entries lie between ends[i] and ends[i + 1]), and for each the place in ``of``."""
    count = ends[of + 1] - ends[of]
    place = np.repeat(np.arange(len(of)), count)
    return np.arange(len(place)) - (np.cumsum(count) - count - ends[of])[place], place


def _expand(x: np.ndarray, a: np.ndarray, b: np.ndarray, y: np.ndarray, q: np.ndarray, v: np.ndarray, itself: bool, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, met) at or above the threshold that the queries ``y`` meet in the graph over ``x`` with edges (a, b), by a.

    (q, v) are the neighbours that each query starts from; with ``itself`` the
    first queries are the vectors of the graph and don't meet themselves.
    """
    n, m = len(x), len(y)
    if not n or not m:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    ends = np.searchsorted(a, np.arange(n + 1))
    queries = np.arange(m)
    # greedy from the medoid
    here = np.full(m, int((x @ x.mean(axis=0)).argmax()))
    value = _cosines(y, queries, x, here)
    moving = queries
    for _ in range(HOPS):
        moving = moving[ends[here[moving] + 1] > ends[here[moving]]]
        if not len(moving):
            break
        at, place = _listed(ends, here[moving])
        sim = _cosines(y, moving[place], x, b[at])
        best = np.maximum.reduceat(sim, np.searchsorted(place, np.arange(len(moving))))
        at, place = at[sim == best[place]], place[sim == best[place]]
        to = b[at[np.searchsorted(place, np.arange(len(moving)))]]
        better = best > value[moving]
        moving = moving[better]
        here[moving], value[moving] = to[better], best[better]
    # ranges grow from there, and from the query's own neighbours
    seen = np.zeros((m, n), bool)
    if itself:
        seen[np.arange(n), np.arange(n)] = True
    pair = np.unique(np.concatenate([queries * n + here, q * n + v]))
    q, v = pair // n, pair % n
    fresh = ~seen[q, v]
    q, v = q[fresh], v[fresh]
    seen[q, v] = True
    from_q, from_v = queries, here  # ranges grow from here even where it lies out of reach
    hit_q, hit_v = [], []
    while len(q) or len(from_q):
        sim = _cosines(y, q, x, v)
        hit_q.append(q[sim >= threshold])
        hit_v.append(v[sim >= threshold])
        go = sim >= threshold - REACH
        q, v = np.concatenate([from_q, q[go]]), np.concatenate([from_v, v[go]])
        from_q = from_v = queries[:0]
        new = []
        for k in range(0, len(q), 20_000):
            at, place = _listed(ends, v[k : k + 20_000])
            qq, to = q[k : k + 20_000][place], b[at]
            ok = ~seen[qq, to]
            pair = np.unique(qq[ok] * n + to[ok])
            seen[pair // n, pair % n] = True
            new.append(pair)
        pair = np.concatenate(new) if new else q[:0]
        q, v = pair // n, pair % n
    return np.concatenate(hit_q), np.concatenate(hit_v)


def _partnered(x: np.ndarray, y: np.ndarray, threshold: float) -> np.ndarray:
    """Whether each vector of ``y`` has any of ``x`` at or above the threshold."""
    return np.concatenate([(y[a : a + 512] @ x.T).max(axis=1) >= threshold - SLACK for a in range(0, len(y), 512)] or [np.zeros(0, bool)])


def search_block(part: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """(vec_id, links, root) of one task; root spans the pairs found.

    The graph is that of the own vectors in block ``one``. They search it
    where the task is that block's; otherwise, those of block ``other`` do.
    What is not in the graph joins it by a pruned list of its neighbours there
    if its nearest one is within the threshold, and is done with if not. Two
    vectors that share shards meet in the one whose own vector has the lower
    owner: there, one of them is own and the other own or a visitor.
    """
    part = part.sort_values("vec_id", kind="stable")
    n = len(part)
    ids, copies, block, owner = (part[c].to_numpy() for c in ("vec_id", "copies", "block", "owner"))
    shard, one, two = int(part["shard"].iloc[0]), part["one"].iloc[0], part["one"].iloc[0] != part["other"].iloc[0]
    x = _unit(part["embedding"].tolist())
    base = np.flatnonzero((owner == shard) & (block == one))
    visitors = np.flatnonzero((block != one) if two else (owner != shard))
    if not len(base):
        return pd.DataFrame({"vec_id": ids[:0], "links": np.zeros(0, np.int64), "root": ids[:0]})
    visitors = visitors[_partnered(x[base], x[visitors], threshold)]
    given = [np.asarray(e if e is not None else [], np.int64) for e in part["neighbours"].iloc[base]]
    a, b = np.repeat(np.arange(len(base)), [len(e) for e in given]), np.searchsorted(ids[base], np.concatenate(given))
    k, r = np.nonzero((lists := _pruned(x[base], shard + 1, x[visitors])) >= 0)
    v = lists[k, r]
    queries = visitors
    if not two:
        queries = np.concatenate([base, visitors])
        k, v = np.concatenate([a, k + len(base)]), np.concatenate([b, v])
    q, v = _expand(x[base], a, b, x[queries], k, v, not two, threshold)
    links = np.zeros(n, np.int64)
    root = np.arange(n)
    if len(q):
        q, v = queries[q], base[v]
        pair = np.unique(np.minimum(q, v) * n + np.maximum(q, v))
        a, b = pair // n, pair % n
        np.add.at(links, a, copies[b])
        np.add.at(links, b, copies[a])
        root = _roots(n, a, b)
    keep = (links > 0) | (root != np.arange(n))
    return pd.DataFrame({"vec_id": ids[keep], "links": links[keep], "root": ids[root[keep]]})


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each index."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def near_duplicates(vectors: DataFrame, threshold: float = COSINE) -> DataFrame:
    """Per row of ``vectors``: vec_id, n_links, component_id, kept.

    Needs vec_id, embedding and label; other columns are ignored. Vectors are
    linked when their labels are equal and not null and their cosine is at
    least ``threshold``. n_links counts the other rows linked directly, equal
    vectors included; component_id is the smallest vec_id reachable. A vector
    that is null, empty, zero or holds null or non-finite components, and one
    of another length, links with nothing; so does a row without vec_id (no
    component_id, kept). Rows that repeat a vec_id are rows of their own: with
    different vectors or labels each has its own links and component. An
    empty table gives an empty result.
    """
    rows = stage(usable(vectors), "vectors-rows")
    n_rows = rows.count()
    key = ["label", "dim", "hi", "lo"]
    # within the graph vec_id is a class's own number: several classes may have one least_id
    grouped = rows.filter("ok").groupBy(*key).agg(F.min("vec_id").alias("least_id"), F.count("*").alias("copies"))
    groups = stage(grouped.withColumn("vec_id", F.monotonically_increasing_id()), "vectors-groups")
    # the vector itself, from a row whose id is its class's least
    full = usable(vectors, keep=True).filter("ok").withColumnRenamed("vec_id", "least_id")
    classes = stage(
        full.join(groups, [*key, "least_id"])
        .dropDuplicates(["vec_id"])
        .select("label", "dim", "vec_id", "copies", "embedding"),
        "vectors-classes",
    )
    dealt = stage(sharded(classes, threshold), "vectors-sharded")
    lies = dealt.withColumn("shard", F.explode("shards")).drop("shards").withColumn("mine", F.col("owner") == F.col("shard"))
    where = ["label", "dim", "shard"]
    n_own, n = F.count_if("mine"), F.count("*")
    whole = n <= BLOCK  # one block for all
    sizes = (
        lies.groupBy(*where)
        .agg(
            F.when(whole, 1).otherwise(F.ceil(n_own / BLOCK)).cast("int").alias("own_blocks"),
            F.when(whole, 0).otherwise(F.ceil((n - n_own) / BLOCK)).cast("int").alias("visitor_blocks"),
            n_own.alias("n_own"),
        )
        .filter("n_own > 0")
    )
    hashed = F.xxhash64("embedding")  # of the vector, so that reruns agree
    placed = (
        lies.join(F.broadcast(sizes), where)  # at most CENTRES rows and one per label
        .withColumn("block", F.when(F.col("mine") | (F.col("visitor_blocks") == 0), F.pmod(hashed, "own_blocks")).otherwise(F.col("own_blocks") + F.pmod(hashed, "visitor_blocks")).cast("int"))
    )
    lists = placed.filter("mine").groupBy(*where, "block").applyInPandas(build_block, "vec_id bigint, neighbours array<bigint>")
    graph = stage(lists, "vectors-graph")  # a vector has one block of its own shard
    # visitors need no lists; those of a vector's own shard lead to vectors that are not in this graph
    visitors = placed.filter("not mine").withColumn("neighbours", F.lit(None).cast("array<bigint>"))
    tasks = (
        placed.filter("mine").join(graph, "vec_id", "left").unionByName(visitors)
        .withColumn("with", F.explode(F.sequence(F.lit(0), F.when(F.col("block") < F.col("own_blocks"), F.col("own_blocks") + F.col("visitor_blocks")).otherwise(F.col("own_blocks")) - 1)))
        .withColumn("one", F.least("block", "with"))
        .withColumn("other", F.greatest("block", "with"))
        .select(*where, "one", "other", "block", "vec_id", "copies", "embedding", "owner", "neighbours")
    )
    met = stage(
        tasks.groupBy(*where, "one", "other").applyInPandas(lambda part: search_block(part, threshold), "vec_id bigint, links bigint, root bigint"),
        "vectors-met",
    )
    found = connected(met.select(F.col("vec_id").alias("a"), F.col("root").alias("b")))
    counts = met.groupBy("vec_id").agg(F.sum("links").alias("links"))
    in_component = groups.join(found.withColumnRenamed("id", "vec_id"), "vec_id", "left").withColumn("component", F.coalesce("component", "vec_id"))
    least = in_component.groupBy("component").agg(F.min("least_id").alias("component_id"))  # one row a class at most, map-side combined
    of_group = stage(
        in_component.join(counts, "vec_id", "left")
        .join(least, "component")
        .select(*key, "copies", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"),
        "vectors-of-group",
    )
    linked = join_by_key(rows.filter("ok").select("vec_id", *key), n_rows, of_group, key, "copies").select("vec_id", "n_links", "component_id")
    alone = rows.filter("not ok").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def audit(vectors: DataFrame, result: DataFrame, threshold: float = COSINE, every: int = 50, block: int = 4096) -> DataFrame:
    """One row (queries, found, present, recall): links found against brute force, for the rows whose vec_id is divisible by ``every`` against all rows, in blocks."""
    good = usable(vectors).filter("ok").select("vec_id", "label", "dim")
    full = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), F.col("embedding").cast("array<double>").alias("embedding"))
    rows = full.join(good, ["vec_id", "label"])
    n_blocks = rows.groupBy("label", "dim").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    dealt = rows.join(F.broadcast(n_blocks), ["label", "dim"]).withColumn("rows", F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int"))
    asked = dealt.filter(F.col("vec_id") % every == 0).withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    queries = asked.select("label", "dim", "with", "vec_id", "embedding").toDF("q_label", "q_dim", "q_with", "vec_id", "embedding")

    def present(key, q: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(r):
            return pd.DataFrame({"vec_id": np.zeros(0, np.int64), "present": np.zeros(0, np.int64)})
        sim = _unit(q["embedding"].tolist()) @ _unit(r["embedding"].tolist()).T >= threshold
        sim &= q["vec_id"].to_numpy()[:, None] != r["vec_id"].to_numpy()[None, :]
        return pd.DataFrame({"vec_id": q["vec_id"], "present": sim.sum(axis=1)})

    brute = (
        queries.groupBy("q_label", "q_dim", "q_with")
        .cogroup(dealt.groupBy("label", "dim", "rows"))
        .applyInPandas(present, "vec_id bigint, present bigint")
        .groupBy("vec_id")
        .agg(F.sum("present").alias("present"))
    )
    both = brute.join(result.select("vec_id", "n_links"), "vec_id")
    return both.agg(
        F.count("*").alias("queries"), F.sum("n_links").alias("found"), F.sum("present").alias("present"), (F.sum("n_links") / F.sum("present")).alias("recall")
    )
