"""Approximate nearest neighbours by cosine: NN-descent builds a neighbour graph, queries search it greedily.

Build: equal vectors are one node, so that copies cost nothing; which rows a node stands for is kept beside. First links come from
``FORESTS`` orders by random hyperplanes: the signs of a vector's products with them make a code, nodes are sorted by
it and compared within blocks of ``BLOCK`` neighbours. Then rounds of NN-descent: every node joins its neighbours with each
other (pairs with a link that is new since the last round) and with itself, as each is a neighbour's neighbour of
the others; a node keeps the ``NEIGHBOURS`` best it has met. It ends when fewer than ``SETTLED`` of the links are
new, or after ``ROUNDS`` rounds.

Search: a query starts at ``ENTRIES`` nodes drawn by hash and keeps the ``BEAM`` best nodes met. In a round it expands the
best ``EXPAND`` of them that it has not expanded yet: their neighbours, in both directions of links, are scored and
compete for the beam. It ends when all its beam is expanded. The beam's nodes are
then scored in double precision on the original vectors, and stand for all their rows.

Graph and beam use vectors rounded to 8 and 16 bits, whose products are exact integers, so that every
task gives a pair the same score. The hyperplanes and entries are the only sampled things; every row is indexed.

* null id; null, empty or zero vector; null or non-finite component: the row takes no part
* vectors of several lengths: those of the commonest length take part (ties: the shorter)
* ties in score: smaller id; repeated rows count once; a repeated id with another vector is one more candidate and query
* fewer candidates than wanted: all that are found; empty table: empty result; other columns are ignored

At scale a round shuffles the neighbours' rounded vectors once per link of a node that has new ones. What a task
finds is reduced to the best per node before it is shuffled, so a node that many have as a neighbour needs no task of its own; joins on such nodes
can be split. Nothing is broadcast but the hyperplanes and the entries, both of fixed size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfscan.sources.shipping import ship
from shelfscan.sources.staging import stage

NEIGHBOURS = 32
FORESTS = 4
BLOCK = 512
PLANES = 20
ROUNDS = 4
SETTLED = 0.03
ENTRIES = 256
BEAM = 192
EXPAND = 96
_HELD = 1 << 20
_LINKS = "u long, w long, s double, fresh boolean"
_GRAPH = "node long, small binary, scale double, ws array<long>, ss array<double>, news array<boolean>"
_BEAM = "query long, qvec binary, ids array<long>, scores array<double>, done array<boolean>, next array<long>"


def usable(df: DataFrame, id_col: str, vector_col: str, asked: Column | None = None) -> DataFrame:
    """id and vector (doubles) of the rows that take part, and whether they are queries."""
    vector = F.col(vector_col).cast("array<double>")
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    asked = F.coalesce(asked, F.lit(False)) if asked is not None else F.lit(True)
    rows = df.select(F.col(id_col).alias("id"), vector.alias("vector"), asked.alias("asked")).where(
        F.col("id").isNotNull() & F.col("vector").isNotNull() & ~F.exists("vector", bad) & F.exists("vector", lambda x: x != 0)
    )
    lengths = rows.groupBy(F.size("vector").alias("n")).agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("rows"), "n").limit(1).collect()
    return rows.where(F.size("vector") == (lengths[0]["n"] if lengths else 0))


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of equally long lists (of doubles)."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.empty((0, 0))


def units(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)  # no overflow or underflow in squares
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _bytes(rows: np.ndarray) -> pa.Array:
    rows = np.ascontiguousarray(rows)
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(rows.shape[1] * rows.itemsize), len(rows), [None, pa.py_buffer(rows)]).cast(pa.binary())


def _rows(column: pa.Array, kind: str) -> np.ndarray:
    """Equally long binary values as rows of floats, whose products are exact."""
    if not len(column):
        return np.empty((0, 0))
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, dtype=np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, dtype=np.uint8)[ends[0] : ends[-1]].view(kind).reshape(len(column), -1).astype(np.float64)


def _sixteen(vectors: np.ndarray) -> np.ndarray:
    return np.rint(units(vectors) * 32767).astype("<i2")


def nodes_of(rows: DataFrame) -> DataFrame:
    """One row per distinct vector: node, vector, small (8 bits) and its scale, fine (16 bits), copies, id (the smallest)."""
    found = rows.groupBy("vector").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"))
    found = found.withColumn("node", F.monotonically_increasing_id())

    def rounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                vectors = matrix(batch.column("vector"))
                fine = _sixteen(vectors)
                scale = np.abs(fine).max(axis=1) / 127.0
                small = np.rint(fine / scale[:, None]).astype("i1")
                columns = [*batch.columns, _bytes(small), pa.array(scale / 32767), _bytes(fine)]
                yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "small", "scale", "fine"])

    kind = rows.schema["id"].dataType.simpleString()
    return stage(found.mapInArrow(rounded, f"vector array<double>, id {kind}, copies long, node long, small binary, scale double, fine binary"), "nodes")


def _best(u: np.ndarray, w: np.ndarray, s: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best distinct w of every u; ties to the smaller w."""
    order = np.lexsort((w, -s, u))
    u, w = u[order], w[order]
    new = np.append(True, (u[1:] != u[:-1]) | (w[1:] != w[:-1]))  # a pair has one score, so its repeats are neighbours
    order, u = order[new], u[new]
    starts = np.flatnonzero(np.append(True, u[1:] != u[:-1]))
    rank = np.arange(len(u)) - np.repeat(starts, np.diff(np.append(starts, len(u))))
    return order[rank < k]


class _Held:
    """Candidates of a task, reduced to the best of every node as they come."""

    def __init__(self, k: int):
        self.k, self.parts, self.size = k, [], 0

    def add(self, u: np.ndarray, w: np.ndarray, s: np.ndarray) -> None:
        self.parts.append((u, w, s))
        self.size += len(u)

    def emptied(self, last: bool = False) -> Iterator[pa.RecordBatch]:
        if self.size and (last or self.size > _HELD):
            u, w, s = (np.concatenate(c) for c in zip(*self.parts, strict=True))
            best = _best(u, w, s, self.k)
            self.parts, self.size = [], 0
            for at in range(0, len(best), 1 << 16):
                part = best[at : at + (1 << 16)]
                columns = [pa.array(u[part]), pa.array(w[part]), pa.array(s[part]), pa.array(np.ones(len(part), dtype=bool))]
                yield pa.RecordBatch.from_arrays(columns, ["u", "w", "s", "fresh"])


def _first_links(nodes: DataFrame, k: int, forests: int, block: int) -> DataFrame:
    """Links within blocks of nodes that random hyperplanes put side by side."""

    def coded(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            fine = _rows(batch.column("fine"), "<i2")
            for t in range(forests):
                planes = np.random.default_rng(t).standard_normal((fine.shape[1], PLANES))
                code = (fine @ planes > 0) @ (1 << np.arange(PLANES)[::-1])
                columns = [pa.array(np.full(len(code), t, dtype=np.int32)), pa.array(code), *batch.select(["node", "small", "scale"]).columns]
                yield pa.RecordBatch.from_arrays(columns, ["t", "code", "node", "small", "scale"])

    def linked(batches):
        held = _Held(k)

        def compare(node, small, scale):
            rows = _rows(small, "i1")
            s = (rows @ rows.T) * (scale[:, None] * scale[None, :])
            np.fill_diagonal(s, -np.inf)
            n = min(k, len(node) - 1)
            if n > 0:
                near = np.argpartition(-s, n - 1, axis=1)[:, :n]
                held.add(np.repeat(node, n), node[near].ravel(), np.take_along_axis(s, near, axis=1).ravel())

        left = None
        for batch in batches:
            table = batch if left is None else pa.concat_batches([left, batch])
            at = 0
            while at < table.num_rows:
                t = table.column("t").to_numpy()[at:]
                same = int(np.searchsorted(t, t[0], side="right"))
                whole = at + same < table.num_rows  # another order follows: this one is complete
                n = block if same >= 2 * block else same if whole else 0
                if not n:
                    break
                part = table.slice(at, n)
                compare(part.column("node").to_numpy(), part.column("small"), part.column("scale").to_numpy())
                at += n
            left = table.slice(at)
            yield from held.emptied()
        if left is not None and left.num_rows:
            compare(left.column("node").to_numpy(), left.column("small"), left.column("scale").to_numpy())
        yield from held.emptied(last=True)

    order = ["t", "code", "node"]
    codes = nodes.select("node", "small", "scale", "fine").mapInArrow(coded, "t int, code long, node long, small binary, scale double")
    return codes.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(linked, _LINKS)


def _kept(links: DataFrame, nodes: DataFrame, k: int) -> DataFrame:
    """One row per node: its k best neighbours, best first, which of them are new, and its rounded vector."""

    def best(batches):
        held, out = None, []  # the node in hand: id, vector, scale, neighbours, scores, fresh
        for batch in batches:
            u, w, s, fresh = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("u", "w", "s", "fresh"))
            # a node's own row comes first; of equal links the older one
            new = np.append(True, (u[1:] != u[:-1]) | (w[1:] != w[:-1]))
            for a, b in zip(*_spans(u), strict=True):
                if held is None or held[0] != u[a]:
                    if held:
                        out.append(held)
                    held = (u[a], batch.column("small")[a].as_py(), batch.column("scale")[a].as_py(), [], [], [])
                    a += 1
                have = held[3:]
                at = np.flatnonzero(new[a:b]) + a
                if len(at) and have[0] and have[0][-1] == w[at[0]]:
                    at = at[1:]
                at = at[: k - len(have[0])]
                for kept, more in zip(have, (w, s, fresh), strict=True):
                    kept.extend(more[at].tolist())
            yield _graph_batch(out)
            out = []
        if held:
            yield _graph_batch([held])

    empty = lambda kind: F.lit(None).cast(kind)
    own = nodes.select(
        F.col("node").alias("u"), F.lit(-1).cast("long").alias("w"), F.lit(float("inf")).alias("s"), F.lit(False).alias("fresh"), "small", "scale"
    )
    rows = own.unionByName(links.select("u", "w", "s", "fresh", empty("binary").alias("small"), empty("double").alias("scale")))
    order = ["u", F.desc("s"), "w", "fresh"]
    return rows.repartition("u").sortWithinPartitions(*order).mapInArrow(best, _GRAPH)


def _spans(sorted_values: np.ndarray) -> tuple[list[int], list[int]]:
    starts = np.flatnonzero(np.append(True, sorted_values[1:] != sorted_values[:-1])) if len(sorted_values) else np.empty(0, dtype=int)
    return starts.tolist(), np.append(starts[1:], len(sorted_values)).tolist() if len(starts) else []


def _graph_batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.binary(), pa.float64(), pa.list_(pa.int64()), pa.list_(pa.float64()), pa.list_(pa.bool_())]
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(types)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=t) for c, t in zip(columns, types, strict=True)], ["node", "small", "scale", "ws", "ss", "news"]
    )


def _local_joins(graph: DataFrame, k: int) -> DataFrame:
    """What nodes with new links find: pairs of their neighbours, and themselves for their new neighbours."""
    full = F.when(F.size("ss") >= k, F.element_at("ss", -1))
    known = graph.select(F.col("node").alias("w"), "small", "scale", F.coalesce(full, F.lit(float("-inf"))).alias("worst"))
    busy = graph.where(F.exists("news", lambda x: x)).select("node", F.explode(F.arrays_zip("ws", "ss", "news")).alias("l"))
    sent = busy.select("node", F.col("l.ws").alias("w_"), F.col("l.ss").alias("s"), F.col("l.news").alias("fresh"))
    sent = sent.join(known, F.col("w_") == F.col("w")).drop("w_")

    def joined(batches):
        held, left = _Held(k), None
        for batch in batches:
            table = batch if left is None or not left.num_rows else pa.concat_batches([left, batch])
            if not table.num_rows:
                continue
            node = table.column("node").to_numpy()
            cut = int(np.searchsorted(node, node[-1]))  # the last node may go on in the next batch
            left = table.slice(cut)
            if cut:
                _pairs(table.slice(0, cut), k, held)
                yield from held.emptied()
        if left is not None and left.num_rows:
            _pairs(left, k, held)
        yield from held.emptied(last=True)

    return sent.select("node", "w", "s", "fresh", "small", "scale", "worst").repartition("node").sortWithinPartitions("node").mapInArrow(joined, _LINKS)


def _pairs(table: pa.RecordBatch, k: int, held: _Held) -> None:
    node, w, s, fresh, scale, worst = (table.column(c).to_numpy(zero_copy_only=False) for c in ("node", "w", "s", "fresh", "scale", "worst"))
    small = _rows(table.column("small"), "i1")
    offered = fresh & (s > worst)
    held.add(w[offered], node[offered], s[offered])
    starts, ends = (np.array(x) for x in _spans(node))
    of = np.repeat(np.arange(len(starts)), ends - starts)
    place = np.arange(len(node)) - starts[of]
    shape = (len(starts), k)
    ids, new, limit, vectors = np.full(shape, -1), np.zeros(shape, dtype=bool), np.full(shape, np.inf), np.zeros((*shape, small.shape[1]))
    ids[of, place], new[of, place], limit[of, place] = w, fresh, worst
    vectors[of, place] = small
    weight = np.zeros(shape)
    weight[of, place] = scale
    a, b = np.triu_indices(k, 1)
    for at in range(0, len(starts), 256):
        part = slice(at, at + 256)
        v = vectors[part]
        score = (v @ v.transpose(0, 2, 1))[:, a, b] * (weight[part][:, a] * weight[part][:, b])
        x, y = ids[part][:, a], ids[part][:, b]
        asked = (new[part][:, a] | new[part][:, b]) & (x >= 0) & (y >= 0)
        for one, other, bound in ((x, y, limit[part][:, a]), (y, x, limit[part][:, b])):
            good = asked & (score > bound)
            held.add(one[good], other[good], score[good])


def neighbour_graph(
    nodes: DataFrame, k: int = NEIGHBOURS, forests: int = FORESTS, block: int = BLOCK, rounds: int = ROUNDS, settled: float = SETTLED
) -> DataFrame:
    """node, its rounded vector (small, scale), ws (neighbours, best first), ss (their scores) and news (found in the last round)."""
    graph = stage(_kept(_first_links(nodes, k, forests, block), nodes, k), "graph")
    for _ in range(rounds):
        old = graph.select(F.col("node").alias("u"), F.explode(F.arrays_zip("ws", "ss")).alias("l"))
        old = old.select("u", F.col("l.ws").alias("w"), F.col("l.ss").alias("s"), F.lit(False).alias("fresh"))
        graph = stage(_kept(old.unionByName(_local_joins(graph, k)), nodes, k), "graph")
        news = F.size(F.filter("news", lambda x: x))
        links, new = graph.agg(F.sum(F.size("ws")), F.sum(news)).first()
        if not links or new < settled * links:
            break
    return graph


def _entries(nodes: DataFrame, entries: int) -> tuple[np.ndarray, np.ndarray]:
    """At most ``entries`` nodes and their vectors."""
    drawn = nodes.orderBy(F.xxhash64("node"), "node").select("node", "fine").limit(entries).collect()
    fine = [np.frombuffer(r["fine"], dtype="<i2").astype(np.float64) for r in drawn]
    return np.array([r["node"] for r in drawn], dtype=np.int64), np.array(fine)


class _Search:
    """The beam of one query."""

    def __init__(self, query: int, vector: bytes, ids: list, scores: list, done: list, beam: int):
        self.query, self.vector, self.beam = query, vector, beam
        self.q = np.frombuffer(vector, dtype="<i2").astype(np.float64)
        self.ids, self.scores, self.done = np.array(ids, dtype=np.int64), np.array(scores, dtype=np.float64), np.array(done, dtype=bool)

    def meet(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        new = ~np.isin(ids, self.ids)
        ids, scores = np.concatenate([self.ids, ids[new]]), np.concatenate([self.scores, vectors[new] @ self.q])
        done = np.append(self.done, np.zeros(int(new.sum()), dtype=bool))
        best = np.lexsort((ids, -scores))[: self.beam]
        self.ids, self.scores, self.done = ids[best], scores[best], done[best]

    def step(self, expand: int) -> tuple:
        go = np.flatnonzero(~self.done)[:expand]
        self.done[go] = True
        return self.query, self.vector, self.ids.tolist(), self.scores.tolist(), self.done.tolist(), self.ids[go].tolist()


def _beam_batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.float64()), pa.list_(pa.bool_()), pa.list_(pa.int64())]
    names = ["query", "qvec", "ids", "scores", "done", "next"]
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, types, strict=True)], names)


def beams(queries: DataFrame, graph: DataFrame, nodes: DataFrame, beam: int = BEAM, expand: int = EXPAND, entries: int = ENTRIES) -> DataFrame:
    """The best nodes each query (query, vector) has met when its search has ended: query, ids, scores."""
    ids, vectors = _entries(nodes, entries)

    def begun(batches):
        for batch in batches:
            out = []
            fine = _sixteen(matrix(batch.column("vector"))) if batch.num_rows else ()
            for query, vector in zip(batch.column("query").to_pylist(), fine, strict=True):
                search = _Search(query, vector.tobytes(), [], [], [], beam)
                search.meet(ids, vectors)
                out.append(search.step(expand))
            yield _beam_batch(out)

    def merged(batches):
        search, out = None, []
        for batch in batches:
            query, kind = batch.column("query").to_numpy(), batch.column("kind").to_numpy()
            node = batch.column("node").to_numpy(zero_copy_only=False)
            for a, b in zip(*_spans(query), strict=True):
                if kind[a] == 0:
                    if search:
                        out.append(search.step(expand))
                    row = {c: batch.column(c)[a].as_py() for c in ("query", "vec", "ids", "scores", "done")}
                    search = _Search(row["query"], row["vec"], row["ids"], row["scores"], row["done"], beam)
                    a += 1
                if b > a:
                    search.meet(node[a:b].astype(np.int64), _rows(batch.column("vec").slice(a, b - a), "<i2"))
            yield _beam_batch(out)
            out = []
        if search:
            yield _beam_batch([search.step(expand)])

    if not len(ids):
        return queries.sparkSession.createDataFrame([], _BEAM).select("query", "ids", "scores")
    out = graph.select("node", F.explode("ws").alias("w"))
    links = stage(out.unionByName(out.select(F.col("w").alias("node"), F.col("node").alias("w"))).distinct(), "links")
    fine = nodes.select(F.col("node").alias("node_"), F.col("fine").alias("vec"))
    now = stage(queries.select("query", "vector").mapInArrow(begun, _BEAM), "beams")
    while not now.where(F.size("next") > 0).isEmpty():
        asked = now.select("query", F.explode("next").alias("node"))
        met = asked.join(links, "node").select("query", F.col("w").alias("node"), F.lit(False).alias("known"))
        known = now.select("query", F.explode("ids").alias("node"), F.lit(True).alias("known"))
        unmet = met.unionByName(known).groupBy("query", "node").agg(F.max("known").alias("known")).where("not known")
        none = lambda kind: F.lit(None).cast(kind)
        found = unmet.join(fine, F.col("node") == F.col("node_")).select(
            "query", F.lit(1).alias("kind"), "node", "vec", none("array<long>").alias("ids"), none("array<double>").alias("scores"),
            none("array<boolean>").alias("done"),
        )
        held = now.select("query", F.lit(0).alias("kind"), none("long").alias("node"), F.col("qvec").alias("vec"), "ids", "scores", "done")
        rows = held.unionByName(found).repartition("query").sortWithinPartitions("query", "kind", "node")
        now = stage(rows.mapInArrow(merged, _BEAM), "beams")
    return now.select("query", "ids", "scores")


def _cosines(pairs: DataFrame) -> DataFrame:
    """query, node and score, in double precision, of rows with two vectors."""

    def scored(batches):
        for batch in batches:
            if batch.num_rows:
                a, b = matrix(batch.column("qv")), matrix(batch.column("vector"))
                dots, squares = (a * b).sum(axis=1), (a * a).sum(axis=1) * (b * b).sum(axis=1)
                plain = np.isfinite(squares) & (squares > 1e-290) & np.isfinite(dots)
                with np.errstate(all="ignore"):
                    norm = np.linalg.norm(a, axis=1) * np.linalg.norm(b, axis=1)
                    score = np.where(plain, dots / norm, (units(a) * units(b)).sum(axis=1))
                yield pa.RecordBatch.from_arrays([batch.column("query"), batch.column("node"), pa.array(score)], ["query", "node", "score"])

    return pairs.select("query", "node", "qv", "vector").mapInArrow(scored, "query long, node long, score double")


def nearest(
    rows: DataFrame, queries: Column | None = None, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding",
    neighbours: int = NEIGHBOURS, beam: int = BEAM,
) -> DataFrame:
    """query_id, rank (from 1), id, score: the k nearest rows found for every row that fulfils ``queries`` (all), its own id left out."""
    ship(rows.sparkSession)
    kept = stage(usable(rows, id_col, vector_col, queries), "vectors")
    nodes = nodes_of(kept)
    graph = neighbour_graph(nodes, neighbours)
    asked = kept.where("asked").select("id", "vector").distinct().withColumn("query", F.monotonically_increasing_id())
    asked = stage(asked, "queries")
    found = beams(asked, graph, nodes, beam).select("query", F.explode("ids").alias("node"))
    pairs = found.join(nodes.select("node", "vector"), "node").join(asked.select("query", F.col("vector").alias("qv")), "query")
    scored = stage(_cosines(pairs), "scored")
    # the k + 1 smallest ids of equal vectors: k are left if the query's own is one of them
    several = nodes.where("copies > 1").select("node", F.col("vector").alias("v"))
    ranked = Window.partitionBy("node").orderBy("id")
    members = kept.join(several, F.col("vector") == F.col("v")).select("node", "id").distinct()
    members = members.withColumn("r", F.row_number().over(ranked)).where(F.col("r") <= k + 1).select("node", "id")
    members = members.unionByName(nodes.where("copies = 1").select("node", "id"))
    best = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    answers = (
        scored.join(members, "node")
        .join(asked.select("query", F.col("id").alias("query_id")), "query")
        .where(F.col("id") != F.col("query_id"))
        .withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
    )
    return answers.select("query_id", "rank", "id", "score")

