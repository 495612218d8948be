"""Approximate nearest neighbours: a graph by NN-descent, searched greedily.

The graph links every vector to its ``DEGREE`` nearest as far as known. It
starts from random hyperplanes: vectors on the same side of all of them are
compared. Then, round by round, the neighbours of a vector, in both directions,
are introduced to each other, and each keeps whom it likes better than its worst
neighbour so far. A query starts at its own vector and expands the best nodes it
has met until the best ``BEAM`` are all expanded.

Tables are dealt into buckets of nodes, and tasks work on a bucket with numpy.
What one bucket has for the members of another travels as one row, so rows do
not multiply with the buckets that a member is known in. Nothing is collected:
rounds are joins and groupings, each written to the shared folder. Inner products
become similarities of equal norms by one more component, so that "neighbour" is
symmetric whatever the norms are.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedback_engine.llm.common import written
from feedback_engine.llm.vectors import usable

DEGREE = 32
ROUNDS = 5
TREES, LEAF = 6, 512  # first comparisons: sets of hyperplanes, and vectors expected on the same sides
BLOCK = 1024  # at most about so many vectors are compared all against all
MEMBERS = 48  # neighbours that a node introduces to each other: its own, and the nearest of those that chose it
HOSTS = 256  # hosts whose introductions are computed at once
INTRODUCED = 6  # new acquaintances that one introduction may give to a vector
BEAM, EXPANDED = 200, 100  # best nodes a query keeps, and how many of them it expands in a round
NEAREST = 20
QUERIES = 20  # ids divisible by this are queries
BUCKET = 4096  # nodes expected in a bucket
HOME = 256  # queries expected in a bucket


def _matrix(column: pa.ChunkedArray | pa.Array, dtype=np.float64) -> np.ndarray:
    rows = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return rows.flatten().to_numpy(zero_copy_only=False).astype(dtype).reshape(len(rows), -1)


def _flat(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column and the row each is of."""
    rows = column.combine_chunks()
    lengths = rows.value_lengths().to_numpy(zero_copy_only=False)
    return rows.flatten().to_numpy(zero_copy_only=False), np.repeat(np.arange(len(rows)), lengths)


def _lists(owner: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, list[pa.Array]]:
    """Each different owner of sorted ``owner``, and its values as lists."""
    starts = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1]))) if len(owner) else np.empty(0, int)
    offsets = pa.array(np.append(starts, len(owner)).astype(np.int32))
    return owner[starts], [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in values]


def _among(values: np.ndarray, held: np.ndarray) -> np.ndarray:
    """Whether each value is one of sorted ``held``."""
    return held[np.minimum(np.searchsorted(held, values), len(held) - 1)] == values if len(held) else np.zeros(len(values), bool)


def _best(owner: np.ndarray, other: np.ndarray, score: np.ndarray, most: int, *more: np.ndarray) -> list[np.ndarray]:
    """The ``most`` others of the highest score of each owner, every pair once, sorted by owner and score."""
    order = np.lexsort((other, owner))
    owner, other, score, *more = (x[order] for x in (owner, other, score, *more))
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (other[1:] != other[:-1])
    starts = np.flatnonzero(new)
    # What is known of a pair more than once: the largest.
    more = [np.maximum.reduceat(x, starts) if len(starts) else x for x in more]
    owner, other, score = owner[starts], other[starts], score[starts]
    order = np.lexsort((other, -score, owner))
    owner, other, score, *more = (x[order] for x in (owner, other, score, *more))
    starts = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1]))) if len(owner) else np.empty(0, int)
    place = np.arange(len(owner)) - np.repeat(starts, np.diff(np.append(starts, len(owner))))
    return [x[place < most] for x in (owner, other, score, *more)]


GRAPH = "node long, others array<long>, scores array<float>, fresh array<boolean>"


def _graph_table(owner: np.ndarray, other: np.ndarray, score: np.ndarray, old: np.ndarray | None = None) -> pa.Table:
    """Lists of neighbours; ``fresh`` marks those that were not known before the round."""
    fresh = np.ones(len(owner), bool) if old is None else ~old
    nodes, (others, scores, marks) = _lists(owner, other.astype(np.int64), score.astype(np.float32), fresh)
    return pa.table({"node": pa.array(nodes, pa.int64()), "others": others, "scores": scores, "fresh": marks})


def _compare(table: pa.Table) -> pa.Table:
    """The nearest of each vector within a block of vectors."""
    nodes, rows = table["node"].to_numpy(), _matrix(table["vector"], np.float32)
    found = []
    for at in range(0, len(nodes), 256):
        score = rows[at : at + 256] @ rows.T
        score[np.arange(len(score)), at + np.arange(len(score))] = -np.inf
        k = min(DEGREE, len(nodes) - 1)
        if k > 0:
            top = np.argpartition(-score, k - 1, axis=1)[:, :k]
            found.append((np.repeat(nodes[at : at + 256], k), nodes[top].ravel(), np.take_along_axis(score, top, 1).ravel()))
    owner, other, score = (np.concatenate(x) for x in zip(*found)) if found else (np.empty(0, np.int64),) * 3
    return _graph_table(*_best(owner, other, score, DEGREE))


SEATED = "node long, vector array<float>, bucket int, place long, part long, others array<long>, scores array<float>, fresh array<boolean>"


def _seated(seats: pa.Table, owner: np.ndarray, other: np.ndarray, score: np.ndarray, old: np.ndarray) -> pa.Table:
    """A row for each of ``seats``, with the nearest out of all that is known of it."""
    owner, other, score, old = _best(owner, other, score, DEGREE, old)
    nodes = seats["node"].to_numpy()
    order = np.argsort(nodes)
    offsets = pa.array(np.append(np.searchsorted(owner, nodes[order]), len(owner)).astype(np.int32))
    lists = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (other.astype(np.int64), score.astype(np.float32), ~old.astype(bool))]
    kept = seats.select(["node", "vector", "bucket", "place", "part"]).take(pa.array(order))
    return pa.table([*kept.columns, *lists], names=[*kept.column_names, "others", "scores", "fresh"])


def _seat(key, seats: pa.Table, lists: pa.Table) -> pa.Table:
    """The nearest of each node of a bucket, out of the lists from all blocks."""
    others, row = _flat(lists["others"])
    return _seated(seats, lists["node"].to_numpy()[row], others, _flat(lists["scores"])[0], np.zeros(len(others), bool))


def _merge(key, graph: pa.Table, news: pa.Table) -> pa.Table:
    """The nearest of each node of a bucket, out of those it had and the news from all places."""
    others, row = _flat(graph["others"])
    new = [_flat(news[x])[0] for x in ("members", "others", "scores")]
    owner, other, score = (
        np.concatenate(x) for x in zip((graph["node"].to_numpy()[row], others, _flat(graph["scores"])[0]), new)
    )
    return _seated(graph, owner, other, score, np.arange(len(owner)) < len(others))


EDGES = "place long, part long, host long, member long, score float, new boolean"


def _members(key, graph: pa.Table, chosen_by: pa.Table) -> pa.Table:
    """Whom each node of a bucket will introduce: its own neighbours, and the nearest of those that chose it."""
    others, row = _flat(graph["others"])
    nodes = graph["node"].to_numpy()
    own = nodes[row], others, _flat(graph["scores"])[0], _flat(graph["fresh"])[0].astype(bool)
    theirs = [chosen_by[x].to_numpy(zero_copy_only=False) for x in ("host", "member", "score", "new")]
    theirs = _best(*theirs[:3], DEGREE, theirs[3].astype(bool))
    host, member, score, new = (np.concatenate(x) for x in zip(own, theirs))
    host, member, score, new = _best(host, member, score, MEMBERS, new)
    order = np.argsort(nodes)
    at = np.searchsorted(nodes[order], host)
    # Nobody has news of a host all of whose members have met.
    some = (np.bincount(at, new, len(nodes)) > 0) & (np.bincount(at, minlength=len(nodes)) > 1)
    keep = some[at]
    seat = order[at[keep]]
    columns = [graph["place"].to_numpy()[seat], graph["part"].to_numpy()[seat], host[keep], member[keep], score[keep].astype(np.float32), new[keep].astype(bool)]
    return pa.table([pa.array(x) for x in columns], names=["place", "part", "host", "member", "score", "new"])


def _introduce(table: pa.Table) -> pa.Table:
    """Introduces the members of each node to each other; keeps what betters a member's worst neighbour.

    Two members that both were there the round before have met, and who is
    among a member's neighbours (``beside``) is no news to it. One row of each
    member has its vector and neighbours; those of its other rows may be null.
    """
    known = table.filter(table["vector"].is_valid())
    members, at = np.unique(known["member"].to_numpy(), return_index=True)
    known = known.take(pa.array(at))
    vectors, least = _matrix(known["vector"], np.float32), known["worst"].to_numpy()
    edges = [table[x].to_numpy(zero_copy_only=False) for x in ("host", "member", "score", "new")]
    host, member, _, new = _best(*edges[:3], MEMBERS, edges[3].astype(bool))
    at = np.searchsorted(members, member)
    starts = np.flatnonzero(np.concatenate(([True], host[1:] != host[:-1]))) if len(host) else np.empty(0, int)
    lengths = np.diff(np.append(starts, len(host)))
    found = []
    for first in range(0, len(starts), HOSTS):
        # The members of so many hosts, a row each; places that a host has no member for count for nothing.
        length, place = lengths[first : first + HOSTS, None], np.arange(lengths[first : first + HOSTS].max())
        there = place < length
        edge = np.where(there, starts[first : first + HOSTS, None] + place, 0)
        some, fresh = vectors[at[edge]], new[edge]
        score = some @ some.transpose(0, 2, 1)
        score[~(there[:, None, :] & there[:, :, None] & (fresh[:, None, :] | fresh[:, :, None]))] = -np.inf
        score[:, place, place] = -np.inf
        k = min(INTRODUCED, len(place) - 1)
        if k < 1:
            continue
        top = np.argpartition(-score, k - 1, axis=2)[:, :, :k]
        value = np.take_along_axis(score, top, 2)
        h, i, j = np.nonzero(value > least[at[edge]][:, :, None])
        found.append((member[edge[h, i]], member[edge[h, top[h, i, j]]], value[h, i, j]))
    owner, other, score = (np.concatenate(x) for x in zip(*found)) if found else (np.empty(0, np.int64),) * 3
    news = ~_known(known, owner, other)
    return _graph_table(*_best(owner[news], other[news], score[news], DEGREE))


def _known(known: pa.Table, owner: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Whether each other is among the neighbours of its owner, a member of ``known`` (a row each, in order)."""
    members = known["member"].to_numpy()
    beside, row = _flat(known["beside"])
    ids = np.unique(np.concatenate((members, other)))
    held = _among(beside, ids)
    pairs = row[held] * len(ids) + np.searchsorted(ids, beside[held])
    return _among(np.searchsorted(members, owner) * len(ids) + np.searchsorted(ids, other), np.sort(pairs))


NEWS = "bucket int, members array<long>, others array<long>, scores array<float>"


def _news(table: pa.Table) -> pa.Table:
    """The news of a place, a row for each bucket of members that it goes to."""
    found = _introduce(table)
    known = table.filter(table["vector"].is_valid())
    members, at = np.unique(known["member"].to_numpy(), return_index=True)
    others, row = _flat(found["others"])
    owner = found["node"].to_numpy()[row]
    bucket = known["bucket"].to_numpy()[at][np.searchsorted(members, owner)]
    order = np.argsort(bucket, kind="stable")
    buckets, lists = _lists(bucket[order], owner[order], others[order], _flat(found["scores"])[0][order])
    return pa.table([pa.array(buckets, pa.int32()), *lists], names=["bucket", "members", "others", "scores"])


def _bucket(node: str, buckets: int):
    return F.pmod(F.xxhash64(node), F.lit(buckets)).cast("int")


def neighbour_graph(nodes: DataFrame, size: int, buckets: int, seed: int = 0, rounds: int = ROUNDS) -> DataFrame:
    """(node, others, scores) of every row of ``nodes`` (node, vector array<float>), by NN-descent."""
    bits = max(0, int(np.ceil(np.log2(max(1, size) / LEAF))))
    trees = written(nodes.mapInArrow(_sides(bits, seed), "node long, vector array<float>, tree int, side long"), "ann_sides")
    counts = trees.groupBy("tree", "side").count().withColumn("parts", F.ceil(F.col("count") / BLOCK)).drop("count")
    # A side that holds many vectors, such as a large group of near copies, is cut by chance.
    part = F.pmod(F.xxhash64("node", "tree"), F.col("parts")).alias("part")
    blocks = trees.join(counts, ["tree", "side"]).select("tree", "side", part, "node", "vector")
    first = blocks.groupBy("tree", "side", "part").applyInArrow(_compare, GRAPH)

    # Hosts are dealt out by where they lie, so a node meets many of its hosts in the same task:
    # sides in order fill a place each, and only a side that is too large is cut by chance.
    lies = trees.where("tree = 0").select("node", "vector", "side")
    before = F.sum("count").over(Window.orderBy("side")) - F.col("count")
    crowds = lies.groupBy("side").count().select(
        "side", F.floor(before / BUCKET).alias("place"), F.ceil(F.col("count") / BUCKET).alias("parts")
    )
    seats = lies.join(crowds, "side").select(
        "node", "vector", _bucket("node", buckets).alias("bucket"), "place", F.pmod(F.xxhash64("node"), "parts").alias("part")
    )
    graph = seats.groupBy("bucket").cogroup(first.groupBy(_bucket("node", buckets))).applyInArrow(_seat, SEATED)
    graph = written(graph, "ann_graph")
    for _ in range(rounds):
        chosen = graph.select("node", F.explode(F.arrays_zip("others", "scores", "fresh")).alias("x"))
        chosen_by = chosen.select(
            F.col("x.others").alias("host"), F.col("node").alias("member"), F.col("x.scores").alias("score"), F.col("x.fresh").alias("new")
        )
        both = graph.groupBy("bucket").cogroup(chosen_by.groupBy(_bucket("host", buckets)))
        edges = both.applyInArrow(_members, EDGES).repartition("member")
        # A member's vector and neighbours go to a place once, with the first of its hosts there.
        again = F.row_number().over(Window.partitionBy("member", "place", "part").orderBy("host"))
        known = graph.select(
            F.col("node").alias("member"),
            "bucket",
            "vector",
            F.coalesce(F.try_element_at("scores", F.lit(DEGREE)), F.lit(float("-inf")).cast("float")).alias("worst"),
            F.col("others").alias("beside"),
        )
        rows = edges.withColumn("again", again).join(known, "member")
        once = [F.when(F.col("again") == 1, F.col(x)).alias(x) for x in ("bucket", "vector", "worst", "beside")]
        rows = rows.select("place", "part", "host", "member", "score", "new", *once)
        news = rows.groupBy("place", "part").applyInArrow(_news, NEWS)
        graph = graph.groupBy("bucket").cogroup(news.groupBy("bucket")).applyInArrow(_merge, SEATED)
        graph = written(graph, "ann_graph")
    return graph.select("node", "others", "scores")


def _sides(bits: int, seed: int):
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = _matrix(batch.column(1))
            for tree in range(TREES):
                normals = np.random.default_rng([seed, tree]).normal(size=(rows.shape[1], bits))
                side = ((rows @ normals > 0) << np.arange(bits)).sum(axis=1).astype(np.int64) if bits else np.zeros(len(rows), np.int64)
                columns = [*batch.columns, pa.array(np.full(len(rows), tree, np.int32)), pa.array(side)]
                yield pa.RecordBatch.from_arrays(columns, names=["node", "vector", "tree", "side"])

    return run


STATE = "query long, home int, vector array<double>, others array<long>, scores array<double>, expanded array<boolean>, now array<long>"
WANTED = "home int, room int, queries array<long>, vectors array<double>, counts array<int>, others array<long>"
SCORED = "home int, queries array<long>, others array<long>, scores array<double>"


def _start(batches):
    """A query starts at its own vector, which it expands first."""
    for batch in batches:
        if batch.num_rows:
            rows, own = _matrix(batch.column(2)), pa.array(np.arange(batch.num_rows + 1), pa.int32())
            lists = batch.column(0), pa.array((rows * rows).sum(axis=1)), pa.array(np.ones(batch.num_rows, bool)), batch.column(0)
            columns = [*batch.columns, *(pa.ListArray.from_arrays(own, x) for x in lists)]
            yield pa.RecordBatch.from_arrays(columns, names=["query", "home", "vector", "others", "scores", "expanded", "now"])


def _wanted(key, state: pa.Table, asked: pa.Table) -> pa.Table:
    """What the queries of a bucket (home) have not met of those beside the nodes they expand, a row for each bucket (room) that it is in."""
    order = np.argsort(state["query"].to_numpy())
    queries = state["query"].to_numpy()[order]
    beside, row = _flat(asked["beside"])
    rooms = _flat(asked["rooms"])[0]
    met, whose = _flat(state["others"])
    ids = np.unique(np.concatenate((beside, met)))
    pair = np.searchsorted(queries, asked["query"].to_numpy()[row]) * len(ids) + np.searchsorted(ids, beside)
    had = np.searchsorted(queries, state["query"].to_numpy()[whose]) * len(ids) + np.searchsorted(ids, met)
    pair, first = np.unique(pair, return_index=True)
    new = ~_among(pair, np.sort(had))
    at, other, room = pair[new] // max(1, len(ids)), beside[first[new]], rooms[first[new]]
    by_room = np.lexsort((at, room))
    at, other, room = at[by_room], other[by_room], room[by_room]
    starts = np.flatnonzero(np.concatenate(([True], (room[1:] != room[:-1]) | (at[1:] != at[:-1])))) if len(at) else np.empty(0, int)
    vectors = _matrix(state["vector"])[order]
    counts = np.diff(np.append(starts, len(at))).astype(np.int32)
    rooms, (asking, lengths) = _lists(room[starts], queries[at[starts]], counts)
    rows = pa.array(np.append(0, np.cumsum(asking.value_lengths().to_numpy() * vectors.shape[1])).astype(np.int32))
    flat = pa.ListArray.from_arrays(rows, pa.array(vectors[at[starts]].ravel()))
    _, (others,) = _lists(room, other)
    home = pa.array(np.full(len(rooms), key[0].as_py(), np.int32))
    return pa.table([home, pa.array(rooms, pa.int32()), asking, flat, lengths, others], names=["home", "room", "queries", "vectors", "counts", "others"])


def _score(key, wanted: pa.Table, known: pa.Table) -> pa.Table:
    """Inner products of the queries with the nodes they want, of one bucket of nodes."""
    if not wanted.num_rows or not known.num_rows:
        lists = [pa.array([], pa.list_(x)) for x in (pa.int64(), pa.int64(), pa.float64())]
        return pa.table([pa.array([], pa.int32()), *lists], names=["home", "queries", "others", "scores"])
    nodes = known["node"].to_numpy()
    order = np.argsort(nodes)
    rows, nodes = _matrix(known["plain"])[order], nodes[order]
    others, whose = _flat(wanted["others"])
    queries = _flat(wanted["queries"])[0]
    vectors = _flat(wanted["vectors"])[0].reshape(len(queries), -1)
    row = np.repeat(np.arange(len(queries)), _flat(wanted["counts"])[0])
    at = np.searchsorted(nodes, others)
    score = np.empty(len(others))
    for k in range(0, len(others), 65536):
        some = slice(k, k + 65536)
        score[some] = (rows[at[some]] * vectors[row[some]]).sum(axis=1)
    homes, lists = _lists(whose, queries[row], others, score)
    return pa.table([wanted["home"].take(pa.array(homes)), *lists], names=["home", "queries", "others", "scores"])


def _keep(key, state: pa.Table, scored: pa.Table) -> pa.Table:
    """The best nodes of each query of a bucket, and which of them it expands now."""
    others, row = _flat(state["others"])
    more = _flat(scored["others"])[0]
    query = np.concatenate((state["query"].to_numpy()[row], _flat(scored["queries"])[0]))
    scores = np.concatenate((_flat(state["scores"])[0], _flat(scored["scores"])[0]))
    expanded = np.concatenate((_flat(state["expanded"])[0].astype(bool), np.zeros(len(more), bool)))
    query, others, scores, expanded = _best(query, np.concatenate((others, more)), scores, BEAM, expanded)
    # Every query has met one node at least, its own.
    open_ = np.cumsum(~expanded)
    starts = np.flatnonzero(np.concatenate(([True], query[1:] != query[:-1]))) if len(query) else np.empty(0, int)
    before = np.repeat(open_[starts] - ~expanded[starts], np.diff(np.append(starts, len(query))))
    chosen = ~expanded & (open_ - before <= EXPANDED)
    queries, (a, b, c) = _lists(query, others.astype(np.int64), scores.astype(np.float64), expanded | chosen)
    ends = np.append(0, np.cumsum(np.add.reduceat(chosen, starts, dtype=int) if len(starts) else []))
    now = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(others[chosen].astype(np.int64)))
    rows = state.select(["query", "home", "vector"]).take(pa.array(np.argsort(state["query"].to_numpy())))
    return pa.table([*rows.columns, a, b, c, now], names=["query", "home", "vector", "others", "scores", "expanded", "now"])


def graph_search(queries: DataFrame, nodes: DataFrame, graph: DataFrame, buckets: int) -> DataFrame:
    """(query, others, scores) of each of ``queries`` (query: a node; vector): the best nodes met by greedy search.

    ``nodes`` has (node, plain), the vectors that are scored in double precision.
    A round expands up to ``EXPANDED`` of the best nodes of every query that has
    one left; the search ends when none has.
    """
    links = graph.select("node", F.explode("others").alias("other"))
    # Chosen neighbours first, then those that chose the node, as many again.
    reverse = Window.partitionBy("node").orderBy(F.xxhash64("other"), "other")
    more = links.select(F.col("other").alias("node"), F.col("node").alias("other"))
    more = more.withColumn("k", F.row_number().over(reverse)).where(F.col("k") <= DEGREE).drop("k")
    beside = F.collect_set(F.struct("other", _bucket("other", buckets).alias("room"))).alias("x")
    adjacent = links.unionByName(more).groupBy("node").agg(beside)
    adjacent = written(adjacent.select("node", F.col("x.other").alias("beside"), F.col("x.room").alias("rooms")), "ann_adjacent")
    known = nodes.select("node", "plain", _bucket("node", buckets).alias("bucket"))

    homes = max(1, -(-queries.count() // HOME))
    first = queries.select("query", _bucket("query", homes).alias("home"), F.col("vector").cast("array<double>").alias("vector"))
    state = written(first.mapInArrow(_start, STATE), "ann_state")
    while not state.where(F.size("now") > 0).isEmpty():
        asked = state.select(F.col("query").alias("query"), F.col("home").alias("home"), F.explode("now").alias("node"))
        asked = asked.join(adjacent, "node").select("query", "home", "beside", "rooms")
        wanted = state.groupBy("home").cogroup(asked.groupBy("home")).applyInArrow(_wanted, WANTED)
        scored = wanted.groupBy("room").cogroup(known.groupBy("bucket")).applyInArrow(_score, SCORED)
        state = written(state.groupBy("home").cogroup(scored.groupBy("home")).applyInArrow(_keep, STATE), "ann_state")
    return state.select("query", "others", "scores")


def nearest_neighbours(vectors: DataFrame, every: int = QUERIES, nearest: int = NEAREST) -> DataFrame:
    """(query_id, rank, vec_id, score): for each id divisible by ``every`` the nearest rows found.

    Nearness is the inner product in double precision; ties go to the smaller
    id. Rows whose vector is not ``usable``, or that have no id, take no part,
    nor do those of another dimension than most. Rows with equal vectors share a
    node, so none of them is missed where one is found; of rows that repeat an id
    the one with the smallest vector counts. An empty table gives an empty one.
    """
    rows = vectors.where(usable(F.col("embedding")) & F.col("vec_id").isNotNull())
    rows = rows.groupBy("vec_id").agg(F.min("embedding").alias("plain"))
    rows = written(rows.withColumn("key", F.struct(F.xxhash64("plain"), F.xxhash64(F.lit(1), "plain"))), "ann_rows")
    common = rows.groupBy(F.size("plain").alias("size")).count().orderBy(F.desc("count"), "size").first()
    if common is None:
        return rows.select(F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id", F.lit(0.0).alias("score"))
    rows = rows.where(F.size("plain") == common["size"])
    groups = rows.groupBy("key").agg(F.min("vec_id").alias("node"))
    nodes = written(rows.join(groups, "key").where("vec_id = node").select("node", "plain", "key"), "ann_nodes")
    square = F.aggregate("plain", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    whole = nodes.agg(F.count(F.lit(1)).alias("n"), F.max(square).alias("most")).first()
    buckets = max(1, -(-whole["n"] // BUCKET))
    # One more component makes all norms equal; then all are scaled to one.
    rest = F.sqrt(F.greatest(F.lit(float(whole["most"])) - square, F.lit(0.0)))
    longer = F.concat(F.transform("plain", lambda x: x.cast("double")), F.array(rest))
    unit = F.transform(longer, lambda x: (x / F.lit(float(whole["most"]) ** 0.5)).cast("float"))
    even = written(nodes.select("node", unit.alias("vector")), "ann_unit")
    graph = neighbour_graph(even, whole["n"], buckets)
    asking = rows.where(F.col("vec_id") % every == 0).join(nodes.select("key", "node"), "key")
    asking = written(asking.select(F.col("vec_id").alias("query_id"), "node"), "ann_queries")
    starts = asking.select("node").distinct().join(nodes, "node").select(F.col("node").alias("query"), F.col("plain").alias("vector"))
    found = graph_search(starts, nodes, graph, buckets)
    # One more than asked for, as a query does not find itself.
    smallest = Window.partitionBy("key").orderBy("vec_id")
    members = rows.select("key", "vec_id").withColumn("k", F.row_number().over(smallest)).where(F.col("k") <= nearest + 1)
    members = members.join(nodes.select("key", "node"), "key").select("node", "vec_id")
    listed = found.select("query", F.explode(F.arrays_zip("others", "scores")).alias("x"))
    listed = listed.select("query", F.col("x.others").alias("node"), F.col("x.scores").alias("score"))
    listed = asking.withColumnRenamed("node", "query").join(listed, "query").join(members, "node").where("vec_id <> query_id")
    in_order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = listed.withColumn("rank", F.row_number().over(in_order)).where(F.col("rank") <= nearest)
    return ranked.select("query_id", "rank", "vec_id", "score")
