"""Introductions of NN-descent, on members that know some of the others."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from feedback_engine.llm import descent


def test_whom_a_member_knows_is_no_news():
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(6, 4)).astype(np.float32)
    beside = [[2, 3], [1], [1, 2, 4, 5, 6], [], [99], [1, 2]]
    table = pa.table(
        {
            "host": pa.array([7] * 6, pa.int64()),
            "member": pa.array(range(1, 7), pa.int64()),
            "score": pa.array([0.5] * 6, pa.float32()),
            "new": pa.array([True] * 6),
            "vector": pa.array(vectors.tolist(), pa.list_(pa.float32())),
            "worst": pa.array([-np.inf] * 6, pa.float32()),
            "beside": pa.array(beside, pa.list_(pa.int64())),
        }
    )
    found = descent._introduce(table)
    got = {node: set(others) for node, others in zip(found["node"].to_pylist(), found["others"].to_pylist())}
    wanted = {k + 1: {x for x in range(1, 7) if x != k + 1} - set(known) for k, known in enumerate(beside)}
    assert got == {node: others for node, others in wanted.items() if others}
    assert 3 not in got


def place(rng, hosts=60, members=40):
    """Edges of hosts to some of the members, whose vector is with the first of their hosts; members 0 to 3 in turn are in buckets 0 to 3."""
    vectors = rng.normal(size=(members, 8)).astype(np.float32)
    rows, seen = [], set()
    for host in range(hosts):
        for member in rng.choice(members, 12, replace=False).tolist():
            first = member not in seen
            seen.add(member)
            told = (member % 4, vectors[member].tolist(), -1.0, [(member + 1) % members]) if first else (None,) * 4
            rows.append((0, 0, 1000 + host, member, float(rng.random()), True, *told))
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float32(), pa.bool_(), pa.int32(), pa.list_(pa.float32()), pa.float32(), pa.list_(pa.int64())]
    names = ["place", "part", "host", "member", "score", "new", "bucket", "vector", "worst", "beside"]
    return pa.table([pa.array(x, kind) for x, kind in zip(zip(*rows), kinds)], names=names), vectors


def test_a_place_sends_a_row_to_each_bucket():
    table, vectors = place(np.random.default_rng(2))
    sent = descent._news(table)
    assert sorted(sent["bucket"].to_pylist()) == [0, 1, 2, 3]
    got = {}
    for row in sent.to_pylist():
        assert {m % 4 for m in row["members"]} == {row["bucket"]}
        for member, other, score in zip(row["members"], row["others"], row["scores"]):
            assert abs(score - vectors[member] @ vectors[other]) < 1e-4 and other != (member + 1) % 40
            got.setdefault(member, set()).add(other)
    # No less than when every edge has the vector of its member, and a list goes to each member.
    whole = {r["member"]: r for r in table.to_pylist() if r["vector"] is not None}
    full = pa.Table.from_pylist([r | {x: whole[r["member"]][x] for x in ("bucket", "vector", "worst", "beside")} for r in table.to_pylist()], table.schema)
    found = descent._introduce(full)
    assert got == {node: set(others) for node, others in zip(found["node"].to_pylist(), found["others"].to_pylist())}


def test_graph_does_not_depend_on_the_number_of_buckets(spark, monkeypatch):
    """News from several places reaches every member: the graph of few vectors is exact, however they are dealt out."""
    rng = np.random.default_rng(3)
    vectors = rng.normal(size=(300, 16))
    vectors = (vectors / np.linalg.norm(vectors, axis=1)[:, None]).astype(np.float32)
    nodes = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(vectors)], "node long, vector array<float>")
    monkeypatch.setattr(descent, "LEAF", 40)
    monkeypatch.setattr(descent, "BUCKET", 50)
    score = vectors @ vectors.T
    np.fill_diagonal(score, -np.inf)
    near = np.argsort(-score, axis=1)[:, :10]
    for buckets in (1, 7):
        graph = {r.node: r for r in descent.neighbour_graph(nodes, len(vectors), buckets).collect()}
        assert sorted(graph) == list(range(len(vectors)))
        for r in graph.values():
            assert len(set(r.others)) == len(r.others) == descent.DEGREE and r.node not in r.others
            assert r.scores == sorted(r.scores, reverse=True)
        assert sum(len({*near[k].tolist()} & {*r.others}) for k, r in graph.items()) >= 0.98 * near.size


def test_introductions_are_those_of_each_host(monkeypatch):
    """Hosts of one member to more than they introduce, a few at a time, against a loop over hosts and members."""
    rng = np.random.default_rng(5)
    monkeypatch.setattr(descent, "HOSTS", 7)
    monkeypatch.setattr(descent, "MEMBERS", 10)
    vectors = rng.normal(size=(50, 8)).astype(np.float32)
    worst = rng.normal(size=50).astype(np.float32)
    rows, wanted = [], {}
    for host in range(40):
        score = rng.random(14)
        members = rng.choice(50, int(rng.integers(1, 15)), replace=False)
        new = rng.random(len(members)) < 0.4
        rows += [(host, int(m), float(score[k]), bool(new[k])) for k, m in enumerate(members)]
        near = np.argsort(-score[: len(members)])[:10]
        for a in near:
            met = [(float(vectors[members[a]] @ vectors[members[b]]), int(members[b])) for b in near if b != a and (new[a] or new[b])]
            for value, other in sorted(met, reverse=True)[: descent.INTRODUCED]:
                if value > worst[members[a]]:
                    wanted.setdefault(int(members[a]), {})[other] = value
    host, member, score, new = zip(*rows)
    table = pa.table(
        {
            "host": pa.array(host, pa.int64()),
            "member": pa.array(member, pa.int64()),
            "score": pa.array(score, pa.float32()),
            "new": pa.array(new),
            "vector": pa.array([vectors[m].tolist() for m in member], pa.list_(pa.float32())),
            "worst": pa.array([worst[m] for m in member], pa.float32()),
            "beside": pa.array([[]] * len(member), pa.list_(pa.int64())),
        }
    )
    found = descent._introduce(table).to_pylist()
    best = {m: sorted(x, key=lambda o: -x[o])[: descent.DEGREE] for m, x in wanted.items()}
    assert {r["node"]: r["others"] for r in found} == best
