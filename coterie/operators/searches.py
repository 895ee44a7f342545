"""Searches of dense graphs within tasks.

Betweenness of all sources, for graphs of a bounded size: each task searches from its own sources and sums by edge itself.

Vertices are numbered and their neighbour lists sent compressed, as in ``cells``, once for each task, as a broadcast would. A task
advances its sources level by level, some at a time, as the columns of matrices with a row for each vertex. No state leaves the task; it
sends one number for each edge, and these are summed by strips of vertices.

Some sources, for larger graphs: the lists are cut into parts that stay where they are. At each level a part gets what the vertices
of all parts hold, compressed, a matrix with a column for each source, and finds from its own lists what its vertices hold at the next. No edge is
shuffled after the lists are made, and credit is summed by edge where the list of its lower vertex is. Betweenness of all sources of a
graph too large for a task goes that way, too, some sources after others, with one sum for each edge carried on.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.limits import limit
from ..plans.order import with_rank
from ..plans.scratch import Saved, Scratch, remove
from ..plans.skew import fits, lookup_join
from .cells import _STRIP, _STRIPS, _lists, _merged, _unpack
from .edges import vertices

# Bytes of a matrix, and sources searched at once.
_MATRIX = 16 << 20
_MOST = 128
_SUMS = "strip long, task long, credits binary, others binary, most double"
# Neighbours that a part of the lists holds, in 4 bytes each.
_PART = 14 << 20
# Rows of credit by source that a task sends at once.
_SENT = 200_000
_HELD = "part long, batch long, code binary, seen binary, found long, most double"


def _ends(strips: list[int], codes: list[bytes], held: list[int], words: int) -> tuple[np.ndarray, np.ndarray]:
    """Vertex and neighbour of each entry of the lists, in order."""
    keys = [_unpack(c, n) + s * _STRIP * 64 * words for s, c, n in zip(strips, codes, held)]
    return np.divmod(np.concatenate(keys), 64 * words)


def _levels(lists: list[np.ndarray], degrees: np.ndarray, some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each vertex and each source of ``some`` the number of shortest paths and the hop level, -1 where none leads."""
    n = len(lists)
    paths, depth = np.zeros((n, len(some))), np.full((n, len(some)), -1, np.int32)
    at = some, np.arange(len(some))
    paths[at], depth[at] = 1, 0
    front, level = paths.copy(), 0
    while (depth < 0).any():
        reached = np.zeros_like(paths)
        ahead, left = front.any(axis=1), (depth < 0).any(axis=1)
        # From the side with fewer edges.
        if degrees[ahead].sum() <= degrees[left].sum():
            for u in np.flatnonzero(ahead).tolist():
                reached[lists[u]] += front[u]
        else:
            for u in np.flatnonzero(left).tolist():
                reached[u] = front[lists[u]].sum(axis=0)
        fresh = (reached > 0) & (depth < 0)
        if not fresh.any():
            break
        level += 1
        front = np.where(fresh, reached, 0.0)
        paths += front
        depth[fresh] = level
    return paths, depth


def _searched(words: int, tasks: int):
    """For the sources of a task the credit of every edge, at its entry with the lower vertex first, and the weight they reach."""

    def search(table: pa.Table) -> pa.Table:
        table = table.sort_by("strip")
        strips, hefts = table["strip"].to_pylist(), np.concatenate([np.array(h) for h in table["hefts"].to_pylist()])
        task, n = table["task"][0].as_py(), len(hefts)
        vertex, other = _ends(strips, table["code"].to_pylist(), table["held"].to_pylist(), words)
        cuts = np.searchsorted(vertex, np.arange(n + 1))
        other = other.astype(np.int32)
        lists = [other[i:j] for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist())]
        credits, others, most = np.zeros(len(other)), np.zeros(n), 0.0
        own = np.arange(task, n, tasks)
        width = max(1, min(_MOST, _MATRIX // (8 * n)))
        for k in range(0, len(own), width):
            some = own[k : k + width]
            with np.errstate(all="ignore"):  # an overflow is told by ``most``
                paths, depth = _levels(lists, np.diff(cuts), some)
                most = max(most, float(paths.max()))
                others[some] = hefts @ (depth > 0)
                weight = hefts[:, None] * hefts[some]
                gathered = np.zeros_like(paths)
                for level in range(int(depth.max()), 0, -1):
                    # What a vertex passes for each path of a parent, and the paths of the parents.
                    shares = np.where(depth == level, (weight + gathered) / paths, 0.0)
                    parents = np.where(depth == level - 1, paths, 0.0)
                    for u in np.flatnonzero(parents.any(axis=1)).tolist():
                        passed = shares[lists[u]]
                        credits[cuts[u] : cuts[u + 1]] += passed @ parents[u]
                        gathered[u] += parents[u] * passed.sum(axis=0)
        # An edge is used from either end; both are added where the lower one is.
        back = np.argsort(other, kind="stable")
        credits += credits[back]
        low = vertex < other
        edge = np.searchsorted(vertex, [s * _STRIP for s in [*strips, strips[-1] + 1]])
        rows = [(credits[i:j][low[i:j]].tobytes(), others[s * _STRIP : (s + 1) * _STRIP].tobytes()) for s, i, j in zip(strips, edge, edge[1:])]
        return pa.table({
            "strip": pa.array(strips, pa.int64()), "task": pa.array([task] * len(strips), pa.int64()),
            "credits": pa.array([r[0] for r in rows], pa.binary()), "others": pa.array([r[1] for r in rows], pa.binary()),
            "most": pa.array([most] * len(strips), pa.float64()),
        })

    return search


def _summed(words: int):
    """The sums of all tasks by edge ``(a, b)`` and, without ``b``, by source."""

    def add(key: tuple, sums: pa.Table, lists: pa.Table) -> pa.Table:
        sums = sums.sort_by("task")
        credits, others = (sum(np.frombuffer(x) for x in sums[c].to_pylist()) for c in ("credits", "others"))
        a, b = _ends(*(lists[c].to_pylist() for c in ("strip", "code", "held")), words)
        low = a < b
        strip = np.arange(len(others)) + key[0].as_py() * _STRIP
        return pa.table({
            "a": np.concatenate([a[low], strip]),
            "b": pa.array(np.concatenate([b[low], strip]), mask=np.arange(low.sum() + len(strip)) >= low.sum()),
            "credit": np.concatenate([credits, others]),
        })

    return add


def credits_in_tasks(edges: Saved, hefts: Saved, scratch: Scratch) -> DataFrame | None:
    """``(src, dst, credit)`` summed over all sources, and ``(src, null, others)``; None where the graph is too small, too large or sparse.

    ``hefts (vertex, heft)`` has the vertices that stand for more than themselves; ``others`` is the weight that a source reaches besides itself.
    """
    spark = scratch.spark
    if not limit(spark, "searchEdges") <= edges.rows <= limit(spark, "taskEdges"):
        return None
    numbered = scratch.save(
        with_rank(vertices(edges.df), [F.col("vertex")], "rank", scratch).selectExpr("vertex", "rank - 1 AS number")
    )
    if not edges.rows or edges.rows < limit(spark, "taskDegree") * numbered.rows:
        return None
    words = -(-numbered.rows // 64)
    lists = scratch.save(_numbered_lists(edges, numbered, words, scratch))
    weights = (
        lookup_join(numbered, hefts, ["vertex"], scratch, "left")
        .select(F.expr(f"number DIV {_STRIP}").alias("strip"), F.struct("number", F.coalesce("heft", F.lit(1.0)).alias("heft")).alias("own"))
        .groupBy("strip").agg(F.sort_array(F.collect_list("own"))["heft"].alias("hefts"))
    )
    tasks = min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-numbered.rows // _MOST))
    copies = lists.df.join(weights, "strip").select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(tasks - 1).cast("long"))).alias("task"))
    sums = scratch.save(
        copies.repartitionByRange(tasks, "task").groupBy("task").applyInArrow(_searched(words, tasks), _SUMS), most=F.max("most")
    )
    if sums.metrics["most"] == float("inf"):
        raise OverflowError("more shortest paths between two vertices than a double can count")
    found = sums.df.drop("most").groupBy("strip").cogroup(lists.df.groupBy("strip")).applyInArrow(_summed(words), "a long, b long, credit double")
    of_a, of_b = numbered.select("number AS a", "vertex AS src"), numbered.select("number AS b", "vertex AS dst")
    named = lookup_join(lookup_join(found, of_a, ["a"], scratch), of_b, ["b"], scratch, "left")
    return scratch.save(named.select("src", "dst", "credit")).df


def _coded(matrix: np.ndarray) -> bytes:
    """Doubles compressed by byte planes."""
    planes = np.ascontiguousarray(np.ascontiguousarray(matrix).reshape(-1).view(np.uint8).reshape(-1, 8).T)
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _decoded(code: bytes, rows: int, width: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(code, 8 * rows * width, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(8, -1).T).view(np.float64).reshape(rows, width)


@dataclass(frozen=True)
class _Shape:
    """How vertices are cut into ``parts`` by strips in turn, and sources into batches of ``widths`` columns."""

    words: int
    parts: int
    widths: tuple[int, ...]

    def own(self, part: int) -> np.ndarray:
        """The numbers of the vertices of a part; the last strip may go beyond the last vertex."""
        return (np.arange(part, self.words, self.parts)[:, None] * _STRIP + np.arange(_STRIP)).ravel()

    def lists(self, table: pa.Table, part: int) -> list[np.ndarray]:
        """The ascending neighbours of each vertex of a part."""
        near = [np.zeros(0, np.int32)] * len(self.own(part))
        for strip, held, code in zip(*(table[c].to_pylist() for c in ("strip", "held", "code"))):
            at, other = np.divmod(_unpack(code, held), 64 * self.words)
            first = (strip - part) // self.parts * _STRIP
            near[first : first + _STRIP] = np.split(other.astype(np.int32), np.searchsorted(at, np.arange(1, _STRIP)))
        return near

    def whole(self, rows: list[dict], width: int) -> np.ndarray:
        """The matrix of all vertices from what the parts sent."""
        out = np.zeros((64 * self.words, width))
        for row in rows:
            own = self.own(row["part"])
            out[own] = _decoded(row["code"], len(own), width)
        return out


def _row(part: int, batch: int, held: np.ndarray, seen: np.ndarray | None = None) -> dict:
    bits = None if seen is None else pa.compress(np.packbits(seen).tobytes(), codec="zstd", asbytes=True)
    most = float(held.max(initial=0.0))
    return {"part": part, "batch": batch, "code": _coded(held), "seen": bits, "found": int((held > 0).sum()), "most": most}


_HELD_ARROW = pa.schema([
    ("part", pa.int64()), ("batch", pa.int64()), ("code", pa.binary()), ("seen", pa.binary()), ("found", pa.int64()), ("most", pa.float64()),
])


def _started(shape: _Shape):
    """Every source of a part at itself."""

    def start(key: tuple, parts: pa.Table, sources: pa.Table) -> pa.Table:
        part, rows, before = key[0].as_py(), [], 0
        number, slot = (sources[c].to_numpy() for c in ("number", "slot"))
        row = number // _STRIP // shape.parts * _STRIP + number % _STRIP
        for batch, width in enumerate(shape.widths):
            held = np.zeros((len(shape.own(part)), width))
            mine = (slot >= before) & (slot < before + width)
            held[row[mine], slot[mine] - before] = 1
            rows.append(_row(part, batch, held, held > 0))
            before += width
        return pa.Table.from_pylist(rows, _HELD_ARROW)

    return start


def _advanced(shape: _Shape):
    """The path counts of the vertices of a part that are first reached from the level given."""

    def advance(key: tuple, lists: pa.Table, sent: pa.Table) -> pa.Table:
        part, rows, sent = key[0].as_py(), [], sent.to_pylist()
        near = shape.lists(lists, part)
        for batch, width in enumerate(shape.widths):
            some = [r for r in sent if r["batch"] == batch]
            front = shape.whole(some, width)
            bits = next(r["seen"] for r in some if r["seen"] is not None)
            held = len(near) * width
            bits = np.frombuffer(pa.decompress(bits, -(-held // 8), codec="zstd", asbytes=True), np.uint8)
            seen = np.unpackbits(bits, count=held).astype(bool).reshape(-1, width)
            reached = np.zeros(seen.shape)
            with np.errstate(all="ignore"):  # an overflow is told by ``most``
                for u in np.flatnonzero(~seen.all(axis=1)).tolist():
                    reached[u] = front[near[u]].sum(axis=0)
            reached[seen] = 0
            rows.append(_row(part, batch, reached, seen | (reached > 0)))
        return pa.Table.from_pylist(rows, _HELD_ARROW)

    return advance


def _shared(shape: _Shape):
    """What each vertex of a level passes for each path of a parent, from ``paths`` of the level and what the next level passes."""

    def share(key: tuple, lists: pa.Table, sent: pa.Table) -> pa.Table:
        part, rows, sent = key[0].as_py(), [], sent.to_pylist()
        near = shape.lists(lists, part)
        for batch, width in enumerate(shape.widths):
            some = [r for r in sent if r["batch"] == batch]
            paths = _decoded(next(r["code"] for r in some if r["kind"] == "paths"), len(near), width)
            passed = shape.whole([r for r in some if r["kind"] == "shares"], width)
            shares = np.zeros(paths.shape)
            with np.errstate(all="ignore"):
                for u in np.flatnonzero(paths.any(axis=1)).tolist():
                    shares[u] = np.where(paths[u] > 0, (1 + paths[u] * passed[near[u]].sum(axis=0)) / paths[u], 0.0)
            rows.append(_row(part, batch, shares))
        return pa.Table.from_pylist(rows, _HELD_ARROW)

    return share


def _matrices(shape: _Shape, sent: list[dict]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each batch of sources the path counts, the shares and the levels of all vertices."""
    for batch, width in enumerate(shape.widths):
        some = [r for r in sent if r["batch"] == batch]
        paths, shares = np.zeros((64 * shape.words, width)), np.zeros((64 * shape.words, width))
        depth = np.full(paths.shape, -9, np.int32)
        for level in sorted({r["depth"] for r in some}):
            at = shape.whole([r for r in some if r["kind"] == "paths" and r["depth"] == level], width)
            paths += at
            depth[at > 0] = level
            shares += shape.whole([r for r in some if r["kind"] == "shares" and r["depth"] == level], width)
        yield paths, shares, depth


def _above(shape: _Shape, lists: pa.Table, part: int) -> list[tuple[int, np.ndarray]]:
    """The vertices of a part, and of each the neighbours with higher numbers."""
    return [(u, n[np.searchsorted(n, u, side="right") :]) for u, n in zip(shape.own(part).tolist(), shape.lists(lists, part))]


def _add(shape: _Shape, near: list[tuple[int, np.ndarray]], sums: list[np.ndarray], sent: list[dict]) -> None:
    """Add to the sums of the edges above each vertex what all sources give to them."""
    for paths, shares, depth in _matrices(shape, sent):
        for (u, n), s in zip(near, sums):
            if len(n):
                apart = depth[n] - depth[u]
                s += np.where(apart == 1, shares[n], 0.0) @ paths[u]
                s += np.where(apart == -1, paths[n], 0.0) @ shares[u]


def _credited(shape: _Shape):
    """The credit of each edge, where the list of its lower vertex is, over all sources."""

    def credit(key: tuple, lists: pa.Table, sent: pa.Table) -> pa.Table:
        near = _above(shape, lists, key[0].as_py())
        sums = [np.zeros(len(n)) for _, n in near]
        _add(shape, near, sums, sent.to_pylist())
        a = np.repeat([u for u, _ in near], [len(n) for _, n in near])
        b, sums = np.concatenate([n for _, n in near]), np.concatenate(sums)
        used = sums > 0
        return pa.table({"a": a[used], "b": b[used].astype(np.int64), "credit": sums[used]})

    return credit


def _strip_sums(near: list[tuple[int, np.ndarray]], sent: dict[int, bytes]) -> list[np.ndarray]:
    """The sums of the edges above each vertex, from those of its strip, or zeros."""
    sums = []
    for k in range(0, len(near), _STRIP):
        held = [len(n) for _, n in near[k : k + _STRIP]]
        code = sent.get(near[k][0] // _STRIP)
        before = np.zeros(sum(held)) if code is None else np.frombuffer(code).copy()
        sums += np.split(before, np.cumsum(held)[:-1])
    return sums


def _carried(shape: _Shape):
    """The sums of the edges of a part, strip by strip, with the credit from these sources added to those sent as ``sums``."""

    def add(key: tuple, lists: pa.Table, sent: pa.Table) -> pa.Table:
        part, rows = key[0].as_py(), sent.to_pylist()
        near = _above(shape, lists, part)
        sums = _strip_sums(near, {r["strip"]: r["sums"] for r in rows if r["kind"] == "sums"})
        _add(shape, near, sums, [r for r in rows if r["kind"] != "sums"])
        starts = range(0, len(near), _STRIP)
        codes = [np.concatenate(sums[k : k + _STRIP]).tobytes() for k in starts]
        return pa.table({
            "part": pa.array([part] * len(codes), pa.int64()), "strip": pa.array([near[k][0] // _STRIP for k in starts], pa.int64()),
            "sums": pa.array(codes, pa.binary()),
        })

    return add


def _by_edge(shape: _Shape):
    """``(a, b, credit)`` of the sums of a part."""

    def read(key: tuple, lists: pa.Table, sums: pa.Table) -> pa.Table:
        near = _above(shape, lists, key[0].as_py())
        held = _strip_sums(near, dict(zip(sums["strip"].to_pylist(), sums["sums"].to_pylist())))
        a = np.repeat([u for u, _ in near], [len(n) for _, n in near])
        return pa.table({"a": a.astype(np.int64), "b": np.concatenate([n for _, n in near]).astype(np.int64), "credit": np.concatenate(held)})

    return read


def _credited_by_source(shape: _Shape):
    """The credit of each edge from each source, sent on bit by bit; ``kind`` tells the lists of a part from what all parts hold."""
    befores = np.cumsum([0, *shape.widths]).tolist()

    def credit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches))
        kinds, part = np.array(table["kind"].to_pylist()), table["to"][0].as_py()
        near = _above(shape, table.filter(pa.array(kinds == "lists")), part)
        sent = table.filter(pa.array(kinds != "lists")).to_pylist()
        del table
        for before, (paths, shares, depth) in zip(befores, _matrices(shape, sent)):
            found, held = [], 0
            for u, n in [*near, (-1, None)]:
                if n is not None and len(n):
                    apart = depth[n] - depth[u]
                    given = np.where(apart == 1, shares[n] * paths[u], 0.0)
                    given += np.where(apart == -1, paths[n] * shares[u], 0.0)
                    at, slot = np.nonzero(given)
                    found.append((np.full(len(at), u), n[at].astype(np.int64), slot + before, given[at, slot]))
                    held += len(at)
                if held and (n is None or held >= _SENT):
                    columns = [pa.array(np.concatenate(c)) for c in zip(*found)]
                    yield pa.RecordBatch.from_arrays(columns, names=["a", "b", "slot", "credit"])
                    found, held = [], 0

    return credit


def _reached(shape: _Shape):
    """``(number, slot, depth, sigma)`` of the states of rows."""
    befores = np.cumsum([0, *shape.widths]).tolist()

    def read(batches):
        for batch in batches:
            for row in batch.to_pylist():
                own = shape.own(row["part"])
                held = _decoded(row["code"], len(own), shape.widths[row["batch"]])
                at, slot = np.nonzero(held)
                depth = np.full(len(at), row["depth"], np.int32)
                columns = own[at], slot + befores[row["batch"]], depth, held[at, slot]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["number", "slot", "depth", "sigma"])

    return read


class PartSearch:
    """The shortest paths from some sources of a dense graph, level by level; see the top of this module."""

    def __init__(self, numbered: Saved, slots: Saved, lists: DataFrame, shape: _Shape, scratch: Scratch):
        self.numbered, self.slots, self.lists, self.shape, self.scratch = numbered, slots, lists, shape, scratch
        parts = scratch.spark.range(shape.parts).select(F.col("id").alias("part"))
        of_part = slots.df.withColumn("part", F.expr(f"number DIV {_STRIP} % {shape.parts}"))
        starts = parts.groupBy("part").cogroup(of_part.groupBy("part")).applyInArrow(_started(shape), _HELD)
        metrics = {"found": F.sum("found"), "most": F.max("most")}
        self.levels = [scratch.save(starts, **metrics)]
        while self.levels[-1].metrics["found"]:
            self.levels.append(scratch.save(self._run(self._sent(self.levels[-1].df), _advanced(shape), _HELD), **metrics))
            if self.levels[-1].metrics["most"] == float("inf"):
                raise OverflowError("more shortest paths between two vertices than a double can count")
        self.levels.pop()

    def _sent(self, rows: DataFrame) -> DataFrame:
        """A copy of each row for every part, named by ``to``; only the part itself gets what it has seen."""
        to = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(self.shape.parts - 1).cast("long"))).alias("to")
        return rows.select("*", to).withColumn("seen", F.expr("IF(part = to, seen, NULL)"))

    def _run(self, sent: DataFrame, function: Callable, schema: str) -> DataFrame:
        return self.lists.groupBy("to").cogroup(sent.groupBy("to")).applyInArrow(function, schema)

    def paths(self) -> DataFrame:
        """``(source, vertex, depth, sigma)``."""
        read, schema = _reached(self.shape), "number long, slot long, depth int, sigma double"
        found = _by_depth(self.levels).mapInArrow(read, schema)
        named = lookup_join(found, self.numbered.select("number", "vertex"), ["number"], self.scratch)
        return lookup_join(named, self.slots.select("slot", "vertex AS source"), ["slot"], self.scratch).select("source", "vertex", "depth", "sigma")

    def _states(self) -> DataFrame:
        """The path counts of all levels and, by ``kind``, what each vertex passes for each path of a parent."""
        shares = [None] * len(self.levels)
        for depth in range(len(self.levels) - 1, 0, -1):
            sent = self.levels[depth].df.select("*", F.col("part").alias("to"), F.lit("paths").alias("kind"))
            if depth + 1 < len(self.levels):
                sent = sent.unionByName(self._sent(shares[depth + 1].df).withColumn("kind", F.lit("shares")))
            shares[depth] = self.scratch.save(self._run(sent, _shared(self.shape), _HELD))
        states = _by_depth(self.levels).withColumn("kind", F.lit("paths"))
        return states.unionByName(_by_depth(shares).withColumn("kind", F.lit("shares"))) if len(shares) > 1 else states

    def _ends(self, found: DataFrame, numbered: Saved) -> DataFrame:
        return _named(found, numbered, self.scratch)

    def carried(self, before: Saved | None) -> DataFrame:
        """``(part, strip, sums)``: the sums of all edges with the credit from the sources added to those of ``before``."""
        sent = self._sent(self._states())
        if before is not None:
            kept = before.df.withColumns({"to": F.col("part"), "kind": F.lit("sums")})
            sent = sent.unionByName(kept, allowMissingColumns=True)
        else:
            sent = sent.withColumns({"strip": F.lit(None).cast("long"), "sums": F.lit(None).cast("binary")})
        return self._run(sent, _carried(self.shape), "part long, strip long, sums binary")

    def credits(self) -> DataFrame:
        """``(src, dst, credit)`` summed over the sources."""
        found = self._run(self._sent(self._states()), _credited(self.shape), "a long, b long, credit double")
        return self._ends(found, self.numbered).select("src", "dst", "credit")

    def credits_by_source(self) -> DataFrame:
        """``(source, src, dst, credit)``, up to a row for each source and edge: where the vertices are broadcast, only what these are found from is written."""
        keep = lambda df: self.scratch.save(df, keep=True)
        lists, states = keep(self.lists).df, keep(self._states()).df
        numbered, slots = keep(self.numbered.df), keep(self.slots.df)
        columns = ["to", "kind", "part", "batch", "depth", "strip", "held", "code"]
        none = lambda df: df.select(*[c if c in df.columns else F.lit(None).cast("long").alias(c) for c in columns])
        rows = none(lists.withColumn("kind", F.lit("lists"))).unionByName(none(self._sent(states)))
        found = (
            rows.repartition(self.shape.parts, "to").groupBy("to")
            .applyInArrow(_credited_by_source(self.shape), "a long, b long, slot long, credit double")
        )
        named = lookup_join(self._ends(found, numbered), slots.select("slot", "vertex AS source"), ["slot"], self.scratch)
        out = named.select("source", "src", "dst", "credit")
        if not (fits(numbered, self.scratch) and fits(slots, self.scratch)):
            return keep(out).df
        out._coterie_result = self.scratch.root
        return out


def _named(found: DataFrame, numbered: Saved, scratch: Scratch) -> DataFrame:
    of_a, of_b = numbered.select("number AS a", "vertex AS src"), numbered.select("number AS b", "vertex AS dst")
    return lookup_join(lookup_join(found, of_a, ["a"], scratch), of_b, ["b"], scratch)


def _by_depth(levels: list[Saved | None]) -> DataFrame:
    """All levels as one table."""
    rows = [level.df.withColumn("depth", F.lit(depth)) for depth, level in enumerate(levels) if level]
    return reduce(DataFrame.unionByName, rows)


def search_in_parts(edges: Saved, sources: DataFrame, scratch: Scratch) -> PartSearch | None:
    """The search from ``sources (vertex)``, or None where the graph is small or sparse, or the states are many."""
    spark = scratch.spark
    if 2 * edges.rows <= limit(spark, "broadcastRows"):
        return None
    numbered = scratch.save(
        with_rank(vertices(edges.df), [F.col("vertex")], "rank", scratch).selectExpr("vertex", "rank - 1 AS number")
    )
    if 8 * numbered.rows > _MATRIX or edges.rows < limit(spark, "taskDegree") * numbered.rows:
        return None
    asked = scratch.save(lookup_join(numbered, scratch.save(sources.select("vertex").distinct()), ["vertex"], scratch, "left_semi"))
    if not 0 < asked.rows * numbered.rows <= limit(spark, "statesPerPartition") * int(spark.conf.get("spark.sql.shuffle.partitions")):
        return None
    slots = scratch.save(with_rank(asked.df, [F.col("number")], "rank", scratch).selectExpr("vertex", "number", "rank - 1 AS slot"))
    shape = _shape(edges, numbered, asked.rows)
    return PartSearch(numbered, slots, _lists_in_parts(edges, numbered, shape, scratch), shape, scratch)


def credits_of_all(edges: Saved, scratch: Scratch) -> DataFrame | None:
    """``(src, dst, credit)`` summed over all sources of a dense graph too large for a task; None where it is not one.

    Some sources are searched after others, as many as ``search_in_parts`` takes; what is written for them goes when their credit is
    added to the sums, one number for each edge. So the disk that this takes does not grow with the sources.
    """
    spark = scratch.spark
    if edges.rows <= limit(spark, "taskEdges"):
        return None
    numbered = scratch.save(
        with_rank(vertices(edges.df), [F.col("vertex")], "rank", scratch).selectExpr("vertex", "rank - 1 AS number")
    )
    if 8 * numbered.rows > _MATRIX or edges.rows < limit(spark, "taskDegree") * numbered.rows:
        return None
    most = max(1, limit(spark, "statesPerPartition") * int(spark.conf.get("spark.sql.shuffle.partitions")) // numbered.rows)
    lists, sums = _lists_in_parts(edges, numbered, _shape(edges, numbered, most), scratch), None
    for first in range(0, numbered.rows, most):
        asked = min(most, numbered.rows - first)
        with Scratch(spark) as inner:
            own = numbered.df.where((F.col("number") >= first) & (F.col("number") < first + asked))
            slots = Saved(own.withColumn("slot", F.col("number") - first), asked)
            before, sums = sums, scratch.save(PartSearch(numbered, slots, lists, _shape(edges, numbered, asked), inner).carried(sums))
        if before is not None:
            remove(spark, before.path)
        spark.sparkContext._jvm.System.gc()  # Spark removes shuffle files only when the plans that made them are collected
    found = lists.groupBy("to").cogroup(sums.df.withColumnRenamed("part", "to").groupBy("to"))
    by_edge = found.applyInArrow(_by_edge(_shape(edges, numbered, most)), "a long, b long, credit double")
    return _named(by_edge, numbered, scratch).select("src", "dst", "credit")


def _shape(edges: Saved, numbered: Saved, sources: int) -> _Shape:
    words = -(-numbered.rows // 64)
    batches = -(-sources // max(1, min(_MOST, _MATRIX // (8 * numbered.rows))))
    widths = tuple(sources // batches + (i < sources % batches) for i in range(batches))
    return _Shape(words, min(words, -(-2 * edges.rows // _PART)), widths)


def _lists_in_parts(edges: Saved, numbered: Saved, shape: _Shape, scratch: Scratch) -> DataFrame:
    lists = _numbered_lists(edges, numbered, shape.words, scratch).withColumn("to", F.expr(f"strip % {shape.parts}"))
    return scratch.cache(lists.repartition(shape.parts, "to"))


def _numbered_lists(edges: Saved, numbered: Saved, words: int, scratch: Scratch) -> DataFrame:
    one = lookup_join(edges, numbered.select("vertex AS src", "number AS a"), ["src"], scratch)
    ends = lookup_join(one, numbered.select("vertex AS dst", "number AS b"), ["dst"], scratch, keys_of=edges).select("a", "b")
    return ends.mapInArrow(_lists(words), _STRIPS).groupBy("strip").applyInArrow(_merged, _STRIPS)
