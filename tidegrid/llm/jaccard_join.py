"""Exact Jaccard self-join of documents' word shingles, as a metric-space join.

One minus the Jaccard similarity is a metric, so a pivot tells documents apart: two whose
distances to it differ by more than the join's distance cannot link.

1. Documents with equal shingle sets, by number and two hashes, fold into the one of least id.
2. Distances between unrelated texts gather at one, where no pivot tells them apart, so
   documents are cut into regions first.  Linked documents share one of their first
   shingles in a common order (as many as a link may leave unshared, and one more).  The order
   is by hash, with shingles that are frequent in a sample last, by their number there; any order is exact.  Documents
   that share such a mark meet once, however many marks they share, as counts of
   their shingles by hash class.  These embed the sets so that distances only shrink: counts that are
   too far apart rule a link out, and what they leave connected forms a region.
3. A region is joined recursively and exactly.  Its documents go to the Voronoi cells of pivots; windows that follow
   from the triangle inequality copy boundary documents to the cells whose documents they may
   link to; and cells are joined in turn, the smallest by comparing what is not connected yet.
   Regions of very many documents or shingles are cut into cells distributed, with pivots chosen by hash; one that pivots no
   longer shrink is joined exactly by pairs of blocks.

What a link connects already is compared no more, so the result keeps every connection; no group's pairs
are listed.  Rows without id are left out; null and wordless texts have no shingles and link with
nothing.  Texts of fewer words than a shingle link with those of the same words.  Rows that share an id are one node of the links, each with its own row.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fold, saved, small_batches, small_side, text_bytes, tidy_after
from .components import components
from .groups import changes, key_runs, scan
from .textbytes import mix, shingles

#: Documents of a region, or of those that share a mark, that one task joins, and shingles of all of them.
REGION, REGION_SHINGLES = 2000, 4_000_000
#: Documents of the sample that tells frequent shingles, about, or one in so many if these are more: a share of all,
#: so that a mark of few documents stays one as the input grows.  A shingle is frequent that so many of them have.
SAMPLE, ONE_IN, TIMES = 20_000, 8, 4
#: Shingles that the sample may name.
FREQUENT = 1_000_000
#: Rows of a table of ids that may be broadcast, at most; beyond it all texts or sets are shuffled to meet it.
IDS = 1_000_000
#: Pivots of a round on a larger region, and of a task's region; documents of a cell that is cut no further.
PIVOTS, CELL_PIVOTS, CELL = 16, 8, 48
#: Groups of equal sets that hold more than one document in so many are broadcast, of which there are fewer.
HOT = 10_000
_SETS = pa.schema([("doc", pa.int64()), ("n", pa.int64()), ("digest", pa.int64()), ("total", pa.int64()), ("prefix", pa.binary()), ("classes", pa.binary())])
_MARKS = pa.schema([("mark", pa.int64()), ("doc", pa.int64())])
_MEETINGS = pa.schema([("meeting", pa.int64()), ("n_docs", pa.int64()), ("docs", pa.list_(pa.int64()))])
_EDGES = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _table(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _digests(s: np.ndarray) -> tuple[int, int]:
    """Two hashes of a whole set; 0 for the empty one."""
    if not len(s):
        return 0, 0
    both = np.array([np.bitwise_xor.reduce(mix(s + np.uint64(1))), np.add.reduce(s)], dtype=np.uint64)
    return tuple(both.view(np.int64).tolist())


def _levels(n: np.ndarray) -> np.ndarray:
    """Hash classes of a set's counts: a power of two, a few shingles to each class."""
    return 1 << np.ceil(np.log2(np.maximum(np.asarray(n), 32) / 4)).astype(np.int64)


def _keep(n: int, percent: int) -> int:
    """Marks of a set: sharing at least percent/100 of the larger set leaves so many unshared, and one more."""
    return n - -(-percent * n // 100) + 1


def _sets(width: int, percent: int, frequent: np.ndarray, times: np.ndarray):
    """Size, digest, marks and class counts of each document's shingle set."""

    @tidy_after
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            texts = [t.lower() for t in batch.column(1).to_pylist()]
            n, digest, total, prefix, classes = [], [], [], [], []
            for _, s in shingles(texts, width):
                n.append(len(s))
                first, second = _digests(s)
                digest.append(first)
                total.append(second)
                level = int(_levels(len(s)))
                classes.append(np.minimum(np.bincount((s & np.uint64(level - 1)).astype(np.int64), minlength=level), 255).astype(np.uint8).tobytes())
                keep = _keep(len(s), percent)
                if len(frequent) and len(s):
                    place = np.minimum(np.searchsorted(frequent, s), len(frequent) - 1)
                    common = frequent[place] == s
                    if common[: 2 * keep].any():
                        s = np.concatenate((s[~common], s[common][np.argsort(times[place[common]], kind="stable")]))
                prefix.append(s[:keep].tobytes())
            yield _table(_SETS, batch.column(0), n, digest, total, prefix, classes)

    return run


def _frequent(plain: DataFrame, width: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that several documents of a sample have, sorted, and how many of them.

    Of each text those three times as many that come first by hash as it has marks: later ones become
    marks only where most of a text is frequent.
    """
    total = max(plain.count(), 1)
    parts = 1_000_000
    sample = plain.where(F.pmod(F.xxhash64("doc"), F.lit(parts)) < max(parts // ONE_IN, parts * SAMPLE // total))

    @tidy_after
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            found = [s[: 3 * _keep(len(s), percent)] for _, s in shingles([t.lower() for t in batch.column(1).to_pylist()], width)]
            value, times = np.unique(np.concatenate([*found, np.zeros(0, dtype=np.uint64)]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(value.view(np.int64)), pa.array(times.astype(np.int64))], names=["shingle", "n"])

    counted = sample.select("doc", "text").mapInArrow(run, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
    rows = counted.where(F.col("n") >= TIMES).orderBy(F.desc("n"), "shingle").limit(FREQUENT).toPandas()
    value, n = rows["shingle"].to_numpy(dtype=np.int64).view(np.uint64), rows["n"].to_numpy(dtype=np.int64)
    order = np.argsort(value)
    return value[order], n[order]


def _marks(only: np.ndarray | None = None):
    """A row for each mark of each document; of those in ``only``, sorted, if it is given."""

    @tidy_after
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column(1).to_pylist()
            count = np.fromiter((len(r) // 8 for r in raw), dtype=np.int64, count=len(raw))
            mark, doc = np.frombuffer(b"".join(raw), dtype=np.int64), np.repeat(batch.column(0).to_numpy(), count)
            if only is not None:
                place = np.minimum(np.searchsorted(only, mark.view(np.uint64)), len(only) - 1)
                chosen = only[place] == mark.view(np.uint64)
                mark, doc = mark[chosen], doc[chosen]
            yield _table(_MARKS, mark, doc)

    return run


def _crowds(own: DataFrame, frequent: np.ndarray, region_docs: int) -> DataFrame | None:
    """Frequent marks of more documents than one task joins, with the first document; None if there are none.

    Counted with partial sums, so that no task gathers a mark's documents.  At most as many
    rows as there are frequent shingles.
    """
    if not len(frequent):
        return None
    counted = own.select("doc", "prefix").mapInArrow(_marks(frequent), "mark long, doc long")
    counted = counted.groupBy("mark").agg(F.count("*").alias("n"), F.min("doc").alias("first")).where(F.col("n") > region_docs)
    counted = saved(counted.select("mark", "first"), "crowds")
    return counted if counted.limit(1).count() else None


def _unique(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    keep = changes(a, b)
    return a[keep], b[keep]


@tidy_after
def _meetings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents that share a mark, named by a hash of their ids; each set of them once a batch."""
    for part in key_runs(batches, "mark"):
        edge = np.flatnonzero(changes(part["mark"]))
        size = np.diff(np.concatenate((edge, [len(part["mark"])])))
        code = mix(part["doc"].view(np.uint64) ^ np.uint64(0x5851F42D4C957F2D))
        name = mix(np.add.reduceat(code, edge)).view(np.int64) if len(edge) else np.zeros(0, np.int64)
        several = np.flatnonzero(size > 1)
        _, once = np.unique(name[several], return_index=True)
        chosen = several[once]
        docs = [part["doc"][edge[i] : edge[i] + size[i]] for i in chosen.tolist()]
        yield pa.RecordBatch.from_arrays([pa.array(name[chosen]), pa.array(size[chosen]), pa.array(docs, type=pa.list_(pa.int64()))], schema=_MEETINGS)


def connect_possible(n: np.ndarray, classes: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Pairs that connect all documents between which counts do not rule out a link.

    ``n`` ascends.  Each document in turn is a pivot for those of like size that are not
    connected to it yet.
    """
    group = np.arange(len(n))
    level = _levels(n)
    folded: dict[int, np.ndarray] = {}
    pairs = []
    for p in range(len(n)):
        stop = int(np.searchsorted(n, n[p] * 100 // percent, side="right"))
        other = np.flatnonzero(group[p + 1 : stop] != group[p]) + p + 1
        if not len(other):
            continue
        size = int(level[p])
        if size not in folded:
            folded.clear()
            # class counts of larger documents fold to this level
            until = int(np.searchsorted(n, n[level == size].max() * 100 // percent, side="right"))
            rows = np.zeros((until, size), dtype=np.int16)
            for i in range(p, until):
                rows[i] = classes[i].reshape(-1, size).sum(axis=0)
            folded[size] = rows
        rows = folded[size]
        apart = np.abs(rows[other] - rows[p]).sum(axis=1)
        for x in other[(100 + percent) * apart <= (100 - percent) * (n[other] + n[p])].tolist():
            if group[x] != group[p]:
                pairs.append((p, x))
                group[group == group[x]] = group[p]
    return pairs


def _possible(percent: int):
    def step(part: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        edge = np.flatnonzero(changes(part["meeting"])).tolist()
        a, b = [], []
        for lo, hi in zip(edge, [*edge[1:], len(part["meeting"])], strict=True):
            doc = part["doc"][lo:hi]
            counts = [np.frombuffer(c, dtype=np.uint8) for c in part["classes"][lo:hi]]
            for i, j in connect_possible(part["n"][lo:hi], counts, percent):
                a.append(max(doc[i], doc[j]))
                b.append(min(doc[i], doc[j]))
        a, b = _unique(np.array(a, dtype=np.int64), np.array(b, dtype=np.int64))
        return {"a": a, "b": b}

    return scan("meeting", _EDGES, step)


class Region:
    """Documents as rows of numbered shingles; distances to one of them at a time."""

    def __init__(self, sets: list[np.ndarray]) -> None:
        self.size = np.array([len(s) for s in sets], dtype=np.int64)
        self.start = np.concatenate(([0], np.cumsum(self.size)))
        distinct, self.flat = np.unique(np.concatenate(sets), return_inverse=True)
        self.has = np.zeros(len(distinct), dtype=bool)

        self._last: tuple[int, np.ndarray] | None = None

    def shared(self, pivot: int) -> np.ndarray:
        if self._last and self._last[0] == pivot:
            return self._last[1]
        own = self.flat[self.start[pivot] : self.start[pivot + 1]]
        self.has[own] = True
        out = np.add.reduceat(self.has[self.flat], self.start[:-1], dtype=np.int64)
        self.has[own] = False
        self._last = pivot, out
        return out

    def distance(self, pivot: int) -> np.ndarray:
        shared = self.shared(pivot)
        return 1 - shared / (self.size + self.size[pivot] - shared)

    def near(self, pivot: int, percent: int) -> np.ndarray:
        shared = self.shared(pivot)
        return 100 * shared >= percent * (self.size + self.size[pivot] - shared)


class Links:
    """Links found, and which documents of a region they connect."""

    def __init__(self, n: int) -> None:
        self.group = np.arange(n)
        self.pairs: list[tuple[int, int]] = []

    def add(self, one: int, others: np.ndarray) -> None:
        for x in others.tolist():
            if self.group[x] != self.group[one]:
                self.pairs.append((one, x))
                self.group[self.group == self.group[x]] = self.group[one]


def join_region(region: Region, percent: int, left: np.ndarray, boundary: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect what links within ``left``, and between it and ``boundary``.

    Each document of ``left`` goes to the Voronoi cell of its nearest pivot.  A link is shorter than the reach, so
    its other end lies within the reach of the cell's distances to every pivot, and at most twice the
    reach farther from the cell's pivot than from its own: such boundary documents are copied to the cell, of
    two cells of ``left`` to the earlier one.  Cells are joined recursively.  In a small one each document is
    compared with those that no link connects to it yet.
    """
    reach, links, work = 1 - percent / 100 + 1e-9, Links(len(region.size)), [(left, boundary)]
    while work:
        left, boundary = work.pop()
        if len(left) and (links.group[left] == links.group[left[0]]).all():
            boundary = boundary[links.group[boundary] != links.group[left[0]]]
            if not len(boundary):
                continue
        if len(left) <= CELL:
            _finish(region, percent, left, boundary, links)
            continue
        # pivots far from each other; the rows are distances from each
        pivots, rows = [], []
        apart = np.full(len(left), np.inf)
        while len(pivots) < CELL_PIVOTS and apart.max() > 0:
            pivots.append(int(left[np.argmax(apart)]))
            rows.append(region.distance(pivots[-1]))
            near = region.near(pivots[-1], percent)
            links.add(pivots[-1], np.concatenate((left[near[left]], boundary[near[boundary]])))
            apart = np.minimum(apart, rows[-1][left])
        to = np.array(rows)
        home = np.argmin(to[:, left], axis=0)
        if (home == home[0]).all():
            _finish(region, percent, left, boundary, links)
            continue
        nearest = to[home, left]
        for c in range(len(pivots)):
            own = left[home == c]
            if len(own):
                low, high = to[:, own].min(axis=1) - reach, to[:, own].max(axis=1) + reach
                later = left[(home > c) & (to[c, left] <= nearest + 2 * reach)]
                others = np.concatenate((later, boundary))
                work.append((own, others[((to[:, others] >= low[:, None]) & (to[:, others] <= high[:, None])).all(axis=0)]))
    return links.pairs


def _finish(region: Region, percent: int, left: np.ndarray, boundary: np.ndarray, links: Links) -> None:
    """Compares each document of ``left`` with those after it and of ``boundary`` that are not connected to it yet."""
    for i, one in enumerate(left.tolist()):
        others = np.concatenate((left[i + 1 :], boundary))
        others = others[links.group[others] != links.group[one]]
        if len(others):
            links.add(one, others[region.near(one, percent)[others]])


def _join_regions(percent: int):
    """Joins whole regions; of a pair of blocks only pairs across, unless it is one block."""

    @tidy_after
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in key_runs(batches, "region"):
            edges = np.flatnonzero(changes(part["region"])).tolist()
            out: list[tuple[int, int]] = []
            for lo, hi in zip(edges, [*edges[1:], len(part["region"])], strict=True):
                region = Region([np.frombuffer(s, dtype=np.uint64) for s in part["shingles"][lo:hi]])
                side = part["side"][lo:hi]
                left, boundary = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
                doc = part["doc"][lo:hi]
                if (side == 2).any():
                    found = join_across(region, percent, np.flatnonzero(side != 2), np.flatnonzero(side == 2))
                else:
                    found = join_region(region, percent, left, boundary)
                out += [(doc[i], doc[j]) for i, j in found]
            a = np.array([max(x) for x in out], dtype=np.int64)
            b = np.array([min(x) for x in out], dtype=np.int64)
            yield _table(_EDGES, a, b)

    return run


def join_across(region: Region, percent: int, one: np.ndarray, two: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect what links between ``one`` and ``two`` connect; fewer than there are documents."""
    links = Links(len(region.size))
    for i in one.tolist():
        others = two[links.group[two] != links.group[i]]
        if len(others):
            links.add(i, others[region.near(i, percent)[others]])
    return links.pairs


def _with_sets(docs: DataFrame, width: int) -> DataFrame:
    """``region``, ``doc``, ``side`` and sorted shingles of documents with a region."""
    schema = pa.schema([("region", pa.int64()), ("doc", pa.int64()), ("side", pa.int32()), ("shingles", pa.binary())])

    @tidy_after
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            found = [s.tobytes() for _, s in shingles([t.lower() for t in batch.column(2).to_pylist()], width)]
            yield _table(schema, batch.column(0), batch.column(1), np.zeros(len(found), dtype=np.int32), found)

    return docs.select("region", "doc", "text").mapInArrow(run, "region long, doc long, side int, shingles binary")


@tidy_after
def _distances(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shared shingles and set sizes of each document with each of its region's pivots."""
    for batch in batches:
        at = {n: i for i, n in enumerate(batch.schema.names)}
        shared = []
        for own, pivots in zip(batch.column(at["shingles"]).to_pylist(), batch.column(at["pivots"]).to_pylist(), strict=True):
            own = np.frombuffer(own, dtype=np.uint64)
            row = []
            for p in pivots:
                p = np.frombuffer(p["shingles"], dtype=np.uint64)
                place = np.minimum(np.searchsorted(own, p), len(own) - 1)
                both = int((own[place] == p).sum())
                row.append({"pivot": 0, "both": both, "either": len(own) + len(p) - both})
            for d, p in zip(row, pivots, strict=True):
                d["pivot"] = p["doc"]
            shared.append(row)
        kind = pa.list_(pa.struct([("pivot", pa.int64()), ("both", pa.int64()), ("either", pa.int64())]))
        kept = ["region", "doc", "side", "shingles"]
        yield pa.RecordBatch.from_arrays([*[batch.column(at[n]) for n in kept], pa.array(shared, type=kind)], names=[*kept, "to"])


def _large_regions(rows: DataFrame, percent: int, region_docs: int) -> tuple[list[DataFrame], DataFrame | None]:
    """``join_region``'s cells, distributed, until small tasks can finish: links found, and those tasks' rows."""
    reach, links, finish = 1 - percent / 100 + 1e-9, [], None
    while True:
        before = rows.count()
        if not before:
            return links, finish
        # pivots: for each of so many hash classes, the left document of least hash
        by_hash = rows.where("side = 0").groupBy("region", F.pmod(F.xxhash64("doc"), F.lit(PIVOTS)).alias("slot"))
        pivots = by_hash.agg(F.min_by(F.struct("doc", "shingles"), F.xxhash64("doc", F.lit(1))).alias("p")).groupBy("region").agg(F.collect_list("p").alias("pivots"))
        pivots = small_side(saved(pivots, "pivots"), 200)
        near = rows.join(pivots, "region").mapInArrow(_distances, "region long, doc long, side int, shingles binary, to array<struct<pivot:long,both:long,either:long>>")
        near = near.withColumns({"d": F.transform("to", lambda p: 1 - p["both"] / p["either"]), "ball": F.transform("to", lambda p: 100 * p["both"] >= percent * p["either"])})
        near = saved(near.withColumn("home", (F.array_position("d", F.array_min("d")) - 1).cast("int")), "near")
        hits = near.select("doc", F.explode(F.arrays_zip("to", "ball")).alias("p")).where("p.ball")
        links.append(hits.select(F.greatest("doc", "p.to.pivot").alias("a"), F.least("doc", "p.to.pivot").alias("b")).where("a <> b"))
        # each cell's windows, and whether it has documents that its pivot does not link to
        least, most = (F.array(*[f(F.get("d", F.lit(i))) for i in range(PIVOTS)]) for f in (F.min, F.max))
        cells = near.where("side = 0").groupBy("region", "home").agg(least.alias("low"), most.alias("high"), F.max(~F.get("ball", "home")).alias("rim"))
        cells = cells.groupBy("region").agg(F.collect_list(F.struct(F.col("home").alias("cell"), "low", "high", "rim")).alias("cells"))

        def belongs(c):
            own = (F.col("side") == 0) & (F.col("home") == c["cell"])
            may = (F.col("side") == 1) | (F.col("home") > c["cell"]) & (F.get("d", c["cell"]) <= F.get("d", "home") + 2 * reach)
            inside = F.forall(F.transform("d", lambda x, i: (x >= c["low"][i] - reach) & (x <= c["high"][i] + reach)), lambda ok: ok)
            linked = ~c["rim"] & F.get("ball", c["cell"])  # to the pivot, as all of the cell are
            return own | may & inside & ~linked

        kept = near.join(small_side(saved(cells, "cells"), 10_000), "region").withColumn("c", F.explode(F.filter("cells", belongs)))
        side = F.when((F.col("side") == 0) & (F.col("home") == F.col("c.cell")), 0).otherwise(1).cast("int")
        after = saved(kept.select(F.xxhash64("region", "c.cell").alias("region"), "doc", side.alias("side"), "shingles"), "regions")
        size = saved(_sizes(after), "sizes")
        large = size.agg(F.coalesce(F.sum(F.when(_much(region_docs), F.col("size"))), F.lit(0))).first()[0]
        if large > 0.9 * before:
            # pivots tell nothing apart here
            size = saved(_sizes(rows), "sizes")
            blocks = _blocks(rows, size, region_docs)
            return links, blocks if finish is None else finish.unionByName(blocks)
        done = after.join(small_side(size.where(~_much(region_docs)).select("region")), "region", "left_semi")
        finish = done if finish is None else finish.unionByName(done)
        rows = after.join(small_side(size.where(_much(region_docs)).select("region"), 10_000), "region", "left_semi")


def _sizes(rows: DataFrame) -> DataFrame:
    """Documents and shingles of each region."""
    return rows.groupBy("region").agg(F.count("*").alias("size"), F.sum(F.length("shingles") / 8).cast("long").alias("weight"))


def _much(region_docs: int) -> Column:
    """Whether a region is too much for one task; a lone document never is."""
    return (F.col("size") > region_docs) | (F.col("size") > 1) & (F.col("weight") > REGION_SHINGLES)


def _blocks(rows: DataFrame, size: DataFrame, region_docs: int) -> DataFrame:
    """Pairs of blocks as regions of their own; the second block of a pair has side 2."""
    by_docs, by_weight = F.ceil(F.col("size") / (region_docs // 2)), F.ceil(2 * F.col("weight") / REGION_SHINGLES)
    n = size.select("region", F.least(F.greatest(by_docs, by_weight), F.col("size")).cast("int").alias("blocks"))
    dealt = rows.join(small_side(n, 10_000), "region").withColumn("block", F.pmod(F.xxhash64("doc"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    pairs = dealt.withColumn("other", other)
    one, two = F.least("block", "other"), F.greatest("block", "other")
    side = F.when(F.col("block") == F.col("other"), F.col("side")).when(F.col("block") > F.col("other"), 2).otherwise(0)
    return pairs.select(F.xxhash64("region", one, two).alias("region"), "doc", side.cast("int").alias("side"), "shingles")


def _folded(sets: DataFrame) -> DataFrame:
    """``doc``, ``n`` and ``first``, the least document with the same set.

    Groups are counted with partial sums.  Those of very many documents go to the documents, as they
    cannot be many; the documents of the others meet their group.
    """
    same = ["n", "digest", "total"]
    groups = sets.where("n > 0").groupBy(*same).agg(F.min("doc").alias("first"), F.count("*").alias("copies")).where("copies > 1")
    groups = saved(groups, "groups")
    most = max(sets.count() // HOT, 1)
    hot = F.broadcast(groups.where(F.col("copies") > most).select(*same, F.col("first").alias("hot")))  # HOT rows at most
    told = sets.select("doc", *same).join(hot, same, "left")
    rest = told.where("hot is null").join(groups.where(F.col("copies") <= most).select(*same, "first"), same, "left")
    every = told.where("hot is not null").select("doc", "n", F.col("hot").alias("first"))
    return every.unionByName(rest.select("doc", "n", F.coalesce("first", "doc").alias("first")))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80, region_docs: int = REGION) -> DataFrame:
    """Per row: doc_id, n_shingles, and component_id, the least id reachable by links."""
    parts = fold(docs.sparkSession)
    plain = docs.select(F.col(id_col).cast("long").alias("doc"), text_bytes(text_col).alias("text")).where("doc is not null")
    frequent, times = _frequent(plain, width, percent)
    sets = saved(plain.mapInArrow(_sets(width, percent, frequent, times), "doc long, n long, digest long, total long, prefix binary, classes binary"), "sets")
    members = saved(_folded(sets), "members")
    folded = small_side(saved(members.where("doc <> first").select("doc").distinct(), "folded"), IDS)
    own = sets.where("n > 0").join(folded, "doc", "left_anti")
    marks = own.select("doc", "prefix").mapInArrow(_marks(), "mark long, doc long")
    crowds = _crowds(own, frequent, region_docs)
    stars: list[DataFrame] = []
    if crowds is not None:
        # many at one mark: connected without a look at counts, for the distributed rounds to part
        marks = marks.join(small_side(crowds, FREQUENT), "mark", "left")
        stars.append(marks.where("doc <> first").select(F.col("doc").alias("a"), F.col("first").alias("b")).distinct())
        marks = marks.where("first is null").drop("first")
    marks = marks.repartition(parts, "mark").sortWithinPartitions("mark", "doc")
    met = marks.mapInArrow(_meetings, "meeting long, n_docs long, docs array<long>")
    met = saved(met.groupBy("meeting", "n_docs").agg(F.first("docs").alias("docs")), "meetings")
    # so many at a mark that is not frequent come up only where a region's limit is a small share of all
    stars.append(met.where(F.col("n_docs") > region_docs).select(F.explode("docs").alias("a"), F.array_min("docs").alias("b")).where("a <> b"))
    pairs = met.where(F.col("n_docs") <= region_docs).select("meeting", F.explode("docs").alias("doc"))
    pairs = pairs.join(small_side(own.select("doc", "n", "classes"), 20_000), "doc").select("meeting", "n", "doc", "classes")
    pairs = pairs.repartition(parts, "meeting").sortWithinPartitions("meeting", "n", "doc").mapInArrow(_possible(percent), "a long, b long")
    related = components(reduce(DataFrame.unionByName, stars, pairs))
    regions = saved(related.select(F.col("node").alias("doc"), F.col("component").alias("region")), "regions")
    weighed = regions.join(own.select("doc", "n"), "doc")
    size = saved(weighed.groupBy("region").agg(F.count("*").alias("size"), F.sum("n").alias("weight")), "sizes")
    large = small_side(size.where(_much(region_docs)).select("region"), 10_000)
    text = plain.join(small_side(regions, IDS), "doc")
    tasks = [_with_sets(text.join(large, "region", "left_anti"), width)]
    links: list[DataFrame] = []
    if size.where(_much(region_docs)).limit(1).count():
        links, rest = _large_regions(saved(_with_sets(text.join(large, "region", "left_semi"), width), "regions"), percent, region_docs)
        tasks += [rest] if rest is not None else []
    for task in tasks:
        task = task.where(F.length("shingles") > 0).repartition(parts, "region").sortWithinPartitions("region", "doc")
        links.append(task.mapInArrow(_join_regions(percent), "a long, b long"))
    every = links[0]
    for more in links[1:]:
        every = every.unionByName(more)
    linked = components(every)
    named = members.join(linked, members["first"] == linked["node"], "left")
    return named.select(F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"), F.coalesce("component", "first").alias("component_id"))


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document, that of least id, of each group; all columns stay."""
    groups = near_duplicates(docs, id_col, text_col, width, percent)
    extra = groups.where("doc_id <> component_id").select("doc_id").distinct()
    # a name that no column of docs has, however its columns are called
    other = max(["extra", *docs.columns], key=len) + "_"
    extra = saved(extra.withColumnRenamed("doc_id", other), "extra")
    return docs.join(small_side(extra), F.col(id_col) == F.col(other), "left_anti")
