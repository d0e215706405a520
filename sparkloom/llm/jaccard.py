"""N-gram Jaccard join with a token-group matrix.

1. Every text becomes a set of hashed shingles; equal sets are one node.
2. A set is cut into as many parts, by ranges of its hashes, as two linked sets
   can differ in shingles, and some more. So linked sets have whole parts in
   common, and each part gives a key. A key stands for several shingles that lie
   anywhere in a text, so a line or passage that many texts hold is no key by itself.
3. Of the keys that several nodes have each node may leave out some, the most
   frequent ones, as linked sets have more in common than one.
4. Nodes that share a key are held against the smallest of them; what these
   links connect needs no comparison any more (not where links are counted).
5. Nodes are put into groups by their most frequent key, and large groups into tiles of
   bounded size. A group's row of the matrix is the union of its shingles. Two
   tiles meet if they share a key. Where a node's overlap with the union cannot
   reach the threshold no member can be linked to it; only for the others the
   tile is opened, and its members are compared exactly.
6. The links connect the nodes; a component is named by its smallest id.
"""

from __future__ import annotations

import math
from bisect import bisect_right

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import dropped, fresh, release_caches, small_batches, text_or_empty, written
from .components import components
from .shingling import mixed, shingle_sets

#: Nodes and shingles in a tile, and queries of a node that one task takes.
TILE, TILE_SHINGLES, QUERIES = 512, 1 << 18, 4096
#: Bits of a key that tell its class of sizes.
KINDS = 3
#: Slots of a task's own memory of keys, a power of two.
SLOTS = 1 << 18


class _Need:
    """Integer arithmetic of the threshold ``num`` / ``den``, and the classes of sizes.

    A pair of linked sets meets in the class of the larger one, so a set takes part in
    its own class and in those of the sizes it may be linked to above.
    """

    def __init__(self, num: int, den: int):
        if not 0 < num <= den <= 2 * num:
            raise ValueError("the threshold must lie between one half and one")
        self.num, self.den, self.starts = num, den, [1, 2]

    def linked(self, common, a, b):
        return self.den * common >= self.num * (a + b - common)

    def least(self, a: int) -> int:
        """Shingles that a set of ``a`` must share with any set it is linked to."""
        return -(-self.num * a // self.den)

    def largest(self, a: int) -> int:
        return a * self.den // self.num

    def sizes(self, a: Column, b: Column) -> Column:
        """If sets of these sizes can be linked."""
        return (F.lit(self.den) * a >= F.lit(self.num) * b) & (F.lit(self.den) * b >= F.lit(self.num) * a)

    def differ(self, a: int, b: int) -> int:
        """Shingles at most that only one of two linked sets has."""
        return (self.den - self.num) * (a + b) // (self.den + self.num)

    def kind(self, a: int) -> int:
        while self.starts[-1] <= a:
            self.starts.append(max(self.starts[-1] + 1, self.starts[-1] * 3 // 2))
        return bisect_right(self.starts, a) - 1

    def top(self, kind: int) -> int:
        while len(self.starts) <= kind + 1:
            self.kind(self.starts[-1])
        return self.starts[kind + 1] - 1

    def keys(self, s: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, int]:
        """The keys of a set with running sums ``of`` its mixed hashes, and how many of each class may be left out.

        Sets of a class are cut into ``differ + 1 + slack`` parts. Two linked sets differ in
        ``most`` shingles at the most, so all parts but as many are equal. Of the
        equal ones some may be empty, in both. What is left tells how many keys
        a set may leave out in a fixed order and still share one with any set it is linked to:
        those of greatest hash are left out here, and up to ``slack`` later in
        order of frequency. The slack is the same for all sets of a class, so a
        pair that loses common keys here has both sides keep the rest. A set with
        so many empty parts that all equal ones may be empty keeps every key.
        """
        n, found, drops = len(s), [], 0
        largest = self.largest(n)
        for i, kind in enumerate(range(self.kind(n), self.kind(largest) + 1)):
            top = self.top(kind)
            most = self.differ(n, min(top, largest))
            if not most:
                continue  # only equal sets are linked
            differ = self.differ(top, top)
            slack = min(-(-differ // 10) + 1, (1 << 18) - 1)
            parts = differ + 1 + slack
            at = np.zeros(parts + 1, np.int64)
            at[1:-1] = np.searchsorted(s, np.arange(1, parts, dtype=np.uint64) * np.uint64((1 << 64) // parts))
            at[-1] = n
            some = np.flatnonzero(at[1:] > at[:-1])
            empty = parts - len(some)
            spare = parts - most - 1 - empty
            if spare < 0:
                some, spare = np.arange(parts), 0
            with np.errstate(over="ignore"):
                keys = mixed(mixed(of[at[some + 1]] - of[at[some]] + np.uint64(kind)) + some.astype(np.uint64))
            keys = (keys & ~np.uint64((1 << KINDS) - 1)) | np.uint64(kind % (1 << KINDS))
            later = min(spare, slack)
            if spare > later:
                keys = np.sort(keys)[: len(keys) - (spare - later)]
            found.append(keys)
            drops |= (later << KINDS | kind % (1 << KINDS)) << (21 * i)
        return np.concatenate(found) if found else s[:0], drops


def _name(n: int, total: np.uint64) -> int:
    """A 64-bit number that stands for a set of this size and sum of mixed hashes."""
    with np.errstate(over="ignore"):
        return int(mixed(mixed(np.full(1, n, np.uint64)) + total).view(np.int64)[0])


def _sums(s: np.ndarray) -> np.ndarray:
    out = np.zeros(len(s) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(mixed(s), out=out[1:])
    return out


def _lists(some: list[np.ndarray], kind):
    import pyarrow as pa

    ends = np.zeros(len(some) + 1, np.int32)
    np.cumsum([len(x) for x in some], out=ends[1:])
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*some, np.empty(0, kind)]).view(np.int64)))


def _sets(rows: DataFrame, n: int, need: _Need) -> DataFrame:
    """``doc_id, t, n, node, drops, keys, again, first`` of each row of ``doc_id, t, text``.

    A set that a task has met before gets no keys. A key that the task remembers from
    another node is in ``again``, with that node in ``first``, and not in ``keys``. So
    however many rows hold a key, few of them are dealt out to see if it is shared.
    """

    def make(batches):
        import pyarrow as pa

        release_caches()
        seen: set[int] = set()
        held, holder = np.zeros(SLOTS, np.uint64), np.zeros(SLOTS, np.int64)
        shift = np.uint64(64 - SLOTS.bit_length() + 1)
        for batch in batches:
            ids, sizes, nodes, drops, keys, again, first = batch.column(0).to_pylist(), [], [], [], [], [], []
            none, nobody = held[:0], holder[:0]
            for doc, s in zip(ids, shingle_sets(batch.column(2), n)):
                of = _sums(s)
                node = _name(len(s), of[-1])
                sizes.append(len(s))
                nodes.append(node)
                if doc is None or not len(s) or node in seen:
                    drops.append(need.keys(s, of)[1] if len(s) else 0)
                    keys.append(none), again.append(none), first.append(nobody)
                    continue
                if len(seen) >= SLOTS:
                    seen.clear()
                seen.add(node)
                k, d = need.keys(s, of)
                drops.append(d)
                slot = (k >> shift).astype(np.int64)
                known = (held[slot] == k) & (holder[slot] != node)
                again.append(k[known])
                first.append(holder[slot[known]])
                k, slot = k[~known], slot[~known]
                held[slot], holder[slot] = k, node
                keys.append(k)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *(pa.array(x, pa.int64()) for x in (sizes, nodes, drops)), _lists(keys, np.uint64), _lists(again, np.uint64), _lists(first, np.int64)],
                names=["doc_id", "t", "n", "node", "drops", "keys", "again", "first"],
            )

    return rows.mapInArrow(make, "doc_id long, t long, n long, node long, drops long, keys array<long>, again array<long>, first array<long>")


def _kept_keys(sets: DataFrame, nodes: DataFrame) -> DataFrame:
    """``key, node, n, c``: the keys that several nodes have, less the most frequent ones that a node may leave out."""
    once = sets.select("node", F.explode("keys").alias("key"))
    same = Window.partitionBy("key")  # a row for a node and task at most
    shared = once.withColumn("lo", F.min("node").over(same)).withColumn("hi", F.max("node").over(same)).where("lo <> hi").select("key", "node")
    repeated = sets.select("node", F.inline(F.arrays_zip("again", "first"))).select(F.col("again").alias("key"), F.explode(F.array("node", "first")).alias("node"))
    members = written(shared.unionByName(repeated).distinct(), "members")
    kind = F.col("key").bitwiseAND((1 << KINDS) - 1)
    spare = F.lit(0).cast("long")
    for i in range(3):
        slot = F.shiftrightunsigned("drops", 21 * i).bitwiseAND((1 << 21) - 1)
        spare = spare + F.when(slot.bitwiseAND((1 << KINDS) - 1) == kind, F.shiftright(slot, KINDS)).otherwise(0)
    counts = members.groupBy("key").agg(F.count("*").alias("c"))
    own = Window.partitionBy("node", "kind")  # the keys of one text
    ranked = members.join(counts, "key").join(nodes.select("node", "n", "drops"), "node").withColumn("kind", kind)
    ranked = ranked.withColumn("nth", F.row_number().over(own.orderBy("c", "key"))).withColumn("many", F.count("*").over(own))
    some = written(ranked.where(F.col("nth") <= F.col("many") - spare).select("key", "node", "n"), "some")
    counts = some.groupBy("key").agg(F.count("*").alias("c")).where("c > 1")
    kept = written(some.join(counts, "key"), "kept")
    for t in (members, some):
        dropped(t)
    return kept


def _token_sets(rows: DataFrame, nodes: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """``node, w, s``: the sets of the wanted nodes and how many rows have them, from one text of each."""
    wanted = written(wanted.distinct().join(nodes.select("node", "w", F.col("rep.doc_id").alias("id"), F.col("rep.t").alias("rt")), "node"), "wanted")
    # A set of at most 2 ** 20 hash values, which is broadcast, keeps most other texts from the shuffle.
    cell = lambda c: F.pmod(F.xxhash64(c), F.lit(1 << 20)).cast("int")
    near = rows.join(F.broadcast(wanted.select(cell("id").alias("cell")).distinct()), cell("doc_id") == F.col("cell"), "left_semi")
    texts = near.join(wanted, (F.col("doc_id") == F.col("id")) & (F.col("t") == F.col("rt")))
    one = texts.withColumn("nth", F.row_number().over(Window.partitionBy("id", "node").orderBy("t"))).where("nth = 1").select("node", "w", "text")

    def make(batches):
        import pyarrow as pa

        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), _lists(list(shingle_sets(batch.column(2), n)), np.uint64)], names=["node", "w", "s"])

    return one.mapInArrow(make, "node long, w long, s array<long>")


class _Tile:
    """The members of a tile, and the union of their shingles with the members that hold each."""

    def __init__(self, need: _Need):
        self.need, self.nodes, self.weights, self.sets = need, [], [], []

    def add(self, node: int, weight: int, s: np.ndarray) -> None:
        self.nodes.append(node), self.weights.append(weight), self.sets.append(s)

    def close(self) -> None:
        self.size, self.weight = np.array([len(s) for s in self.sets], np.int64), np.array(self.weights, np.int64)
        every = np.concatenate(self.sets)
        order = np.argsort(every, kind="stable")
        self.tokens, self.owner = every[order], np.repeat(np.arange(len(self.sets)), self.size)[order]
        self.group, self.links = np.arange(len(self.sets)), np.zeros(len(self.sets), np.int64)

    def linked(self, s: np.ndarray) -> np.ndarray:
        """The places of the members linked to a set; none if the union shares too little with it."""
        left, right = np.searchsorted(self.tokens, s, "left"), np.searchsorted(self.tokens, s, "right")
        held = right - left
        if np.count_nonzero(held) < self.need.least(len(s)):
            return self.owner[:0]
        left, held = left[held > 0], held[held > 0]
        at = np.repeat(left - np.cumsum(held) + held, held) + np.arange(held.sum())
        common = np.bincount(self.owner[at], minlength=len(self.sets))
        return np.flatnonzero(self.need.linked(common, len(s), self.size))

    def meet(self, places: np.ndarray, node: int, weight: int, edges: list) -> int:
        """Note links of a node to members. Only one to each group that earlier links made becomes an edge."""
        if not len(places):
            return 0
        self.links[places] += weight
        groups, first = np.unique(self.group[places], return_index=True)
        edges += [(node, self.nodes[i], 0) for i in places[first].tolist()]
        if len(groups) > 1:
            self.group[np.isin(self.group, groups)] = groups[0]
        return int(self.weight[places].sum())


def _open(units: DataFrame, sets: DataFrame, need: _Need, counts: bool) -> DataFrame:
    """``a, b, links`` from units of work.

    ``units``: ``a, b, side, node``. The nodes of side 1 are compared with those of side 0, which are a tile;
    where ``a`` is ``b`` those of side 0 are compared with each other. A row with ``b`` is an edge
    of a forest that connects what is linked in the unit, so the rows are no
    more than the nodes; one without, if ``counts``, tells how many rows a node is linked to.
    The tile comes first in the stream, so a task holds one tile at a time.
    """
    stream = units.join(sets, "node").select("a", "b", "side", "node", "w", "s").repartition("a", "b").sortWithinPartitions("a", "b", "side", "node")

    def compare(batches):
        import pyarrow as pa

        release_caches()
        unit, tile, open_, found = None, None, True, []

        def end():
            if tile is None:
                return
            if open_:
                tile.close()
            if unit[0] == unit[1]:
                for i in range(1, len(tile.nodes)):
                    places = tile.linked(tile.sets[i])
                    places = places[places < i]
                    groups = np.unique(tile.group[places])
                    n = tile.meet(places, tile.nodes[i], tile.weights[i], found)
                    if len(groups):
                        tile.group[i] = groups[0]
                    tile.links[i] += n
            if counts:
                found.extend((x, None, n) for x, n in zip(tile.nodes, tile.links.tolist()) if n)

        def batch_of():
            a, b, n = zip(*found)
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(n, pa.int64())], names=["a", "b", "links"])

        for batch in batches:
            places = zip(*(batch.column(i).to_pylist() for i in range(5)))
            ends, tokens = batch.column(5).offsets.to_numpy(), batch.column(5).values.to_numpy().view(np.uint64)
            for i, (a, b, side, node, w) in enumerate(places):
                if (a, b) != unit:
                    end()
                    unit, tile, open_ = (a, b), _Tile(need), True
                s = tokens[ends[i] : ends[i + 1]]
                if side == 0:
                    tile.add(node, w, s)
                    continue
                if not tile.nodes:
                    continue
                if open_:
                    tile.close()
                    open_ = False
                n = tile.meet(tile.linked(s), node, w, found)
                if n and counts:
                    found.append((node, None, n))
            if found:
                yield batch_of()
                found.clear()
        end()
        if found:
            yield batch_of()

    return stream.mapInArrow(compare, "a long, b long, links long")


def _pivot_units(kept: DataFrame, nodes: DataFrame, need: _Need) -> DataFrame:
    """Each node against the smallest of each key it has."""
    pivots = kept.groupBy("key").agg(F.min("node").alias("a"))
    pairs = kept.join(pivots, "key").where("node <> a").select("a", "node", "n").distinct()
    pairs = pairs.join(nodes.select(F.col("node").alias("a"), F.col("n").alias("an")), "a").where(need.sizes(F.col("n"), F.col("an")))
    parts = pairs.groupBy("a").agg(F.ceil(F.count("*") / QUERIES).cast("long").alias("parts"))
    queries = pairs.join(parts, "a").select("a", F.pmod(F.xxhash64("node"), F.col("parts")).alias("b"), F.lit(1).alias("side"), "node")
    return parts.select("a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("b"), F.lit(0).alias("side"), F.col("a").alias("node")).unionByName(queries)


def _tile_units(kept: DataFrame, need: _Need) -> DataFrame:
    """Pairs of tiles that share a key, from ``key, node, n, c, g``; no pair whose nodes all have one ``g``."""
    home = kept.groupBy("node").agg(F.max(F.struct("c", "key")).alias("home"), F.first("g").alias("g"), F.first("n").alias("n"))
    cell = F.struct(F.col("home.key"), F.pmod(F.xxhash64("g"), F.ceil(F.col("home.c") / F.lit(TILE // 2))))
    placed = home.select("node", "n", cell.alias("cell"))
    cells = placed.groupBy("cell").agg(F.greatest(F.ceil(F.count("*") / F.lit(TILE)), F.ceil(F.sum("n") / F.lit(TILE_SHINGLES))).alias("parts"))
    tiled = written(placed.join(cells, "cell").select("node", F.xxhash64("cell", F.pmod(F.xxhash64(F.lit("tile"), "node"), F.col("parts"))).alias("tile")), "tiled")
    lies = kept.join(tiled, "node").groupBy("key", "tile").agg(F.min("g").alias("g0"), F.max("g").alias("g1"), F.min("n").alias("n0"), F.max("n").alias("n1"))
    other = lies.select("key", F.col("tile").alias("tile2"), F.col("g0").alias("h0"), F.col("g1").alias("h1"), F.col("n0").alias("m0"), F.col("n1").alias("m1"))
    differ = (F.least("g0", "h0") < F.greatest("g1", "h1")) & (F.col("tile") <= F.col("tile2"))
    fits = (F.lit(need.den) * F.col("n1") >= F.lit(need.num) * F.col("m0")) & (F.lit(need.den) * F.col("m1") >= F.lit(need.num) * F.col("n0"))
    pairs = written(lies.join(other, "key").where(differ & fits).select(F.col("tile").alias("a"), F.col("tile2").alias("b")).distinct(), "tile-pairs")
    # Of two tiles the nodes of the smaller one are sent to the larger one, in as many parts as they need.
    many = tiled.groupBy("tile").agg(F.count("*").alias("m"))
    two = pairs.where("a <> b").join(many.select(F.col("tile").alias("a"), F.col("m").alias("ma")), "a").join(many.select(F.col("tile").alias("b"), F.col("m").alias("mb")), "b")
    two = two.select(F.when(F.col("ma") >= F.col("mb"), F.col("a")).otherwise(F.col("b")).alias("large"), F.when(F.col("ma") >= F.col("mb"), F.col("b")).otherwise(F.col("a")).alias("small"), F.least("ma", "mb").alias("m"))
    parts = two.groupBy("large").agg(F.ceil(F.sum("m") / QUERIES).cast("long").alias("parts"))
    queries = two.join(parts, "large").select(F.col("large").alias("a"), F.pmod(F.xxhash64("small"), F.col("parts")).alias("b"), F.col("small").alias("tile")).join(tiled, "tile").select("a", "b", F.lit(1).alias("side"), "node")
    units = parts.select(F.col("large").alias("a"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("b")).unionByName(pairs.where("a = b"))
    return units.join(tiled.withColumnRenamed("tile", "a"), "a").select("a", "b", F.lit(0).alias("side"), "node").unionByName(queries)


def _linked(docs: DataFrame, n: int, num: int, den: int, id_col: str, text_col: str, counts: bool) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """``sets`` (``doc_id, t, n, node`` of each row), ``nodes``, ``edges`` that connect linked nodes, and their ``links`` if counted."""
    need, spark = _Need(num, den), docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_or_empty(text_col)).alias("t"), text_or_empty(text_col).alias("text"))

    def opened(units, counts=False):
        with small_batches(spark):
            return written(_open(units, tokens, need, counts), "links")

    with small_batches(spark):
        sets = written(_sets(rows, n, need), "sets")
    known = sets.where("doc_id is not null and n > 0")
    nodes = written(known.groupBy("node").agg(F.min(F.struct("doc_id", "t")).alias("rep"), F.min("n").alias("n"), F.min("drops").alias("drops"), F.count("*").alias("w")), "nodes")
    kept = _kept_keys(known, nodes)
    with small_batches(spark):
        tokens = written(_token_sets(rows.where("doc_id is not null"), nodes, kept.select("node"), n), "token-sets")
    if counts:
        found = opened(_tile_units(kept.withColumn("g", F.col("node")), need), True)
        edges, links = found.where("b is not null").select("a", "b"), found.where("b is null").groupBy("a").agg(F.sum("links").alias("links"))
    else:
        first = opened(_pivot_units(kept, nodes, need)).select("a", "b")
        grouped = written(components(first), "groups")
        in_groups = kept.join(grouped, "node", "left").withColumn("g", F.coalesce("component", "node"))
        mixed_keys = in_groups.groupBy("key").agg(F.min("g").alias("g0"), F.max("g").alias("g1")).where("g0 <> g1").select("key")
        in_groups = written(in_groups.join(mixed_keys, "key"), "mixed")
        edges, links = first.unionByName(opened(_tile_units(in_groups, need)).select("a", "b")), None
        for t in (grouped, in_groups):
            dropped(t)
    for t in (kept, tokens):
        dropped(t)
    return sets.select("doc_id", "t", "n", "node"), nodes, edges, links


def jaccard_components(docs: DataFrame, n: int = 4, num: int = 85, den: int = 100, id_col: str = "doc_id", text_col: str = "text", links: bool = False) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every document, and ``n_links`` if ``links``.

    Two documents are linked when ``den`` times the common shingles of their
    sets is at least ``num`` times all shingles of both. ``component_id`` is the
    smallest id that links reach. The search loses no link. ``n_links``
    is the number of other rows with an id that a row is linked to; to count
    them, all nodes of a group are compared, so work grows with the square of the
    different texts in a group, where the components alone take one comparison
    each with a common partner.

    Null or empty text, and white space alone: no shingle, no link, a component of its
    own. Texts with equal sets are linked. Rows with the same id are one
    document: each keeps its own size and number of links, and the links of all lead to one component. Null
    ids: a row each with a null component, linked with nothing. Empty table: no
    rows. Other columns are ignored. The threshold lies between one half and one.
    """
    sets, nodes, edges, found = _linked(docs, n, num, den, id_col, text_col, links)
    known = sets.where("doc_id is not null and n > 0")
    same_id = known.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("b")).where("a <> b")
    tied = known.join(same_id.select("doc_id", "a"), "doc_id").select("a", F.col("node").alias("b")).where("a <> b")
    every = written(components(edges.unionByName(tied)), "components")
    ids = nodes.select("node", "w", F.col("rep.doc_id").alias("rep")).join(every, "node", "left").withColumn("g", F.coalesce("component", "node"))
    names = ids.where("component is not null").groupBy("g").agg(F.min("rep").alias("least"))
    of_node = ids.join(names, "g", "left").select("node", F.coalesce("least", "rep").alias("c"), "w")
    of_node = of_node.join(found.withColumnRenamed("a", "node"), "node", "left") if links else of_node
    of_node = written(of_node, "named")
    of_doc = known.select("doc_id", "node").join(of_node.select("node", "c"), "node").groupBy("doc_id").agg(F.min("c").alias("c"))
    out = sets.join(of_doc, "doc_id", "left").withColumn("c", F.coalesce("c", "doc_id"))
    if not links:
        return out.select("doc_id", F.col("n").alias("n_shingles"), F.col("c").alias("component_id"))
    free = F.col("doc_id").isNull() | (F.col("n") == 0)
    out = out.join(of_node.drop("c"), "node", "left")
    n_links = F.when(free, 0).otherwise(F.col("w") - 1 + F.coalesce("links", F.lit(0))).cast("long")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.col("c").alias("component_id"), n_links.alias("n_links"))


def one_of_each(docs: DataFrame, n: int = 5, num: int = 4, den: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group of linked texts, with all its columns.

    The row of smallest id stays, and of several such rows that of smallest hash of the
    text; equal rows count as one. Rows without an id, and texts without a
    shingle, stay, as they are linked with nothing; so does a text that only
    shares its id with a linked one. Empty table: no rows.
    """
    sets, nodes, edges, _ = _linked(docs, n, num, den, id_col, text_col, False)
    every = written(components(edges), "components")
    groups = nodes.join(every, "node", "left").where("w > 1 or component is not null").select("node", F.coalesce("component", "node").alias("g"))
    rows = sets.where("doc_id is not null and n > 0").join(groups, "node")
    first = rows.groupBy("g").agg(F.min(F.struct("doc_id", "t")).alias("first"))
    marked = rows.join(first, "g").groupBy("doc_id", "t").agg(F.max((F.col("first") == F.struct("doc_id", "t")).cast("int")).alias("stays"), F.count("*").alias("many")).where("stays = 0 or many > 1")
    i, t, stays, cell, nth, hit = fresh(docs, 6)
    marked = written(marked.select(F.col("doc_id").alias(i), F.col("t").alias(t), F.col("stays").alias(stays)), "marked")
    # A set of at most 2 ** 20 hash values, which is broadcast, keeps rows without a mark from the shuffle.
    cells = F.broadcast(marked.select(F.pmod(F.xxhash64(i), F.lit(1 << 20)).cast("int").alias(cell)).distinct().withColumn(hit, F.lit(1)))
    own_id = F.col(f"`{id_col}`").cast("long")
    near = docs.join(cells, F.pmod(F.xxhash64(own_id), F.lit(1 << 20)).cast("int") == F.col(cell), "left")
    met = near.where(F.col(hit).isNotNull()).join(marked, (own_id == F.col(i)) & (F.xxhash64(text_or_empty(f"`{text_col}`")) == F.col(t)), "left").where(F.coalesce(F.col(stays), F.lit(1)) == 1)
    # What has no mark is not numbered; of equal rows that have one the first stays.
    twice = met.where(F.col(i).isNotNull()).withColumn(nth, F.row_number().over(Window.partitionBy(i, t).orderBy(i))).where(F.col(nth) == 1)
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return near.where(F.col(hit).isNull()).select(*columns).unionByName(met.where(F.col(i).isNull()).select(*columns)).unionByName(twice.select(*columns))
