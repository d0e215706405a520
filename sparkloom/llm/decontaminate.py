"""Benchmark decontamination: q-gram lemma filtering and banded alignment."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import release_caches, text_or_empty
from .encoding import balanced

#: Characters of a gram, edits allowed for each character of an item, bits of the first filter.
Q, EDIT_RATE, BITS = 8, 0.08, 22
#: Characters of benchmark text that one block of items, which is broadcast, may hold.
BLOCK_CHARS = 2_000_000
_BASE = np.uint64(0x9E3779B97F4A7C15)


def normal(text: str) -> str:
    """Lower case, each run of white space one space."""
    return " ".join(text.lower().split())


def budget(length: int, q: int = Q, rate: float = EDIT_RATE) -> int:
    """Edits allowed in an item: a share of its length, and few enough for the lemma to hold."""
    return max(0, min(int(length * rate), (length - q) // q))


def _codes(points: np.ndarray, q: int) -> np.ndarray:
    """A number for each gram of q code points."""
    n = len(points) - q + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = points[:n].astype(np.uint64)
    with np.errstate(over="ignore"):
        for i in range(1, q):
            out *= _BASE
            out += points[i : i + n]
        out ^= out >> np.uint64(29)
        out *= np.uint64(0xBF58476D1CE4E5B9)
    return out


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


class Items:
    """The grams of a block of benchmark items, sorted, with a bit table before them."""

    def __init__(self, items: list[tuple[int, str]], q: int = Q, rate: float = EDIT_RATE):
        self.q = q
        self.ids = [i for i, _ in items]
        self.texts = [t for _, t in items]
        self.edits = np.array([budget(len(t), q, rate) for t in self.texts], np.int64)
        self.lengths = np.array([len(t) for t in self.texts], np.int64)
        # The lemma: a region within k edits of an item keeps all its grams but q for each edit.
        self.needs = self.lengths - q + 1 - q * self.edits
        codes = [_codes(_points(t), q) for t in self.texts]
        sizes = [len(c) for c in codes]
        every = np.concatenate(codes) if codes else np.empty(0, np.uint64)
        order = np.argsort(every, kind="stable")
        self.codes = every[order]
        self.item = np.repeat(np.arange(len(items)), sizes)[order]
        self.place = np.concatenate([np.arange(s) for s in sizes] or [np.empty(0, np.int64)])[order]
        self.table = np.zeros(1 << BITS, bool)
        self.table[(self.codes >> np.uint64(64 - BITS)).astype(np.int64)] = True
        self.short = [(i, t) for i, t in zip(self.ids, self.texts) if 0 < len(t) < q]
        # Bands of diagonals: each begins half a width after the one before, and holds any k + 1 neighbours.
        self.step = np.maximum(16, self.edits + 1)


def distance(item: str, region: str, most: int, centre: int, slack: int) -> tuple[int, int, int]:
    """(edits, start, end) of the part of ``region`` nearest to ``item``; edits is ``most`` + 1 if above.

    The alignment stays within ``slack`` diagonals of ``centre``; its ends in the region are free.
    """
    at = region.find(item)
    if at >= 0:
        return 0, at, at + len(item)
    a, b = _points(item), _points(region)
    width = 2 * slack + 1
    lane = np.arange(width)
    big = 1 << 20
    # Cell (i, d) of a row stands for column i + centre - slack + d of the region.
    column = lane + centre - slack
    cost = np.where((column >= 0) & (column <= len(b)), 0, big)
    origin = column.copy()
    for i in range(1, len(a) + 1):
        column = column + 1
        inside = (column >= 1) & (column <= len(b))
        same = np.zeros(width, bool)
        same[inside] = b[column[inside] - 1] == a[i - 1]
        new, source = cost + ~same, origin
        new = np.where(column >= 1, new, big)
        up = np.append(cost[1:] + 1, big)  # a character of the item that the region lacks
        skip = up < new
        new, source = np.where(skip, up, new), np.where(skip, np.append(origin[1:], 0), source)
        new = np.where((column >= 0) & (column <= len(b)), new, big)
        # Characters of the region that the item lacks: a running minimum along the row.
        reach = np.minimum.accumulate(new - lane)
        best = np.maximum.accumulate(np.where(new - lane == reach, lane, 0))
        cost, origin = np.minimum(new, reach + lane), np.where(reach + lane < new, source[best], source)
        cost = np.where((column >= 0) & (column <= len(b)), cost, big)
        if cost.min() > most:
            return most + 1, 0, 0
    k = int(cost.argmin())
    return (int(cost[k]), int(origin[k]), int(column[k])) if cost[k] <= most else (most + 1, 0, 0)


def search_texts(column, items: Items, most: int = 1_000_000):
    """:func:`found_in` over an Arrow column of texts, about ``most`` bytes at a time; null is empty."""
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    for a, b in balanced(sizes, most):
        for d, *rest in found_in([normal(t or "") for t in column.slice(a, b - a).to_pylist()], items):
            yield (a + d, *rest)


def found_in(texts: list[str], items: Items) -> list[tuple[int, int, int, int, int]]:
    """(text number, item id, edits, start, end) of every item that a text holds, texts being normal.

    All texts of a call are one row of code points with a separator between.
    Grams that the bit table passes are looked up; their diagonals are counted
    by item in overlapping bands; bands that meet the lemma are aligned.
    """
    out = []
    sep = "\x00"
    joined = sep.join(texts)
    points = _points(joined)
    begins = np.cumsum([0, *(len(t) + 1 for t in texts)])
    hits_p, hits_g = [], []
    step = 1 << 18
    for a in range(0, max(1, len(points) - items.q + 1), step):
        codes = _codes(points[a : a + step + items.q - 1], items.q)
        p = np.flatnonzero(items.table[(codes >> np.uint64(64 - BITS)).astype(np.int64)])
        if len(p):
            c = codes[p]
            lo, hi = np.searchsorted(items.codes, c, "left"), np.searchsorted(items.codes, c, "right")
            n = hi - lo
            real = n > 0
            p, lo, n = p[real] + a, lo[real], n[real]
            if not len(p):
                continue
            hits_p.append(np.repeat(p, n))
            hits_g.append(np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum()))
    if hits_p:
        p, g = np.concatenate(hits_p), np.concatenate(hits_g)
        item, place = items.item[g], items.place[g]
        doc = np.searchsorted(begins, p, "right") - 1
        # One number for each text, item and cell of diagonals; two neighbouring cells are a band.
        shift = int(items.lengths.max())  # so that no diagonal is negative
        stride = (len(points) + shift) // int(items.step.min()) + 2
        if len(texts) * len(items.ids) * stride >= 1 << 63:
            raise ValueError("texts and items are too many for one call")
        cell = (p - begins[doc] - place + shift) // items.step[item]
        key = (doc * len(items.ids) + item) * stride + cell
        order = np.argsort(key, kind="stable")
        key, place = key[order], place[order]
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        counts = np.diff(np.append(first, len(key)))
        cells = key[first]
        after = np.append(np.where(cells[1:] == cells[:-1] + 1, counts[1:], 0), 0)
        rows = cells // stride
        enough = np.flatnonzero(counts + after >= items.needs[rows % len(items.ids)])
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        for c in enough.tolist():
            d, i = divmod(int(rows[c]), len(items.ids))
            if best.get((d, i), (1,))[0] == 0:
                continue
            start = first[c]
            if len(np.unique(place[start : start + counts[c] + after[c]])) < items.needs[i]:
                continue
            k, w = int(items.edits[i]), int(items.step[i])
            low = int(cells[c] % stride) * w - shift  # the least diagonal of the band
            begin = max(0, low - k)
            region = texts[d][begin : low + 2 * w + int(items.lengths[i]) + k]
            edits, a, b = distance(items.texts[i], region, k, low + w - begin, w + k + 1)
            if edits <= k and (edits, begin + a) < best.get((d, i), (k + 1,))[:2]:
                best[d, i] = (edits, begin + a, begin + b)
        out += [(d, items.ids[i], *v) for (d, i), v in best.items()]
    for i, t in items.short:
        out += [(d, i, 0, x.find(t), x.find(t) + len(t)) for d, x in enumerate(texts) if t in x]
    return out


def _blocks(benchmark: DataFrame, block_chars: int):
    """Distinct items as lists of bounded size, streamed to the driver one block at a time."""
    block, size = [], 0
    items = benchmark.select(F.col("item_id").cast("long"), F.col("text")).where("item_id is not null and text is not null").dropDuplicates()
    for item, text in items.toLocalIterator():
        text = normal(text)
        if not text:
            continue
        block.append((item, text))
        size += len(text)
        if size >= block_chars:
            yield sorted(block)
            block, size = [], 0
    if block:
        yield sorted(block)


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``doc_id, item_id, edits, start, end`` for every benchmark item that a text holds.

    A text holds an item if a part of it is within eight edits for a hundred
    characters of the item, both in lower case with each run of white space as one space;
    ``start`` and ``end`` are places in that form of the text. The items are a
    query set that meets all texts in blocks of bounded size; each text is read
    once a block and never moves. Items shorter than a gram must occur exactly.

    Null or empty texts and items: no row. Null ids of documents: rows with a
    null id. Repeated rows: found each. Empty tables: no rows. Other columns are
    ignored.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    schema = "doc_id long, item_id long, edits int, start long, end long"
    spark = docs.sparkSession
    out = None
    for block in _blocks(benchmark, block_chars):
        shared = spark.sparkContext.broadcast(block)

        def search(batches, shared=shared):
            import pyarrow as pa

            release_caches()
            items = Items(shared.value)
            for batch in batches:
                ids = batch.column(0).to_pylist()
                found = [(ids[d], *rest) for d, *rest in search_texts(batch.column(1), items)]
                cols = list(zip(*found)) or [()] * 5
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["doc_id", "item_id", "edits", "start", "end"])

        part = rows.mapInArrow(search, schema)
        out = part if out is None else out.unionByName(part)
    return spark.createDataFrame([], schema) if out is None else out


def clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The documents that hold no benchmark item, with all their columns, without a shuffle.

    Null and empty texts hold nothing and stay. Null ids and repeated rows are looked at each on its own. Empty tables: nothing goes.
    """
    spark = docs.sparkSession
    for block in _blocks(benchmark, block_chars):
        docs = docs.mapInArrow(_cleaner(spark.sparkContext.broadcast(block), docs.columns.index(text_col)), docs.schema)
    return docs


def _cleaner(shared, at: int):
    def clean(batches):
        import pyarrow as pa

        release_caches()
        items = Items(shared.value)
        for batch in batches:
            kept = np.ones(batch.num_rows, bool)
            for d, *_ in search_texts(batch.column(at), items):
                kept[d] = False
            yield batch.filter(pa.array(kept))

    return clean
