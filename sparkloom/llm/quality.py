"""Quality classifier: random Fourier features, ridge regression, isotonic calibration."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import dropped, release_caches, text_or_empty, values, written

#: The document statistics, in order.
STATISTICS = (
    "log_bytes", "log_words", "word_length", "upper", "digit", "space", "line_feed", "high_byte",
    "stop", "comma", "exclaim", "bar", "hash", "other_sign", "sign_words", "distinct_words",
    "top_word", "same_as_last", "distinct_lines", "short_words",
)
#: Bound of the labelled rows that a model is fitted on; parts of them for calibration, and tasks that add up.
MAX_TRAINING_ROWS, FOLDS, TASKS = 20_000, 4, 8


def statistics(text: bytes) -> list[float]:
    """Numbers that describe a text; those of an empty text are zero."""
    n = len(text)
    if not n:
        return [0.0] * len(STATISTICS)
    count = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    words = text.split()
    w = max(1, len(words))
    seen: dict[bytes, int] = {}
    for x in words:
        seen[x] = seen.get(x, 0) + 1
    lines = text.split(b"\n")
    letters = count[65:91].sum() + count[97:123].sum() + count[128:].sum()
    signs = count[33:48].sum() + count[58:65].sum() + count[91:97].sum() + count[123:127].sum()
    named = count[[46, 44, 33, 124, 35]]
    return [
        np.log1p(n), np.log1p(len(words)), min(30.0, n / w), count[65:91].sum() / max(1, letters), count[48:58].sum() / n, count[32] / n, count[10] / n, count[128:].sum() / n,
        *(named / w), (signs - named.sum()) / w, signs / n, len(seen) / w,
        max(seen.values(), default=0) / w, sum(a == b for a, b in zip(words, words[1:])) / w, len(set(lines)) / len(lines), sum(len(x) <= 3 for x in words) / w,
    ]


@dataclass
class Model:
    """Everything that scoring needs; a few hundred numbers."""

    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    steps: np.ndarray  # raw scores at which the calibrated score is known
    values: np.ndarray

    def features(self, x: np.ndarray) -> np.ndarray:
        """Their inner products approximate a Gaussian kernel over scaled statistics; one column is constant."""
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.hstack([np.cos(z @ self.directions + self.phases) * np.sqrt(2 / len(self.phases)), np.ones((len(x), 1))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weights

    def scores(self, x: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(x), self.steps, self.values)


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: the non-decreasing fit of y over x, at the ends of its level pieces."""
    order = np.argsort(x, kind="stable")
    x, y = x[order], y[order]
    total, weight, left, right = [], [], [], []
    for a, b in zip(x.tolist(), y.tolist()):
        total.append(b), weight.append(1.0), left.append(a), right.append(a)
        while len(total) > 1 and (total[-2] * weight[-1] >= total[-1] * weight[-2] or left[-1] <= right[-2]):
            t, w, _, r = total.pop(), weight.pop(), left.pop(), right.pop()
            total[-1] += t
            weight[-1] += w
            right[-1] = r
    level = np.array(total) / np.array(weight)
    return np.ravel(np.column_stack([left, right])), np.repeat(level, 2)


def document_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", also: tuple = ()) -> DataFrame:
    """``doc_id, x`` with the statistics of each whole text, and the columns ``also`` (name, type) as they are."""
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_or_empty(f"`{text_col}`").cast("binary").alias("text"), *[F.col(c) for c, _ in also])

    def measure(batches):
        import pyarrow as pa

        release_caches()
        for batch in batches:
            x = np.array([statistics(t) for t in values(batch.column(1))], float).reshape(-1, len(STATISTICS))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), len(STATISTICS)).cast(pa.list_(pa.float64())), *batch.columns[2:]], names=["doc_id", "x", *[c for c, _ in also]])

    return rows.mapInArrow(measure, "doc_id long, x array<double>" + "".join(f", {c} {t}" for c, t in also))


def _solve(a: np.ndarray, b: np.ndarray, rows: float, ridge: float) -> np.ndarray:
    return np.linalg.solve(a + ridge * rows * np.eye(len(b)) / (len(b) - 1), b)


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", max_rows: int = MAX_TRAINING_ROWS, features: int = 256, width: float = 6.0, ridge: float = 1e-3, seed: int = 7, text_col: str = "text") -> Model | None:
    """Fit the classifier on at most ``max_rows`` labelled rows, chosen by a hash of the id.

    The chosen ids are bounded in number, so they are broadcast to the one scan
    of the texts; of rows that repeat an id the one of least text hash is taken, so the bound holds. Every
    partition adds up its own part of the normal equations, apart for each of
    ``FOLDS`` parts of the ids; the sums are added and solved by the driver, whose work does not grow with
    the table. Isotonic regression is fitted on scores of rows by weights that
    did not see their part, and the final weights see all. A label, language, source or id is
    never an input of a score. Of several labels of an id the greatest counts. None if there is no label.
    """
    name = F.col(f"`{id_col}`").cast("long")
    label = F.col(f"`{label_col}`")
    chosen = labels.where(label.isNotNull() & name.isNotNull()).groupBy(name.alias("key")).agg(F.max(label).cast("double").alias("label"))
    chosen = chosen.orderBy(F.xxhash64("key"), "key").limit(max_rows)
    rows = docs.select(name.alias("doc_id"), text_or_empty(f"`{text_col}`").alias("text"))
    seen = rows.join(F.broadcast(chosen), F.col("doc_id") == F.col("key")).select("doc_id", "label", F.xxhash64("text").alias("hash"), "text")
    found = document_statistics(seen, "doc_id", "text", (("label", "double"), ("hash", "long")))
    one = F.row_number().over(Window.partitionBy("doc_id").orderBy("hash"))
    fold = F.pmod(F.xxhash64(F.lit("fold"), "doc_id"), F.lit(FOLDS)).cast("int")
    # The window has dealt the few rows anew, so fewer tasks from here on do not make the scan of the texts narrow.
    train = written(found.withColumn("nth", one).where("nth = 1").select("doc_id", "x", "label", fold.alias("fold")).coalesce(TASKS), "quality-train")
    # Moments come from sums, too.
    size = len(STATISTICS)
    each = train.select(*[F.col("x")[i].alias(f"x{i}") for i in range(size)])
    moments = each.agg(F.count("*"), *[F.avg(f"x{i}") for i in range(size)], *[F.stddev_pop(f"x{i}") for i in range(size)]).first()
    if not moments[0]:
        return None
    rng = np.random.default_rng(seed)
    scale = np.array(moments[1 + size :], float)
    model = Model(np.array(moments[1 : 1 + size], float), np.where(scale > 1e-9, scale, 1.0), rng.normal(0, 1 / width, (size, features)), rng.uniform(0, 2 * np.pi, features), np.zeros(features + 1), np.zeros(1), np.zeros(1))

    def inputs(batch):
        return model.features(np.array(batch.column(1).flatten()).reshape(-1, size)), np.array(batch.column(2)), np.array(batch.column(3))

    def sums(batches):
        import pyarrow as pa

        a, b, n = np.zeros((FOLDS, features + 1, features + 1)), np.zeros((FOLDS, features + 1)), np.zeros(FOLDS)
        for batch in batches:
            z, y, part = inputs(batch)
            for k in range(FOLDS):
                own = z[part == k]
                a[k] += own.T @ own
                b[k] += own.T @ y[part == k]
                n[k] += len(own)
        yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in (a, b, n)], names=["a", "b", "n"])

    parts = train.coalesce(TASKS).mapInArrow(sums, "a binary, b binary, n binary").collect()  # at most TASKS rows
    a, b, n = (sum(np.frombuffer(p[k]) for p in parts).reshape(shape) for k, shape in (("a", (FOLDS, features + 1, -1)), ("b", (FOLDS, -1)), ("n", FOLDS)))
    model.weights = _solve(a.sum(0), b.sum(0), n.sum(), ridge)
    without = np.array([_solve(a.sum(0) - a[k], b.sum(0) - b[k], n.sum() - n[k], ridge) if n.sum() > n[k] else model.weights for k in range(FOLDS)])

    def raw(batches):
        import pyarrow as pa

        for batch in batches:
            z, _, part = inputs(batch)
            yield pa.RecordBatch.from_arrays([pa.array((z * without[part]).sum(1)), batch.column(2)], names=["raw", "label"])

    pairs = train.mapInArrow(raw, "raw double, label double").toPandas()  # a row for each id, max_rows at most
    model.steps, model.values = isotonic(pairs["raw"].to_numpy(), pairs["label"].to_numpy())
    dropped(train)
    return model


def score(docs: DataFrame, model: Model | None, id_col: str = "doc_id") -> DataFrame:
    """``doc_id, score``: the likelihood of label 1 for each whole text; 0.5 without a model."""
    size = len(STATISTICS)

    def apply(batches):
        import pyarrow as pa

        for batch in batches:
            x = np.array(batch.column(1).flatten(), float).reshape(-1, size)
            s = model.scores(x) if model else np.full(len(x), 0.5)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s)], names=["doc_id", "score"])

    return document_statistics(docs, id_col).mapInArrow(apply, "doc_id long, score double")


def held_out(id_col: str = "doc_id"):
    """True for ids whose crc32, as text, leaves 1 when divided by 3; false for null."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def quality(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAINING_ROWS) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document.

    Learns only from labels of ids that are not held out. Null or empty text:
    scored by its statistics, which are all zero. Null ids and repeated rows:
    one row each. No usable label: every score 0.5. Empty table: no rows. Other
    columns are ignored.
    """
    model = fit(docs, labels.where(~held_out()), max_rows=max_rows)
    return score(docs, model).select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, max_rows: int = MAX_TRAINING_ROWS) -> DataFrame:
    """The documents scored ``threshold`` or more, with all their columns, in one scan without a join.

    Null and empty texts are scored by their statistics, which are all zero. Null ids and
    repeated rows are scored each on its own. No usable label: all documents stay. Empty table: no rows.
    """
    model = fit(docs, labels.where(~held_out()), max_rows=max_rows)
    if model is None:
        return docs

    at = docs.columns.index("text")

    def good(batches):
        import pyarrow as pa

        release_caches()
        for batch in batches:
            x = np.array([statistics((t or "").encode()) for t in values(batch.column(at))], float).reshape(-1, len(STATISTICS))
            yield batch.filter(pa.array(model.scores(x) >= threshold))

    return docs.mapInArrow(good, docs.schema)
