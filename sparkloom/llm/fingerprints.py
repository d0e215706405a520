"""Document fingerprints by consistent weighted sampling, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import text_or_empty, written

#: Samples of a signature, and words of a shingle.
SAMPLES, SHINGLE = 64, 5
_SPACES = r"\x20\t\n\x0B\f\r"


def word_hashes(text: Column) -> Column:
    """The hashes of the words of a text in their order; none if it has no words."""
    bare = F.regexp_replace(text, rf"^[{_SPACES}]+|[{_SPACES}]+\z", "")
    return F.when(bare == "", F.array().cast("array<bigint>")).otherwise(F.transform(F.split(bare, rf"[{_SPACES}]+"), lambda w: F.xxhash64(w)))


def shingles(words: Column) -> Column:
    """The hashes of every run of ``SHINGLE`` words, overlapping; a shorter text is one run."""
    later = [F.slice(words, i + 1, F.greatest(F.size(words) - i, F.lit(0))) for i in range(1, SHINGLE)]
    # A run grows by one word at a time; where a text is too short for it there is no further word.
    run = words
    for one in later:
        run = F.zip_with(run, one, lambda h, w: F.xxhash64(h, w))
    return F.slice(run, 1, F.greatest(F.size(words) - (SHINGLE - 1), F.least(F.size(words), F.lit(1))))


def weighted(texts: DataFrame, keys: list[str], outer: bool = False) -> DataFrame:
    """``keys, which, term, w``: how often each shingle occurs in ``text`` (which 0) and ``edited`` (1).

    What occurs as often in both is one row, with which 2. The marks of a row
    are a shingle's hash and the text it is from; sorted, those of one shingle
    follow each other, and the places where a run of equal marks ends give counts.
    With ``outer`` keys without any shingle have one row, without a term.
    """
    words = texts.select(*keys, word_hashes(F.col("text")).alias("own"), word_hashes(F.col("edited")).alias("other"))
    marked = lambda c, bit: F.transform(shingles(F.col(c)), lambda h: F.shiftleft(h, 1).bitwiseOR(F.lit(bit).cast("long")))
    rows = words.select(*keys, F.sort_array(F.concat(marked("own", 0), marked("other", 1))).alias("m"))
    ends = F.filter(F.sequence(F.lit(0), F.size("m") - 1), lambda i: ~F.coalesce(F.get("m", i) == F.get("m", i + 1), F.lit(False)))
    rows = rows.select(*keys, "m", F.when(F.size("m") > 0, ends).otherwise(F.array().cast("array<int>")).alias("e"))
    rows = rows.select(*keys, "m", "e", (F.posexplode_outer if outer else F.posexplode)("e").alias("j", "last"))
    end = lambda k: F.coalesce(F.get("e", F.col("j") + k), F.lit(-1))
    mark = lambda k: F.get("m", end(k))
    me, w, which = mark(0), F.col("last") - end(-1), mark(0).bitwiseAND(F.lit(1))
    no = F.lit(False)
    with_next = (which == 0) & F.coalesce((mark(1) == me.bitwiseOR(F.lit(1))) & (end(1) - F.col("last") == w), no)
    with_prior = (which == 1) & F.coalesce((mark(-1) == me.bitwiseXOR(F.lit(1))) & (end(-1) - end(-2) == w), no)
    return rows.where(F.col("j").isNull() | ~with_prior).select(*keys, F.when(with_next, 2).otherwise(which.cast("int")).alias("which"), F.shiftrightunsigned(me, 1).alias("term"), w.alias("w"))


def _constant(n: int) -> int:
    return (0x9E3779B97F4A7C15 * (n + 1)) & ((1 << 63) - 1)


def _draw(term: Column, constant: Column) -> Column:
    """A hash of a term, another one for each constant, as a number from 0 to 2 ** 63 - 1."""
    return F.shiftrightunsigned(F.xxhash64(term.bitwiseXOR(constant)), 1)


def _exponential(draw: Column) -> Column:
    """An exponential number, which grows with the draw."""
    return -F.log1p(-(draw + F.lit(0.5)) / F.lit(float(1 << 63)))


def _sample(term: Column, log_weight: Column, k: int | Column, samples: int = SAMPLES) -> Column:
    """What a term offers for sample ``k`` (a column below ``samples``, or a number): the least offer is the sample; its low 32 bits are the identity.

    r and c are gamma(2, 1) and beta uniform, all from hashes of the term and k.
    With t = floor(ln w / r + beta), y = exp(r (t - beta)) and a = c / (y e^r), the
    term with the least a is the sample, and (term, t) its identity: two weighted
    sets have the same identity with probability equal to their generalised
    Jaccard similarity. r is the sum of two exponential numbers and beta the share of
    the first in it, which is independent of the sum; likewise c is the sum
    of two others, e and f, and exp(-r (1 - beta)), a uniform number, is the share of e in it. So
    a = e exp(-r t) and r = -ln(first) - ln(e / (e + f)).

    For t = 0, as always with weight 1, a is e, which grows with its draw, so the
    draw itself stands for it, and no logarithm is taken. For t > 0 the number
    is brought to the same scale, and its low bits to a hash of term and t.
    """
    if isinstance(k, int):
        draw, second, third = (_draw(term, F.lit(_constant(3 * k + i))) for i in range(3))
    else:
        constants = F.array(*[F.lit(_constant(n)) for n in range(3 * samples)])
        draw, second, third = (_draw(term, F.get(constants, k * 3 + i)) for i in range(3))
    e, f, first = _exponential(draw), _exponential(second), _exponential(third)
    r = first - F.ln(e / (e + f))
    t = F.floor((log_weight + first) / r)
    scaled = (-F.expm1(-e * F.exp(-r * t)) * F.lit(float(1 << 63))).cast("long")
    other = scaled.bitwiseAND(F.lit(((1 << 31) - 1) << 32)).bitwiseOR(F.xxhash64(term, t).bitwiseAND(F.lit(0xFFFFFFFF)))
    return F.when(log_weight == 0, draw).when(t <= 0, draw).otherwise(other)


def signatures(texts: DataFrame, keys: list[str], samples: int = SAMPLES) -> DataFrame:
    """``keys, which`` and ``s0`` ... of the signatures of ``text`` (which 0) and ``edited`` (1).

    A term's weight is how often it occurs. What both have in common is sampled
    once. Texts without a term have no samples. If ``texts`` lies dealt by some of
    the keys, nothing moves.
    """
    names = [f"s{k}" for k in range(samples)]
    terms = weighted(texts, keys, outer=True).select(*keys, F.coalesce("which", F.lit(2)).alias("which"), "term", "w")
    # A term of weight 1 is one row, which offers a draw for each sample; one of greater weight a row for each sample, with its offer.
    heavy = F.col("w") > 1
    terms = terms.select(*keys, "which", "term", "w", F.explode(F.when(heavy, F.sequence(F.lit(0), F.lit(samples - 1))).otherwise(F.array(F.lit(-1)))).alias("nth"))
    terms = terms.select(*keys, "which", "term", "nth", F.when(F.col("nth") >= 0, _sample(F.col("term"), F.ln(F.col("w").cast("double")), F.col("nth"), samples)).alias("offer"))
    light = (F.col("nth") < 0) & F.col("term").isNotNull()
    best = terms.groupBy(*keys, "which").agg(*[F.min(F.when(light, _draw(F.col("term"), F.lit(_constant(3 * k)))).when(F.col("nth") == k, F.col("offer"))).alias(s) for k, s in enumerate(names)])
    each = best.select(*keys, F.explode(F.when(F.col("which") == 2, F.array(F.lit(0), F.lit(1))).otherwise(F.array("which"))).alias("which"), *names)
    best = each.groupBy(*keys, "which").agg(*[F.min(s).alias(s) for s in names])
    return best.select(*keys, "which", *[F.col(s).bitwiseAND(F.lit(0xFFFFFFFF)).alias(s) for s in names])


def _packed(samples: list[Column]) -> Column:
    """Four bytes a sample; no bytes without terms."""
    return F.unhex(F.when(samples[0].isNull(), F.lit("")).otherwise(F.concat(*[F.lpad(F.hex(s), 8, "0") for s in samples])))


def likeness(a: Column, b: Column, samples: int = SAMPLES) -> Column:
    """The share of equal samples of two packed fingerprints; two without terms are alike, one alone is like none."""
    same = F.lit(0)
    for k in range(samples):
        same = same + (F.substring(a, 4 * k + 1, 4) == F.substring(b, 4 * k + 1, 4)).cast("int")
    none_a, none_b = F.octet_length(a) == 0, F.octet_length(b) == 0
    return F.when(none_a & none_b, 1.0).when(none_a | none_b, 0.0).otherwise(same / F.lit(float(samples)))


def _neighbours(keys: DataFrame) -> DataFrame:
    """``doc_id, h, dup, need`` with ``next`` and ``last``, the rows after and before it in one order of all rows.

    The order is descending in (doc_id, h, dup), null last, and closes into a ring.
    Rows are dealt by ranges; each range finds neighbours within itself, and one
    row a range is enough to tie the ranges together.
    """
    order = [F.col("doc_id").desc_nulls_last(), F.col("h").desc(), F.col("dup").desc()]
    placed = written(keys.repartitionByRange(*order).withColumn("pid", F.spark_partition_id()), "order")
    within = Window.partitionBy("pid").orderBy(*order)
    me, height = F.struct("doc_id", "h", "dup", "need"), F.struct(F.col("doc_id").isNotNull().cast("int"), "doc_id", "h", "dup")
    rows = placed.withColumn("next", F.lead(me).over(within)).withColumn("last", F.lag(me).over(within))
    ends = placed.groupBy("pid").agg(F.min_by(me, height).alias("low"), F.max_by(me, height).alias("high"))
    ring, every = Window.orderBy("pid"), Window.partitionBy()
    ends = ends.select(
        "pid",
        F.coalesce(F.lead("high").over(ring), F.min_by("high", "pid").over(every)).alias("after"),
        F.coalesce(F.lag("low").over(ring), F.max_by("low", "pid").over(every)).alias("before"),
    )
    rows = rows.join(F.broadcast(ends), "pid")  # a row for each range
    return rows.select("doc_id", "h", "dup", "need", F.coalesce("next", "after").alias("next"), F.coalesce("last", "before").alias("last"))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", samples: int = SAMPLES) -> DataFrame:
    """Fingerprints of every text and of its edited form, and how alike they are.

    Returns ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next``. The edited text has its last floor(n_chars / 3)
    code points replaced by the first as many, or all, of the next document in
    descending id (after the last, the first). Texts are dealt by id and hash once, with
    the heads that edits need; all terms of a document are made and reduced
    where it lies, and its length and digest go along as keys.

    Null or empty text: an empty fingerprint. Null ids come last. Rows of one id
    follow each other in descending order of a hash of the text; equal rows are
    each other's neighbours. A single document is its own neighbour. Empty table: no
    rows. Other columns are ignored.
    """
    # Rows are told apart by id and hash, which are never null together; equal rows get numbers.
    no_null = lambda c, h: F.coalesce(c, F.xxhash64(h, F.lit("no id")))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text")).withColumn("h", F.xxhash64("text")).withColumn("k", no_null(F.col("doc_id"), F.col("h")))
    number = F.row_number().over(Window.partitionBy("k", "h").orderBy("doc_id"))
    keyed = rows.withColumn("n", number)
    sized = rows.select("doc_id", "k", "h", F.floor(F.char_length("text") / 3).cast("int").alias("need")).withColumn("dup", number).select("doc_id", "h", "dup", "need")
    order = written(_neighbours(sized), "neighbours")
    place = lambda c, *names: [no_null(F.col(f"{c}doc_id"), F.col(f"{c}h")).alias(names[0]), F.col(f"{c}h").alias(names[1]), F.col(f"{c}dup").alias(names[2])]
    # The numbers are compared by their difference, so that the texts stay dealt by the key alone.
    on = (F.col("k") == F.col("k2")) & (F.col("h") == F.col("h2")) & (F.col("n") - F.col("n2") == 0)
    back = order.where("last.need > 0").select(*place("", "k2", "h2", "n2"), *place("last.", "to_k", "to_h", "to_n"), F.col("last.need").alias("need"))
    heads = keyed.join(back, on).select(F.col("to_k").alias("k2"), F.col("to_h").alias("h2"), F.col("to_n").alias("n2"), F.substring("text", F.lit(1), F.col("need")).alias("head"))
    text = F.col("text")
    chars = F.char_length(text)
    edited = F.concat(F.substring(text, F.lit(1), chars - F.floor(chars / 3).cast("int")), F.coalesce("head", F.lit("")))
    both = keyed.join(heads, on, "left").select("k", "h", "n", text, edited.alias("edited"), chars.cast("long").alias("n_chars"), F.unhex(F.sha2(edited.cast("binary"), 256)).alias("sha"))
    facts = ["k", "h", "n", "n_chars", "sha"]
    printed = signatures(both, facts, samples).select(*facts, "which", _packed([F.col(f"s{i}") for i in range(samples)]).alias("print"))
    full = written(printed.groupBy(*facts).agg(F.max(F.when(F.col("which") == 0, F.col("print"))).alias("own"), F.max(F.when(F.col("which") == 1, F.col("print"))).alias("other")), "fingerprints", "none")
    nothing = F.unhex(F.lit(""))
    own, other, after = (F.coalesce(c, nothing) for c in ("own", "other", "after"))
    # Only a document's own print goes to the document before it.
    onward = order.select(*place("next.", "k", "h", "n"), *place("", "to_k", "to_h", "to_n"), "doc_id")
    nexts = full.select("k", "h", "n", "own").join(onward, ["k", "h", "n"]).select("doc_id", F.col("to_k").alias("k"), F.col("to_h").alias("h"), F.col("to_n").alias("n"), F.col("own").alias("after"))
    text_form = lambda c: F.lower(F.hex(c))
    return full.join(nexts, ["k", "h", "n"]).select("doc_id", "n_chars", text_form("sha").alias("edited_sha256"), text_form(own).alias("fingerprint"), text_form(other).alias("edited_fingerprint"), likeness(own, other, samples).alias("near_edited"), likeness(own, after, samples).alias("near_next"))
