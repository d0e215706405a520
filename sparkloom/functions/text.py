"""Text functions: tokens, keywords, paragraphs, sections, headings, citations, fuzzy tests."""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

#: Fixed value: words that are never keywords.
STOPWORDS = tuple("the and for that this with are from how what does can should will all its get set use let via per any one two has had not but been each into was".split())


#: Letters with marks, and the letters without.
MARKED, BARE = "àáâãäåçèéêëìíîïñòóôõöùúûüýÿ", "aaaaaaceeeeiiiinooooouuuuyy"


def folded(text: Column) -> Column:
    """Lower case, Latin letters without their marks."""
    return F.translate(F.lower(text), MARKED, BARE)


def keywords(text: Column) -> Column:
    """Distinct words ``[a-z][a-z0-9_]{2,}`` of the lower-case text that are no stop words."""
    found = F.regexp_extract_all(F.lower(text), F.lit(r"([a-z][a-z0-9_]{2,})"), F.lit(1))
    return F.array_except(found, F.array(*map(F.lit, STOPWORDS)))


def query_terms(text: Column, most: int = 30) -> Column:
    """Search terms: camel case split, ``[a-zA-Z0-9_]{2,}``, first occurrence kept, at most ``most``."""
    apart = F.regexp_replace(text, r"([a-z])([A-Z])", "$1 $2")
    return F.slice(F.array_distinct(F.regexp_extract_all(F.lower(apart), F.lit(r"([a-z0-9_]{2,})"), F.lit(1))), 1, most)


def or_query(text: Column, most: int = 30) -> Column:
    return F.array_join(F.transform(query_terms(text, most), lambda t: F.concat(F.lit('"'), t, F.lit('"'))), " OR ")


def name_tokens(name: Column) -> Column:
    """Tokens of three characters or more; a space goes before every capital, so acronyms vanish."""
    apart = F.regexp_replace(name, r"([A-Z])", " $1")
    return F.array_distinct(F.filter(F.split(F.lower(apart), r"[^a-z0-9]+"), lambda w: F.length(w) >= 3))


def paragraphs(text: Column) -> Column:
    """Trimmed parts between blank lines, empty ones dropped."""
    return F.filter(F.transform(F.split(text, r"\n{2,}"), lambda p: F.trim(p)), lambda p: p != "")


def headings(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(r"(?m)^#{2,}\s*(.+)$"), F.lit(1))


def sections(text: Column) -> Column:
    """Parts that begin with a second-level heading."""
    return F.filter(F.split(text, r"(?m)(?=^## )"), lambda s: F.trim(s) != "")


def citations(text: Column) -> Column:
    """Rule ids cited in brackets, upper case."""
    return F.transform(F.regexp_extract_all(text, F.lit(r"(?i)\[((?:TR-)?BR-[0-9]+)\]"), F.lit(1)), lambda c: F.upper(c))


def snippet(text: Column, needle: Column, around: int = 80) -> Column:
    at = F.instr(text, needle)
    return F.when(at > 0, F.substring(text, F.greatest(F.lit(1), at - around), F.length(needle) + 2 * around))


def fuzzy_contains(needle: Column, hay: Column, ratio: float = 0.75) -> Column:
    """The needle, or at least ``ratio`` of its words of three characters or more, as substrings of the hay, in lower case."""
    words = F.filter(F.split(F.lower(needle), r"[^a-z0-9_]+"), lambda w: F.length(w) > 2)
    held = F.size(F.filter(words, lambda w: F.contains(F.lower(hay), w)))
    return F.contains(F.lower(hay), F.lower(needle)) | ((F.size(words) > 0) & (held >= ratio * F.size(words)))


def real_line_feeds(text: Column, fewer_than: int = 10) -> Column:
    r"""``\n`` written out becomes a line feed where the text has few real ones."""
    return F.when(F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) < fewer_than, F.replace(text, F.lit("\\n"), F.lit("\n"))).otherwise(text)


def json_object(text: Column) -> Column:
    """The part from the first ``{`` to the last ``}``, without a code fence; null if it does not parse."""
    bare = F.regexp_replace(text, r"(?s)^\s*```[a-z]*\s*|\s*```\s*$", "")
    found = F.nullif(F.regexp_extract(bare, r"(?s)(\{.*\})", 1), F.lit(""))
    return F.when(F.call_function("try_parse_json", found).isNotNull(), found)


def sql_fields(sql: Column) -> Column:
    """Columns an INSERT or a SELECT names, trimmed, in order."""
    insert = F.regexp_extract(sql, r"(?is)INSERT\s+INTO\s+\S+\s*\(([^)]*)\)", 1)
    select = F.regexp_extract(sql, r"(?is)SELECT\s+(.*?)\s+FROM\s", 1)
    names = F.coalesce(F.nullif(insert, F.lit("")), F.nullif(select, F.lit("")))
    return F.transform(F.split(names, ","), lambda c: F.trim(c))


def section_lines(docs, keep: list[str], kinds: dict[str, str], text: str = "text"):
    """``keep, kind, ord, item``: list items below the last heading that has a word of a kind.

    The first kind whose expression meets the heading counts; a heading that
    meets none ends the section. Bullets and numbers are cut off.
    """
    lines = docs.select(*keep, F.posexplode(F.split(text, "\n")).alias("ord", "line"))
    heading = F.col("line").rlike(r"^#{1,6}\s")
    kind = None
    for name, pattern in kinds.items():
        hit = F.lower("line").rlike(pattern)
        kind = F.when(hit, name) if kind is None else kind.when(hit, name)
    running = Window.partitionBy(*keep).orderBy("ord").rowsBetween(Window.unboundedPreceding, 0)
    marked = lines.withColumn("kind", F.last(F.when(heading, kind.otherwise("")), True).over(running))
    item = F.trim(F.regexp_replace("line", r"^\s*([-*+]|[0-9]+[.)])\s+", ""))
    return marked.where(~heading & F.col("line").rlike(r"^\s*([-*+]|[0-9]+[.)])\s+") & (F.col("kind") != "")).select(*keep, "kind", "ord", item.alias("item"))


def term_covered(term: Column, text: Column, least: int = 4) -> Column:
    """The whole term, or any of its words of ``least`` characters, is part of the text, in lower case."""
    words = F.filter(F.split(F.lower(term), r"[^a-z0-9]+"), lambda w: F.length(w) >= least)
    return F.contains(F.lower(text), F.lower(term)) | F.exists(words, lambda w: F.contains(F.lower(text), w))


def bounded_sections(text: Column, most: int) -> Column:
    """Sections at second-level headings; longer ones are cut at third-level headings, and then to ``most`` characters."""
    parts = F.flatten(F.transform(sections(text), lambda s: F.when(F.length(s) <= most, F.array(s)).otherwise(F.filter(F.split(s, r"(?m)(?=^### )"), lambda p: F.trim(p) != ""))))
    cut = lambda p: F.transform(F.sequence(F.lit(0), F.floor((F.length(p) - 1) / most).cast("int")), lambda i: F.substring(p, i * most + 1, F.lit(most)))
    return F.flatten(F.transform(parts, cut))


def within(order: Column, *ranges) -> Column:
    """Status by thresholds given best first: ``within(x, (0.85, 'pass'), (0.25, 'warn'), 'fail')``."""
    *steps, last = ranges
    out = None
    for least, name in steps:
        out = F.when(order >= least, name) if out is None else out.when(order >= least, name)
    return out.otherwise(last)
