"""Names and labels of entities: normal forms, alias and direction rules, decisions. All are Column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Labels that may stand for each other. Fixed values.
COMPATIBLE_LABELS = (("Metric", "Financial Metric"), ("Strategy", "Trading System", "Trading Concept"), ("Signal", "Indicator", "Market Feature"), ("Method", "Algorithm", "Model"))
#: Labels that say nothing. Fixed values.
PLAIN_LABELS = ("__Entity__", "Concept")
TAXONOMY = ("SUBCLASS_OF", "INSTANCE_OF", "TYPE_OF")


def name_tokens(name: Column) -> Column:
    """Lower-case runs of letters and digits, in order; null has none."""
    return F.filter(F.split(F.lower(F.coalesce(name, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda t: t != "")


def normal_name(name: Column) -> Column:
    return F.array_join(name_tokens(name), " ")


def token_set(name: Column) -> Column:
    return F.array_sort(F.array_distinct(name_tokens(name)))


def shingles(tokens: Column, width: int = 3) -> Column:
    """Distinct runs of width tokens as text; of fewer tokens, the whole as one; without tokens, none."""

    def of(t: Column) -> Column:
        runs = F.transform(F.sequence(F.lit(1), F.size(t) - width + 1), lambda i: F.array_join(F.slice(t, i, width), " "))
        return F.when(F.size(t) == 0, F.array().cast("array<string>")).when(F.size(t) < width, F.array(F.array_join(t, " "))).otherwise(F.array_distinct(runs))

    return F.get(F.transform(F.array(tokens), of), F.lit(0))  # as a lambda's variable the tokens are made once, not once a run


def overlap(a: Column, b: Column) -> Column:
    """Shared part of the smaller of two sets; 0 if one is empty."""
    least = F.least(F.size(a), F.size(b))
    return F.when(least > 0, F.size(F.array_intersect(a, b)) / least).otherwise(F.lit(0.0))


def alias_like(a: Column, b: Column) -> Column:
    """Whether two names may be one: equal, of the same tokens, one within the other, or one the initials of the other (in the order of its tokens)."""
    na, nb, ta, tb = normal_name(a), normal_name(b), name_tokens(a), name_tokens(b)
    initials = lambda t: F.array_join(F.transform(t, lambda x: F.substring(x, 1, 1)), "")
    packed = lambda n: F.replace(n, F.lit(" "), F.lit(""))
    acronym = ((initials(ta) == packed(nb)) & (initials(tb) == packed(na))) | ((initials(ta) == packed(nb)) & (F.size(tb) == 1) & (F.size(ta) > 1)) | ((initials(tb) == packed(na)) & (F.size(ta) == 1) & (F.size(tb) > 1))
    return (na != "") & (nb != "") & ((na == nb) | (token_set(a) == token_set(b)) | F.contains(na, nb) | F.contains(nb, na) | acronym)


def incompatible_labels(a: Column, b: Column) -> Column:
    """Whether telling labels of two entities are disjoint and not of one group that may stand for each other."""
    plain = F.array(*(F.lit(x) for x in PLAIN_LABELS))
    sa, sb = F.array_except(a, plain), F.array_except(b, plain)
    inside = lambda s, g: F.size(F.array_except(s, F.array(*(F.lit(x) for x in g)))) == 0
    grouped = reduce(lambda x, y: x | y, (inside(sa, g) & inside(sb, g) for g in COMPATIBLE_LABELS))
    return (F.size(sa) > 0) & (F.size(sb) > 0) & ~F.arrays_overlap(sa, sb) & ~grouped


def concept_only(labels: Column) -> Column:
    return F.size(F.array_except(labels, F.array(*(F.lit(x) for x in PLAIN_LABELS)))) == 0


def shorter_name(a: Column, b: Column) -> Column:
    """The shorter of two names, the first of equally long ones; an empty name gives way."""
    x, y = F.coalesce(a, F.lit("")), F.coalesce(b, F.lit(""))
    return F.when((y == "") | ((x != "") & (F.length(x) <= F.length(y))), x).otherwise(y)


def direction(source: Column, target: Column, relation: Column) -> Column:
    """Why a taxonomy relation from source to target is not plausible; empty if it is."""
    s, t, ss, ts = normal_name(source), normal_name(target), token_set(source), token_set(target)
    narrower = (F.size(ss) > 0) & (F.size(F.array_except(ss, ts)) == 0) & (F.size(ts) > F.size(ss))
    return (
        F.when(~F.coalesce(relation, F.lit("")).isin(*TAXONOMY), "Unsupported relation").when((s != "") & (s == t), "Target name matches source name")
        .when(narrower, "Target appears lexically narrower than source").when((s != "") & F.startswith(t, F.concat(s, F.lit(" "))), "Target appears to specialize the source").otherwise("")
    )


def relation_name(relation: Column) -> Column:
    """Upper-case relation type with underscores; IS_A is TYPE_OF."""
    r = F.regexp_replace(F.upper(F.trim(F.coalesce(relation, F.lit("")))), "[ -]+", "_")
    return F.when(r == "IS_A", "TYPE_OF").otherwise(r)


def identifier(text: Column, most: int = 100) -> Column:
    """A safe identifier: other characters than letters, digits and underscore as one underscore, none at the ends, no leading digit, at most `most` characters."""
    s = F.regexp_replace(F.regexp_replace(F.coalesce(text, F.lit("")), "[^A-Za-z0-9_]+", "_"), "^_+|_+$", "")
    return F.substring(F.when(s.rlike("^[0-9]"), F.concat(F.lit("_"), s)).otherwise(s), 1, most)


def slug(text: Column) -> Column:
    """Lower-case letters and digits, joined by single hyphens."""
    return F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def uuids(text: Column) -> Column:
    """Distinct UUIDs in a text, lower-case, in order."""
    return F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}"), 0))


def sentences(text: Column) -> Column:
    """Sentences of a text: it is cut after . ! or ? before white space, and at line ends; ends are trimmed, empty ones left out."""
    return F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), r"(?<=[.!?])[ \t\n\r\f]+|\n+"), lambda s: F.btrim(s, F.lit(" \t\n\r\f"))), lambda s: s != "")


def deltas(text: Column, size: int = 80) -> Column:
    """Stretches of size characters, for answers sent bit by bit; empty text has none."""
    t = F.coalesce(text, F.lit(""))
    return F.when(t == "", F.array().cast("array<string>")).otherwise(F.transform(F.sequence(F.lit(0), F.floor((F.length(t) - 1) / size).cast("int")), lambda i: F.substring(t, i * size + 1, F.lit(size))))


def clamp(value: Column, low: float, high: float) -> Column:
    """Value within [low, high]; null and not-a-number are low."""
    return F.when(value.isNull() | F.isnan(value), F.lit(low)).otherwise(F.greatest(F.lit(low), F.least(F.lit(high), value)))


def transient(message: Column) -> Column:
    """Whether an error's message reads like one that goes by itself."""
    return F.lower(F.coalesce(message, F.lit(""))).rlike("rate limit|timeout|timed out|temporarily|unavailable|overloaded|connection|429|503")


def date_span(start: Column, end: Column) -> Column:
    """Struct of start and end dates (ISO text; empty is null) and whether they are valid: both readable, not in reverse."""
    read = lambda c: F.when(F.trim(c) != "", F.try_to_date(F.trim(c), "yyyy-MM-dd"))
    given = lambda c: F.coalesce(F.trim(c) != "", F.lit(False))
    a, b = read(start), read(end)
    bad = (given(start) & a.isNull()) | (given(end) & b.isNull()) | F.coalesce(a > b, F.lit(False))
    return F.struct(a.alias("start"), b.alias("end"), (~bad).alias("valid"))


#: What errors say when an answer was too long. Fixed values.
OUTPUT_LIMITS = ("length limit was reached", "could not parse response content", "maximum context length", "maximum output tokens", "max output tokens", "response was truncated", "finish_reason:length")


def over_limit(message: Column) -> Column:
    """Whether an error's message tells of an output that was too long."""
    return reduce(lambda a, b: a | b, (F.contains(F.lower(F.coalesce(message, F.lit(""))), F.lit(m)) for m in OUTPUT_LIMITS))


def file_stem(text: Column) -> Column:
    """A file name's stem of ASCII letters, digits, dots, hyphens and single underscores; 'record' if nothing is left."""
    one = F.regexp_replace(F.regexp_replace(F.btrim(F.coalesce(text, F.lit(""))), "[^A-Za-z0-9._-]+", "_"), "_+", "_")
    s = F.regexp_replace(one, r"^[._]+|[._]+$", "")
    return F.when(s == "", "record").otherwise(s)


def staged_name(path: Column) -> Column:
    """Name of a text file for a relative path: its letters and digits in lower case, and ten digits of its SHA-1."""
    s = F.lower(F.regexp_replace(F.regexp_replace(path, "[^A-Za-z0-9]+", "_"), "^_+|_+$", ""))
    return F.concat(F.when(s == "", "source").otherwise(s), F.lit("__"), F.substring(F.sha1(path), 1, 10), F.lit(".txt"))


def last_segment(url: Column) -> Column:
    """Last part of a URL's path; without one, the host's first label."""
    rest = F.regexp_replace(F.regexp_replace(url, "^[A-Za-z][A-Za-z0-9+.-]*://", ""), "[?#].*$", "")
    host, path = F.regexp_extract(rest, "^([^/]*)", 1), F.regexp_replace(F.regexp_replace(rest, "^[^/]*", ""), "^/+|/+$", "")
    return F.when(path == "", F.substring_index(host, ".", 1)).otherwise(F.substring_index(path, "/", -1))
