"""Text, identity and URI expressions. Case is folded by lower(), which differs from full case folding for a few letters such as sharp s."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = r"[ \t\n\r\f]+"
TERM = r"[\p{L}\p{N}_-]+"
CAPITALS = rf"(^|[^\p{{L}}\p{{N}}_])([A-Z]{TERM}({SPACE}[A-Z]{TERM}){{0,3}})"


def words(text: Column) -> Column:
    """Words between white space; null has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def corpus_key(value: Column) -> Column:
    """Trimmed, lower-case, underscores as hyphens, no empty part."""
    return F.array_join(F.filter(F.split(F.translate(F.lower(F.trim(value)), "_", "-"), "-"), lambda p: p != ""), "-")


def uuid5(namespace: Column, name: Column) -> Column:
    """Version-5 UUID of a name in a namespace (a UUID as text)."""
    g = F.sha1(F.concat(F.unhex(F.translate(namespace, "-", "")), F.encode(name, "UTF-8")))
    variant = F.lower(F.hex(F.conv(F.substring(g, 17, 2), 16, 10).cast("int").bitwiseAND(63).bitwiseOR(128)))
    return F.concat_ws("-", F.substring(g, 1, 8), F.substring(g, 9, 4), F.concat(F.lit("5"), F.substring(g, 14, 3)), F.concat(variant, F.substring(g, 19, 2)), F.substring(g, 21, 12))


def content_fingerprint(text: Column) -> Column:
    """SHA-256 of the folded text with runs of white space as one space."""
    return F.sha2(F.lower(F.array_join(words(text), " ")), 256)


def canonical_uri(value: Column) -> Column:
    """http(s): host in lower case without www., no trailing slash, no fragment, one form for videos; else the folded path. Empty: null."""
    v = F.trim(value)
    part = lambda k: F.regexp_extract(v, r"^((?i:https?))://([^/?#]*)([^?#]*)(\?[^#]+)?", k)
    host = F.regexp_replace(F.lower(part(2)), r"^www\.", "")
    stem = F.regexp_replace(part(3), "/+$", "")
    video = F.when(host == "youtu.be", F.regexp_extract(stem, r"^/([A-Za-z0-9_-]{11})$", 1)).when(host.isin("youtube.com", "m.youtube.com"), F.regexp_extract(part(4), r"[?&]v=([A-Za-z0-9_-]{11})(&|$)", 1)).otherwise("")
    plain = F.concat(F.lower(part(1)), F.lit("://"), host, F.when(stem == "", "/").otherwise(stem), part(4))
    return F.when(v == "", None).when(part(1) == "", F.lower(v)).when(video != "", F.concat(F.lit("https://www.youtube.com/watch?v="), video)).otherwise(plain)


def lemma(name: Column) -> Column:
    """Lower-case name with its last word in the singular, by suffix rules."""
    one = F.array_join(words(F.lower(name)), " ")
    return (
        F.when(one.rlike("[^aeiou ]ies$"), F.regexp_replace(one, "ies$", "y")).when(one.rlike("(s|x|z|ch|sh)es$"), F.regexp_replace(one, "es$", ""))
        .when(one.rlike("[^sui ]s$"), F.regexp_replace(one, "s$", "")).otherwise(one)
    )


def cited(answer: Column, requested: Column, allowed: Column) -> Column:
    """Citations asked for or tagged [S1] in an answer, in order and once each, as far as they are allowed."""
    tags = F.regexp_extract_all(answer, F.lit(r"\[(S\d+)\]"), 1)
    return F.filter(F.array_distinct(F.concat(requested, tags)), lambda c: F.array_contains(allowed, c))


def valid_vector(v: Column, dimension: int) -> Column:
    """Whether a vector has the dimension and finite numbers only."""
    return F.coalesce((F.size(v) == dimension) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
