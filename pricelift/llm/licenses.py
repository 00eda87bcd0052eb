"""Licence scan: canonical digests of whole texts, joined to the digests of known licences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelift.llm.license_texts import KNOWN

#: Spellings that count as the same words: (pattern over the folded text, replacement).  Fixed values.
SPELLINGS = (
    (r"\blicence", "license"),
    (r"\bsub licens", "sublicens"),
    (r"\bnon (commercial|infring|exclusive)", r"non\1"),
    (r"\backnowledgement", "acknowledgment"),
    (r"\bauthoris", "authoriz"),
    (r"\bcopyright (owner|holder)s?\b", "copyright holder"),
    (r"\bhttps\b", "http"),
)

#: Words behind "copyright" in the prose of licences; any other word there names an owner.  Fixed values.
PROSE = tuple(
    "act and are as can claim claims disclaimer disclaimers for grant holder holders if in infringement interest interests is law laws"
    " license licensed licenses licence licences licensing like line lines may must notice notices of on or owner owners ownership"
    " permission permissions policy protection registration right rights shall statement statements status subsists that to treaties"
    " treaty under which will with".split()
)


def other_word(words: tuple[str, ...]) -> str:
    """A pattern of a word that is none of ``words``, without lookahead, which not every engine has."""
    ways = ["[a-zß-ÿ]+"] if not words else []
    if words:
        first = sorted({w[0] for w in words if w})
        ways.append(f"[^{''.join(first)}\x00-\x60\x7B-\xBF]")
        for letter in first:
            rest = tuple(w[1:] for w in words if w[:1] == letter)
            deeper = other_word(tuple(r for r in rest if r)) if any(rest) else "[a-zß-ÿ]+"
            # the letters so far are a word of their own unless one of the words ends here
            ways.append(f"{letter}(?:{deeper})" + ("" if "" in rest else "|" + letter + r"(?:[^a-zß-ÿ]|$)"))
    return "|".join(ways)


#: Lines that only name the owner of the rights.
COPYRIGHT_LINES = (
    r"(?m)^[^a-z0-9\n]*(?:copyright[ \t]*(?:\(c\)|©|[0-9]|<|\[|\{)|copyright(?:[ \t]*:[ \t]*|[ \t]+)(?:" + other_word(PROSE)
    + r")|\(c\)[ \t]*(?:[^a-zß-ÿ \t\n]|$|" + other_word(("you", *PROSE)) + r")|©|all rights reserved)[^\n]*$"
)

#: Whatever is not a letter, a digit or beyond Latin-1 punctuation separates words.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\xBF\x{2000}-\x{206F}]+"

#: Lines that may be a notice of their own name a licence.
NOTICE_HINT = r"(?i)licen[sc]e"


def canonical(text: Column) -> Column:
    """Lower case, without copyright lines and punctuation, in one spelling, one space between words."""
    folded = F.regexp_replace(F.lower(text), COPYRIGHT_LINES, " ")
    folded = F.regexp_replace(folded, SEPARATORS, " ")
    for pattern, put in SPELLINGS:
        folded = F.regexp_replace(folded, pattern, put.replace(r"\1", "$1"))
    return F.trim(folded)


def digest(text: Column) -> Column:
    return F.sha2(canonical(text), 256)


def known_digests(spark: SparkSession, known: dict[str, str] = KNOWN) -> DataFrame:
    """(known_digest, license): as many rows as texts were handed over."""
    rows = spark.createDataFrame(sorted(known.items()), "license string, body string")
    return rows.select(digest(F.col("body")).alias("known_digest"), "license").groupBy("known_digest").agg(F.min("license").alias("license"))


def scan(docs: DataFrame, known: dict[str, str] = KNOWN) -> DataFrame:
    """Every document with the digest of its whole text and the licence that this text is, else null.

    ``notices`` lists, sorted, the licences that a whole line of the text names by a known notice.  A null
    or text without words has a null digest and no licence.  Equal rows are scanned
    alike; an empty table stays empty; further columns are not read.
    """
    body = F.coalesce(F.col("text").cast("string"), F.lit(""))
    lines = F.filter(F.split(body, "\n"), lambda line: line.rlike(NOTICE_HINT))
    # most texts have no such line: the array is empty then and costs nothing further
    line_digests = F.array_distinct(F.transform(lines, digest))
    base = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.nullif(canonical(body), F.lit("")).alias("folded"), line_digests.alias("line_digests"),
    ).select("doc_id", F.sha2(F.col("folded"), 256).alias("text_digest"), "line_digests")
    # the known texts are handed over as a parameter, so their size is known before the join
    table = known_digests(docs.sparkSession, known)
    whole = base.join(F.broadcast(table), F.col("text_digest") == F.col("known_digest"), "left").drop("known_digest")
    # digests of constants: folded to one literal map when the plan is optimised
    by_digest = F.create_map(*[c for name, text in sorted(known.items()) for c in (digest(F.lit(text)), F.lit(name))])
    names = F.filter(F.transform(F.col("line_digests"), lambda d: by_digest[d]), lambda n: n.isNotNull())
    return whole.select("doc_id", "text_digest", "license", F.array_join(F.sort_array(F.array_distinct(names)), ",").alias("notices"))
