"""Licence scan by canonical digests.

A text is brought to a canonical form: without copyright statements, in lower case, every run of
punctuation, signs and spaces of any script as one space, and equivalent spellings as one. The SHA-256 of the form is joined
with those of the known licence texts and notices: once for the whole text, once for each of its lines.
All of it is DataFrame functions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .license_texts import listed

# A line that is a copyright statement: the word with a sign or a year, a sign with a year or a name, the reservation
# alone; or the word with a holder's name or kind and nothing else, unless licence wording follows the word.
# No pattern looks ahead, so that other engines can take them as they are.
_SIGN = r"(?:\(c\)|©|&copy;|(?:c\W+)?\d{4}|[\[<{](?:yyyy|year))"
_NAME = r"[A-Z][\w.&'-]*(?:[ ,]+(?:and|of|the|&|[A-Z][\w.&'-]*))*[\s.]*$"
_KIND = r"(?:inc|ltd|llc|corp|gmbh|foundation|university|contributors?|authors?|developers|team)"
SIGNED = rf"(?i)^[^a-z0-9]*(?:copyright[\W_]*{_SIGN}|©|&copy;|\(c\)\W*\d{{4}}|all rights reserved\W*$|(?-i:\([cC]\)\s+{_NAME}))"
HELD = rf"^[^A-Za-z0-9]*(?:(?i:copyright\s+.{{0,100}}\b{_KIND}\b.{{0,100}}$)|(?:[Cc]opyright|COPYRIGHT)(?: by)?\s+(?:the )?(?:[A-Z][a-z]){_NAME.removeprefix('[A-Z]')})"
WORDED = r"(?i)^[^a-z0-9]*copyright\s+(?:holder|owner|notice|licen[cs]e|law|treat|act|statement|protection|interest|and|or|of|in|to|for|is|are|as)s?\b"
# A statement inside a line, up to the words with which a licence begins; these stay.
INLINE = rf"(?is)\bcopyright[\W_]*{_SIGN}.{{0,300}}?(permission is hereby granted|permission to use, copy|redistribution and use in source)"
GAPS = r"[^\p{L}\p{N}]+"  # punctuation, signs, spaces and marks of any script
BROADCAST_MOST = 100_000  # known texts up to which their digests (about 100 bytes each) are sent to all tasks
# Spellings that mean the same, after lower case and gaps as spaces.
SPELLINGS = (("licence", "license"), ("sub license", "sublicense"), ("non commercial", "noncommercial"), ("non infringement", "noninfringement"),
             (" merchantibility ", " merchantability "), (" https ", " http "), (" favour ", " favor "), (" behaviour ", " behavior "))


def canonical_lines(text: Column) -> Column:
    """The canonical form of each line that has words and isn't a copyright statement."""
    def form(line):
        out = F.concat(F.lit(" "), F.regexp_replace(F.lower(line), GAPS, " "), F.lit(" "))
        for one, other in SPELLINGS:
            out = F.replace(out, F.lit(one), F.lit(other))
        return F.trim(F.regexp_replace(out, " +", " "))

    lines = F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), lambda line: F.regexp_replace(line, INLINE, " $1"))
    lines = F.filter(lines, lambda line: ~(line.rlike(SIGNED) | (line.rlike(HELD) & ~line.rlike(WORDED))))
    return F.filter(F.transform(lines, form), lambda line: line != "")


def known_digests(spark, texts: Sequence[tuple[str, str]]) -> DataFrame:
    """(digest, license_id) of a list of any length."""
    rows = spark.createDataFrame(list(texts), "license_id string, text string")
    digest = F.sha2(F.array_join(canonical_lines(F.col("text")), " "), 256)
    return rows.groupBy(digest.alias("digest")).agg(F.min("license_id").alias("license_id"))


def licence_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", texts: Sequence[tuple[str, str]] | None = None) -> DataFrame:
    """(doc_id, n_lines, text_sha256, license_id, notices).

    ``n_lines`` counts lines with words that aren't copyright statements, ``text_sha256`` is the digest of the
    whole canonical text, ``license_id`` its licence (null: none known), ``notices`` the licences that
    lines name, sorted and comma-joined. Null texts are empty. Repeated rows and null ids stay, one row each. An empty table gives an empty result; other columns are not read. Texts of any length are
    scanned whole.
    """
    texts = list(texts or listed())
    digests = known_digests(docs.sparkSession, texts)
    if len(texts) <= BROADCAST_MOST:
        digests = F.broadcast(digests)
    rows = docs.select(F.col(id_col).alias("doc_id"), canonical_lines(F.col(text_col).cast("string")).alias("lines"))
    rows = rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.size("lines").cast("long").alias("n_lines"),
                       F.sha2(F.array_join("lines", " "), 256).alias("text_sha256"), "lines")
    lines = rows.select("row", "doc_id", "n_lines", "text_sha256", F.explode_outer("lines").alias("line"))
    found = lines.join(digests.select(F.col("digest").alias("line_digest"), F.col("license_id").alias("name")), F.sha2("line", 256) == F.col("line_digest"), "left")
    found = found.groupBy("row", "doc_id", "n_lines", "text_sha256").agg(F.collect_set("name").alias("names"))
    named = F.array_join(F.sort_array("names"), ",")
    found = found.join(digests.select("digest", "license_id"), F.col("text_sha256") == F.col("digest"), "left")
    return found.select("doc_id", "n_lines", "text_sha256", "license_id", named.alias("notices"))
