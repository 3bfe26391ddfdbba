"""Document fingerprints: a Merkle tree over paragraphs and sections.

A paragraph is a run of a text up to the end of a sentence or line (64 code points at most
before it, so that texts without marks are cut too).  Its hash is a leaf.  A section ends at a
paragraph whose hash ends in 0 or 1, about every eighth: its borders depend on the content, so
an insertion moves no section but its own.  A section's hash is taken over its leaves, the
root over the sections.  Equal texts have equal roots; where roots differ, equal sections are
skipped and differing ones name the paragraphs that were edited.

The fingerprint is ``root:sections:leaves``, the latter two shortened to eight hex digits each.
The likeness of two fingerprints is 1 for equal roots, else the Dice coefficient of the sets of
their nodes (roots, sections, leaves).

DataFrame functions only.  Null text counts as empty: its tree is a root alone.  Long texts
keep to their row.  Following documents are found by ranges of ids whose borders are quantiles of
the ids, so that ranges hold about equally many documents however the ids lie; an id that many
rows share, and rows without one, are spread over several ranges by a hash of the text.  No task
holds the whole order: one shuffle of the texts, and one row per range beyond that.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.operators.slices import slice_count
from strata.session import ensure_checkpoint_dir

PARAGRAPH = r"[^\n.!?]{1,64}[\n.!?]*+|[\n.!?]++"
SECTION = r"(?=[0-9a-f])(?:[0-9a-f]{15}[2-9a-f])*+(?:[0-9a-f]{15}[01])?"
SHORT_SECTION = SECTION.replace("15", "7")


def node(data: Column) -> Column:
    return F.substring(F.md5(data), 1, 16)


def leaves(text: Column) -> Column:
    """The paragraphs' hashes, in order, as one string of 16 digits each."""
    return F.array_join(F.transform(F.regexp_extract_all(text, F.lit(PARAGRAPH), F.lit(0)), node), "")


def shortened(hashes: Column) -> Column:
    return F.regexp_replace(hashes, "[0-9a-f]{8}([0-9a-f]{8})", "$1")  # the last digit tells where sections end


def with_fingerprint(df: DataFrame, text_col: str, name: str) -> DataFrame:
    """Adds the fingerprint of a column of texts."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return (
        df.withColumn(name, leaves(text))
        .withColumn(name, F.struct(
            F.col(name).alias("leaves"),
            F.array_join(F.transform(F.regexp_extract_all(F.col(name), F.lit(SECTION), F.lit(0)), node), "").alias("sections")))
        .withColumn(name, F.concat_ws(":", F.md5(F.col(name)["sections"]), shortened(F.col(name)["sections"]),
                                      shortened(F.col(name)["leaves"])))
    )


def nodes(fingerprint: Column) -> Column:
    """The nodes below the root, told apart by their level."""
    part = lambda i: F.regexp_extract_all(F.split_part(fingerprint, F.lit(":"), F.lit(i)), F.lit("[0-9a-f]{8}"), F.lit(0))
    return F.array_distinct(F.concat(part(3), F.transform(part(2), lambda x: F.concat(F.lit("s"), x))))


def likeness(a: Column, b: Column) -> Column:
    x, y = nodes(a), nodes(b)
    return F.when(a == b, 1.0).when(a.isNull() | b.isNull(), F.lit(None).cast("double")).otherwise(
        2.0 * F.size(F.array_intersect(x, y)) / (F.size(x) + F.size(y) + 2))


def level(fingerprint: Column, number: int) -> Column:
    """The shortened hashes of the sections (2) or leaves (3), in order."""
    return F.regexp_extract_all(F.split_part(fingerprint, F.lit(":"), F.lit(number)), F.lit("[0-9a-f]{8}"), F.lit(0))


def differing_paragraphs(a: Column, b: Column) -> Column:
    """Numbers of the paragraphs of ``a`` that ``b`` doesn't have, from the root down: nothing if the roots are
    equal, and only the leaves of sections that ``b`` doesn't have are looked at."""
    groups = F.regexp_extract_all(F.split_part(a, F.lit(":"), F.lit(3)), F.lit(SHORT_SECTION), F.lit(0))
    section = F.struct(level(b, 2).alias("sections"), level(b, 3).alias("leaves"))

    def descend(there: Column) -> Column:
        branches = F.transform(F.arrays_zip(level(a, 2).alias("hash"), groups.alias("leaves")), lambda s: F.transform(
            F.regexp_extract_all(s["leaves"], F.lit("[0-9a-f]{8}"), F.lit(0)),
            lambda leaf: F.when(~F.array_contains(there["sections"], s["hash"]), leaf)))
        return F.transform(F.flatten(branches), lambda leaf, i: F.when(
            leaf.isNotNull() & ~F.array_contains(there["leaves"], leaf), i))

    found = F.transform(F.array(section), lambda there: F.filter(descend(there), lambda i: i.isNotNull()))[0]
    return F.when(a == b, F.array().cast("array<int>")).otherwise(found)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint) of every whole text."""
    return with_fingerprint(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("_text")),
                            "_text", "fingerprint").select("doc_id", "fingerprint")


def ranges_of(rows: DataFrame, n_ranges: int) -> Column:
    """The range of each row of (doc_id, text, _hash): never falls along (doc_id, _hash), nulls first."""
    n_ranges = max(2, min(n_ranges, 4096))
    places = F.array(*[F.lit(i / n_ranges) for i in range(1, n_ranges)])
    n, n_null, borders = rows.agg(F.count(F.lit(1)), F.count_if(F.col("doc_id").isNull()), F.percentile_approx(
        "doc_id", places, F.lit(10 * n_ranges if n_ranges > 1000 else 10_000))).first()  # as many borders as ranges
    share = F.shiftright("_hash", 33) / F.lit(float(1 << 31)) + 0.5  # of the hash's values, below this one
    null_ranges = math.ceil(n_ranges * n_null / n) if n else 0
    if not borders:
        return F.floor(share * null_ranges).cast("long")
    step = math.isqrt(len(borders))
    blocks = [borders[i:i + step] for i in range(0, len(borders), step)]

    def count(values: list, test) -> Column:  # how many borders of sorted blocks pass: whole blocks, then within the next
        heads = F.size(F.filter(F.array(*[F.lit(v[-1]) for v in values]), test))
        inner = F.get(F.array(*[F.array(*map(F.lit, v)) for v in values]), heads)
        return heads * step + F.coalesce(F.size(F.filter(inner, test)), F.lit(0))

    below = count(blocks, lambda x: x < F.col("doc_id"))
    upto = count(blocks, lambda x: x <= F.col("doc_id"))
    # the rows of an id that is a border several times are dealt over the ranges between these
    mine = F.least(upto, below + F.floor(share * (upto - below + 1)))
    return F.when(F.col("doc_id").isNull(), F.floor(share * null_ranges) - null_ranges).otherwise(mine).cast("long")


def with_following(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", per_range: int | None = None) -> DataFrame:
    """(doc_id, text, next_text): each document with the text of the next by id, the last with
    that of the first.  Equal ids go by a hash of the text, then by the text; rows without an id come
    first; null text is empty.  There are as many ranges as shuffle partitions, or one for ``per_range`` rows."""
    ensure_checkpoint_dir(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("_hash", F.xxhash64("text"))
    rows = rows.withColumn("_range", ranges_of(rows, -(-rows.count() // per_range) if per_range else slice_count(docs)))
    order = Window.partitionBy("_range").orderBy("doc_id", "_hash", "text")
    # one row per range, found before the shuffle: a range's last document needs the first of the
    # following range that has any
    firsts = rows.withColumn("_n", F.row_number().over(order)).where("_n = 1").select("_range", "text").checkpoint()
    ranges = firsts.select("_range")
    start = ranges.agg(F.min("_range").alias("_start")).scalar()
    following = ranges.select(
        "_range", F.coalesce(F.lead("_range").over(Window.orderBy("_range")), start).alias("_after"))
    border = following.join(firsts.select(F.col("_range").alias("_after"), F.col("text").alias("_border")), "_after")
    # the rows lie by range already, so the small side alone moves for this join
    led = rows.withColumn("_next", F.lead("text").over(order)).join(border.drop("_after"), "_range")
    return led.select("doc_id", "text", F.coalesce("_next", "_border").alias("next_text"))  # a text is never null here


def compare_with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: its fingerprint, that of its text with the last quarter replaced by the
    beginning of the next document, and how like the first is to the second and to the next's."""
    rows = with_following(docs, id_col, text_col)
    n = F.length("text")
    quarter = F.floor(n / 4).cast("int")
    rows = rows.select("doc_id", "text", "next_text", n.cast("long").alias("n_chars"), F.concat(
        F.expr("substring(text, 1, length(text) - cast(floor(length(text) / 4) as int))"),
        F.substring(F.col("next_text"), F.lit(1), quarter)).alias("edited"))
    for column, name in (("text", "fingerprint"), ("edited", "edited_fingerprint"), ("next_text", "_next_fingerprint")):
        rows = with_fingerprint(rows, column, name)
    return rows.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("_next_fingerprint")).alias("near_next"))
