"""Information-theoretic sanitisation of personal data.

Patterns find the protected entities: addresses of mail and hosts, card and phone numbers.
Beside them, corpus co-occurrence tells which terms give an entity away: of the documents that
hold a term, how many hold an entity of a kind (and of any kind), against the share of all
documents that do.  The logarithm of this ratio is the disclosure in bits (pointwise mutual
information of term and entity).  Every occurrence of a term that exceeds the disclosure
threshold, the least confidence and the least support is generalised, near an entity or far, also
in documents without one.  Words within entities are no terms.

All statistics cover the whole corpus.  DataFrame functions only: matches come from
``regexp_extract_all``, their places from the lengths of what ``split`` leaves between them.
The patterns are possessive and start at the beginning of a run, so matching takes linear time
and no deep recursion on long texts; they match what the plain ones do.

Terms are counted with partial aggregates; only documents that hold a disclosing term give rows
to a join, one per document and term.  Null text counts as empty, a null id is kept, repeated rows are sanitised
alike and stay repeated, other columns stay as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.session import ensure_checkpoint_dir

# Fixed patterns, in the order of their kinds.
KINDS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# What a text must hold to be searched for the kind at all.
HINTS = {"email": "@", "ip": ".", "card": "", "phone": "+"}
TERM = r"\p{L}\p{N}"
UNSEEN = "\ua66e"  # a letter in hardly any text; words that hold it are no terms
SPAN = "array<struct<start:int,kind_no:int,kind:string,end:int>>"


def digits_of(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def passes_luhn(digits: Column) -> Column:
    number = lambda c, i: F.when(i % 2 == 1, c.cast("int") * 2).otherwise(c.cast("int"))
    doubled = F.transform(F.regexp_extract_all(F.reverse(digits), F.lit("[0-9]"), F.lit(0)), number)
    return F.aggregate(doubled, F.lit(0), lambda s, x: s + F.when(x > 9, x - 9).otherwise(x)) % 10 == 0


def is_valid(kind: str, text: Column) -> Column:
    if kind == "ip":
        part = r"0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9][0-9]|[0-9]|(?<=0))"
        return text.rlike(rf"^{part}\.{part}\.{part}\.{part}$")
    n = F.length(digits_of(text))
    if kind == "card":
        return F.when(n.between(14, 19), passes_luhn(digits_of(text))).otherwise(False)
    if kind == "phone":
        return n.between(10, 15)
    return F.lit(True)


def let(value: Column, body) -> Column:
    """``body(value)`` with the value evaluated once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def running(values: Column, combine) -> Column:
    """Running totals of an array of ints: ``combine`` of each value with all before it.

    Appending to an array copies it, so totals are built within blocks of about the square root of the
    length, and each block takes the total of the blocks before it: n values cost some n ** 1.5 copies."""
    def scan(part: Column) -> Column:
        return F.aggregate(part, F.array().cast("array<int>"), lambda acc, x: F.concat(acc, F.array(
            F.when(F.size(acc) == 0, x).otherwise(combine(F.try_element_at(acc, F.lit(-1)), x)))))

    def blocks(v: Column) -> Column:
        width = F.ceil(F.sqrt(F.size(v))).cast("int")
        return let(width, lambda w: F.transform(
            F.sequence(F.lit(0), F.floor((F.size(v) - 1) / w).cast("int")), lambda i: scan(F.slice(v, i * w + 1, w))))

    def joined(parts: Column) -> Column:
        ends = scan(F.transform(parts, lambda p: F.try_element_at(p, F.lit(-1))))
        return let(ends, lambda e: F.flatten(F.transform(parts, lambda p, i: F.when(i == 0, p).otherwise(
            let(F.get(e, i - 1), lambda before: F.transform(p, lambda x: combine(before, x)))))))

    return let(values, lambda v: F.when(F.size(v) == 0, F.array().cast("array<int>")).otherwise(let(blocks(v), joined)))


def matches(text: Column, pattern: str) -> Column:
    """Array of {start, end, text} of all matches, leftmost first; code points from 0."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.transform(F.split(text, pattern, -1), F.length)
    steps = F.filter(F.arrays_zip(found.alias("found"), between.alias("gap")), lambda s: s["found"].isNotNull())

    def placed(steps: Column) -> Column:
        ends = running(F.transform(steps, lambda s: s["gap"] + F.length(s["found"])), lambda x, y: x + y)
        return let(ends, lambda e: F.transform(steps, lambda s, i: F.struct(
            (F.get(e, i) - F.length(s["found"])).alias("start"), F.get(e, i).alias("end"), s["found"].alias("text"))))

    return let(steps, placed)


def spans_of(text: Column, kind: str) -> Column:
    """Spans of one kind, those that fail its check dropped."""
    no = list(KINDS).index(kind)
    good = F.filter(matches(text, KINDS[kind]), lambda m: is_valid(kind, m["text"]))
    spans = F.transform(good, lambda m: F.struct(
        m["start"].alias("start"), F.lit(no).alias("kind_no"), F.lit(kind).alias("kind"), m["end"].alias("end")))
    return F.when(text.rlike(KINDS[kind]) if not HINTS[kind] else text.contains(HINTS[kind]), spans).otherwise(
        F.array().cast(SPAN))


def span_string(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def row_key(id_col: Column, text: Column) -> Column:
    """Tells rows of different id or text apart, also where ids are null or repeated."""
    return F.xxhash64(id_col, text)


def replaced(text: Column, spans: Column, by) -> Column:
    """The text with ``by(span, its text)`` in place of each span, overlapping ones by the first.

    A span is dropped if an earlier one reaches behind its start.  Finding a place in a text means
    walking to it, so the text is first cut into stretches of about the square root of the spans."""
    def whole(parts: Column) -> Column:  # spans in order -> kept ones with the place where the text before them begins
        def kept(reach: Column) -> Column:
            before = lambda i: F.when(i == 0, F.lit(0)).otherwise(F.get(reach, i - 1))
            with_before = F.transform(parts, lambda s, i: F.struct(s.alias("span"), before(i).alias("since")))
            return F.filter(with_before, lambda x: x["span"]["start"] >= x["since"])

        return let(running(F.transform(parts, lambda s: s["end"]), F.greatest), kept)

    def stretches(pieces: Column) -> Column:
        width = F.greatest(F.ceil(F.sqrt(F.size(pieces))).cast("int"), F.lit(1))
        return let(width, lambda w: F.transform(
            F.sequence(F.lit(0), F.floor((F.size(pieces) - 1) / w).cast("int")),
            lambda i: let(F.slice(pieces, i * w + 1, w), stretch)))

    def stretch(part: Column) -> Column:
        begin = F.get(part, F.lit(0))["since"]
        end = F.try_element_at(part, F.lit(-1))["span"]["end"]

        def inside(x: Column, here: Column, at: Column) -> Column:
            taken = F.substring(here, x["span"]["start"] - at + 1, x["span"]["end"] - x["span"]["start"])
            return F.concat(F.substring(here, x["since"] - at + 1, x["span"]["start"] - x["since"]), by(x["span"], taken))

        return let(F.struct(begin.alias("at"), F.substring(text, begin + 1, end - begin).alias("text")), lambda here: F.array_join(
            F.transform(part, lambda x: inside(x, here["text"], here["at"])), ""))

    def built(pieces: Column) -> Column:
        rest = F.array_max(F.transform(spans, lambda s: s["end"]))
        return F.concat(F.array_join(stretches(pieces), ""), F.substring(text, rest + 1, F.length(text)))

    return F.when(F.size(spans) == 0, text).otherwise(let(let(spans, whole), built))


def generalised(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind in angle brackets."""
    return replaced(text, spans, lambda s, _: F.concat(F.lit("<"), F.upper(s["kind"]), F.lit(">")))


def terms_of(text: Column, spans: Column) -> Column:
    """The distinct terms outside the spans, lower-cased; the empty one is in every text."""
    outside = replaced(text, spans, lambda s, _: F.lit(" "))
    words = F.filter(F.split(F.lower(outside), rf"[^{TERM}]+"), lambda w: ~w.contains(UNSEEN))
    return F.array_distinct(F.concat(F.array(F.lit("")), words))


def places_of(text: Column, terms: Column, spans: Column) -> Column:
    """Spans of all occurrences of the terms that lie outside the spans: letters and digits of the spans are
    put out of sight first, so that a word that reaches into one isn't a term's either."""
    unseen = replaced(text, spans, lambda _, taken: F.regexp_replace(taken, f"[{TERM}]", UNSEEN))
    held = let(terms, lambda t: F.filter(matches(unseen, f"[{TERM}]++"), lambda m: F.array_contains(t, F.lower(m["text"]))))
    return F.transform(held, lambda m: F.struct(m["start"].alias("start"), F.lit(len(KINDS)).alias("kind_no"),
                                                F.lit("term").alias("kind"), m["end"].alias("end")))


def with_entities(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows with ``_key``, ``_text``, counts by kind and ``_spans``, the entities in order."""
    rows = docs.withColumn("_text", F.coalesce(F.col(text_col), F.lit("")))
    rows = rows.select("*", row_key(F.col(id_col).cast("long"), F.col("_text")).alias("_key"),
                       *[spans_of(F.col("_text"), kind).alias(f"_{kind}") for kind in KINDS])
    return rows.select(*docs.columns, "_key", "_text", *[F.size(f"_{kind}").cast("long").alias(f"_n_{kind}") for kind in KINDS],
                       F.array_sort(F.concat(*[f"_{kind}" for kind in KINDS])).alias("_spans"))


def disclosing_terms(terms: DataFrame, min_bits: float, min_share: float, min_docs: int) -> DataFrame:
    """(term, bits): the terms that reveal entities of some kind, or of any, from counts over all
    documents.  ``terms`` has one row per document and term, with a flag for each event."""
    events = [*KINDS, "any"]
    counts = (terms.groupBy("term").agg(F.count("*").alias("n"), *[F.count(F.when(F.col(e), 1)).alias(e) for e in events])
              .where((F.col("any") >= min_docs) | (F.col("term") == "")).checkpoint())
    totals = counts.where("term = ''").first()  # the empty term is in every document
    bits = [F.when((F.col(e) >= min_docs) & (F.col(e) / F.col("n") >= min_share),
                   F.log2(F.col(e) / F.col("n") / F.lit(totals[e] / totals["n"]))) for e in events if totals and totals[e]]
    if not bits:
        return counts.select("term", F.lit(0.0).alias("bits")).limit(0)
    return (counts.where("term <> ''").select("term", F.greatest(*bits, F.lit(None).cast("double")).alias("bits"))
            .where(F.col("bits") >= min_bits))


def with_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_bits: float = 1.0,
               min_share: float = 0.5, min_docs: int = 5, broadcast_terms: int = 100_000) -> DataFrame:
    """The rows with ``_key``, counts by kind, ``_spans`` of entities and ``_all_spans`` of entities and
    of every occurrence of a disclosing term.  The terms are broadcast if there are no more than
    ``broadcast_terms`` of them; only documents that hold one give rows to the join with the texts."""
    ensure_checkpoint_dir(docs.sparkSession)
    rows = with_entities(docs, id_col, text_col)
    words = rows.select("_key", F.explode(terms_of(F.col("_text"), F.col("_spans"))).alias("term"),
                        *[(F.col(f"_n_{kind}") > 0).alias(kind) for kind in KINDS], (F.size("_spans") > 0).alias("any"))
    terms = disclosing_terms(words, min_bits, min_share, min_docs).select("term").checkpoint()
    if terms.limit(broadcast_terms + 1).count() <= broadcast_terms:
        terms = F.broadcast(terms)
    held = words.select("_key", "term").join(terms, "term").groupBy("_key").agg(F.collect_set("term").alias("_terms")).checkpoint()
    held = held.toDF("_held", "_terms")
    out = rows.join(held, F.col("_key") == F.col("_held"), "left")
    added = F.when(F.col("_terms").isNotNull(), places_of(F.col("_text"), F.col("_terms"), F.col("_spans"))).otherwise(
        F.array().cast(SPAN))
    return out.withColumn("_all_spans", F.array_sort(F.concat("_spans", added))).drop("_held", "_terms")


def find_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **thresholds) -> DataFrame:
    """(key, doc_id, counts, spans, all_spans): entities, and entities with disclosing terms."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return with_spans(rows, **thresholds).select(
        F.col("_key").alias("key"), "doc_id", *[F.col(f"_n_{kind}").alias(f"n_{kind}") for kind in KINDS],
        F.col("_spans").alias("spans"), F.col("_all_spans").alias("all_spans"))


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **thresholds) -> DataFrame:
    """The documents, all columns as they are but the text, in which entities and the terms that
    disclose them are generalised.  Texts that hold none are unchanged, null text stays null."""
    numbered = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])  # helper columns can't clash with these
    id_at, text_at = (f"c{docs.columns.index(c)}" for c in (id_col, text_col))
    found = with_spans(numbered, id_at, text_at, **thresholds)
    clean = F.when(F.size("_all_spans") > 0, generalised(F.col("_text"), F.col("_all_spans"))).otherwise(F.col(text_at))
    return found.withColumn(text_at, clean).select(*numbered.columns).toDF(*docs.columns)
