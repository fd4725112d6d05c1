"""I-Match fingerprints over randomised lexicon subsets (operator 9).

Native: DataFrame functions only.

* Document frequencies of all terms, counted over distinct texts, give the
  lexicon: the terms whose inverse document frequency lies in the chosen band.
* Near copies are distinct texts: where a group of them is large, its terms leave
  the band.  So a text of whose sampled terms a share below LEAST is in the
  lexicon has all its terms in its subsets instead.
* A term's hash deals it to one of M random parts of the lexicon; the first
  SUBSETS of them are the randomised subsets.  M is a power of two near the
  document's number of distinct terms, so a subset holds one or two of its terms
  at any length; the fingerprint also has the subsets of 2 M, so that documents
  of somewhat different length share a level.
* Each subset is hashed: the exclusive or of its distinct terms' hashes, which is
  the hash of the sorted list without the sort (it does not depend on order).

The likeness of two fingerprints is the share of equal hashes among the subsets
of a common level that are not empty in both.

Terms go to the lexicon by a broadcast only while its counted size is below
BROADCAST_TERMS, else by a shuffled join.

Defined results: null text is empty text; only texts without any term have a
fingerprint of empty subsets; equal fingerprints have likeness 1, those without a
common level 0; repeated rows (same id and text) count as one document in the
order and in the frequencies and are returned as often as they occur; rows that
share an id with other texts are ordered by a hash of the text; an only document
is followed by itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablepipe.llm.common import with_global_rank, written

TERM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Terms in more than a twentieth of all documents, or in fewer than two, are outside the band.
HIGH_SHARE = 0.05
LOW_DOCS = 2
SUBSETS = 32
PER_SUBSET = 1.5
LEAST = 0.3
BROADCAST_TERMS = 2_000_000
# Groups of copies (a hash and an id each) sent to all executors at most; more are shuffled.
BROADCAST_GROUPS = 1_000_000


def _terms(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0)))


def lexicon(texts: DataFrame, text_col: str, high_share: float = HIGH_SHARE, low_docs: int = LOW_DOCS) -> DataFrame:
    """term (64-bit hash) of the terms in the band; written."""
    total = texts.count()
    counted = texts.select(F.explode(F.transform(_terms(F.col(text_col)), lambda t: F.xxhash64(t))).alias("term")).groupBy("term").count()
    return written(counted.where(F.col("count").between(low_docs, max(low_docs, high_share * total))).select("term"), "lexicon")


def fingerprints(texts: DataFrame, keys: list[str], text_col: str, terms: DataFrame, subsets: int = SUBSETS, per_subset: float = PER_SUBSET, least: float = LEAST) -> DataFrame:
    """``keys``, level, low and high (hashes of the subsets at the level and the
    next one, null where empty).  ``keys`` must be unique."""
    found = texts.select(*keys, F.transform(_terms(F.col(text_col)), lambda t: F.xxhash64(t)).alias("_h"))
    smallest = (subsets - 1).bit_length()
    level = F.greatest(F.lit(smallest), F.round(F.log2(F.greatest(F.size("_h"), F.lit(1)) / per_subset)).cast("int"))
    found = found.withColumn("level", level).withColumn("_mask", F.expr("shiftleft(1L, level) - 1"))
    near = F.filter("_h", lambda h: h.bitwiseAND(F.col("_mask")) < subsets)
    # One null a document keeps those without a term.
    rows = found.select(*keys, "level", "_mask", F.explode(F.concat(near, F.array(F.lit(None).cast("long")))).alias("_h"))
    lexical = terms.select(F.col("term").alias("_term"))
    if terms.count() <= BROADCAST_TERMS:
        lexical = F.broadcast(lexical)
    rows = rows.join(lexical, F.col("_h") == F.col("_term"), "left")
    # Both lists are bounded: a subset holds few terms at any length.
    out = rows.groupBy(*keys, "level", "_mask").agg(F.collect_list("_h").alias("_all"), F.collect_list("_term").alias("_lex"))
    used = out.withColumn("_used", F.when(F.size("_lex") < F.size("_all") * least, F.col("_all")).otherwise(F.col("_lex")))

    def hashes(mask: str) -> Column:
        member = f"filter(_used, t -> (t & ({mask})) = j)"
        return F.expr(f"transform(sequence(0L, {subsets - 1}L), j -> aggregate({member}, cast(null as bigint), (x, t) -> coalesce(x ^ t, t)))")

    return used.select(*keys, "level", hashes("_mask").alias("low"), hashes("_mask * 2 + 1").alias("high"))


def as_text(level: str, low: str, high: str) -> Column:
    """The fingerprint as a string: the level, then 8 hex digits a subset (the upper half of its hash)."""
    digits = lambda c: F.array_join(F.transform(F.col(c), lambda x: F.coalesce(F.lower(F.lpad(F.hex(F.shiftrightunsigned(x, 32)), 8, "0")), F.lit("-"))), ",")
    return F.concat_ws(":", F.col(level).cast("string"), digits(low), digits(high))


def likeness(a: tuple[str, str, str], b: tuple[str, str, str]) -> Column:
    """Likeness of two fingerprints, each given as its columns (level, low, high)."""
    (la, a0, a1), (lb, b0, b1) = ([F.col(c) for c in x] for x in (a, b))

    def share(x: Column, y: Column) -> Column:
        both = F.zip_with(x, y, lambda p, q: F.when(p.isNull() & q.isNull(), F.lit(None)).otherwise(p.eqNullSafe(q)))
        live = F.size(F.filter(both, lambda v: v.isNotNull()))
        same = F.size(F.filter(both, lambda v: v.isNotNull() & v))
        return F.when(live == 0, F.lit(0.0)).otherwise(same / live)

    equal = (la == lb) & a0.eqNullSafe(b0) & a1.eqNullSafe(b1)
    return F.when(equal, F.lit(1.0)).when(la == lb, share(a0, b0)).when(lb == la + 1, share(a1, b0)).when(la == lb + 1, share(a0, b1)).otherwise(F.lit(0.0))


def _one_of_copies(rows: DataFrame, order: DataFrame) -> DataFrame:
    """Of the rows (doc_id, hash, text) of one text the first in the order."""
    groups = order.groupBy(F.col("hash").alias("g_hash")).agg(F.count(F.lit(1)).alias("copies"), F.min_by("doc_id", "rank").alias("first_id")).where("copies > 1")
    groups = written(groups, "groups")
    if groups.count() <= BROADCAST_GROUPS:
        groups = F.broadcast(groups)
    found = rows.join(groups, F.col("hash") == F.col("g_hash"), "left")
    return found.where(F.col("g_hash").isNull() | F.col("doc_id").eqNullSafe(F.col("first_id"))).select(*rows.columns)


def edited_likeness(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has its last quarter replaced by the beginning of the next
    document (ascending id, after the last the first)."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).withColumn("hash", F.xxhash64("text"))
    counted = rows.select("doc_id", "hash", F.length("text").cast("long").alias("n")).groupBy("doc_id", "hash", "n").agg(F.count(F.lit(1)).alias("times"))
    order = written(with_global_rank(counted, ["doc_id", "hash"], name="order"), "order")
    total, every = order.agg(F.count(F.lit(1)), F.sum("times")).first()
    if total != every:  # repeated rows: one of each from here on
        rows = rows.dropDuplicates(["doc_id", "hash"])
    after = order.select(F.col("doc_id").alias("next_id"), F.col("hash").alias("next_hash"), F.col("rank").alias("next_rank"))
    pairs = written(order.join(after, F.expr(f"(rank + 1) % {max(total, 1)}") == F.col("next_rank")).drop("rank", "next_rank"), "pairs")

    heads = rows.join(pairs.select(F.col("doc_id").alias("of_id"), F.col("hash").alias("of_hash"), "n", "next_id", "next_hash"), F.col("doc_id").eqNullSafe(F.col("next_id")) & (F.col("hash") == F.col("next_hash")))
    heads = heads.select("of_id", "of_hash", F.expr("substring(text, 1, cast(n div 4 as int))").alias("head"))
    both = rows.join(heads, F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.col("hash") == F.col("of_hash")))
    both = both.withColumn("n", F.length("text"))
    edited = F.concat(F.expr("substring(text, 1, n - n div 4)"), F.col("head"))
    both = both.select("doc_id", "hash", F.explode(F.array(F.struct(F.lit(False).alias("edit"), F.col("text").alias("text")), F.struct(F.lit(True).alias("edit"), edited.alias("text")))).alias("v")).select("doc_id", "hash", "v.*")
    both = both.withColumn("sha", F.when(F.col("edit"), F.sha2("text", 256)))
    prints = written(fingerprints(both, ["doc_id", "hash", "edit", "sha"], "text", lexicon(_one_of_copies(rows, order), "text")), "prints")

    def named(what: DataFrame, prefix: str) -> DataFrame:
        return what.select(*[F.col(c).alias(f"{prefix}_{c}") for c in ("doc_id", "hash", "level", "low", "high", "sha")])

    own, new, nxt = named(prints.where("not edit"), "o"), named(prints.where("edit"), "e"), named(prints.where("not edit"), "x")
    same = lambda i, h, p: F.col(i).eqNullSafe(F.col(f"{p}_doc_id")) & (F.col(h) == F.col(f"{p}_hash"))
    out = pairs.join(own, same("doc_id", "hash", "o")).join(new, same("doc_id", "hash", "e")).join(nxt, same("next_id", "next_hash", "x"))
    o, e, x = (tuple(f"{p}_{c}" for c in ("level", "low", "high")) for p in "oex")
    out = out.withColumn("copy", F.explode(F.expr("sequence(1L, times)")))
    return out.select("doc_id", F.col("n").alias("n_chars"), F.col("e_sha").alias("edited_sha256"), as_text(*o).alias("fingerprint"), as_text(*e).alias("edited_fingerprint"), likeness(o, e).alias("near_edited"), likeness(o, x).alias("near_next"))
