"""Mixing sources to target weights by a low-discrepancy schedule (operator 3).

Native: DataFrame functions only.

* Sizes are word counts.  Targets share the total by weight; what a source
  cannot give (more than ``max_repeats`` times its size) is reshared by weight.
* The documents of a source are shuffled (by a seeded hash) and laid end to end;
  that line of words is cut into blocks of equal size.
* Slot i of the schedule has the golden-ratio point frac(i * phi).  The point,
  mapped through the sources' cumulative shares of the slots, names the slot's
  source; its rank among that source's slots names pass and block.  Each source
  uses as many slots as its target needs, the last one partly; a source that the
  points leave short by one or two slots gets them at the end.
* Blocks join the documents that lie in them by (source, block).

A hot source is spread over hash buckets of its shuffle key, over segments of
the schedule and over its blocks, so no task sees a whole source.

Defined results: null text has size 0; a null source is a source of its own
(last); documents of size 0 take no part (taken 0) but are returned; repeated
rows are documents of their own; no words at all: targets and taken are 0.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablepipe.llm.common import ascii_words, with_global_rank, written

WEIGHTS = (1, 2, 3)
MAX_REPEATS = 3
BLOCK = 1024
SEED = 17
# Hash buckets of a source's shuffle order: 16 ** 3.
KEY_DIGITS = 3
SEGMENT = 65_536
_GOLDEN = (math.sqrt(5) - 1) / 2
_LOW = 1 << 20


def golden_point(i: Column) -> Column:
    """frac(i * golden ratio) for i up to 2 ** 40, split so that doubles stay exact enough."""
    high, low = F.floor(i / _LOW), i % _LOW
    x = high * F.lit((_LOW * _GOLDEN) % 1.0) + low * F.lit(_GOLDEN)
    return x - F.floor(x)


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """source, source_size, weight, target from (source, size) rows."""
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = sources.withColumn("no_name", F.col("source").isNull())
    ranked = with_global_rank(sources, ["no_name", "source"], name="sources")
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    ranked = written(ranked.select("source", "source_size", F.element_at(cycle, (F.col("rank") % len(weights) + 1).cast("int")).alias("weight")), "weights")
    cap = max_repeats * F.col("source_size")
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    level, held = 0.0, -1
    while total:  # reshare until no further source is above its cap; one aggregate row a round
        over = cap <= F.lit(level) * F.col("weight")
        given, rest, count = ranked.agg(F.sum(F.when(over, cap).otherwise(0)), F.sum(F.when(over, 0.0).otherwise(F.col("weight"))), F.sum(over.cast("int"))).first()
        if count == held or not rest:
            break
        level, held = (total - given) / rest, count
    return ranked.withColumn("target", F.least(cap.cast("double"), F.lit(float(level)) * F.col("weight")))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple = WEIGHTS, max_repeats: int = MAX_REPEATS, block: int = BLOCK, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """(documents, schedule).

    documents: doc_id, source, size, source_size, target, taken (every row of
    ``docs``; what is taken of a document in its last pass is its beginning).
    schedule: slot, source, pass, block, take (words from the block's start)."""
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col(id_col).cast("string"), F.lit("null"))))
    size = F.coalesce(F.size(ascii_words(F.col(text_col))), F.lit(0)).cast("long")
    size = F.when(F.col(text_col).isNull(), F.lit(0).cast("long")).otherwise(size)
    sized = written(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), size.alias("size"), key.alias("key")), "sizes")
    targets = source_targets(sized, weights, max_repeats)

    blocks = F.ceil(F.col("source_size") / block)
    want = F.least(F.round("target"), max_repeats * F.col("source_size").cast("double")).cast("long")
    plan = targets.where("source_size > 0").withColumn("want", want).withColumn("width", F.ceil(F.col("source_size") / blocks).cast("long"))
    plan = plan.withColumn("blocks", F.expr("(source_size + width - 1) div width"))
    plan = plan.withColumn("passes", F.expr("want div source_size")).withColumn("rest", F.expr("want % source_size"))
    plan = plan.withColumn("slots", F.expr("passes * blocks + (rest + width - 1) div width"))
    plan = plan.withColumn("no_name", F.col("source").isNull())
    plan = written(with_global_rank(plan, ["no_name", "source"], value="slots", before="cum", name="plan"), "shares")
    schedule = written(_schedule(plan, plan.agg(F.sum("slots")).first()[0] or 0), "schedule")

    # Where each document begins on its source's line of words.
    live = sized.where("size > 0").withColumn("bucket", F.substring("key", 1, KEY_DIGITS))
    totals = live.groupBy("source", "bucket").agg(F.sum("size").alias("in_bucket"))
    ahead = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select(F.col("source").alias("b_source"), F.col("bucket").alias("b_bucket"), F.coalesce(F.sum("in_bucket").over(ahead), F.lit(0)).alias("base"))
    live = live.join(bases, F.col("source").eqNullSafe(F.col("b_source")) & (F.col("bucket") == F.col("b_bucket")))
    inside = Window.partitionBy("source", "bucket").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    live = live.select("doc_id", "source", "size", (F.col("base") + F.coalesce(F.sum("size").over(inside), F.lit(0))).alias("start"))

    width = plan.select(F.col("source").alias("p_source"), "width")
    pieces = live.join(width, F.col("source").eqNullSafe(F.col("p_source"))).drop("p_source")
    pieces = pieces.withColumn("block", F.explode(F.expr("sequence(start div width, (start + size - 1) div width)")))
    low, high = F.greatest(F.col("start") - F.col("block") * F.col("width"), F.lit(0)), F.least(F.col("start") + F.col("size") - F.col("block") * F.col("width"), F.col("width"))
    pieces = pieces.withColumn("low", low).withColumn("high", high)
    uses = schedule.groupBy(F.col("source").alias("s_source"), F.col("block").alias("s_block")).agg(F.sum(F.col("whole").cast("long")).alias("whole"), F.max(F.when(~F.col("whole"), F.col("take"))).alias("part"))
    got = F.coalesce(F.col("whole"), F.lit(0)) * (F.col("high") - F.col("low")) + F.greatest(F.least(F.col("high"), F.coalesce(F.col("part"), F.lit(0))) - F.col("low"), F.lit(0))
    used = pieces.join(uses, F.col("source").eqNullSafe(F.col("s_source")) & (F.col("block") == F.col("s_block")), "left")
    taken = used.groupBy("source", "start", "doc_id", "size").agg(F.sum(got).cast("long").alias("taken")).drop("start")
    empty = sized.where("size = 0").select("source", "doc_id", "size", F.lit(0).cast("long").alias("taken"))
    shares = targets.select(F.col("source").alias("t_source"), "source_size", "target")
    out = taken.unionByName(empty).join(shares, F.col("source").eqNullSafe(F.col("t_source")))
    return out.select("doc_id", "source", "size", "source_size", "target", "taken"), schedule.drop("whole")


def _schedule(plan: DataFrame, n: int) -> DataFrame:
    """slot, source, pass, block, take, whole (takes the entire block) for ``n`` slots."""
    spark = plan.sparkSession
    cells = max(1, n // 64)  # a source has a slot at least, so few sources meet in a cell
    at = spark.range(n).select(F.col("id").alias("slot"), (golden_point(F.col("id")) * n).alias("point")).withColumn("cell", F.floor(F.col("point") * cells / max(n, 1)))
    first, last = F.floor(F.col("cum") * cells / max(n, 1)), F.floor((F.col("cum") + F.col("slots")) * cells / max(n, 1))
    share = plan.where("slots > 0").select("source", "cum", "slots", F.explode(F.sequence(first, last)).alias("cell"))
    hit = at.join(share, "cell").where("point >= cum and point < cum + slots").select("slot", "source")
    hit = hit.withColumn("segment", F.expr(f"slot div {SEGMENT}"))
    counts = hit.groupBy("source", "segment").agg(F.count(F.lit(1)).alias("hits"))
    ahead = Window.partitionBy("source").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select(F.col("source").alias("c_source"), F.col("segment").alias("c_segment"), F.coalesce(F.sum("hits").over(ahead), F.lit(0)).alias("base"))
    ranked = hit.join(bases, F.col("source").eqNullSafe(F.col("c_source")) & (F.col("segment") == F.col("c_segment")))
    inside = Window.partitionBy("source", "segment").orderBy("slot")
    ranked = ranked.select("slot", "source", (F.col("base") + F.row_number().over(inside) - 1).alias("rank"))
    found = counts.groupBy(F.col("source").alias("f_source")).agg(F.sum("hits").alias("hits"))
    more = plan.join(found, F.col("source").eqNullSafe(F.col("f_source")), "left").withColumn("hits", F.coalesce("hits", F.lit(0))).where("hits < slots")
    more = more.select("source", F.explode(F.expr("sequence(hits, slots - 1)")).alias("rank")).select((F.lit(n) + F.col("rank")).alias("slot"), "source", "rank")
    facts = plan.select(F.col("source").alias("p_source"), "slots", "blocks", "passes", "rest", "width", "source_size")
    out = ranked.unionByName(more).join(facts, F.col("source").eqNullSafe(F.col("p_source"))).where("rank < slots")
    out = out.withColumn("pass", F.expr("rank div blocks")).withColumn("block", F.expr("rank % blocks"))
    limit = F.least(F.col("width"), F.col("source_size") - F.col("block") * F.col("width"))
    out = out.withColumn("take", F.when(F.col("pass") < F.col("passes"), limit).otherwise(F.least(limit, F.col("rest") - F.col("block") * F.col("width"))))
    return out.select("slot", "source", "pass", "block", "take", (F.col("pass") < F.col("passes")).alias("whole"))


def mixed_documents(docs: DataFrame, taken: DataFrame, id_col: str = "doc_id", text_col: str = "text", count_col: str | None = "n_chars") -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them whole, then the
    beginning (by words) of what it takes in part.  ``taken``: doc_id, size,
    taken; rows that share an id are taken alike in the order of the table."""
    rows = taken.where("taken > 0").select(F.col("doc_id").alias("_id"), F.col("size").alias("_size"), F.col("taken").alias("_taken"))
    rows = rows.groupBy("_id", "_size").agg(F.sum("_taken").alias("_taken"), F.count(F.lit(1)).alias("_same"))
    size = F.size(ascii_words(F.coalesce(F.col(text_col), F.lit("")))).cast("long")
    joined = docs.withColumn("_words", size).join(rows, F.col(id_col).eqNullSafe(F.col("_id")) & (F.col("_words") == F.col("_size")))
    joined = joined.withColumn("_each", F.expr("_taken div _same"))
    copies = F.expr("_each div _size + if(_each % _size > 0, 1, 0)")
    joined = joined.where("_each > 0").withColumn("_pass", F.explode(F.sequence(F.lit(1).cast("long"), copies)))
    part = F.array_join(F.slice(ascii_words(F.col(text_col)), F.lit(1), F.expr("cast(_each % _size as int)")), " ")
    text = F.when(F.col("_pass") * F.col("_size") <= F.col("_each"), F.col(text_col)).otherwise(part)
    out = joined.withColumn(text_col, text)
    if count_col and count_col in docs.columns:
        out = out.withColumn(count_col, F.length(text_col).cast(docs.schema[count_col].dataType))
    return out.select(*docs.columns)
