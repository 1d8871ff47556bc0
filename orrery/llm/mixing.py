"""Mixing sources to target weights with a low-discrepancy schedule.

Every source gets a quota of equal-token blocks. The van der Corput points
of the slots 0, 1, 2, ... are mapped through the cumulative quotas to sources;
the slots of a source are ranked, and slot rank r takes block r of the
source's shuffled stream of documents. The stream is repeated up to
``most_epochs`` times.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD_PATTERN, written

_CHUNK_BITS = 16  # slots numbered by one window task at most: 2 ** 16 a source


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = (5.0, 2.0, 1.0), most_epochs: int = 3) -> DataFrame:
    """(source, size) rows -> one row per source: source_no, weight,
    source_size, target.

    Sources in code-point order, null last, weigh ``weights`` in turn and
    share the total size; a target stops at ``most_epochs`` times its
    source's size and the excess is shared again by weight. That is water
    filling: with sources by rising size / weight, the first ones stop at
    their limit and the rest get weight times one level. The windows run over
    one row per source.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").cast("binary").asc_nulls_last())
    per = per.withColumn("source_no", (F.row_number().over(order) - 1).cast("long"))
    per = per.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                                                (F.col("source_no") % len(weights) + 1).cast("int")))
    per = per.withColumn("limit", (F.col("source_size") * most_epochs).cast("double"))
    rising = Window.orderBy(F.col("limit") / F.col("weight"), "source_no")
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    after = rising.rowsBetween(0, Window.unboundedFollowing)
    total = F.sum(F.col("source_size").cast("double")).over(rising.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    level = (total - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    # The level that holds from each source on if all before it stop at their
    # limits rises while sources stop and falls after: the highest is right.
    everything = rising.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    per = per.withColumn("level", level)
    return per.withColumn("target", F.least(F.col("limit"), F.max("level").over(everything) * F.col("weight"))).select(
        "source", "source_no", "weight", "source_size", "target")


def schedule(sources: DataFrame, block_words: int, bits: int, total_blocks: int) -> DataFrame:
    """The ranked slots: (source_no, block, slot), one row per block of quota.

    ``2 ** bits`` van der Corput points, at least twice the blocks, so every
    source gets its whole quota: among 2 ** bits points an interval holds its
    share of them to within one.
    """
    n = 1 << bits
    quota = F.ceil(F.round("target") / block_words).cast("long")
    low = F.coalesce(F.sum("q").over(Window.orderBy("source_no").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    q = sources.select("source_no", quota.alias("q")).filter("q > 0").withColumn("low", low)
    step = 1 << _CHUNK_BITS
    part = q.select("source_no", "q", "low", F.explode(F.sequence(F.lit(0), F.expr(f"(q - 1) div {step}"))).alias("part"))
    part = part.repartition(F.col("source_no"), F.col("part"))
    # The points of the cumulative interval [p, p + 1) of total_blocks, as bit-reversed slot numbers.
    cell = part.select("source_no", "q", F.explode(F.expr(
        f"sequence(low + part * {step}L, low + least(q, (part + 1) * {step}L) - 1)")).alias("p"))
    edge = lambda p: F.ceil((p).cast("decimal(20,0)") * F.lit(n).cast("decimal(20,0)") / F.lit(total_blocks).cast("decimal(20,0)")).cast("long")
    point = cell.select("source_no", "q", F.explode(F.sequence(edge(F.col("p")), edge(F.col("p") + 1) - 1)).alias("v"))
    slot = F.conv(F.reverse(F.lpad(F.conv(F.col("v").cast("string"), 10, 2), bits, "0")), 2, 10).cast("long") if bits else F.lit(0).cast("long")
    slots = point.select("source_no", "q", slot.alias("slot")).withColumn("chunk", F.shiftright("slot", _CHUNK_BITS))
    counts = slots.groupBy("source_no", "chunk").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("source_no").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.withColumn("first", before).drop("n")
    inside = F.row_number().over(Window.partitionBy("source_no", "chunk").orderBy("slot")) - 1
    ranked = slots.withColumn("i", inside).join(starts, ["source_no", "chunk"])
    return ranked.withColumn("block", F.col("first") + F.col("i")).filter("block < q").select("source_no", "block", "slot")


def mix(docs: DataFrame, weights: tuple[float, ...] = (5.0, 2.0, 1.0), most_epochs: int = 3, block_words: int = 8192,
        seed: int = 17, hash_buckets: int = 4096) -> tuple[DataFrame, DataFrame]:
    """(doc_id, source, text, ...) -> (documents, pieces).

    documents: doc_id, source, size, source_size, target, source_no and
    ``start``, the place of the document in its source's shuffled stream.
    pieces: source_no, start, slot, block, epoch, from_word, n_words: what each
    slot takes; the mix is the pieces by slot.

    A source's pieces sum to its target rounded to a whole word, and no
    document is taken more than ``most_epochs`` times. Null texts and texts
    without words have size 0 and are never taken; a null source is a source
    of its own; repeated rows are separate documents; an empty table gives
    empty results. Reruns give the same rows. The shuffled order of a source
    is by hash; its running sums go by hash bucket first, so a hot source is
    spread over ``hash_buckets`` window groups.
    """
    sizes = written(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), "mix-sizes")
    sources = written(source_targets(sizes, weights, most_epochs), "mix-sources")
    blocks = sources.agg(F.sum(F.ceil(F.round("target") / block_words))).first()[0] or 0
    bits = max(0, (2 * int(blocks) - 1).bit_length())
    h = F.xxhash64(F.coalesce(F.col("doc_id"), F.lit(-1).cast("long")), F.col("size"), F.lit(seed))
    keyed = sizes.withColumn("h", h).withColumn("bucket", F.pmod("h", F.lit(hash_buckets)))
    per_bucket = keyed.groupBy("source", "bucket").agg(F.sum("size").alias("n"))
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = per_bucket.select("source", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("source", "bucket").orderBy("h", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = keyed.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    base = base.alias("b").join(sources.alias("s"), F.col("b.source").eqNullSafe(F.col("s.source"))).select(
        "b.source", "b.bucket", "b.base", "s.source_size", "s.target", "s.source_no")
    placed = (placed.alias("k").join(base.alias("b"), F.col("k.source").eqNullSafe(F.col("b.source")) & (F.col("k.bucket") == F.col("b.bucket")))
              .select("k.doc_id", "k.source", "k.size", "b.source_size", "b.target", "b.source_no",
                      (F.col("b.base") + F.col("k.inside")).alias("start")))
    documents = written(placed, "mix-documents", gathered=True)
    limit = F.round("target").cast("long")
    epochs = documents.filter("size > 0").select(
        "source_no", "start", "size", "source_size", limit.alias("limit"),
        F.explode(F.sequence(F.lit(0), F.lit(most_epochs - 1))).alias("epoch"))
    epochs = epochs.withColumn("a", F.col("epoch") * F.col("source_size") + F.col("start")).withColumn(
        "z", F.least(F.col("a") + F.col("size"), F.col("limit"))).filter("a < z")
    cut = epochs.select("source_no", "start", "epoch", "a", "z", F.explode(F.expr(
        f"sequence(a div {block_words}, (z - 1) div {block_words})")).alias("block"))
    first = F.greatest(F.col("a"), F.col("block") * block_words)
    cut = cut.select("source_no", "start", "epoch", "block", (first - F.col("a")).alias("from_word"),
                     (F.least(F.col("z"), (F.col("block") + 1) * block_words) - first).alias("n_words"))
    pieces = cut.join(schedule(sources, block_words, bits, int(blocks) or 1), ["source_no", "block"])
    return documents, pieces.select("source_no", "start", "slot", "block", "epoch", "from_word", "n_words")


def op1(spark, sf_dir) -> DataFrame:
    from ..tables import read_table
    documents, pieces = mix(read_table(spark, sf_dir, "documents"))
    taken = pieces.groupBy("source_no", "start").agg(F.sum("n_words").alias("taken"))
    # Documents without words match nothing; their keys are spread, not null.
    key = F.when(F.col("size") > 0, F.col("start")).otherwise(-1 - F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)))
    out = documents.withColumn("at", key).join(taken.withColumnRenamed("start", "at"), ["source_no", "at"], "left")
    return out.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))
