"""Mixing sources to target weights by weighted fair queueing.

Each source's documents are shuffled by a hash of their id. A copy of a document gets a virtual finish time: the tokens
of its source up to and with this copy, divided by the source's target. The copy that a source's target ends in is cut
there, and finishes at time 1; what follows it is never sent. All copies are sorted by that time over the whole cluster, and
the sequence is truncated at the total budget. A source that is given more than it has starts again from its first document,
at most `max_epochs` times.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewell.llm.common import col_or_null, prefix_sum, unused, word_count, written

#: Sources in code-point order weigh these, repeating.
WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3


def source_targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """One row per source: source, source_size, base (tokens of the sources before it), target.

    The sources share all tokens by weight; a target stops at max_epochs times its source's size, and the excess goes to
    the others by weight until none is above. The filling level is found by repeated sums over the table of sources.
    """
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = [F.col("source").asc_nulls_last()]
    ranked = prefix_sum(totals.withColumn("_one", F.lit(1)), order, "_one", "_rank", "mix-sources")
    ranked = prefix_sum(ranked.drop("_one"), order, "source_size", "base", "mix-bases")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_rank") % len(weights) + 1).cast("int"))
    ranked = written(ranked.select("source", "source_size", "base", weight.alias("weight"), (F.col("source_size") * float(max_epochs)).alias("most")), "mix-weights")
    total = float(ranked.agg(F.sum("source_size")).head()[0] or 0)
    level = 0.0
    while True:
        full = F.col("weight") * level >= F.col("most")
        capped, free = ranked.agg(F.sum(F.when(full, F.col("most")).otherwise(0.0)), F.sum(F.when(full, 0.0).otherwise(F.col("weight")))).head()
        if not free or (total - capped) / free <= level:
            break
        level = (total - capped) / free
    return ranked.select("source", "source_size", "base", F.least("most", F.col("weight") * level).alias("target"))


def _plan(docs: DataFrame, id_col: str, text_col: str, source_col: str, weights: tuple[int, ...], max_epochs: int, seed: int = 17) -> DataFrame:
    """mix(), with columns text_hash and cut: the words of the one copy that is taken in part, else null."""
    text = F.col(f"`{text_col}`")
    sized = docs.select(F.col(f"`{id_col}`").alias("doc_id"), col_or_null(docs, source_col).alias("source"), word_count(text).alias("size"), F.xxhash64(text).alias("text_hash"))
    sized = written(sized.withColumn("_h", F.xxhash64(F.col("doc_id").cast("string"), F.lit(seed))), "mix-sizes")
    targets = source_targets(sized, weights, max_epochs)
    budget = int(sized.agg(F.sum("size")).head()[0] or 0)

    order = [F.col("source").asc_nulls_last(), F.col("_h"), F.col("doc_id"), F.col("size"), F.col("text_hash")]
    queued = prefix_sum(sized, order, "size", "_before", "mix-queues")
    # A source's row is one of few; a salt spreads the rows of a large source over several tasks.
    salts = 16
    spread = targets.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    queued = queued.withColumn("_salt", F.pmod("_h", F.lit(salts)).cast("int")).withColumnRenamed("source", "_source")
    queued = queued.join(spread, F.col("_source").eqNullSafe(F.col("source")) & (queued["_salt"] == spread["_salt"])).drop("_salt", "_source")
    queued = queued.withColumn("_first", F.col("_before") - F.col("base"))
    queued = written(queued.withColumn("_uid", F.monotonically_increasing_id()), "mix-finish")

    copies = queued.filter("size > 0 and target > 0").withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(max_epochs - 1))))
    begin = F.col("copy") * F.col("source_size") + F.col("_first")
    copies = copies.withColumn("_words", F.least(F.col("size"), F.floor(F.col("target") - begin + 1e-6))).filter("_words > 0")
    copies = copies.select("_uid", "doc_id", "_h", "copy", "size", "_words", "source", ((begin + F.col("_words")) / F.col("target")).alias("finish"))
    place = [F.col("finish"), F.col("_h"), F.col("doc_id"), F.col("source").asc_nulls_last(), F.col("copy"), F.col("_uid")]
    taken = prefix_sum(copies, place, "_words", "_sent", "mix-sequence").withColumn("_words", F.least(F.col("_words"), F.lit(budget) - F.col("_sent"))).filter("_words > 0")
    cut = F.max(F.when(F.col("_words") < F.col("size"), F.col("_words")))
    taken = taken.groupBy("_uid").agg(F.count("*").alias("copies"), F.sum("_words").alias("taken"), cut.alias("cut"), F.min("finish").alias("first_finish"))
    out = queued.join(taken, "_uid", "left")
    return out.select("doc_id", "source", "size", "source_size", "target", F.coalesce("copies", F.lit(0)).alias("copies"), F.coalesce("taken", F.lit(0)).alias("taken"), "first_finish", "cut", "text_hash")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: int = 17) -> DataFrame:
    """doc_id, source, size, source_size, target, copies, taken, first_finish: a row for each row of docs.

    taken counts words, those of a cut copy in part: a source's taken words are its target, rounded down. Null text has no
    tokens; null source is one source, sorted last. Documents without tokens are never taken. Repeated rows and repeated
    ids are separate documents. An empty table gives an empty result. The same rows give the same result, whatever their
    order and partitioning.
    """
    return _plan(docs, id_col, text_col, source_col, weights, max_epochs, seed).drop("cut", "text_hash")


def first_words(text: Column, n: Column) -> Column:
    """The text up to its n-th word."""
    return F.array_join(F.slice(F.split(text, r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])"), F.lit(1), n.cast("int")), "")


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """The rows of docs that the mix takes, each as often as it is taken, with the columns of docs, which may have any names.

    A copy that is cut has the text up to its last word that is taken; that is one copy a source at most. Rows with equal
    ids, sources and texts are interchangeable: the copies due to them are dealt out among them in turn. Null texts and
    texts without words are never taken; an empty table gives none.
    """
    names = unused(docs, "id", "source", "hash", "due", "rows", "cut", "copies", "copy")
    id_, source, hash_, due, rows, cut, copies, copy = names
    plan = _plan(docs, id_col, text_col, source_col, weights, max_epochs).select(F.col("doc_id").alias(id_), F.col("source").alias(source), F.col("text_hash").alias(hash_), "copies", "cut")
    sums = plan.groupBy(id_, source, hash_).agg(F.sum("copies").alias(due), F.count("*").alias(rows), F.max("cut").alias(cut))
    sums = written(sums.filter(F.col(due) > 0), "mix-due")
    text = F.col(f"`{text_col}`")
    met = [F.col(f"`{id_col}`").eqNullSafe(F.col(id_)), col_or_null(docs, source_col).eqNullSafe(F.col(source)), F.xxhash64(text) == F.col(hash_)]
    # One plan at every size: the sums grow with the documents, and are not to be broadcast because they happen to be small.
    dealt = docs.join(sums.filter(F.col(rows) == 1).hint("merge"), met).withColumn(copies, F.col(due)).withColumn(copy, F.lit(1))
    alike = sums.filter(F.col(rows) > 1)
    if not alike.isEmpty():
        rank = F.row_number().over(Window.partitionBy(id_, source, hash_).orderBy(F.lit(1)))
        shared = docs.join(alike, met).withColumn(copy, rank)
        dealt = dealt.unionByName(shared.withColumn(copies, F.floor((F.col(due) - F.col(copy)) / F.col(rows)) + 1))
    # Of the copies due, numbered from 1, a row has every rows-th from its own rank on; the last one may be cut.
    dealt = dealt.filter(F.col(copies) > 0).withColumn(copy, F.explode(F.sequence(F.col(copy).cast("long"), F.col(due).cast("long"), F.col(rows).cast("long"))))
    own = F.when((F.col(copy) == F.col(due)) & F.col(cut).isNotNull(), first_words(text, F.col(cut))).otherwise(text)
    return dealt.select(*[own.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns])
