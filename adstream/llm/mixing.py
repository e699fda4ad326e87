"""Mixing sources to target weights: documents in random order, cut at each source's budget.

Every document has a hash-random key. Within its source it lies at the sum of the sizes of the
documents with smaller keys. A source is taken whole as often as its budget allows and then up
to the place where the budget ends, inside a document where need be. The sums are distributed:
ranges of keys are added up, the sums of ranges placed by the same step, and only the documents
of one range are ordered in one task.

Documents that agree in source, id and size (repeated rows, or a hot NULL id) are one row with a
number of copies until the end. Everything is DataFrame functions; nothing but a few sums over
all sources comes to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adstream.llm.common import saved, scratch

# Fixed values of the contract.
WEIGHTS = (5, 2, 1)
MOST_EPOCHS = 3
SPACES = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
# Documents of a range of keys, ranges of a range of ranges, and copies written by one task.
RANGE = 1 << 14
FAN = 1 << 10
COPIES = 1 << 14


def word_count(text: Column) -> Column:
    """Words of a text; NULL has none. No array of words is built, however long the text."""
    # Every word becomes one letter; then spaces go.
    marked = F.regexp_replace(F.coalesce(text, F.lit("")), WORD, "x")
    return F.length(F.regexp_replace(marked, SPACES, "")).cast("long")


def _total(rows: DataFrame, group: Sequence[str], at: str, size: str) -> DataFrame:
    """``rows`` of one row for each group and ``at`` (from 0), with ``before``: the sum of ``size``
    over smaller ``at`` of the group. No window holds more than ``FAN`` rows."""
    inside = Window.partitionBy(*group, "above").orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("above", F.shiftright(at, FAN.bit_length() - 1))
    rows = saved(
        rows.withColumn("before", F.coalesce(F.sum(size).over(inside), F.lit(0).cast("long"))),
        scratch(rows.sparkSession, "sums"),
    )
    if rows.where("above > 0").isEmpty():
        return rows.drop("above")
    upper = rows.groupBy(*group, "above").agg(F.sum(size).alias("sum_above"))
    upper = _total(upper.withColumnRenamed("above", "at_above"), group, "at_above", "sum_above")
    upper = upper.select(*group, F.col("at_above").alias("above"), F.col("before").alias("before_above"))
    placed = rows.join(upper, [*group, "above"])
    return placed.withColumn("before", F.col("before") + F.col("before_above")).drop("above", "before_above")


def targets(sources: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_EPOCHS) -> DataFrame:
    """``sources`` (``source``, ``source_size``) with ``rank``, ``target`` and ``budget``, its whole words.

    Weights go round the sources in code-point order, NULL last, and share the sum of all sizes. A
    target above ``most`` times its source's size stops there and the rest is shared again among
    the others, until none is above.
    """
    spark = sources.sparkSession
    ranked = _ranks(sources)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights)).cast("int") + 1)
    wide = lambda c: F.col(c).cast("decimal(38,0)")
    rows = saved(
        ranked.select("source", "rank", "source_size", weight.cast("long").alias("weight")), scratch(spark, "sources")
    )
    total, share = rows.agg(F.sum("source_size"), F.sum("weight")).first()
    if not total:
        nothing = (F.lit(0.0).alias("target"), F.lit(0).cast("long").alias("budget"))
        return rows.select("source", "rank", "source_size", *nothing)
    rest = total
    while True:
        # A source stops where most * size < weight * rest / share, compared in whole numbers.
        above = wide("source_size") * (most * share) < wide("weight") * rest
        stopped = rows.where(above).agg(F.sum("source_size")).first()[0] or 0
        left, others = total - most * stopped, rows.where(~above).agg(F.sum("weight")).first()[0]
        if (left, others) == (rest, share):
            break
        rest, share = left, others
    shared = wide("weight") * rest
    most_words = F.col("source_size") * most
    target = F.when(above, most_words.cast("double")).otherwise(shared.cast("double") / share)
    budget = F.when(above, most_words).otherwise(F.expr(f"cast(weight as decimal(38,0)) * {rest} div {share}"))
    aimed = rows.select("source", "rank", "source_size", target.alias("target"), budget.cast("long").alias("budget"))
    return saved(aimed, scratch(spark, "targets"))


def _ranks(sources: DataFrame) -> DataFrame:
    """``sources`` with ``rank``, from 0 in code-point order with NULL last.

    A range-partitioned sort, rows numbered within each partition, and the sizes of the partitions
    before added: no task holds all sources.
    """
    spark = sources.sparkSession
    sort = [F.col("source").isNull(), F.col("source")]
    rows = saved(
        sources.repartitionByRange(*sort)
        .sortWithinPartitions(*sort)
        .withColumn("row", F.monotonically_increasing_id()),
        scratch(spark, "ordered"),
    )
    rows = rows.withColumn("place", F.shiftright("row", 33))
    sizes = _total(rows.groupBy("place").agg(F.count("*").alias("n")), [], "place", "n")
    number = F.col("row").bitwiseAND(F.lit((1 << 33) - 1))
    return rows.join(sizes.select("place", "before"), "place").select(
        "source", "source_size", (F.col("before") + number).alias("rank")
    )


def mix(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    most: int = MOST_EPOCHS,
    range_rows: int = RANGE,
) -> DataFrame:
    """``doc_id``, ``size``, ``source_size``, ``target`` and ``taken`` of every row of ``docs``.

    ``taken`` counts the words that the mix takes of the document, with repeats: a multiple of its
    size, and for one document of a source a part of the next. They add up to the target of the
    source, rounded down. Which documents come first depends only on their ids and sizes, so
    reruns agree. A NULL or empty text has size 0 and is taken 0 times, a NULL source is a source
    of its own, NULL and repeated ids are ordinary documents. Other columns are not read; without
    rows the result is empty.
    """
    units = _taken(docs, weights, most, range_rows)
    # Copies of one unit are written by several tasks; all but one of them take the same.
    parts = F.expr(f"sequence(0L, (copies - 1) div {COPIES})")
    dealt = units.withColumn("part", F.explode(parts))
    many = dealt.where(f"copies > {COPIES}").repartition("source", "doc_id", "size", "part")
    dealt = dealt.where(f"copies <= {COPIES}").unionByName(many)
    copy = F.explode(F.expr(f"sequence(part * {COPIES}L, least(copies, (part + 1) * {COPIES}L) - 1)"))
    # Copy k of a unit lies k sizes further.
    rows = dealt.withColumn("copy", copy).withColumn("begins", F.expr("before + copy * size"))
    taken = F.expr("epochs * size + least(size, greatest(rest - begins, 0L))")
    return rows.select("doc_id", "size", "source_size", "target", taken.alias("taken"))


def _taken(docs: DataFrame, weights: Sequence[int], most: int, range_rows: int) -> DataFrame:
    """One row for each source, id and size: its copies and place, and the source's budget."""
    spark = docs.sparkSession
    rows = docs.select(
        F.col("source").cast("string").alias("source"),
        F.col("doc_id").cast("long").alias("doc_id"),
        word_count(F.col("text")).alias("size"),
    )
    units = rows.groupBy("source", "doc_id", "size").agg(F.count("*").alias("copies"))
    number = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    key = F.md5(F.concat_ws(":", number("doc_id"), number("size")))
    units = saved(
        units.withColumn("key", key).withColumn("words", F.expr("size * copies")), scratch(spark, "units")
    )
    sources = saved(
        units.groupBy("source").agg(F.sum("words").alias("source_size"), F.count("*").alias("n")),
        scratch(spark, "sizes"),
    )
    aimed = targets(sources.select("source", "source_size"), weights, most).withColumnRenamed("source", "of")
    ranges = F.greatest(F.lit(1), F.ceil(F.col("n") / range_rows)).cast("long").alias("ranges")
    aimed = aimed.join(sources.select(F.col("source").alias("named"), ranges), F.col("of").eqNullSafe(F.col("named")))
    joined = units.join(aimed.drop("named"), F.col("source").eqNullSafe(F.col("of"))).drop("of")
    # Keys are spread evenly, so equal ranges of them hold about equally many units.
    leading = F.conv(F.substring("key", 1, 8), 16, 10).cast("long")
    at = F.shiftright(leading * F.col("ranges"), 32).alias("range")
    placed = saved(joined.select("*", at).drop("ranges"), scratch(spark, "placed"))
    sums = _total(placed.groupBy("rank", "range").agg(F.sum("words").alias("words")), ["rank"], "range", "words")
    sums = sums.select("rank", "range", F.col("before").alias("before_range"))
    inside = Window.partitionBy("rank", "range").orderBy("key", F.col("doc_id").isNull(), "doc_id", "size")
    inside = inside.rowsBetween(Window.unboundedPreceding, -1)
    within = placed.withColumn("within", F.coalesce(F.sum("words").over(inside), F.lit(0).cast("long")))
    found = within.join(sums, ["rank", "range"]).withColumn("before", F.col("before_range") + F.col("within"))
    whole = F.expr("CASE WHEN source_size > 0 THEN budget div source_size ELSE 0L END")
    found = found.withColumn("epochs", whole).select(
        "source", "doc_id", "size", "copies", "before", "source_size", "target", "epochs",
        F.expr("budget - epochs * source_size").alias("rest"),
    )
    return saved(found, scratch(spark, "taken"))


def mixed_texts(
    docs: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_EPOCHS
) -> DataFrame:
    """The mix itself: ``doc_id``, ``source``, ``text`` and ``repeats``, how often the text is taken.

    The document that a budget cuts has a further row with its words before the cut, single spaces
    between them. Rows that are not taken are left out. Expects that ``doc_id`` tells documents
    apart: rows of one source, id and size are read as copies of one text.
    """
    units = _taken(docs, weights, most, RANGE).where("size > 0").select(
        F.col("source").alias("u_source"),
        F.col("doc_id").alias("u_doc"),
        F.col("size").alias("u_size"),
        F.expr("epochs * copies + least(copies, greatest(rest - before, 0L) div size)").alias("repeats"),
        F.expr("CASE WHEN rest - before < copies * size THEN greatest(rest - before, 0L) % size ELSE 0L END").alias("cut"),
    )
    same = (
        F.col("u_source").eqNullSafe(F.col("source"))
        & F.col("u_doc").eqNullSafe(F.col("doc_id"))
        & (F.col("u_size") == F.col("size"))
    )
    texts = docs.select("doc_id", F.col("source").cast("string").alias("source"), "text")
    texts = texts.withColumn("size", word_count(F.col("text"))).where("size > 0")
    texts = texts.groupBy("source", "doc_id", "size").agg(F.min("text").alias("text"))
    found = texts.join(units, same)
    several = found.where("repeats > 0").select("doc_id", "source", "text", "repeats")
    words = F.filter(F.split("text", f"{SPACES}+"), lambda w: w != "")
    first = F.array_join(F.slice(words, 1, F.col("cut").cast("int")), " ").alias("text")
    cut = found.where("cut > 0").select("doc_id", "source", first, F.lit(1).cast("long").alias("repeats"))
    return several.unionByName(cut)
