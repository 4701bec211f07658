"""Mixing sources to target weights with a low-discrepancy schedule.

Sources in code-point order, null last, weigh 1, 2, 3, repeating. Together they are to
give as many words as the corpus has; a target stops at three times its source's size
and the excess is shared again by weight among the others.

The mix is a row of slots of ``BLOCK`` words. Slot ``i`` has the golden-ratio point
``i * phi mod 1``; the source whose stretch of the cumulative targets holds the point
gets the slot. Slots are ranked per source. The documents of a source stand in a
shuffled order by the MD5 of ``doc_id``, repeat when they end and are cut into blocks of
as many words; the slot of rank ``r`` is joined with block ``r``, and a document takes
the words that its blocks have in slots. ``first_slot`` is the earliest of those slots.

Everything is DataFrame work. Slots are ranked range by range and documents summed bucket
by bucket, so a source with a third of all words is spread over as many tasks as it has
thousands of slots and documents. One window row stands for each source, or for each
``WIDE`` ranges of it.

Defined results: a null or blank text has size 0 and is taken 0 times; documents whose
``doc_id`` and size agree are alike and share their place in any order; a null source
is a source of its own; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from faregrid.llm.words import computed_once, put_back, set_aside, word_count, words
from faregrid.session import staged

WEIGHTS = (1, 2, 3)
MOST_EPOCHS = 3
BLOCK = 16
BUCKET_ROWS = 2000
BITS = 31
GOLDEN = 1_327_217_885  # 2**31 divided by the golden ratio, made odd
CELLS = 4096
RANGE = 4096
WIDE = 4096

MODULUS = 1 << BITS


def source_targets(sizes: DataFrame) -> DataFrame:
    """Adds ``number``, ``weight``, ``target`` and the stretch ``low`` to ``high`` of all points.

    ``sizes`` has one row per source: ``source``, ``source_size``. With targets
    ``min(cap, level * weight)`` the caps bind in order of cap per weight, so running
    sums in that order give the level at which all shares add up.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    place = F.row_number().over(by_name) - 1
    weight = F.element_at(
        F.array(*[F.lit(w) for w in WEIGHTS]), (place % len(WEIGHTS) + 1).cast("int")
    )
    everything = Window.partitionBy()
    by_ratio = Window.orderBy("ratio", F.col("source").isNull(), "source")
    earlier = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    later = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    ranked = (
        sizes.withColumn("number", place)
        .withColumn("weight", weight)
        .withColumn("cap", F.col("source_size") * MOST_EPOCHS)
        .withColumn("ratio", F.col("cap") / F.col("weight"))
        .withColumn("total", F.sum("source_size").over(everything))
        .withColumn("capped", F.coalesce(F.sum("cap").over(earlier), F.lit(0)))
        .withColumn("open_weight", F.sum("weight").over(later))
        .withColumn("level", (F.col("total") - F.col("capped")) / F.col("open_weight"))
        .withColumn("rank", F.row_number().over(by_ratio))
    )
    # the first source that its level does not cap sets the level of all after it
    first_open = F.when(F.col("level") <= F.col("ratio"), F.struct("rank", "level"))
    stretch = F.floor(F.col("target") * MODULUS / F.greatest(F.col("total"), F.lit(1)))
    running = F.sum("stretch").over(by_name.rowsBetween(Window.unboundedPreceding, 0))
    return (
        ranked.withColumn("top", F.min(first_open).over(everything)["level"])
        .withColumn(
            "target", F.least(F.col("cap").cast("double"), F.col("top") * F.col("weight"))
        )
        .withColumn("stretch", stretch.cast("bigint"))
        .withColumn("high", running)
        .withColumn("low", F.col("high") - F.col("stretch"))
        .select("source", "number", "source_size", "weight", "target", "total", "low", "high")
    )


def slot_point(slot: Column) -> Column:
    return (slot % MODULUS * GOLDEN) % MODULUS


def schedule(spark: SparkSession, targets: DataFrame, block: int = BLOCK) -> DataFrame:
    """``slot``, its ``source`` and ``number``: as many slots as ``block`` goes into all words.

    Points find their source by an equality on a grid cell and a comparison within it,
    so the work per slot does not grow with the number of sources.
    """
    total = targets.agg(F.coalesce(F.max("total"), F.lit(0))).first()[0]
    width = MODULUS // CELLS
    cells = targets.filter("high > low").select(
        "source",
        "number",
        "low",
        "high",
        F.explode(F.sequence(F.floor(F.col("low") / width), F.floor((F.col("high") - 1) / width)))
        .alias("cell"),
    )
    slots = spark.range(-(-total // block)).select(
        F.col("id").alias("slot"), slot_point(F.col("id")).alias("point")
    )
    inside = (
        (F.floor(F.col("point") / width) == F.col("cell"))
        & (F.col("point") >= F.col("low"))
        & (F.col("point") < F.col("high"))
    )
    return slots.join(cells, inside).select("slot", "source", "number")


def range_counts(slots: DataFrame) -> DataFrame:
    """``number``, ``range``, its slots ``n`` and ``before``, the slots of the ranges in front."""
    counts = slots.groupBy("number", F.floor(F.col("slot") / RANGE).alias("range")).agg(
        F.count("*").alias("n")
    )
    counts = counts.withColumn("wide", F.floor(F.col("range") / WIDE))
    up_to = (Window.unboundedPreceding, -1)
    wide = (
        counts.groupBy("number", "wide")
        .agg(F.sum("n").alias("all"))
        .withColumn(
            "front",
            F.sum("all").over(Window.partitionBy("number").orderBy("wide").rowsBetween(*up_to)),
        )
        .select("number", "wide", F.coalesce("front", F.lit(0)).alias("front"))
    )
    inside = Window.partitionBy("number", "wide").orderBy("range").rowsBetween(*up_to)
    return (
        counts.withColumn("inside", F.coalesce(F.sum("n").over(inside), F.lit(0)))
        .join(wide, ["number", "wide"])
        .select("number", "range", "n", (F.col("front") + F.col("inside")).alias("before"))
    )


def ranked_slots(slots: DataFrame, counts: DataFrame) -> DataFrame:
    """``number``, ``block`` (the rank of the slot in its source, from 0) and ``slot``."""
    inside = Window.partitionBy("number", "range").orderBy("slot")
    return (
        slots.withColumn("range", F.floor(F.col("slot") / RANGE))
        .withColumn("place", F.row_number().over(inside) - 1)
        .join(counts.select("number", "range", "before"), ["number", "range"])
        .select("number", (F.col("before") + F.col("place")).alias("block"), "slot")
    )


def _sized(docs: DataFrame, *carry: str) -> DataFrame:
    digest = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    return computed_once(
        docs,
        *carry,
        size=word_count(F.col("text")),
        _order=digest,
        _unit=F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint"),
    )


def _plan(sized: DataFrame, block: int) -> tuple[DataFrame, DataFrame]:
    """Per source: its figures, row count and slots; and all slots by rank."""
    spark = sized.sparkSession
    per_source = staged(
        sized.groupBy("source").agg(
            F.sum("size").alias("source_size"), F.count("*").alias("_rows")
        ),
        "source-sizes",
    )
    targets = staged(source_targets(per_source.select("source", "source_size")), "targets")
    slots = schedule(spark, targets, block).select("number", "slot")
    counts = staged(range_counts(slots), "slot-counts")
    own_rows = per_source.select(F.col("source").alias("_a"), "_rows")
    plan = (
        targets.join(own_rows, F.col("source").eqNullSafe(F.col("_a")))
        .join(counts.groupBy("number").agg(F.sum("n").alias("_slots")), "number", "left")
        .select(
            F.col("source").alias("_source"),
            "number",
            "source_size",
            "target",
            "_rows",
            F.coalesce("_slots", F.lit(0)).alias("_slots"),
        )
    )
    return staged(plan, "mix-plan"), ranked_slots(slots, counts)


def _bucketed(rows: DataFrame, plan: DataFrame) -> DataFrame:
    # the plan has one row per source and lies in files, so the planner knows its size
    buckets = F.ceil(F.col("_rows") / BUCKET_ROWS)
    return rows.join(plan, F.col("source").eqNullSafe(F.col("_source"))).withColumn(
        "_bucket", F.shiftright(F.col("_unit") * buckets, 32)
    )


def _placed(rows: DataFrame, sized: DataFrame, plan: DataFrame) -> DataFrame:
    """``rows`` with the plan of their source and ``place``, the words in front of them in it.

    ``place`` adds the sums of the buckets before and, within the bucket, of the documents
    before. Of documents with words it names one of its source.
    """
    sums = _bucketed(sized, plan).groupBy("number", "_bucket").agg(F.sum("size").alias("_sum"))
    before = (
        Window.partitionBy("number")
        .orderBy("_bucket")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = sums.select(
        "number",
        "_bucket",
        F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset"),
    )
    inside = (
        Window.partitionBy("number", "_bucket")
        .orderBy("_order", "doc_id", "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        _bucketed(rows, plan)
        .withColumn("_inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .join(offsets, ["number", "_bucket"])
        .withColumn("place", F.col("_offset") + F.col("_inside"))
    )


def block_rows(placed: DataFrame, block: int = BLOCK) -> DataFrame:
    """``number``, ``block``, ``place`` and ``words``: what each block holds of each document.

    Only blocks that have a slot are made, and no round beyond the last allowed one.
    """
    last_round = F.least(
        F.lit(MOST_EPOCHS - 1),
        F.floor((F.col("_slots") * block - 1) / F.greatest(F.col("source_size"), F.lit(1))),
    )
    rounds = (
        placed.filter("size > 0 and _slots > 0")
        .select(
            "number",
            "place",
            "size",
            "source_size",
            "_slots",
            F.explode(F.sequence(F.lit(0).cast("bigint"), last_round.cast("bigint"))).alias("_k"),
        )
        .withColumn("_from", F.col("_k") * F.col("source_size") + F.col("place"))
        .withColumn("_to", F.col("_from") + F.col("size"))
        .filter(F.col("_from") < F.col("_slots") * block)
    )
    first = F.floor(F.col("_from") / block)
    last = F.least(F.floor((F.col("_to") - 1) / block), F.col("_slots") - 1)
    words_in = F.least((F.col("block") + 1) * block, F.col("_to")) - F.greatest(
        F.col("block") * block, F.col("_from")
    )
    return rounds.select(
        "number", "place", "_from", "_to", F.explode(F.sequence(first, last)).alias("block")
    ).select("number", "block", "place", words_in.alias("words"))


def _given(placed: DataFrame, slots: DataFrame, block: int) -> DataFrame:
    """``number``, ``place``, ``taken`` and ``first_slot`` of the documents that have slots."""
    return (
        block_rows(placed, block)
        .join(slots, ["number", "block"])
        .groupBy("number", "place")
        .agg(F.sum("words").alias("taken"), F.min("slot").alias("first_slot"))
    )


def taken(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """What the mix takes of every document, with the figures of its source.

    Returns ``doc_id``, ``size``, ``source``, ``source_size``, ``target``, ``taken``,
    ``first_slot`` (null where nothing is taken) and ``place``, the words in front of the
    document in the shuffled order of its source.
    """
    sized = staged(_sized(docs, "doc_id", "source"), "sizes")
    plan, slots = _plan(sized, block)
    placed = staged(_placed(sized, sized, plan).drop("_order", "_unit"), "places")
    given = _given(placed, slots, block).select(
        F.col("number").alias("_n"), F.col("place").alias("_p"), "taken", "first_slot"
    )
    same = (
        (F.col("number") == F.col("_n")) & (F.col("place") == F.col("_p")) & (F.col("size") > 0)
    )
    return placed.join(given, same, "left").select(
        "doc_id",
        "size",
        "source",
        "source_size",
        "target",
        F.coalesce("taken", F.lit(0)).alias("taken"),
        "first_slot",
        "place",
    )


def mixed(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """The rows of ``docs`` as the mix takes them: repeated, cut or left out.

    A document stands once for every round that takes words of it. At most one document
    of a source is cut: its last copy holds the words taken, joined by single blanks,
    and its ``n_chars`` follows. The columns are those of ``docs``.
    """
    whole, names = set_aside(docs, "doc_id", "source", "text")
    sized = staged(_sized(docs, "doc_id", "source"), "sizes")
    plan, slots = _plan(sized, block)
    given = _given(_placed(sized, sized, plan), slots, block).withColumnRenamed("taken", "_taken")
    rows = _sized(whole, "doc_id", "source", *names.values())
    placed = _placed(rows, sized, plan).filter("size > 0").select(
        "number", "place", "size", *names.values()
    )
    copies = F.ceil(F.col("_taken") / F.col("size"))
    copied = placed.join(given, ["number", "place"]).select(
        *names.values(),
        "_taken",
        "size",
        F.explode(F.sequence(F.lit(1).cast("bigint"), copies)).alias("_copy"),
    )
    cut = F.col("_copy") * F.col("size") > F.col("_taken")
    left = F.col("_taken") - (F.col("_copy") - 1) * F.col("size")
    text = F.col(names["text"])
    head = F.array_join(F.slice(words(text), F.lit(1), left.cast("int")), " ")
    new = {"text": F.when(cut, head).otherwise(text)}
    if "n_chars" in names:
        kind = docs.schema["n_chars"].dataType
        counted = F.when(cut, F.length(head)).otherwise(F.col(names["n_chars"]))
        new["n_chars"] = counted.cast(kind)
    return put_back(copied, names, **new)
