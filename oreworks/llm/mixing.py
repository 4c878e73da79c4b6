"""Mixing sources to target weights by pivotal dependent rounding, in DataFrame operations only.

Sources in code-point order, null last, weigh 5, 2, 1, repeating. Together they get
``TOTAL`` (150 %) of all words by weight; a target stops at ``MOST`` (2) times its source's
words and the excess is shared again by weight, until none is above.

Within a source every document would be taken ``target / words of the source`` times. The
integral part of that is taken; of the rest every document holds as many words as its
fraction asks for (its mass). Pairs of documents then play for their masses: words move from one to the
other until one of the two is taken whole or not at all, and which way is drawn
so that the expected mass of each stays what it was. The words of the pair never change, so those of
the source don't either. Documents play in rows of about ``ROW`` chosen by a hash of the id, in the
order of that hash; the one still undecided at the end of a row plays in the
next round, so rounds form a tree that is as deep as the logarithm of the largest source.
No task or row holds a source, and rounds are written to the shared folder.

The last undecided document of a source is the only one taken in part: it gives the words that are missing to the
target. Draws come from hashes of the ids, so reruns agree.

Null and empty texts have size 0 and are taken 0 times. A null source is a source. Rows that share an id, null or not,
are documents of their own: those equal in id, source and size are counted and dealt out again under numbers, so
that they play in different rows, the draws do not depend on where a row was written, and no task holds an id.
Where no words exist, targets are 0. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from oreworks import scratch

WEIGHTS = (5, 2, 1)
TOTAL, MOST, ROW = 1.5, 2.0, 64
RUN = 4096  # equal rows that are dealt out together
WORD = r"[^\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame) -> DataFrame:
    """source, source_size, documents, target for each source; ``sizes`` has source and size.

    The targets are those of filling all sources at speeds equal to their weights until each is
    at its cap or the total is out. Sources ordered by the time at which they are full, the level follows from
    running sums. One row per source meets in one task.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("documents"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    rank = F.row_number().over(by_name) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]), (rank % len(WEIGHTS) + 1).cast("int"))
    sources = sources.withColumn("weight", weight).withColumn("cap", MOST * F.col("source_size"))
    everything = Window.partitionBy()
    by_time = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_time.rowsBetween(Window.unboundedPreceding, -1)
    sources = (
        sources.withColumn("whole", F.sum("source_size").over(everything) * TOTAL)
        .withColumn("full", F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        .withColumn("open", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        # Would this source and all that fill later be short of their caps at this level?
        .withColumn("level", (F.col("whole") - F.col("full")) / F.col("open"))
        .withColumn("short", F.col("level") * F.col("weight") < F.col("cap"))
        # The level is that of the first of them in the order of filling.
        .withColumn("time", F.col("cap") / F.col("weight"))
        .withColumn("first", F.min(F.when(F.col("short"), F.struct("time", F.col("source").isNull(), "source", "level"))).over(everything))
        .withColumn("final", F.col("first.level"))
    )
    target = F.least(F.col("cap"), F.coalesce(F.col("final") * F.col("weight"), F.col("cap")))
    return sources.select("source", "source_size", "documents", target.alias("target"))


def _played(row: Column) -> Column:
    """What becomes of a row: ``done`` with mass 0 or whole for all but the one that is left, ``rest``."""

    def step(state: Column, other: Column) -> Column:
        one, two = state["rest"], other
        a, b, wa, wb = one["mass"], two["mass"], one["size"].cast("double"), two["size"].cast("double")
        up, down = F.least(wa - a, b), F.least(a, wb - b)  # words to the first, words to the second
        draw = F.shiftrightunsigned(F.xxhash64(F.lit(17), one["key"], two["key"]), 11) / float(1 << 53)
        rises = draw * (up + down) < down
        # The one that is settled is set to exactly nothing or everything.
        new_a = F.when(rises, F.when(wa - a <= b, wa).otherwise(a + b)).otherwise(F.when(a <= wb - b, 0.0).otherwise(a - (wb - b)))
        new_b = F.when(rises, F.when(wa - a <= b, b - (wa - a)).otherwise(0.0)).otherwise(F.when(a <= wb - b, a + b).otherwise(wb))
        first_settled = (new_a == 0) | (new_a == wa)
        first, second = one.withField("mass", new_a), two.withField("mass", new_b)
        return F.struct(
            F.concat(state["done"], F.array(F.when(first_settled, first).otherwise(second))).alias("done"),
            F.when(first_settled, second).otherwise(first).alias("rest"),
        )

    start = F.struct(F.filter(row, lambda x: F.lit(False)).alias("done"), row[0].alias("rest"))
    return F.aggregate(F.slice(row, 2, F.greatest(F.size(row), F.lit(1))), start, step)


def _numbered(sized: DataFrame) -> DataFrame:
    """The rows of ``sized`` with ``number``, 0 and on among rows that are equal in all columns."""
    equal = sized.groupBy(*sized.columns).agg(F.count("*").alias("rows"))
    run = equal.withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("rows") - 1) / RUN))))
    first = F.col("run") * RUN
    numbers = F.sequence(first, F.least(first + RUN, F.col("rows")) - 1)
    # Runs of one group come from one task; dealt by their own number they don't stay there.
    several = run.where(F.col("rows") > RUN).repartition(F.xxhash64(*sized.columns, "run"))
    parts = [part.select(*sized.columns, F.explode(numbers).alias("number")) for part in (run.where(F.col("rows") <= RUN), several)]
    return parts[0].unionByName(parts[1])


def mix(documents: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row per document: ``key``, source, size, source_size, target, copies (whole ones) and part (words of
    one more copy, not 0 for at most one document of a source)."""
    spark = documents.sparkSession

    def stage(df: DataFrame, label: str) -> DataFrame:
        return scratch.stage(df, scratch.new_path(spark, f"mix-{label}"))

    sized = stage(documents.select(F.col(key).alias("id"), "source", words(F.col("text")).alias("size")), "sizes")
    aims = stage(targets(sized.select("source", "size")), "targets")
    aims_of = aims.withColumnRenamed("source", "s")
    asked = (
        _numbered(sized)
        .withColumn("key", F.xxhash64(F.lit(5), F.col("id").isNull(), "id", "source", "size", "number"))
        .drop("number")
        .join(aims_of, F.col("source").eqNullSafe(F.col("s")), "left")
        .drop("s")
        .withColumn("times", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
        .withColumn("copies", F.when(F.col("size") > 0, F.floor("times")).otherwise(0).cast("long"))
        .withColumn("mass", (F.col("times") - F.floor("times")) * F.col("size"))
    )
    fields = ("id", "source", "size", "source_size", "target", "copies", "mass", "key")
    asked = asked.select(*fields, "documents")
    settled = (F.col("mass") <= 0) | (F.col("mass") >= F.col("size"))
    asked = stage(asked, "asked")
    done, open_ = [asked.where(settled).select(*fields)], asked.where(~settled)
    left, depth = aims.agg(F.max("documents")).first()[0] or 0, 0
    while True:
        rows = F.greatest(F.ceil(F.col("documents") / F.lit(ROW)), F.lit(1))
        dealt = open_.withColumn("row", F.when(rows <= 1, F.lit(0)).otherwise(F.pmod(F.xxhash64(F.lit(depth), "key"), rows)))
        one = F.struct("key", *[f for f in fields if f != "key"])
        played = (
            dealt.groupBy("source", "row", rows.alias("documents"))
            .agg(F.array_sort(F.collect_list(one)).alias("all"))
            .select("documents", _played(F.col("all")).alias("played"))
        )
        played = stage(played, "round")
        done.append(played.select(F.explode("played.done").alias("x")).select(*[F.col("x")[f].alias(f) for f in fields]))
        open_ = played.select(*[F.col("played.rest")[f].alias(f) for f in fields], "documents")
        if left <= ROW:
            break
        left, depth = -(-left // ROW), depth + 1
    done.append(open_.select(*fields))
    result = done[0]
    for more in done[1:]:
        result = result.unionByName(more)
    whole = F.col("mass") >= F.col("size")
    return result.select(
        F.col("id").alias(key),
        "source",
        "size",
        "source_size",
        "target",
        (F.col("copies") + F.when(whole & (F.col("size") > 0), 1).otherwise(0)).alias("copies"),
        F.when(whole, 0).otherwise(F.round("mass")).cast("long").alias("part"),
    )


def repeated(documents: DataFrame) -> DataFrame:
    """``documents`` as the mix takes them: a row for each copy, whole texts only. A part of at least half a document is a
    copy. All columns stay."""
    spark = documents.sparkSession
    taken = [c.lower() for c in documents.columns]
    row, copies = (next(n for n in (stem + "_" * i for i in range(len(taken) + 1)) if n not in taken) for stem in ("row", "copies"))
    staged = documents.withColumn(row, F.monotonically_increasing_id())
    staged = scratch.stage(staged, scratch.new_path(spark, "mix-documents"))
    mixed = mix(staged, row)
    times = (F.col("copies") + F.when(2 * F.col("part") >= F.col("size"), F.signum("part")).otherwise(0)).cast("int")
    mixed = mixed.select(row, times.alias(copies)).where(F.col(copies) > 0)
    return staged.join(mixed, row).select(*documents.columns, F.explode(F.array_repeat(F.lit(0), F.col(copies))).alias(copies)).drop(copies)
