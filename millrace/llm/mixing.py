"""Mixing sources to target weights by weighted fair queueing.

How it works
    Sources get weights by rank; each one's target is its share of all words, never over ``max_repeat`` times its size,
    and what it cannot take is shared again by weight (water filling). Within a source documents are shuffled by a hash,
    and up to ``max_repeat`` copies of the source follow each other. A document's virtual finish time is the number of
    its source's words up to its own end, divided by the target. All copies are range-sorted by that time and cut where
    the running total passes the budget.

    A source that holds a third of all rows is never in one task: the shuffled order is cut into blocks of about
    ``block_rows``, each summed on its own, and blocks get their start from the (small) table of block totals, which is
    summed over blocks of blocks in turn. The cut is found in the one range partition that holds it. Within a source
    copies are taken in order, so a source has one cut, which decides each of its documents where it lies: no text
    moves.

Defined results
    null text: size 0. null source: a source of its own, last. Documents of size 0 take 0. Repeated doc_ids: rows of
    their own. Ties in the order are broken by doc_id and size. A source without words has target 0. Empty table: no
    rows. Extra columns: ignored here, kept by :func:`mix_documents`, whatever their names and types. Runs with the same
    seed agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import join_classes, materialize, parallelism, quoted, row_mark, whole_row, words

WEIGHTS = (5, 2, 1)
MAX_REPEAT = 3
#: The shuffled order is a number below 2 ** ORDER_BITS.
ORDER_BITS = 60
#: Blocks that are summed in one task, and sources that are broadcast (some 100 bytes each); more are joined.
BLOCKS_SUMMED, SOURCES_SENT = 4_096, 100_000


def shuffled(doc_id: Column, seed: int) -> Column:
    """A number below 2 ** 60 from an MD5 of seed and id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def running(rows: DataFrame, order: list[str], sums: dict[str, Column]) -> DataFrame:
    """``rows`` with, for each name, the sum over all rows before in the order; range-partitioned, so no task sees all."""
    spark = rows.sparkSession
    parts = max(2, parallelism(spark))
    ranged = rows.withColumns({f"{n}__own": c for n, c in sums.items()}).repartitionByRange(parts, *order)
    ranged = materialize(ranged.withColumn("__part", F.spark_partition_id()), "ranges")
    held = ranged.groupBy("__part").agg(*[F.sum(f"{n}__own").alias(n) for n in sums]).orderBy("__part").collect()  # a row a partition
    before, offsets = dict.fromkeys(sums, 0), []
    for r in held:
        offsets.append((r["__part"], *before.values()))
        before = {n: before[n] + r[n] for n in sums}
    table = spark.createDataFrame(offsets, "__part int" + "".join(f", {n}__before long" for n in sums))
    inside = Window.partitionBy("__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    joined = ranged.join(F.broadcast(table), "__part")
    joined = joined.withColumns({n: F.col(f"{n}__before") + F.coalesce(F.sum(f"{n}__own").over(inside), F.lit(0)) for n in sums})
    return joined.drop("__part", *[f"{n}__{x}" for n in sums for x in ("own", "before")])


def targets(sources: DataFrame, weights=WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """source, source_size -> also rank and target: water filling by two running sums over the sources."""
    ranked = running(sources.withColumn("none", F.col("source").isNull()), ["none", "source"], {"rank": F.lit(1).cast("long")})
    ranked = ranked.withColumn("weight", F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int")))
    ranked = ranked.withColumn("cap", F.col("source_size") * max_repeat).withColumn("ratio", F.col("cap") / F.col("weight"))
    filled = running(ranked, ["ratio", "rank"], {"spent": F.col("cap"), "gone": F.col("weight").cast("long")})
    everything, all_weights = filled.agg(F.sum("source_size"), F.sum("weight")).first()
    filled = filled.withColumn("level", (F.lit(everything).cast("long") - F.col("spent")) / (F.lit(all_weights).cast("long") - F.col("gone")))
    over = F.col("ratio") > F.col("level")
    water = F.lit(filled.agg(F.max(F.when(over, F.col("level")))).first()[0]).cast("double")
    target = F.when(over, water * F.col("weight")).otherwise(F.col("cap").cast("double"))
    return filled.select("source", "source_size", "documents", "rank", target.alias("target"))


def finish(copy: int | Column) -> Column:
    """Virtual finish time of a copy of a document."""
    copy = F.lit(copy) if isinstance(copy, int) else copy
    return (copy * F.col("source_size") + F.col("reached")) / F.col("target")


def _place(copy: int | Column) -> Column:
    copy = F.lit(copy) if isinstance(copy, int) else copy
    return F.struct(finish(copy).alias("v"), F.col("rank"), copy.alias("copy"), F.col("order"), F.coalesce("doc_id", F.lit(-(2**63))).alias("doc"), F.col("uid"))


def mix(docs: DataFrame, weights=WEIGHTS, max_repeat: int = MAX_REPEAT, seed: int = 42, block_rows: int = 2_000, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row a document: doc_id, source, size, source_size, target, taken (and uid, a row number)."""
    rows = docs.select(
        quoted(id_col).alias("doc_id"),
        quoted(source_col).alias("source"),
        F.size(words(quoted(text_col))).cast("long").alias("size"),
        shuffled(quoted(id_col), seed).alias("order"),
        F.monotonically_increasing_id().alias("uid"),
    )
    return mix_rows(materialize(rows, "sizes"), weights, max_repeat, block_rows)


def with_sources(rows: DataFrame, sources: DataFrame, total: int) -> DataFrame:
    """``rows`` (with own_source) joined to their sources (a stored table: source, documents and others)."""
    if sources.count() <= SOURCES_SENT:
        return rows.join(F.broadcast(sources), F.col("own_source").eqNullSafe(F.col("source")), "inner").drop("own_source")
    key = F.struct(F.col("source").isNull().alias("none"), F.coalesce("source", F.lit("")).alias("name"))
    named = rows.withColumn("key", F.struct(F.col("own_source").isNull().alias("none"), F.coalesce("own_source", F.lit("")).alias("name")))
    return join_classes(named, sources.withColumn("key", key), ["key"], "documents", total).drop("key", "own_source")


def queue(rows: DataFrame, weights=WEIGHTS, max_repeat: int = MAX_REPEAT, block_rows: int = 2_000):
    """(queued, cut): rows (a stored table of doc_id, source, size, order, uid) with rank, source_size, target and
    ``reached``, the words of their source up to their own end; and the first place that the mix does not take."""
    spark = rows.sparkSession
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("documents"))
    aims = materialize(targets(sources, weights, max_repeat), "targets")
    budget, total = aims.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("documents"), F.lit(0))).first()
    # every source's order in blocks, so that the largest source is dealt over as many tasks as it needs
    blocks = F.ceil(F.col("documents") / block_rows).cast("long")
    known = with_sources(rows.withColumnRenamed("source", "own_source"), aims, total)
    known = known.withColumn("block", F.floor(F.col("order") / F.lit(float(2**ORDER_BITS)) * blocks))
    in_block = Window.partitionBy("rank", "block").orderBy("order", "doc_id", "size", "uid").rowsBetween(Window.unboundedPreceding, 0)
    summed = known.withColumn("__in", F.sum("size").over(in_block))
    queued = summed.join(_starts(known), ["rank", "block"]).withColumn("reached", F.col("__before") + F.col("__in"))
    queued = materialize(queued.select("doc_id", "source", "size", "source_size", "target", "rank", "order", "uid", "reached"), "queued")
    # globally range-sorted copies; a size of 0 takes nothing wherever it stands
    copies = queued.filter("size > 0").withColumn("copy", F.explode(F.array(*[F.lit(i) for i in range(max_repeat)])))
    copies = copies.select(_place(F.col("copy")).alias("place"), "size")
    ranged = copies.repartitionByRange(max(2, parallelism(spark)), "place").select("place", "size", F.spark_partition_id().alias("part"))
    ranged = materialize(ranged, "ranged")
    passed, cut = 0, None
    for part, held in ranged.groupBy("part").agg(F.sum("size")).orderBy("part").collect():  # a row a partition
        if passed + held > budget:
            running = F.sum("size").over(Window.partitionBy("part").orderBy("place").rowsBetween(Window.unboundedPreceding, 0))
            cut = ranged.filter(F.col("part") == part).withColumn("__run", running + passed).filter(F.col("__run") > budget).agg(F.min("place")).first()[0]
            break
        passed += held
    return queued, cut


def _starts(known: DataFrame) -> DataFrame:
    """rank, block and the words of the source before the block. Blocks are summed in groups, then groups."""
    def before(*keys):
        return Window.partitionBy(*keys[:-1]).orderBy(keys[-1]).rowsBetween(Window.unboundedPreceding, -1)

    sums = known.groupBy("rank", "block").agg(F.sum("size").alias("__sum")).withColumn("__group", F.floor(F.col("block") / BLOCKS_SUMMED))
    groups = sums.groupBy("rank", "__group").agg(F.sum("__sum").alias("__all"))
    groups = groups.select("rank", "__group", F.coalesce(F.sum("__all").over(before("rank", "__group")), F.lit(0)).alias("__base"))
    inside = sums.withColumn("__inside", F.coalesce(F.sum("__sum").over(before("rank", "__group", "block")), F.lit(0)))
    return inside.join(groups, ["rank", "__group"]).select("rank", "block", (F.col("__base") + F.col("__inside")).alias("__before"))


def _before(cut, copy: int) -> Column:
    """Is the place of a row's copy before the cut?"""
    first_out = F.struct(*[F.lit(cut[n]).alias(n) for n in ("v", "rank", "copy", "order", "doc", "uid")])
    return _place(copy) < first_out


def mix_rows(rows: DataFrame, weights=WEIGHTS, max_repeat: int = MAX_REPEAT, block_rows: int = 2_000) -> DataFrame:
    """The mix over rows of doc_id, source, size, order and uid, which must be a stored table."""
    queued, cut = queue(rows, weights, max_repeat, block_rows)
    times = F.lit(max_repeat) if cut is None else sum((F.when(_before(cut, i), 1).otherwise(0) for i in range(max_repeat)), F.lit(0))
    taken = F.when(F.col("size") > 0, F.col("size") * times).otherwise(F.lit(0)).cast("long")
    return queued.select("doc_id", "source", "size", "source_size", "target", taken.alias("taken"), "uid")


def _in_source(copy: int | Column, size: Column) -> Column:
    """Where a copy stands in its source's own order."""
    copy = F.lit(copy) if isinstance(copy, int) else copy
    return F.struct(copy.alias("copy"), F.col("order"), F.coalesce("doc_id", F.lit(-(2**63))).alias("doc"), size.alias("size"), F.col("uid"))


def mix_documents(docs: DataFrame, weights=WEIGHTS, max_repeat: int = MAX_REPEAT, seed: int = 42, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``docs`` as the mix takes them: each row as many times as it is taken, all columns kept.

    Rows of size 0 add nothing to any total and go. Rows are told apart by a hash of the whole row; rows that are equal
    throughout are taken equally often.
    """
    row = docs.select(
        whole_row(docs).alias("row"), quoted(id_col).cast("long").alias("doc_id"), quoted(source_col).cast("string").alias("own_source"),
        F.size(words(quoted(text_col))).cast("long").alias("size"), shuffled(quoted(id_col), seed).alias("order"), row_mark(docs).alias("uid"),
    )
    rows = materialize(row.select("doc_id", F.col("own_source").alias("source"), "size", "order", "uid"), "sizes")
    queued, cut = queue(rows, weights, max_repeat)
    sources = queued.groupBy("source", "rank").agg(F.count(F.lit(1)).alias("documents"))
    if cut is None:
        sources = sources.withColumn("cut", F.lit(None).cast("struct<copy:int,order:long,doc:long,size:long,uid:long>"))
    else:
        copies = queued.filter("size > 0").withColumn("out", F.coalesce(*[F.when(~_before(cut, i), i) for i in range(max_repeat)]))
        cuts = copies.filter("out IS NOT NULL").groupBy("rank").agg(F.min(_in_source(F.col("out"), F.col("size"))).alias("cut"))
        sources = sources.join(cuts, "rank", "left")
    sources = materialize(sources.select("source", "documents", "cut"), "cuts")
    taken = with_sources(row, sources, sources.agg(F.coalesce(F.sum("documents"), F.lit(0))).first()[0]).filter("size > 0")
    times = sum((F.when(F.col("cut").isNull() | (_in_source(i, F.col("size")) < F.col("cut")), 1).otherwise(0) for i in range(max_repeat)), F.lit(0))
    return taken.select("row", F.explode(F.array_repeat(F.lit(0), times))).select("row.*")
