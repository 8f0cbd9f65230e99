"""Mixing sources to target weights by hash-threshold histograms, in DataFrame operations only.

Every document has a fixed place between 0 and 2**48, taken from the digest of its id and text. A source whose target is r times its
size takes each document floor(r) times, and the rest of its budget from the documents placed lowest. The place where the budget
ends is found without sorting: sizes are summed by source and bucket of 12 place bits, the running sums of the buckets show the
one in which the budget ends, and only that bucket is split by the next 12 bits, four times over. Rows that share the place in which it
ends, copies of one id and text, are taken in the number that fits. What is left open, less than one document, goes to the document
beyond whose size comes nearest. Up to that one document of each source a larger budget keeps all that a smaller one takes, and a rerun
takes the same documents.

Null text has size 0 and the digest of the empty text, a null id that of the empty id. Null sources form a source of their own, which is last.
Equal rows have one place and are told apart by a number only where the budget ends among them; which of them are taken is not fixed, as
the result is the same. An empty table gives an empty result. Texts are read once; later passes read four narrow columns. The window
functions run over sources, buckets and the partitions that hold rows of such a place, never over all documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendframe.llm.common import staged, table

#: Bits of a place, and bits that each pass decides.
BITS, STEP = 48, 12
#: Weights of the sources in code-point order, repeating.
WEIGHTS = (1.0, 2.0, 3.0)
#: No source is repeated more often.
MOST = 3
WORD = r"[^\x20\x09-\x0D]++[\x20\x09-\x0D]*+"


def words(text: Column) -> Column:
    """Number of `[^\\x20\\x09-\\x0D]+` in the text: each word and the white space after it becomes one character."""
    bare = F.ltrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\f\r"))
    return F.length(F.regexp_replace(bare, WORD, "x")).cast("long")


def place(doc_id: Column, text: Column) -> Column:
    both = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.md5(F.coalesce(text, F.lit("")).cast("binary")))
    return F.conv(F.substring(F.md5(both.cast("binary")), 1, BITS // 4), 16, 10).cast("long")


def targets(sizes: DataFrame) -> DataFrame:
    """Target of each source (source, source_size): weight shares of the whole, at most MOST times the size, the excess reshared.

    With sources ordered by the share at which they reach their limit, those that do are a prefix; the level of the others is
    what is left over the sum of their weights.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.row_number().over(order) - 1) % len(WEIGHTS) + 1)
    capped = sizes.withColumn("weight", weight).withColumn("most", F.col("source_size") * float(MOST))
    up = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    before, rest = up.rowsBetween(Window.unboundedPreceding, -1), up.rowsBetween(0, Window.unboundedFollowing)
    free = F.sum("source_size").over(Window.partitionBy()) - F.coalesce(F.sum("most").over(before), F.lit(0.0))
    level = F.first(F.when(F.col("most") >= F.col("weight") * F.col("at"), F.col("at")), ignorenulls=True)
    return (
        capped.withColumn("at", free / F.sum("weight").over(rest))
        .withColumn("level", level.over(up.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
        .select("source", "source_size", F.least(F.col("most"), F.coalesce(F.col("weight") * F.col("level"), F.col("most"))).alias("target"))
    )


def thresholds(sized: DataFrame, budgets: DataFrame) -> DataFrame:
    """Per source the place below which documents fill `budget` (`below`), how many rows of that place fit too (`fitting`), and the place
    of the row that closes the gap (`closing`).

    sized: source, size, place. budgets: source, budget, ...
    """
    state = budgets.withColumn("low", F.lit(0).cast("long")).withColumn("need", F.col("budget"))
    for bits in range(BITS - STEP, -1, -STEP):
        inside = F.col("place").between(F.col("low"), F.col("low") + (1 << bits + STEP) - 1)
        here = sized.alias("d").join(F.broadcast(state.select(F.col("source").alias("s"), "low")), F.col("source").eqNullSafe(F.col("s")) & inside)
        sums = here.groupBy("source", F.shiftright("place", bits).alias("bucket")).agg(F.sum("size").alias("n"))
        run = F.sum("n").over(Window.partitionBy("source").orderBy("bucket"))
        ends = (
            sums.withColumn("upto", run)
            .join(F.broadcast(state.select(F.col("source").alias("s"), "need")), F.col("source").eqNullSafe(F.col("s")))
            .where(F.col("upto") > F.col("need"))
            .groupBy("source")
            .agg(F.min(F.struct("bucket", "upto", "n")).alias("end"))
            .select(F.col("source").alias("s"), "end")
        )
        state = state.join(ends, F.col("source").eqNullSafe(F.col("s")), "left").drop("s")
        taken = F.col("end.upto") - F.col("end.n")
        state = staged(
            state.withColumn("need", F.when(F.col("end").isNotNull(), F.col("need") - taken).otherwise(F.col("need")))
            .withColumn("low", F.when(F.col("end").isNotNull(), F.shiftleft("end.bucket", bits)).otherwise(1 << BITS))
            .drop("end")
        )
    at = F.broadcast(state.select(F.col("source").alias("s"), "low", "need"))
    here = sized.join(at, F.col("source").eqNullSafe(F.col("s")) & (F.col("place") == F.col("low")))
    fit = F.least(F.count("*"), F.floor(F.first("need") / F.nullif(F.max("size"), F.lit(0))))
    fits = here.groupBy("source").agg(F.coalesce(fit, F.lit(0)).alias("fitting"), F.count("*").alias("rows"), F.max("size").alias("each")).withColumnRenamed("source", "s")
    state = state.join(F.broadcast(fits), F.col("source").eqNullSafe(F.col("s")), "left").drop("s").na.fill(0, ["fitting", "rows", "each"])
    state = staged(state.withColumn("need", F.col("need") - F.col("fitting") * F.col("each")))
    at = F.broadcast(state.select(F.col("source").alias("s"), "low", "need", (F.col("rows") > F.col("fitting")).alias("more")))
    beyond = sized.join(at, F.col("source").eqNullSafe(F.col("s")) & (F.col("place") >= F.col("low"))).where((F.col("place") > F.col("low")) | F.col("more"))
    gap = F.abs(F.col("size") - F.col("need"))
    closing = beyond.where(gap < F.col("need")).groupBy("source").agg(F.min(F.struct(gap.alias("gap"), "place")).alias("c"))
    closing = closing.select(F.col("source").alias("s"), F.col("c.place").alias("closing"))
    return staged(state.join(closing, F.col("source").eqNullSafe(F.col("s")), "left").drop("s", "need", "rows", "each").withColumnRenamed("low", "below"))


def numbered(rows: DataFrame, found: DataFrame) -> DataFrame:
    """rows (source, place, ...) with `number`: from 1 among the rows of the places that `found` names for a source, 1 for all others.

    A place's rows are counted by partition, so a place with any number of rows is numbered in as many tasks as hold some.
    """
    named = found.select(F.col("source").alias("s"), F.explode(F.array_distinct(F.array("below", "closing"))).alias("p")).where("p IS NOT NULL")
    same = F.col("source").eqNullSafe(F.col("s")) & (F.col("place") == F.col("p"))
    others = rows.join(F.broadcast(named), same, "left_anti").withColumn("number", F.lit(1).cast("long"))
    there = staged(rows.join(F.broadcast(named), same, "left_semi").withColumn("part", F.spark_partition_id()))
    up = Window.partitionBy("source", "place").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = there.groupBy("source", "place", "part").agg(F.count("*").alias("n")).withColumn("start", F.coalesce(F.sum("n").over(up), F.lit(0)))
    parts = parts.select(F.col("source").alias("s"), F.col("place").alias("p"), F.col("part").alias("q"), "start")
    nth = F.row_number().over(Window.partitionBy("source", "place", "part").orderBy(F.lit(0)))
    joined = there.withColumn("nth", nth).join(parts, same & (F.col("part") == F.col("q")))
    return others.unionByName(joined.withColumn("number", F.col("start") + F.col("nth")).select(*others.columns))


def _plan(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Narrow rows of all documents, and per source its size, target, whole copies and thresholds."""
    sized = staged(docs.select("doc_id", "source", words(F.col("text")).alias("size"), place(F.col("doc_id"), F.col("text")).alias("place")))
    sources = staged(targets(sized.groupBy("source").agg(F.sum("size").alias("source_size"))))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int")
    budgets = sources.withColumn("copies", whole).withColumn("budget", F.col("target") - F.col("copies") * F.col("source_size"))
    return sized, thresholds(sized, budgets)


def _copies(rows: DataFrame, found: DataFrame) -> DataFrame:
    """rows (source, place, ...) with what is known of their source, and `copies`, how often the mix takes each."""
    closes = F.coalesce(F.col("place") == F.col("closing"), F.lit(False))
    taken = F.when(F.col("place") == F.col("below"), F.col("fitting")).otherwise(0) + closes.cast("int")
    extra = (F.col("place") < F.col("below")) | (F.col("number") <= taken)
    joined = numbered(rows, found).join(F.broadcast(found.withColumnRenamed("source", "s")), F.col("source").eqNullSafe(F.col("s")), "left")
    return joined.withColumn("copies", F.when(extra & (F.col("copies") < MOST), F.col("copies") + 1).otherwise(F.col("copies")))


def mix(docs: DataFrame) -> DataFrame:
    """Every document with its size, its source's size and target, and how many copies (0 to 3) the mix takes."""
    sized, found = _plan(docs)
    return _copies(sized, found).select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"))


def stage(docs: DataFrame) -> DataFrame:
    """The rows of docs, each as many times as the mix takes it, with their own columns."""
    _, found = _plan(docs.select("doc_id", "source", "text"))
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs["source"].alias("source"), place(docs["doc_id"], docs["text"]).alias("place"))
    return _copies(rows, found).withColumn("n", F.explode(F.sequence(F.lit(0), F.col("copies")))).where("n > 0").select("row.*")


def op4_mixing(spark, sf_dir: str) -> DataFrame:
    """Size, target and words taken of each document."""
    return mix(table(spark, sf_dir, "documents")).drop("source", "copies")


#: The same mix by running sums over all documents. DuckDB has no possessive quantifiers, so words are extracted.
OP4_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))), 1, 12))::BIGINT AS place
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (
  SELECT *, [1.0, 2.0, 3.0][1 + (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3]::DOUBLE AS weight,
         source_size * 3.0::DOUBLE AS most FROM s),
a AS (
  SELECT *, ((sum(source_size) OVER ()) - coalesce(sum(most) OVER (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0::DOUBLE))
         / sum(weight) OVER (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
l AS (SELECT arg_min(level, most / weight) AS level FROM a WHERE most >= weight * level),
t AS (
  SELECT source, source_size, least(most, coalesce(weight * (SELECT level FROM l), most)) AS target FROM a),
b AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::INT AS copies,
         target - (CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::INT) * source_size AS budget FROM t),
r AS (
  SELECT d.*, source_size, target, copies, budget, sum(size) OVER (PARTITION BY d.source ORDER BY place) AS upto
  FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source),
e AS (SELECT source, min(place) FILTER (upto > budget) AS below, any_value(budget) - coalesce(max(upto) FILTER (upto <= budget), 0) AS need FROM r GROUP BY source),
f AS (
  SELECT e.source, any_value(e.below) AS below, any_value(need) - coalesce(least(count(r.place), floor(any_value(need) / nullif(max(size), 0))), 0) * coalesce(max(size), 0) AS need,
         coalesce(least(count(r.place), floor(any_value(need) / nullif(max(size), 0))), 0) AS fitting, count(r.place) AS n
  FROM e LEFT JOIN r ON r.source IS NOT DISTINCT FROM e.source AND place = e.below GROUP BY e.source),
c AS (
  SELECT r.source, arg_min(place, (abs(size - need), place)) AS closing
  FROM r JOIN f ON r.source IS NOT DISTINCT FROM f.source WHERE (place > below OR place = below AND n > fitting) AND abs(size - need) < need GROUP BY r.source),
x AS (SELECT *, row_number() OVER (PARTITION BY source, place) AS number FROM r)
SELECT doc_id, size, source_size, target,
       (size * least(3, copies + CASE WHEN below IS NULL OR place < below
          OR number <= (CASE WHEN place = below THEN fitting ELSE 0 END) + (CASE WHEN place = closing THEN 1 ELSE 0 END) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM x JOIN f ON x.source IS NOT DISTINCT FROM f.source LEFT JOIN c ON x.source IS NOT DISTINCT FROM c.source
"""
