"""Mixing sources to target weights: random order within each source, running sums of sizes, a cut at each budget."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from surveylake.llm.common import table, written

#: Weights of the sources in order, repeating; words of the mix as a share of all; most epochs.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
EPOCHS = 2
SEED = "mix"
#: Rows of a range of keys, and ranges whose sums are added up together.
RANGE_ROWS = 1 << 12
BLOCK = 1024
WORD = r"[^\x20\x09-\x0D]+"


def running_sums(ranges: DataFrame, values: list[str], within: list[str]) -> DataFrame:
    """`before_<value>` of each row of a table of ranges: the sum over the ranges before it of the same `within`.

    `ranges` has a column `range`, a number from 0. Sums are formed within blocks of ranges and over the blocks.
    """
    rows = ranges.withColumn("_block", F.expr(f"range div {BLOCK}"))
    before = lambda v, w: F.coalesce(F.sum(v).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    inner = Window.partitionBy(*within, "_block").orderBy("range")
    outer = Window.partitionBy(*(within or [F.lit(0)])).orderBy("_block")
    blocks = rows.groupBy(*within, "_block").agg(*[F.sum(v).alias(v) for v in values])
    blocks = blocks.select(*within, "_block", *[before(v, outer).alias(f"_outer_{v}") for v in values])
    rows = rows.select("*", *[before(v, inner).alias(f"_inner_{v}") for v in values]).join(blocks, [*within, "_block"])
    sums = [(F.col(f"_inner_{v}") + F.col(f"_outer_{v}")).alias(f"before_{v}") for v in values]
    return rows.select(*[c for c in ranges.columns], *sums)


def ordered_sums(rows: DataFrame, order: list[str], values: list[str]) -> DataFrame:
    """All rows with `before_<value>`, the sums over the rows before them in the given order, and `place`, their number.

    Rows are dealt by ranges of the order, so no window spans the table and equal rows are in one range.
    """
    cut = rows.repartitionByRange(*order).withColumns({"range": F.spark_partition_id().cast("long"), "_one": F.lit(1).cast("long")})
    cut, each = written(cut, "ranges"), [*values, "_one"]
    totals = running_sums(cut.groupBy("range").agg(*[F.sum(v).alias(v) for v in each]), each, [])
    totals = totals.select("range", *[F.col(f"before_{v}").alias(f"_before_{v}") for v in each])
    inside = Window.partitionBy("range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    sums = {v: F.coalesce(F.sum(v).over(inside), F.lit(0)) + F.col(f"_before_{v}") for v in each}
    found = cut.join(totals, "range")
    return found.select(*rows.columns, *[sums[v].alias(f"before_{v}") for v in values], sums["_one"].alias("place"))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, epochs: int = EPOCHS) -> DataFrame:
    """`sizes` (`source`, `source_size`, `source_rows`) with the place of each source in order and its `target`.

    Sources weigh `weights` in code-point order, null last. They share `share` times all sizes by weight; none gets
    more than `epochs` times its size, and what is over is shared by weight among the others until none is above.
    So one level holds for all: a source gets the lesser of its weight times the level and its most. In the order of
    most by weight the level follows from running sums; the driver sees three numbers, and no task all sources.
    """
    listed = sizes.withColumn("no_source", F.col("source").isNull())
    ranked = written(ordered_sums(listed, ["no_source", "source"], []), "source-places")
    weight = F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    most = epochs * F.col("source_size")
    weighed = ranked.drop("no_source").withColumns({"weight": weight, "most": most, "turn": most / weight})
    filled = written(ordered_sums(weighed.withColumnRenamed("place", "source_place"), ["turn", "source_place"], ["most", "weight"]), "source-turns")
    total, all_weights = filled.agg(F.sum("source_size"), F.sum("weight")).first()
    # The level if the sources before this one have their most, and this one and all after it share the rest.
    level = (share * (total or 0) - F.col("before_most")) / ((all_weights or 0) - F.col("before_weight"))
    (level,) = filled.select(level.alias("level"), "turn").where("level <= turn").agg(F.max("level")).first()
    most = F.col("most").cast("double")
    target = most if level is None else F.least(most, F.col("weight") * F.lit(level))
    return filled.select("source", "source_place", "source_size", "source_rows", target.alias("target"))


def digest(key: Column, text: Column) -> Column:
    """What places a document at random in its source: the same for repeated rows, whatever the input's partitions."""
    named = [F.coalesce(part.cast("string"), F.lit("")) for part in (key, text)]
    return F.md5(F.concat(F.lit(f"{SEED}:"), named[0], F.lit(":"), named[1]).cast("binary"))


def planned(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    epochs: int = EPOCHS,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """What the mix takes of each distinct `doc_id`, `source`, `digest`: with `copies`, the number of its rows.

    Each source takes its target, rounded to whole words: as many whole epochs as that holds, and in a last one the
    documents in random order up to the word where the budget ends. `full` are the whole epochs, `budget` the words
    of the last one, and `before` the words before the first copy in the source's order.

    The order is that of `digest`; the digests of a source are cut into even ranges by its number of rows. Each
    range is sorted by a task, and sums over the ranges before it are added. Repeated rows are counted before
    anything is shuffled, so neither a hot source nor a row repeated without end lands in one task.
    """
    size = F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(WORD)).cast("long")
    named = docs.select(F.col(key).alias("doc_id"), F.col(source).alias("source"), digest(F.col(key), F.col(text)).alias("digest"), size.alias("size"))
    profile = written(named.groupBy("doc_id", "source", "digest", "size").agg(F.count(F.lit(1)).alias("copies")), "mix-profile")
    all_ = F.col("size") * F.col("copies")
    sizes = profile.groupBy("source").agg(F.sum(all_).alias("source_size"), F.sum("copies").alias("source_rows"))
    known = written(targets(sizes, weights, share, epochs), "mix-targets")
    near = known.withColumnRenamed("source", "_source")
    placed = profile.join(near, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    ranges = F.ceil(F.col("source_rows") / range_rows)
    placed = placed.withColumns({"words": all_, "range": F.shiftright(F.conv(F.substring("digest", 1, 8), 16, 10).cast("long") * ranges, 32)})
    sums = placed.groupBy("source_place", "range").agg(F.sum("words").alias("words"))
    sums = written(running_sums(sums, ["words"], ["source_place"]).drop("words"), "mix-ranges")
    inside = Window.partitionBy("source_place", "range").orderBy("digest", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("words").over(inside), F.lit(0).cast("long")) + F.col("before_words")
    taken = F.round("target").cast("long")
    full = F.when(F.col("source_size") > 0, F.expr("cast(round(target) as bigint) div source_size")).otherwise(0).cast("long")
    found = placed.join(sums, ["source_place", "range"]).withColumns({"before": before, "full": full})
    names = ["doc_id", "source", "digest", "size", "copies", "source_size", "target", "full", "before"]
    return found.select(*names, (taken - F.col("full") * F.col("source_size")).alias("budget"))


#: Copies of a row that are told apart at a time.
COPIES = 1 << 16


def taken_words(docs: DataFrame, **how) -> DataFrame:
    """`doc_id`, `source`, `size`, `source_size`, `target`, `taken` of every row; see `planned`.

    A null text has size 0, and nothing is taken of it; a null source is one of its own. Repeated rows follow each
    other in the order, so they may differ in what is taken of them. A text of any length is counted whole. An empty
    table gives none, and so do sources without words get a target of 0.
    """
    plan = planned(docs, **how)
    some = plan.withColumn("first", F.explode(F.expr(f"sequence(0L, copies - 1, {COPIES}L)")))
    each = some.withColumn("copy", F.explode(F.expr(f"sequence(first, least(copies, first + {COPIES}) - 1)")))
    start = F.col("before") + F.col("copy") * F.col("size")
    taken = F.col("full") * F.col("size") + F.greatest(F.lit(0), F.least("size", F.col("budget") - start))
    return each.select("doc_id", "source", "size", "source_size", "target", taken.cast("long").alias("taken"))


def mixed(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", **how) -> DataFrame:
    """The mix itself: the columns of `docs`, and `mix_epoch` (from 0) and `mix_words`, a row for each time a row is taken.

    The document where a source's budget ends is cut after the last word that fits, the others are whole. Columns of
    `docs` of these two names are replaced. Of repeated rows those are taken that Spark numbers first; only the rows
    at a source's end are numbered.
    """
    plan = planned(docs, key=key, text=text, source=source, **how)
    plan = written(plan.where("full > 0 or before < budget"), "mix-plan")
    names = ["doc_id", "source", "digest"]
    plan = plan.select(*[F.col(n).alias(f"_mix_{n}") for n in names], F.struct("size", "full", "before", "budget", "copies").alias("_mix"))
    same = F.col(key).eqNullSafe(F.col("_mix_doc_id")) & F.col(source).eqNullSafe(F.col("_mix_source"))
    kept = docs.drop("mix_epoch", "mix_words")
    columns = kept.columns
    rows = kept.join(plan, same & (digest(F.col(key), F.col(text)) == F.col("_mix_digest")))
    at_end = (F.col("_mix.copies") > 1) & (F.col("_mix.before") < F.col("_mix.budget"))
    at_end &= F.col("_mix.before") + F.col("_mix.copies") * F.col("_mix.size") > F.col("_mix.budget")
    number = F.row_number().over(Window.partitionBy("_mix_doc_id", "_mix_source", "_mix_digest").orderBy(F.lit(0))) - 1
    rows = rows.where(~at_end).withColumn("_mix_copy", F.lit(0)).unionByName(rows.where(at_end).withColumn("_mix_copy", number))
    left = F.greatest(F.lit(0), F.least("_mix.size", F.col("_mix.budget") - F.col("_mix.before") - F.col("_mix_copy") * F.col("_mix.size")))
    epochs = F.transform(F.sequence(F.lit(0).cast("long"), F.col("_mix.full")), lambda e: F.struct(e.alias("epoch"), F.when(e < F.col("_mix.full"), F.col("_mix.size")).otherwise(left).cast("long").alias("words")))
    rows = rows.withColumn("_mix_time", F.explode(F.filter(epochs, lambda e: e["words"] > 0)))
    first = F.array_join(F.slice(F.regexp_extract_all(F.col(text), F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0)), F.lit(1), F.col("_mix_time.words").cast("int")), "")
    cut = F.when(F.col("_mix_time.words") < F.col("_mix.size"), first).otherwise(F.col(text))
    return rows.select(
        *[cut.alias(c) if c == text else F.col(c) for c in columns],
        F.col("_mix_time.epoch").alias("mix_epoch"), F.col("_mix_time.words").alias("mix_words"),
    )


def op13_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = taken_words(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "source_size", "target", "taken", "source")


def sql(docs: str = "documents", weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, epochs: int = EPOCHS) -> str:
    """The same for DuckDB, with the sharing of the excess round by round."""
    return f"""
WITH RECURSIVE texts AS MATERIALIZED (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS size,
         md5('{SEED}:' || coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')) AS digest FROM {docs}),
sizes AS (SELECT source, sum(size)::BIGINT AS source_size FROM texts GROUP BY source),
weighed AS MATERIALIZED (
  SELECT *, list_value({", ".join(map(str, weights))})[((row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(weights)} + 1)::INT] AS w,
         {epochs} * source_size AS most FROM sizes),
shares AS (
  SELECT 0 AS round, source, w, most, false AS capped,
         w * ({share} * (SELECT sum(source_size) FROM weighed) / (SELECT sum(w) FROM weighed)) AS got FROM weighed
  UNION ALL
  SELECT round + 1, source, w, most, capped OR got > most,
         CASE WHEN capped OR got > most THEN most::DOUBLE ELSE w * level END
  FROM (SELECT *, ({share} * sum(most // {epochs}) OVER () - sum(CASE WHEN capped OR got > most THEN most ELSE 0 END) OVER ())
                  / sum(CASE WHEN capped OR got > most THEN 0 ELSE w END) OVER () AS level,
               bool_or(got > most AND NOT capped) OVER () AS again FROM shares) WHERE again),
last AS (SELECT source, got AS target FROM shares WHERE round = (SELECT max(round) FROM shares)),
ordered AS (
  SELECT t.doc_id, t.size, s.source_size, l.target, t.source, round(l.target)::BIGINT AS words,
         coalesce(sum(t.size) OVER (PARTITION BY t.source ORDER BY t.digest, t.doc_id, t.size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM texts t JOIN sizes s ON t.source IS NOT DISTINCT FROM s.source JOIN last l ON t.source IS NOT DISTINCT FROM l.source)
SELECT doc_id, size, source_size, target, source,
       CASE WHEN source_size = 0 THEN 0 ELSE words // source_size * size
         + greatest(0, least(size, words % source_size - start)) END::BIGINT AS taken
FROM ordered"""


OP13_SQL = sql()
