"""Mixing sources to target weights with a golden-ratio schedule over shuffled equal-token blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskframe.llm.common import MIN_CELLS, ROWS_PER_CELL, cut, running_totals, unused

#: Weights of the sources in code-point order of their names, repeating.
WEIGHTS = (5, 2, 1)
#: A source stops at so many times its own size.
MAX_EPOCHS = 3
#: Words of a block.  The schedule has total words / BLOCK_WORDS slots.
BLOCK_WORDS = 64
SEED = 17
WORD = r"[^\x20\x09-\x0D]+"
#: 2^32 / golden ratio, made odd: slot n has the point n * GOLDEN mod 2^32.
GOLDEN = 2654435769
SPAN = 1 << 32
#: Cells of the unit line by which slots find their source.
LINE_CELLS = 1 << 12


def source_targets(sized: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """One row per source: pos, source, source_size, target, lo, hi (its part of the line 0..2^32).

    Water-filling: target = min(max_epochs * size, level * weight), with the level that makes the
    targets add up to all sizes.  Sources sorted by the level at which they stop give it in closed
    form.  The table has one row per source name, not per document.
    """
    s = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    s = s.withColumn("pos", F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))))
    s = s.withColumn("w", F.element_at(F.array(*map(F.lit, weights)), (F.col("pos") - 1) % len(weights) + 1).cast("double"))
    s = s.withColumn("cap", F.col("source_size") * max_epochs).withColumn("stop", F.col("cap") / F.col("w"))
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    upto = Window.orderBy("stop", "pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    s = s.withColumn("total", F.sum("source_size").over(everything))
    s = s.withColumn("full_at", F.sum("cap").over(upto) + F.col("stop") * (F.sum("w").over(everything) - F.sum("w").over(upto)))
    s = s.withColumn("capped", F.col("full_at") <= F.col("total"))
    s = s.withColumn("left_words", F.col("total") - F.sum(F.when(F.col("capped"), F.col("cap")).otherwise(0)).over(everything))
    s = s.withColumn("left_w", F.sum(F.when(F.col("capped"), F.lit(0.0)).otherwise(F.col("w"))).over(everything))
    level = F.col("w") * F.col("left_words") / F.nullif(F.col("left_w"), F.lit(0.0))
    s = s.withColumn("target", F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(level))
    line = Window.orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    edge = F.floor(F.sum("target").over(line) / F.nullif(F.col("total"), F.lit(0)) * SPAN + 0.5).cast("bigint")
    s = s.withColumn("hi", F.coalesce(F.least(edge, F.lit(SPAN)), F.lit(0).cast("bigint")))
    last = F.row_number().over(Window.orderBy(F.desc("pos"))) == 1
    s = s.withColumn("hi", F.when(last & (F.col("total") > 0), F.lit(SPAN)).otherwise(F.col("hi")))
    s = s.withColumn("lo", F.lag("hi", 1, 0).over(Window.orderBy("pos")))
    return s.select("pos", "source", "source_size", "target", "lo", "hi", "total")


def point(n: Column) -> Column:
    """n * GOLDEN mod 2^32 without overflow."""
    high, low = F.shiftright(n, 31), n.bitwiseAND((1 << 31) - 1)
    return (high * ((GOLDEN << 31) % SPAN) % SPAN + low * GOLDEN % SPAN) % SPAN


def schedule(spark: SparkSession, sources: DataFrame, n_slots: int, block_words: int = BLOCK_WORDS,
             max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """The mixing schedule: slot, pos, block, epoch.

    Slot n takes the source in whose part of the line its point falls.  Slots are ranked per source
    (chunk counts first, so that a large source is not one window group), and rank k takes block
    k mod blocks in epoch k div blocks; ranks beyond ``max_epochs`` rounds are left out.
    """
    slots = spark.range(n_slots).select(F.col("id").alias("slot"), point(F.col("id")).alias("u"))
    slots = slots.withColumn("lc", F.expr(f"u div {SPAN // LINE_CELLS}"))
    parts = sources.where("hi > lo").withColumn(
        "lc", F.explode(F.expr(f"sequence(lo div {SPAN // LINE_CELLS}, (hi - 1) div {SPAN // LINE_CELLS})")))
    hit = slots.join(parts, "lc").where("u >= lo and u < hi").withColumn("chunk", F.shiftright("slot", 16))
    ranked = running_totals(hit.select("slot", "pos", "source_size", "chunk"), "chunk", [F.col("slot")],
                            {"1": "k"}, by=["pos"])
    blocks = F.expr(f"(source_size + {block_words - 1}) div {block_words}")
    ranked = ranked.withColumn("blocks", blocks)
    return (ranked.where(F.col("k") < F.col("blocks") * max_epochs)
            .select("slot", "pos", (F.col("k") % F.col("blocks")).alias("block"), F.expr("k div blocks").alias("epoch")))


def mix(docs: DataFrame, weights=WEIGHTS, block_words: int = BLOCK_WORDS, max_epochs: int = MAX_EPOCHS,
        seed: int = SEED) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken, copies, text_hash.

    ``taken`` counts the words of the document's part in every scheduled block (repeats counted);
    ``copies`` is how often the block that holds its first word is scheduled (0 for a text without
    words).  Documents of a source are laid out in the order of a seeded hash of their id; repeated
    ids stand side by side.  Null texts have size 0; null sources are one source of their own; a
    table without words gives targets of 0 and takes nothing.
    """
    spark = docs.sparkSession
    key = F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit(str(seed))))
    sized = cut(docs.select(
        "doc_id", "source", F.xxhash64("text").alias("text_hash"),
        F.regexp_count(F.coalesce(F.col("text"), F.lit("")), F.lit(WORD)).cast("bigint").alias("size"),
        key.alias("key")))
    n_rows, total = sized.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).head()
    cells = max(MIN_CELLS, n_rows // ROWS_PER_CELL)
    sources = cut(source_targets(sized, weights, max_epochs))
    laid = sized.join(sources.select(F.col("source").alias("_s"), "pos", "source_size", "target"),
                      F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    laid = laid.withColumn("cell", F.expr(f"(conv(substr(key, 1, 6), 16, 10) * {cells}L) div {1 << 24}L"))
    laid = running_totals(laid, "cell", [F.col("key"), F.col("doc_id"), F.col("size")],
                          {"size": "a", "1": "row_no"}, by=["pos"])
    laid = cut(laid.select("doc_id", "source", "text_hash", "size", "source_size", "target", "pos", "a", "row_no"))
    plan = schedule(spark, sources, -(-int(total) // block_words), block_words, max_epochs)
    uses = plan.groupBy("pos", "block").agg(F.count(F.lit(1)).alias("uses"))
    pieces = laid.where("size > 0").select(
        "pos", "row_no", "a", "size",
        F.explode(F.expr(f"sequence(a div {block_words}, (a + size - 1) div {block_words})")).alias("block"))
    overlap = F.expr(f"least(a + size, (block + 1) * {block_words}) - greatest(a, block * {block_words})")
    first = F.expr(f"block = a div {block_words}")
    taken = (pieces.join(uses, ["pos", "block"])
             .groupBy("pos", "row_no")
             .agg(F.sum(overlap * F.col("uses")).alias("taken"),
                  F.sum(F.when(first, F.col("uses")).otherwise(0)).alias("copies")))
    out = laid.join(taken, ["pos", "row_no"], "left")
    return out.select("doc_id", "source", "size", "source_size",
                      F.coalesce("target", F.lit(0.0)).alias("target"),
                      F.coalesce("taken", F.lit(0).cast("bigint")).alias("taken"),
                      F.coalesce("copies", F.lit(0).cast("bigint")).alias("copies"), "text_hash")


def apply_mix(docs: DataFrame, **options) -> DataFrame:
    """``docs`` (all columns), each row as often as the schedule takes the block of its first word.

    Documents that the mix does not take are left out; equal rows of an id stand equally often.  Null sources are
    one source; null and empty texts are never taken.  Columns may have any names: inner ones are called otherwise.
    """
    own, of, text, times = unused(docs, "own", "of", "hashed", "times")
    plan = cut(mix(docs, **options).groupBy("doc_id", "source", "text_hash").agg(F.max("copies").alias("copies"))
               .where("copies > 0"))
    plan = plan.select(F.col("doc_id").alias(own), F.col("source").alias(of), F.col("text_hash").alias(text),
                       F.col("copies").alias(times))
    hit = (F.col("doc_id").eqNullSafe(F.col(own)) & F.col("source").eqNullSafe(F.col(of))
           & (F.xxhash64("text") == F.col(text)))
    rows = docs.join(plan, hit).select(*(F.col(f"`{c}`") for c in docs.columns), times)
    return rows.withColumn(times, F.explode(F.sequence(F.lit(1).cast("bigint"), times))).drop(times)


def op9(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text")
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken")


def op9_sql(block_words: int = BLOCK_WORDS, seed: int = SEED) -> str:
    return f"""
with sized as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::bigint as size,
         md5(concat(doc_id::varchar, ':{seed}')) as key from documents),
s0 as (select source, sum(size)::bigint as source_size from sized group by source),
s1 as (select *, row_number() over (order by source asc nulls last) as pos from s0),
s2 as (select *, [5.0, 2.0, 1.0][((pos - 1) % 3 + 1)::int]::double as w, source_size * 3 as cap,
              sum(source_size) over () as total from s1),
s3 as (select *, sum(cap) over (order by cap / w, pos rows unbounded preceding)
              + cap / w * (sum(w) over () - sum(w) over (order by cap / w, pos rows unbounded preceding)) as full_at from s2),
s4 as (select *, total - sum(case when full_at <= total then cap else 0 end) over () as left_words,
              sum(case when full_at <= total then 0.0 else w end) over () as left_w from s3),
s5 as (select *, case when full_at <= total then cap::double else w * left_words / left_w end as target from s4),
s6 as (select *, least(floor(sum(target) over (order by pos rows unbounded preceding) / total * {SPAN} + 0.5)::bigint, {SPAN}) as hi0 from s5),
s7 as (select *, case when pos = max(pos) over () then {SPAN} else hi0 end as hi from s6),
src as (select *, lag(hi, 1, 0) over (order by pos) as lo, (source_size + {block_words - 1}) // {block_words} as blocks from s7),
slots as (select n, (n * {GOLDEN}) % {SPAN} as u
          from range(0, (select ((sum(size) + {block_words - 1}) // {block_words})::bigint from sized)) t(n)),
ranked as (select pos, blocks, row_number() over (partition by pos order by n) - 1 as k
           from slots join src on u >= lo and u < hi),
uses as (select pos, k % blocks as block, count(*) as uses from ranked where k < 3 * blocks group by 1, 2),
laid as (select doc_id, size, source_size, target, pos,
                sum(size) over (partition by pos order by key, doc_id, size rows unbounded preceding) - size as a
         from sized join src on sized.source is not distinct from src.source),
pieces as (select doc_id, pos, a, size, unnest(range((a // {block_words})::bigint, ((a + size - 1) // {block_words} + 1)::bigint)) as block
           from laid where size > 0),
taken as (select doc_id, sum((least(a + size, (block + 1) * {block_words}) - greatest(a, block * {block_words})) * uses)::bigint as taken
          from pieces join uses using (pos, block) group by doc_id)
select doc_id, size, source_size, target, coalesce(taken, 0)::bigint as taken from laid left join taken using (doc_id)
"""
