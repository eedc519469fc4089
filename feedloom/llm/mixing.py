"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

1. *Targets.* Sources in code-point order (null last) weigh 5, 2, 1, 5, 2, 1, ... and share the words of all
   documents by weight; a target stops at ``MOST`` times its source's size and the excess goes to the others.
   That is one water level, found with running sums over the sources.
2. *Draws.* A source's documents are put in the order of a hash of id and text. Whole passes take every document; the last, partial
   pass takes the leading documents of that order (a random subset), then fills what is left of the target
   with later documents that still fit, ``FILLS`` times, so a long document at the edge does not spoil it.
3. *Blocks.* The drawn words of a source, laid end to end, are cut into blocks; the number of its blocks is its
   exact quota. A binary tree splits the quotas of all sources among the output shards: the left half's share
   of every source is one multivariate-hypergeometric draw, made source by source from inverted cumulative
   weights. Both halves together hold every block, so all quotas stay exact at any depth.
4. *Dealing.* A source's blocks, in a permuted order, are dealt to the shards by those quotas; no two shards
   share a block. Rows carry a hashed ``shuffle_key`` that orders them within their shard.

Only DataFrame and SQL functions are used. Every draw is a hash of ``SEED`` and stable names, so reruns agree.
Running sums over a source go through sums of hash ranges: no task holds a whole source, and rows that are equal in id and text, however
many, are cut up by their place in the table. The number of shards follows the words, so a shard's size does not; it is written as
several ordered parts. The tree, the block map and the quotas are bounded by ``shards * BLOCKS_PER_SHARD`` and the number of sources.

Defined results: null texts and texts without words have size 0; they are drawn when their place in the order
is reached and add no words. Rows repeated with the same id are separate documents. A null doc_id hashes as
the empty string. An empty table gives an empty result. Other columns pass through ``mix`` unchanged.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.llm.common import WORDS, packed
from feedloom.session import cut

SEED = "mix-1"
#: Weights of the sources in their order, repeating; a target is at most MOST times its source's size.
WEIGHTS = (5, 2, 1)
MOST = 3
#: Rounds that fill the rest of a target with documents that still fit.
FILLS = 3
#: Shards: this many at least, and twice as many until none has more words; and the blocks of each.
SHARDS = 16
SHARD_WORDS = 1 << 25
BLOCKS_PER_SHARD = 64
#: Words of a part of a shard, which one task sorts and writes.
PART_WORDS = 1 << 22
#: Documents that one hash range of a source should have at most, and equal rows that are cut up themselves.
RANGE_ROWS = 500
EQUAL_ROWS = 2000
#: Nodes of the splitting tree from which on its levels are computed by several tasks.
WIDE = 1024
#: Half width, in standard deviations, of the support that a hypergeometric draw inverts. What lies outside
#: has a probability below the resolution of the 53-bit uniform number it is compared with.
SPAN = 12

ORACLE_SQL = r"""
WITH RECURSIVE sized AS (
    SELECT row_number() OVER () AS rid, doc_id, source,
           CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
           md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')) AS draw
    FROM documents
), sources AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
           CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w
    FROM sized GROUP BY source
), shares AS (
    SELECT 0 AS step, source, source_size, w, false AS full_, CAST(0 AS DOUBLE) AS target FROM sources
    UNION ALL
    SELECT step + 1, source, source_size, w, full_ OR given >= 3 * source_size,
           CASE WHEN full_ OR given >= 3 * source_size THEN CAST(3 * source_size AS DOUBLE) ELSE given END
    FROM (
        SELECT *, w * (sum(source_size) OVER () - sum(CASE WHEN full_ THEN 3 * source_size ELSE 0 END) OVER ())
                    / CAST(sum(CASE WHEN full_ THEN 0 ELSE w END) OVER () AS DOUBLE) AS given
        FROM shares
    ) WHERE step <= (SELECT count(*) FROM sources)
), targets AS (
    SELECT source, source_size, target,
           CASE WHEN source_size = 0 THEN 0 ELSE CAST(floor(target / source_size) AS BIGINT) END AS passes
    FROM shares WHERE step = (SELECT max(step) FROM shares)
), rest0 AS (
    SELECT s.*, t.source_size, t.target, t.passes, t.target - t.passes * t.source_size AS want
    FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
), pass0 AS (
    SELECT *, sum(size) OVER (PARTITION BY source ORDER BY draw, size, rid) <= want AS picked FROM rest0
), rest1 AS (
    SELECT *, want - coalesce(sum(size) FILTER (WHERE picked) OVER (PARTITION BY source), 0) AS left1 FROM pass0
), pass1 AS (
    SELECT *, picked OR (size <= left1 AND sum(CASE WHEN NOT picked AND size <= left1 THEN size ELSE 0 END)
        OVER (PARTITION BY source ORDER BY draw, size, rid) <= left1) AS picked1 FROM rest1
), rest2 AS (
    SELECT *, want - coalesce(sum(size) FILTER (WHERE picked1) OVER (PARTITION BY source), 0) AS left2 FROM pass1
), pass2 AS (
    SELECT *, picked1 OR (size <= left2 AND sum(CASE WHEN NOT picked1 AND size <= left2 THEN size ELSE 0 END)
        OVER (PARTITION BY source ORDER BY draw, size, rid) <= left2) AS picked2 FROM rest2
), rest3 AS (
    SELECT *, want - coalesce(sum(size) FILTER (WHERE picked2) OVER (PARTITION BY source), 0) AS left3 FROM pass2
), pass3 AS (
    SELECT *, picked2 OR (size <= left3 AND sum(CASE WHEN NOT picked2 AND size <= left3 THEN size ELSE 0 END)
        OVER (PARTITION BY source ORDER BY draw, size, rid) <= left3) AS picked3 FROM rest3
)
SELECT doc_id, size, source_size, target, CAST(size * (passes + CASE WHEN picked3 THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM pass3
"""


def size_of(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORDS)).cast("long")


def targets(sized: DataFrame) -> DataFrame:
    """(source, source_size, weight, target): one row per source.

    A source is full if, were the water level at its own ratio of cap to weight, all sources together would
    hold no more than there is; the level of the others follows from what the full ones leave.
    """
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (place % len(WEIGHTS) + 1).cast("int"))
    most, everyone = F.col("source_size") * MOST, Window.partitionBy()
    by_level = Window.orderBy("level", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0)
    total = F.sum("source_size").over(everyone)
    return (
        sizes.withColumn("weight", weight)
        .withColumn("level", most / F.col("weight"))
        .withColumn("total", total)
        .withColumn("held", F.sum(most).over(by_level))
        .withColumn("others", F.sum("weight").over(everyone) - F.sum("weight").over(by_level))
        .withColumn("full", F.col("held") + F.col("level") * F.col("others") <= F.col("total"))
        .withColumn("kept_back", F.coalesce(F.sum(F.when(F.col("full"), most)).over(everyone), F.lit(0)))
        .withColumn("open_weight", F.coalesce(F.sum(F.when(~F.col("full"), F.col("weight"))).over(everyone), F.lit(0)))
        .select(
            "source", "source_size", "weight",
            F.when(F.col("full"), most.cast("double"))
            .otherwise(F.col("weight") * (F.col("total") - F.col("kept_back")) / F.col("open_weight").cast("double")).alias("target"),
        )
    )


def running(rows: DataFrame, value: Column, name: str) -> DataFrame:
    """``rows`` with the sum of ``value`` up to and including the row, in its source's drawing order.

    Ranges of the drawing hash are summed first; only those sums are scanned source by source, and rows are
    scanned within their range.
    """
    rows = rows.withColumn("_value", value)
    sums = rows.groupBy("source", "slice").agg(F.sum("_value").alias("_sum"))
    before = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(
        F.col("source").alias("_source"), F.col("slice").alias("_slice"),
        F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"),
    )
    same = rows["source"].eqNullSafe(sums["_source"]) & (rows["slice"] == sums["_slice"])
    inside = Window.partitionBy("source", "slice").orderBy("draw", "size", "rid").rowsBetween(Window.unboundedPreceding, 0)
    joined = rows.join(sums, same).withColumn(name, F.col("_before") + F.sum("_value").over(inside))
    return joined.drop("_source", "_slice", "_before", "_value")


def sliced(rows: DataFrame) -> DataFrame:
    """``rows`` with ``slice``: consecutive ranges of the drawing order, told by the first digits of the hash.

    Many equal rows share a hash. Where there are, the whole hash names the slice, and their part of the table.
    """
    digits = max(2, math.ceil(math.log(max(1, rows.count()) / RANGE_ROWS + 1, 16)))
    prefix = F.substring("draw", 1, digits)
    equal = cut(rows.groupBy("draw").agg(F.count("*").alias("n")).where(F.col("n") > EQUAL_ROWS).select("draw"))
    if equal.isEmpty():
        return rows.withColumn("slice", prefix)
    near = equal.select(F.substring("draw", 1, digits).alias("_near")).distinct()
    rows = rows.join(equal.select(F.col("draw").alias("_equal")), F.col("draw") == F.col("_equal"), "left")
    rows = rows.join(near, prefix == F.col("_near"), "left")
    part = F.lpad(F.shiftright("rid", 33).cast("string"), 10, "0")
    slice_ = F.when(F.col("_equal").isNotNull(), F.concat("draw", part)).when(F.col("_near").isNotNull(), F.col("draw")).otherwise(prefix)
    return rows.withColumn("slice", slice_).drop("_equal", "_near")


def drawn(docs: DataFrame) -> DataFrame:
    """Every document with its source's size and target, and ``copies``: how often the mix takes it.

    ``row`` holds the document itself if the caller put it there.
    """
    extra = [c for c in ("row",) if c in docs.columns]
    named = F.concat(F.lit(f"{SEED}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.coalesce("text", F.lit("")))
    sized = cut(docs.select(
        "doc_id", "source", size_of(F.col("text")).alias("size"), *extra,
        F.md5(named.cast("binary")).alias("draw"), F.monotonically_increasing_id().alias("rid"),
    ))
    small = sized.drop("row")
    goals = cut(targets(small))
    named = goals.select(F.col("source").alias("_source"), "source_size", "target")
    small = sliced(small)
    rows = small.join(named, small["source"].eqNullSafe(named["_source"])).drop("_source")
    passes = F.when(F.col("source_size") == 0, F.lit(0)).otherwise(F.floor(F.col("target") / F.col("source_size")))
    rows = rows.withColumn("passes", passes.cast("long")).withColumn("want", F.col("target") - F.col("passes") * F.col("source_size"))
    rows = cut(running(rows, F.col("size"), "place").withColumn("picked", F.col("place") <= F.col("want")))
    for _ in range(FILLS):
        rows = cut(_filled(rows))
    rows = rows.withColumn("copies", F.col("passes") + F.col("picked").cast("int")).drop("want", "picked", "passes")
    if extra:
        rows = rows.join(sized.select("rid", "row"), "rid")
    return rows


def _filled(rows: DataFrame) -> DataFrame:
    """One more round: of the documents left that fit into what is missing, take leading ones until it is full."""
    done = rows.groupBy("source").agg(F.sum(F.when(F.col("picked"), F.col("size")).otherwise(0)).alias("_done"))
    done = cut(done.select(F.col("source").alias("_of"), "_done"))
    rows = rows.join(done, rows["source"].eqNullSafe(done["_of"])).drop("_of")
    rows = rows.withColumn("missing", F.col("want") - F.col("_done")).drop("_done")
    fits = ~F.col("picked") & (F.col("size") <= F.col("missing"))
    rows = rows.withColumn("fits", fits)
    rows = running(rows, F.when(F.col("fits"), F.col("size")).otherwise(0), "filled")
    return rows.withColumn("picked", F.col("picked") | (F.col("fits") & (F.col("filled") <= F.col("missing")))).drop("missing", "fits", "filled")


def draw_sql(n: str, k: str, total: str, u: str) -> str:
    """SQL for one hypergeometric draw: of ``n`` blocks drawn from ``total``, how many a source with ``k`` gets.

    The mode starts at weight 1, weights above and below follow from the ratio of neighbours, and the first
    count whose cumulative weight reaches the uniform number ``u`` is the draw.
    """
    up = "(s.k - i) * (s.n - i) / ((i + 1) * (s.t - s.k - s.n + i + 1))"
    down = "i * (s.t - s.k - s.n + i) / ((s.k - i + 1) * (s.n - i + 1))"
    kept = "'n', s.n, 'k', s.k, 't', s.t, 'u', s.u"
    first = f"""array(named_struct('n', cast({n} as double), 'k', cast({k} as double), 't', cast({total} as double), 'u', {u}))"""
    ranged = f"""transform({first}, s -> named_struct({kept},
        'lo', greatest(0D, s.n - (s.t - s.k)), 'hi', least(s.n, s.k), 'mode', floor((s.n + 1) * (s.k + 1) / (s.t + 2)),
        'sd', sqrt(greatest(1D, s.n * s.k / greatest(s.t, 1D) * (1 - s.k / greatest(s.t, 1D))))))"""
    bounded = f"""transform({ranged}, s -> named_struct({kept}, 'mode', cast(greatest(least(s.mode, s.hi), s.lo) as bigint),
        'lo', cast(greatest(s.lo, floor(s.mode - {SPAN} * s.sd - 2)) as bigint),
        'hi', cast(least(s.hi, ceil(s.mode + {SPAN} * s.sd + 2)) as bigint)))"""
    weighed = f"""transform({bounded}, s -> named_struct({kept}, 'lo', s.lo, 'hi', s.hi,
        'above', aggregate(sequence(s.mode, s.hi), named_struct('w', 1D, 'sum', 0D),
            (b, i) -> named_struct('w', b.w * {up}, 'sum', b.sum + b.w)).sum,
        'below', aggregate(sequence(s.mode, s.lo), named_struct('w', 1D, 'sum', 0D, 'last', 1D),
            (b, i) -> named_struct('w', b.w * {down}, 'sum', b.sum + b.w, 'last', b.w))))"""
    return f"""transform({weighed}, s -> coalesce(aggregate(sequence(s.lo, s.hi),
        named_struct('w', s.below.last, 'sum', 0D, 'got', cast(null as bigint)),
        (b, i) -> named_struct('w', b.w * {up}, 'sum', b.sum + b.w,
            'got', coalesce(b.got, if(b.sum + b.w >= s.u * (s.above + s.below.sum - 1), i, null)))).got, s.hi))[0]"""


def split(quotas: DataFrame, shards: int) -> DataFrame:
    """(shard, source, quota) from (source, blocks): the splitting tree, one level after the other.

    A node holds the quotas of all sources. Its left half gets half of the node's blocks: the sources are drawn
    one after the other, each from what the earlier ones have left, which makes the draw multivariate.
    """
    if shards < 1 or shards & (shards - 1):
        raise ValueError("the number of shards must be a power of two")
    nodes = quotas.groupBy().agg(F.array_sort(F.collect_list(F.struct("source", F.col("blocks").alias("q")))).alias("parts"))
    nodes = nodes.select(F.lit(1).cast("long").alias("node"), "parts")
    for level in range(shards.bit_length() - 1):
        if 1 << level == WIDE:
            nodes = nodes.repartition(WIDE, "node")
        nodes = _halved(nodes)
    return nodes.select((F.col("node") - shards).alias("shard"), F.explode("parts").alias("p")).select(
        "shard", "p.source", F.col("p.q").alias("quota"),
    )


def _halved(nodes: DataFrame) -> DataFrame:
    """Every node replaced by its two halves."""
    total = "aggregate(parts, 0L, (a, p) -> a + p.q)"
    uniform = f"pmod(xxhash64('{SEED}', node, p.source), 9007199254740992) / 9007199254740992D"
    draw = draw_sql("a.n", "p.q", "a.total", uniform)
    lefts = nodes.withColumn("lefts", F.expr(f"""
        aggregate(parts, named_struct('n', {total} div 2, 'total', {total}, 'got', cast(array() as array<bigint>)),
            (a, p) -> transform(array({draw}),
                x -> named_struct('n', a.n - x, 'total', a.total - p.q, 'got', concat(a.got, array(x))))[0]).got"""))
    half = "named_struct('node', node * 2 + {i}, 'parts', zip_with(parts, lefts, (p, x) -> named_struct('source', p.source, 'q', {q})))"
    both = F.expr(f"explode(array({half.format(i=0, q='x')}, {half.format(i=1, q='p.q - x')}))")
    return lefts.select(both.alias("side")).select("side.node", "side.parts")


def deal(blocks: DataFrame, shards: int) -> DataFrame:
    """(source, block, shard): each source's permuted blocks dealt to the shards by their quotas."""
    quotas = split(blocks, shards)
    upto = Window.partitionBy("source").orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)
    quotas = quotas.withColumn("hi", F.sum("quota").over(upto)).withColumn("lo", F.col("hi") - F.col("quota"))
    quotas = quotas.where("quota > 0").select(F.col("source").alias("_source"), "shard", "lo", "hi")
    order = Window.partitionBy("source").orderBy(F.xxhash64(F.lit(SEED), "source", "block"), "block")
    each = blocks.where("blocks > 0").select("source", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"))
    each = each.withColumn("nth", F.row_number().over(order) - 1)
    return each.join(
        quotas, each["source"].eqNullSafe(quotas["_source"]) & (F.col("nth") >= F.col("lo")) & (F.col("nth") < F.col("hi")),
    ).select("source", "block", "shard")


def shards_of(words: int) -> int:
    """How many shards a mix of so many words has: a power of two."""
    return max(SHARDS, 1 << max(0, math.ceil(words / SHARD_WORDS) - 1).bit_length())


def dealt_copies(rows: DataFrame, shards: int | None = None) -> DataFrame:
    """(rid, mix_copy, mix_shard, mix_part, mix_key): one row per copy of the ``drawn`` documents, dealt to its shard.

    Keys order a shard; its parts are consecutive ranges of the keys, of about ``PART_WORDS`` words.
    """
    last = F.when(F.col("copies") > F.col("whole"), F.col("size")).otherwise(0)
    slim = rows.withColumn("whole", F.when(F.col("source_size") == 0, F.lit(0)).otherwise(F.floor(F.col("target") / F.col("source_size"))).cast("long"))
    slim = running(slim, last, "late")
    copies = slim.where("copies > 0").withColumn("mix_copy", F.explode(F.sequence(F.lit(0), (F.col("copies") - 1).cast("int"))))
    start = F.when(F.col("mix_copy") < F.col("whole"), F.col("place") - F.col("size")).otherwise(F.col("late") - F.col("size"))
    copies = cut(copies.select("rid", "source", "draw", "mix_copy", "size", (F.col("mix_copy") * F.col("source_size") + start).alias("at")))
    words = copies.agg(F.sum("size")).first()[0] or 0
    shards = shards or shards_of(words)
    long = max(1, math.ceil(words / (shards * BLOCKS_PER_SHARD)))
    copies = copies.withColumn("block", F.floor(F.col("at") / long))
    dealt = deal(copies.groupBy("source").agg((F.max("block") + 1).alias("blocks")), shards)
    dealt = cut(dealt.select(F.col("source").alias("_source"), F.col("block").alias("_block"), F.col("shard").alias("mix_shard")))
    placed = copies.join(dealt, copies["source"].eqNullSafe(dealt["_source"]) & (copies["block"] == dealt["_block"]))
    key = F.xxhash64(F.lit(SEED), "draw", "mix_copy", "rid")
    parts = max(1, math.ceil(words / (shards * PART_WORDS)))
    part = F.least(F.lit(parts - 1), F.floor((key / F.lit(2.0**64) + 0.5) * parts)).cast("int")
    return placed.select("rid", "mix_copy", "mix_shard", part.alias("mix_part"), key.alias("mix_key"))


def _placed(docs: DataFrame, shards: int | None) -> tuple[DataFrame, DataFrame]:
    """(rid, row) of all documents, and the stored places of their copies."""
    rows = drawn(docs.select("doc_id", "source", "text", packed(docs).alias("row")))
    return rows.select("rid", "row"), cut(dealt_copies(rows.drop("row"), shards))


PLACES = ("mix_copy", "mix_shard", "mix_part", "mix_key")


def mix(docs: DataFrame, shards: int | None = None) -> DataFrame:
    """The mixed rows: the columns of ``docs`` once for each copy taken, then mix_copy, mix_shard, mix_part and mix_key.

    Columns of ``docs`` with those names are replaced.
    """
    rows, placed = _placed(docs.drop(*PLACES), shards)
    return rows.join(placed, "rid").select("row.*", *PLACES)


def shuffled(docs: DataFrame, shards: int | None = None) -> DataFrame:
    """The columns of ``docs``, once for each copy taken: every part of a shard in a partition, in the order of its keys."""
    rows, placed = _placed(docs, shards)
    last = placed.agg(F.max("mix_shard").alias("shard"), F.max("mix_part").alias("part")).first()
    files = (last["shard"] + 1) * (last["part"] + 1) if last["shard"] is not None else 1
    rows = rows.join(placed, "rid").repartition(files, "mix_shard", "mix_part").sortWithinPartitions("mix_shard", "mix_part", "mix_key")
    return rows.select("row.*")


def mixed(docs: DataFrame, shards: int | None = None) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, and taken: its words in the copies dealt to all shards."""
    rows = drawn(docs.select("doc_id", "source", "text"))
    dealt = dealt_copies(rows, shards).groupBy("rid").agg(F.count("*").alias("dealt"))
    return rows.join(dealt, "rid", "left").select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.coalesce("dealt", F.lit(0))).alias("taken"),
    )
