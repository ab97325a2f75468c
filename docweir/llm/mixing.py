"""Mixing sources to target weights by a low-discrepancy schedule of equal-token blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from docweir.llm.common import WORD, checkpointed, read

#: Places of the hash order that shuffles a source.
TURNS = 1 << 32

#: Weights dealt to the sources in turn, the share of all words that is mixed, and how often a source may repeat.
WEIGHTS, SHARE, REPEATS = (3, 1, 2), 1.5, 2
#: Words of a block, which is what a slot of the schedule takes.
BLOCK_WORDS = 512
#: Up to so many sources their table is broadcast; beyond, it is joined by shuffle.
BROADCAST_SOURCES = 10_000
#: Slot k falls at k * STEP mod 2^31: STEP is the odd number nearest to 2^31 over the golden ratio.
POINTS, STEP = 1 << 31, 1_327_217_885
_CELL = 1 << 19


def _count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, repeats: int = REPEATS) -> DataFrame:
    """Targets of (source, source_size): source, source_size, sid, target, total.

    Sources in the order of their code points, null last, take the weights in turn. A target is its
    weight's part of share * all sizes, at most repeats * the source's size; the excess is shared
    anew by weight. That fixed point has a closed form: sources sorted by size per weight are capped
    from the smallest on, up to the first whose part of what is then left fits. One row per source
    passes through the ungrouped windows.
    """
    order = W.orderBy(F.col("source").isNull(), "source")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("sid") % len(weights) + 1).cast("int")).cast("double")
    cap = F.col("source_size") * float(repeats)
    rows = sizes.withColumn("sid", F.row_number().over(order) - 1).withColumns({"w": weight, "cap": cap})
    whole = W.partitionBy(F.lit(0))
    tight = whole.orderBy(F.col("cap") / F.col("w"), "sid")
    before, after = tight.rowsBetween(W.unboundedPreceding, -1), tight.rowsBetween(0, W.unboundedFollowing)
    rows = rows.withColumns({"goal": F.sum("source_size").over(whole) * share, "total": F.sum("source_size").over(whole)})
    level = (F.col("goal") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("w").over(after)
    rows = rows.withColumn("level", level)
    fits = F.max(F.when(F.col("level") * F.col("w") <= F.col("cap"), F.col("level"))).over(whole)
    return rows.select("source", "source_size", "sid", F.least("cap", F.coalesce(fits * F.col("w"), F.col("cap"))).alias("target"), "total")


def _ranked(df: DataFrame, group: list[str], coarse: str, order: list[str], amount: str | None, name: str) -> DataFrame:
    """df with `name`: how much (rows, or the sum of amount) stands before a row in its group.

    In two levels: sums per (group, coarse) and then within, so that no task holds a whole group.
    coarse must agree with the order.
    """
    one = F.col(amount) if amount else F.lit(1)
    cells = df.groupBy(*group, coarse).agg(F.sum(one).alias("_all"))
    ahead = W.partitionBy(*group).orderBy(coarse).rowsBetween(W.unboundedPreceding, -1)
    cells = cells.select(*group, coarse, F.coalesce(F.sum("_all").over(ahead), F.lit(0)).alias("_ahead"))
    inner = W.partitionBy(*group, coarse).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    within = df.withColumn("_within", F.coalesce(F.sum(one).over(inner), F.lit(0)))
    return within.join(cells, [*group, coarse]).withColumn(name, F.col("_ahead") + F.col("_within")).drop("_ahead", "_within")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, repeats: int = REPEATS, block_words: int = BLOCK_WORDS, seed: int = 11) -> DataFrame:
    """One row per row of docs: id, size, source_size, target, taken, first_slot, slots.

    size counts words (null text: 0). Each source's documents, in a seeded hash order, are one stream
    of words, played repeats times over and cut into blocks of block_words. The schedule has as many
    slots as the targets have blocks: slot k maps the point k * golden ratio mod 1 through the
    cumulative targets to a source, and the r-th slot of a source plays block r of its stream, the
    last one only up to the target. The points give each source its blocks but for a few (their
    discrepancy, which grows with the logarithm of the slots): a source's slots beyond its blocks are
    empty, and the blocks that it lacks are played behind all drawn slots. taken is the sum of what
    the slots play of a document, at most repeats * size; first_slot is the first of them (null: none)
    and slots is how many there are.

    A source whose target isn't a whole number takes it rounded. Null sources are one source, ranked
    last; rows without words take nothing; repeated rows are rows of their own. An empty table gives
    no rows.

    Nothing but narrow rows is shuffled, and no task holds a whole source: ranks and prefix sums run
    in two levels of about the square root of the rows each.
    """
    narrow = checkpointed(docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), _count(F.col(text_col)).alias("size")))
    targets = checkpointed(source_targets(narrow.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("_rows")).drop("_rows"), weights, share, repeats))
    quota = F.round("target").cast("long")
    blocks = F.ceil(quota / block_words).cast("long")
    facts = targets.agg(F.count(F.lit(1)), F.sum(blocks)).first()
    count, slots = facts[0], facts[1] or 0
    rows = narrow.count()
    spark = docs.sparkSession
    if not count:
        none = F.lit(0).cast("long")
        return narrow.select(F.col("id").alias(id_col), "size", none.alias("source_size"), F.lit(0.0).alias("target"), none.alias("taken"), F.lit(None).cast("long").alias("first_slot"), none.alias("slots"))
    small = F.broadcast(targets) if count <= BROADCAST_SOURCES else targets
    known = narrow.join(small.drop("total"), narrow["source"].eqNullSafe(small["source"])).drop("source")

    # The schedule: a source's lane is its part of the points.
    upper = F.sum("target").over(W.partitionBy(F.lit(0)).orderBy("sid"))
    lanes = targets.withColumn("hi", upper).withColumn("all", F.sum("target").over(W.partitionBy(F.lit(0))))
    lanes = lanes.where("target > 0").select("sid", quota.alias("quota"), blocks.alias("need"), F.floor((F.col("hi") - F.col("target")) / F.col("all") * POINTS).alias("lo"), F.when(F.col("hi") >= F.col("all"), POINTS).otherwise(F.floor(F.col("hi") / F.col("all") * POINTS)).alias("hi"))
    cells = lanes.where("hi > lo").withColumn("cell", F.explode(F.sequence(F.floor(F.col("lo") / _CELL), F.floor((F.col("hi") - 1) / _CELL))))
    drawn = spark.range(slots).select(F.col("id").alias("slot"), (F.col("id") % POINTS * STEP % POINTS).alias("point")).withColumn("cell", F.floor(F.col("point") / _CELL))
    schedule = drawn.join(F.broadcast(cells) if count <= BROADCAST_SOURCES else cells, "cell").where("point >= lo and point < hi")
    run = max(1, int(slots**0.5))
    schedule = schedule.select("sid", "slot", "quota", "need", F.floor(F.col("slot") / run).alias("stretch"))
    schedule = _ranked(schedule, ["sid"], "stretch", ["slot"], None, "block").select("sid", "slot", "block", "quota", "need")
    have = schedule.groupBy("sid").agg(F.count(F.lit(1)).alias("have"))
    short = lanes.join(have, "sid", "left").withColumn("have", F.coalesce("have", F.lit(0))).where("need > have")
    short = short.withColumn("block", F.explode(F.sequence("have", F.col("need") - 1)))
    # Sources that lack blocks take turns behind the drawn slots.
    short = short.select("sid", (slots + (F.col("block") - F.col("have")) * count + F.col("sid")).alias("slot"), "block", "quota", "need")
    schedule = schedule.unionByName(short).where("block < need").select("sid", "slot", "block", F.least(F.lit(block_words).cast("long"), F.col("quota") - F.col("block") * block_words).alias("take"))

    # The streams: a bucket is a stretch of the hash order, and each has about the square root of the rows.
    buckets = max(1, int(rows**0.5))
    digits = F.sha2(F.concat_ws(":", F.lit(str(seed)), F.col("id").cast("string")).cast("binary"), 256)
    mixed = known.withColumn("turn", F.conv(F.substring(digits, 1, 8), 16, 10).cast("long"))
    mixed = mixed.withColumn("bucket", F.floor(F.col("turn") * buckets / TURNS))
    placed = _ranked(mixed, ["sid"], "bucket", ["turn", "id", "size"], "size", "start")
    nth = F.row_number().over(W.partitionBy("sid", "bucket").orderBy("turn", "id", "size"))
    placed = placed.withColumn("nth", nth)
    ends = F.col("begin") + F.col("size")
    pieces = placed.withColumn("round", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1)))).withColumn("begin", F.col("start") + F.col("round") * F.col("source_size"))
    last = F.floor((F.greatest(ends, F.col("begin") + 1) - 1) / block_words)
    pieces = pieces.withColumn("block", F.explode(F.sequence(F.floor(F.col("begin") / block_words), last)))
    pieces = pieces.withColumns({"from": F.greatest(F.col("begin"), F.col("block") * block_words), "to": F.least(ends, (F.col("block") + 1) * block_words)})
    met = pieces.join(schedule, ["sid", "block"], "left")
    got = F.greatest(F.lit(0).cast("long"), F.least(F.col("to"), F.col("block") * block_words + F.coalesce("take", F.lit(0))) - F.col("from"))
    met = met.withColumn("got", got)
    keys = ["sid", "bucket", "nth", "id", "size", "source_size", "target"]
    played = F.col("got") > 0
    out = met.groupBy(*keys).agg(F.sum("got").alias("taken"), F.min(F.when(played, F.col("slot"))).alias("first_slot"), F.count_if(played).alias("slots"))
    return out.select(F.col("id").alias(id_col), "size", "source_size", "target", "taken", "first_slot", "slots")


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, with what the mix takes of each."""
    return mix(read(spark, sf_dir, "documents"))


#: Written from the contract, with its own numbers. What the slots play of a source is its stream up
#: to the target, so taken needs no schedule; first_slot and slots do.
SQL = r"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
o AS (SELECT *, row_number() OVER (ORDER BY source IS NULL, source) - 1 AS sid FROM s),
w AS (SELECT *, CAST([3, 1, 2][sid % 3 + 1] AS DOUBLE) AS w, source_size * 2.0::DOUBLE AS cap FROM o),
l AS (SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(cap) OVER (ORDER BY cap / w, sid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / sum(w) OVER (ORDER BY cap / w, sid ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
t AS (SELECT source, source_size, sid, least(cap, coalesce(max(CASE WHEN level * w <= cap THEN level END) OVER () * w, cap)) AS target FROM l),
q AS (SELECT *, CAST(round(target) AS BIGINT) AS quota, CAST(ceil(round(target) / 512) AS BIGINT) AS need, sum(target) OVER (ORDER BY sid) AS upto, sum(target) OVER () AS al FROM t),
lanes AS (SELECT sid, quota, need, floor((upto - target) / al * 2147483648) AS lo, CASE WHEN upto >= al THEN 2147483648 ELSE floor(upto / al * 2147483648) END AS hi FROM q WHERE target > 0),
n AS (SELECT CAST(sum(need) AS BIGINT) AS slots, count(*) AS sources FROM (SELECT need FROM q)),
drawn AS (SELECT k AS slot, k * 1327217885 % 2147483648 AS point FROM (SELECT unnest(range(slots)) AS k FROM n)),
p AS (SELECT sid, slot, quota, need, row_number() OVER (PARTITION BY sid ORDER BY slot) - 1 AS block FROM drawn JOIN lanes ON point >= lo AND point < hi),
h AS (SELECT l.sid, l.need, coalesce(c, 0) AS have FROM lanes l LEFT JOIN (SELECT sid, count(*) AS c FROM p GROUP BY sid) USING (sid)),
plan AS (SELECT sid, slot, block FROM p WHERE block < need
 UNION ALL SELECT sid, slots + (block - have) * sources + sid, block FROM (SELECT sid, have, unnest(range(have, need)) AS block FROM h WHERE need > have), n),
turns AS (SELECT doc_id, size, source_size, target, quota, sid, row_number() OVER () AS r, CAST('0x' || substr(sha256('11:' || doc_id), 1, 8) AS BIGINT) AS turn FROM d JOIN q ON q.source IS NOT DISTINCT FROM d.source),
st AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY sid ORDER BY turn, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM turns),
b AS (SELECT *, unnest([start, start + source_size]) AS begin FROM st),
g AS (SELECT *, greatest(0, least(begin + size, quota) - begin) AS got FROM b),
e AS (SELECT r, sid, unnest(range(CAST(begin // 512 AS BIGINT), CAST((begin + got - 1) // 512 + 1 AS BIGINT))) AS block FROM g WHERE got > 0),
f AS (SELECT r, min(slot) AS first_slot, count(*) AS slots FROM e JOIN plan USING (sid, block) GROUP BY r),
k AS (SELECT r, doc_id, size, source_size, target, CAST(sum(got) AS BIGINT) AS taken FROM g GROUP BY r, doc_id, size, source_size, target)
SELECT doc_id, size, source_size, target, taken, CAST(first_slot AS BIGINT) AS first_slot, CAST(coalesce(slots, 0) AS BIGINT) AS slots FROM k LEFT JOIN f USING (r)
"""
