"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source asks for the same number of copies f = target /
source size. The whole part is taken; the fraction is a copy probability.
Pairs move probability mass, counted in words, from one to the other until one
of the two is integral: the words expected from the pair stay what they were.
A pair is the longest fractional document of a block and the block's other
ones, taken as one unit whose members rise or fall together. Between two single
documents the shorter would always be integral first, and the longest be left
to the end; against a unit the longest is settled first. One fractional
document is left of each block, its shortest as a rule, and blocks combine
their leftovers in a reduction tree until one is left per source, which is
rounded by a coin. A source's words then miss its target by less than that
document.

DataFrame functions only. Blocks are dealt by a hash of document and level,
so a source with a third of all rows spreads over many blocks, and no block
outgrows ``fan`` times a small factor.

Defined cases: null text or one without words has size 0 and takes 0 words;
null source is a source of its own, last in order; rows equal in doc_id,
source and text share their copies evenly, the odd ones going to the first of
them; an empty table gives no rows; other columns are carried, whatever their
names, or ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import cut, word_count

WEIGHTS = (5, 2, 1)
MAX_COPIES = 3
FAN = 64
#: Size stands first: blocks settle their long documents first.
KEY = ["size", "mix_hash", "doc_id", "source"]


def ranked(sources: DataFrame) -> DataFrame:
    """Adds rank, from 0: the sources' order by code point, null last. Ranges
    of sources are sorted apart; only their sizes, a row a partition, meet."""
    order = [F.col("source").isNull(), F.col("source")]
    r = sources.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("id", F.monotonically_increasing_id())
    r = cut(r, "mix-ranked").withColumn("part", F.shiftrightunsigned("id", 33))
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    parts = r.groupBy("part").agg(F.count("*").alias("n"))
    parts = parts.select(F.col("part").alias("r_part"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    at = F.col("start") + F.col("id").bitwiseAND(F.lit((1 << 33) - 1))
    return r.join(F.broadcast(parts), F.col("part") == F.col("r_part")).withColumn("rank", at).drop("id", "part", "r_part", "start")


def source_targets(sources: DataFrame, weights=WEIGHTS, cap: int = MAX_COPIES) -> DataFrame:
    """(source, source_size) -> source, source_size, target.

    Shares are level * weight. Sources whose share is above cap * size stop
    there, and the level of the others rises by what these leave, until no
    more stop: one sum over the sources a round.
    """
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    s = ranked(cut(sources.select("source", "source_size"), "mix-sources"))
    s = s.select("source", "source_size", weight.alias("weight"), (F.lit(float(cap)) * F.col("source_size")).alias("most"))
    level, stopped = 0.0, -1
    while True:
        stops = (F.col("most") <= level * F.col("weight")) if stopped >= 0 else F.lit(False)
        now = s.agg(F.count_if(stops), F.sum(F.col("source_size").cast("double")), F.sum(F.when(stops, F.col("most"))), F.sum(F.when(~stops, F.col("weight")))).first()
        if now[0] == stopped or not now[3]:
            return s.select("source", "source_size", F.least("most", level * F.col("weight")).alias("target"))
        level, stopped = (now[1] - (now[2] or 0.0)) / now[3], now[0]


def _uniform(*parts: Column) -> Column:
    """A fixed draw in [0, 1) from the given values."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11).cast("double") / F.lit(float(1 << 53))


def _pivot(level: int, seed: int):
    """The merge of F.aggregate over a block's documents, longest first.

    The state has the document left, those that are integral, and about the
    unit of those still to come: their words ``words``, their mass ``mass`` by
    their first probabilities, and what all of these have become: a * p + b.
    """

    def merge(state: Column, x: Column) -> Column:
        a, b, size = state["a"], state["b"], x["size"].cast("double")
        words, mass = state["words"] - size, state["mass"] - x["p"] * size
        p = F.least(F.greatest(a * x["p"] + b, F.lit(0.0)), F.lit(1.0))
        unit_mass = F.least(F.greatest(a * mass + b * words, F.lit(0.0)), words)
        unit_room = words - unit_mass
        up, down = F.least((1 - p) * size, unit_mass), F.least(p * size, unit_room)
        rises = _uniform(x["mix_hash"], x["doc_id"], F.lit(level), F.lit(seed)) * (up + down) < down
        # The share of the unit's mass, or room, that moves; 1 settles the unit.
        share = F.when(rises, F.coalesce(F.try_divide(up, unit_mass), F.lit(0.0))).otherwise(F.coalesce(F.try_divide(down, unit_room), F.lit(0.0)))
        settled = F.when(rises, (1 - p) * size <= unit_mass).otherwise(p * size <= unit_room)
        final = F.when(rises, F.when(settled, 1.0).otherwise(p + up / size)).otherwise(F.when(settled, 0.0).otherwise(p - down / size))

        def node(value: Column) -> Column:
            return F.struct(*[x[c].alias(c) for c in KEY], value.alias("p"))

        def next_state(left: Column, done: Column, a: Column, b: Column) -> Column:
            return F.struct(left.alias("left"), done.alias("done"), a.alias("a"), b.alias("b"), words.alias("words"), mass.alias("mass"))

        zero, kept = F.lit(0.0), 1 - share
        paired = F.when(settled, next_state(state["left"], F.concat(state["done"], F.array(node(final))), a * kept, b * kept + F.when(rises, zero).otherwise(share))).otherwise(next_state(node(final), state["done"], zero, F.when(rises, 0.0).otherwise(1.0)))
        # The unit was settled before: its members are what b says.
        member = next_state(state["left"], F.concat(state["done"], F.array(node(b))), zero, b)
        return F.when(state["left"].isNotNull(), member).when(words <= 0, next_state(node(p), state["done"], a, b)).otherwise(paired)

    return merge


def round_copies(units: DataFrame, fan: int = FAN, seed: int = 0) -> DataFrame:
    """(doc_id, source, mix_hash, size, p), 0 < p < 1 -> KEY, extra 0 or 1."""
    node = "struct<size:bigint,mix_hash:bigint,doc_id:bigint,source:string,p:double>"
    left = cut(units.select(*KEY, "p"), "mix-units")
    most = left.groupBy("source").count().agg(F.max("count")).first()[0] or 0
    decided, level = [], 0
    while most > 1:
        n = left.groupBy(F.col("source").alias("n_source")).agg(F.count("*").alias("n"))
        blocks = left.join(n, F.col("source").eqNullSafe(F.col("n_source"))).drop("n_source")
        block = F.pmod(F.xxhash64("mix_hash", "doc_id", F.lit(level), F.lit(seed)), F.ceil(F.col("n") / fan))
        folded = blocks.groupBy("source", block.alias("block")).agg(F.sort_array(F.collect_list(F.struct(*KEY, "p")), asc=False).alias("nodes"))
        total = F.expr("aggregate(nodes, 0e0, (t, x) -> t + x.size)"), F.expr("aggregate(nodes, 0e0, (t, x) -> t + x.p * x.size)")
        none = F.lit(None).cast(node), F.array().cast(f"array<{node}>")
        start = F.struct(none[0].alias("left"), none[1].alias("done"), F.lit(1.0).alias("a"), F.lit(0.0).alias("b"), total[0].alias("words"), total[1].alias("mass"))
        state = F.aggregate("nodes", start, _pivot(level, seed))
        folded = cut(folded.select(state.alias("s")), f"mix-level{level}")
        decided.append(folded.select(F.explode("s.done").alias("d")).select("d.*"))
        left = folded.select("s.left.*")
        most, level = left.groupBy("source").count().agg(F.max("count")).first()[0], level + 1
    extra = left.withColumn("p", (_uniform("mix_hash", "doc_id", F.lit(level), F.lit(seed)) < F.col("p")).cast("double"))
    for d in decided:
        extra = extra.unionByName(d)
    return extra.select(*KEY, (F.col("p") >= 0.5).cast("int").alias("extra"))


def mix_copies(docs: DataFrame, weights=WEIGHTS, cap: int = MAX_COPIES, fan: int = FAN, seed: int = 0) -> DataFrame:
    """One row per distinct (doc_id, source, text): KEY, source_size, target,
    rows (how often it stands in the table), copies (for all of them)."""
    size = word_count(F.col("text"))
    units = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), F.xxhash64("text").alias("mix_hash"), size.alias("size"))
    units = cut(units.groupBy(*KEY).agg(F.count("*").alias("rows")), "mix-sizes")
    sources = units.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("source_size"))
    targets = cut(source_targets(sources, weights, cap).withColumnRenamed("source", "t_source"), "mix-targets")
    units = units.join(targets, F.col("source").eqNullSafe(F.col("t_source"))).drop("t_source")
    asked = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(cap))) * F.col("rows")).otherwise(0.0)
    units = units.withColumn("asked", F.when(F.col("size") > 0, asked).otherwise(0.0))
    units = units.withColumn("whole", F.floor("asked")).withColumn("p", F.col("asked") - F.col("whole"))
    extra = round_copies(units.where("p > 0"), fan, seed)
    extra = extra.select(*[F.col(c).alias(f"x_{c}") for c in KEY], "extra")
    joined = units.join(extra, [F.col(c).eqNullSafe(F.col(f"x_{c}")) for c in KEY], "left")
    return joined.select(*KEY, "source_size", "target", "rows", (F.col("whole") + F.coalesce("extra", F.lit(0))).alias("copies"))


def mix_report(docs: DataFrame, **options) -> DataFrame:
    """One row per document row: doc_id, size, source_size, target, copies, taken."""
    m = mix_copies(docs, **options).select(*KEY, "source_size", "target", "rows", "copies")
    each = m.withColumn("i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))))
    each = each.withColumn("copies", F.floor(F.col("copies") / F.col("rows")) + (F.col("i") <= F.col("copies") % F.col("rows")).cast("long"))
    return each.select("doc_id", F.col("size"), "source", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def _numbered(rows: DataFrame) -> DataFrame:
    """Adds i, from 1, over equal documents. They may be a third of all rows, so
    each input partition's are numbered apart, after those of earlier ones."""
    group = ["doc_id", "source", "mix_hash"]
    before = W.partitionBy(*group).orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    n = rows.groupBy(*group, "part").agg(F.count("*").alias("n"))
    n = n.select(*[F.col(c).alias(f"n_{c}") for c in (*group, "part")], F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    own = F.row_number().over(W.partitionBy(*group, "part").orderBy("row_no"))
    j = rows.withColumn("own", own).join(n, [F.col(c).eqNullSafe(F.col(f"n_{c}")) for c in (*group, "part")])
    return j.withColumn("i", F.col("start") + F.col("own"))


def mix_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every document as many times as it is taken, all columns."""
    m = mix_copies(docs, **options).where("copies > 0").select("doc_id", "source", "mix_hash", "rows", "copies").alias("m")
    # The document travels as one column, so that no name can clash.
    key = [F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), F.xxhash64("text").alias("mix_hash")]
    d = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), *key, F.monotonically_increasing_id().alias("row_no")).alias("d")
    joined = d.join(m, [F.col(f"d.{c}").eqNullSafe(F.col(f"m.{c}")) for c in ("doc_id", "source", "mix_hash")]).select("d.*", "m.rows", "m.copies")
    once, often = joined.where("rows = 1"), joined.where("rows > 1")
    # Written, as numbers of partitions must not change between two readings.
    often = _numbered(cut(often.withColumn("part", F.shiftrightunsigned("row_no", 33)), "mix-often"))
    often = often.withColumn("copies", F.floor(F.col("copies") / F.col("rows")) + (F.col("i") <= F.col("copies") % F.col("rows")).cast("long")).select(once.columns)
    rows = once.unionByName(often).where("copies > 0")
    return rows.select("doc", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("i")).select("doc.*")
