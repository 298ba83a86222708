"""Mixing sources to target weights by pivotal dependent rounding.

A source's documents all get the same expected number of copies, target / size of the source.
Its whole part is taken; the fraction is rounded so that the words taken stay at the target:
two sides trade mass, in words, until one is integral; the trade's direction is drawn so that
each fraction keeps its expectation. In the first blocks a document's partner is the pool of all
smaller ones, above them it is one other residual. What a block leaves is one fractional
document, the residual; residuals are paired again in blocks, level by level, up to one per source: a reduction tree whose blocks are shuffled groups of bounded expected size, so a
source with a third of all rows is spread over many tasks. Only DataFrame functions are used.

All draws are hashes of doc_ids and the level, so reruns agree. Defined results: a null text has
size 0; documents of size 0 are taken 0 words; null is a source of its own, last in order;
repeated rows are rounded each on its own; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, in_order, numbered, pick, saved, text_key

#: Weights by position of the source in code point order.
WEIGHTS = (1.0, 2.0, 3.0)
MAX_COPIES = 3
#: Expected documents in a block of the reduction tree.
BLOCK = 256
SEED = 20_240_501
EPS = 1e-9


def sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, source, text_key, size), one row per document; size counts the words."""
    return pick(docs, "doc_id", "source", "text").select(
        "doc_id", "source", text_key(F.col("text")).alias("text_key"),
        F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long").alias("size"),
    )


def targets(sized: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """(source, n, source_size, target): one row per source.

    Targets share the total by weight, at most ``max_copies`` times the source's size; the
    excess is shared again by weight until no source is above. That ends where target =
    min(cap, level * weight) for one level: with sources sorted by cap / weight, those below
    the level are capped, which running sums over the sources find at once.
    """
    by_source = sized.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("source_size"))
    every = Window.partitionBy()
    position = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.get(F.array(*(F.lit(float(w)) for w in weights)), F.pmod(position, F.lit(len(weights))).cast("int"))
    ranked = by_source.withColumn("weight", weight).withColumn("cap", (F.col("source_size") * max_copies).cast("double"))
    at = F.col("cap") / F.col("weight")
    before = Window.orderBy(at, F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    total = F.sum("source_size").over(every).cast("double")
    capped, shared = F.coalesce(F.sum("cap").over(before), F.lit(0.0)), F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    level = (total - capped) / (F.sum("weight").over(every) - shared)
    # the level if all earlier sources are capped; the first source that stays
    # below its cap has the true one, those after it lower ones
    tried = ranked.withColumn("level", level).withColumn("open", at >= F.col("level"))
    true_level = F.max(F.when(F.col("open"), F.col("level"))).over(every)
    return tried.withColumn("target", F.when(F.col("source_size") == 0, 0.0).otherwise(F.least("cap", F.coalesce(true_level * F.col("weight"), F.col("cap"))))).select(
        "source", "n", "source_size", "target"
    )


def _draw(*keys: Column) -> Column:
    """A number in [0, 1) from a hash."""
    return F.shiftrightunsigned(F.xxhash64(*keys, F.lit(SEED)), 11).cast("double") * F.lit(2.0**-53)


def _let(value: Column, use) -> Column:
    """``use`` of a value that is evaluated once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _no_keys() -> Column:
    return F.array().cast("array<bigint>")


def _pivot_pool(items: Column) -> Column:
    """Round a block of (key, order, size, mass) with one common fraction, largest size first.

    Each document in turn trades mass with the pool of all smaller ones, whose fractions stay
    equal to each other: drawn so that its expectation stays, it ends at 0 or full, or, if the
    pool cannot take that much, the pool does and the document stays open. So the document
    that a block leaves open is as a rule one of its smallest. Same result as :func:`_pivot`.
    """
    opened = F.struct(F.get(items, F.lit(0))["key"].alias("key"), F.get(items, F.lit(0))["order"].alias("order"), F.lit(0.0).alias("size"), F.lit(0.0).alias("mass"))
    total = lambda name: F.aggregate(items, F.lit(0.0), lambda a, x: a + x[name])
    state = F.struct(total("mass").alias("mass"), total("size").alias("size"), F.lit(0).alias("mode"), opened.alias("open"), _no_keys().alias("up"))

    def trade(acc: Column, x: Column) -> Column:
        own = F.least(acc["mass"] / acc["size"], F.lit(1.0)) * x["size"]
        sides = _let(
            F.struct(own.alias("own"), (x["size"] - own).alias("rest"), F.greatest(acc["mass"] - own, F.lit(0.0)).alias("pool"), F.greatest(acc["size"] - x["size"], F.lit(0.0)).alias("left")),
            lambda v: F.struct(
                v["own"].alias("own"), v["rest"].alias("rest"), v["pool"].alias("pool"), v["left"].alias("left"),
                F.least(v["rest"], v["pool"]).alias("gain"), F.least(v["own"], F.greatest(v["left"] - v["pool"], F.lit(0.0))).alias("give"),
            ),
        )

        def settle(v: Column) -> Column:
            wins = _draw(x["order"], F.lit(-2)) * (v["gain"] + v["give"]) < v["give"]
            up, down = wins & (v["rest"] <= v["pool"]), ~wins & (v["own"] <= v["give"])
            mass = F.when(wins, v["own"] + v["gain"]).otherwise(v["own"] - v["give"])
            return F.struct(
                F.when(up, v["pool"] - v["rest"]).otherwise(v["pool"] + v["own"]).alias("mass"),
                v["left"].alias("size"),
                # 1: the pool is down, 2: the pool is full
                F.when(up | down, F.lit(0)).when(wins, F.lit(1)).otherwise(F.lit(2)).alias("mode"),
                F.when(up | down, acc["open"]).otherwise(F.struct(x["key"].alias("key"), x["order"].alias("order"), x["size"].alias("size"), mass.alias("mass"))).alias("open"),
                F.concat(acc["up"], F.when(up, F.array(x["key"])).otherwise(_no_keys())).alias("up"),
            )

        rest_up = F.struct(
            acc["mass"].alias("mass"), acc["size"].alias("size"), acc["mode"].alias("mode"), acc["open"].alias("open"),
            F.concat(acc["up"], F.when(acc["mode"] == 2, F.array(x["key"])).otherwise(_no_keys())).alias("up"),
        )
        return F.when(acc["mode"] == 0, _let(sides, settle)).otherwise(rest_up)

    return F.aggregate(items, state, trade, lambda acc: F.struct(acc["open"].alias("open"), acc["up"].alias("up")))


def _pivot(items: Column, level: int) -> Column:
    """Trade mass along an array of (key, order, size, mass): struct of the ``open`` residual and ``up``.

    ``open`` is the document still fractional after meeting all others in turn, ``up`` the keys
    of those rounded up; all others are rounded down. The moves keep every expectation, and the
    sum of masses (mass = fraction * size).
    """
    state = F.struct(F.get(items, F.lit(0)).alias("open"), _no_keys().alias("up"))

    def meet(acc: Column, b: Column) -> Column:
        a = acc["open"]
        rest_a, rest_b = a["size"] - a["mass"], b["size"] - b["mass"]
        to_a, to_b = F.least(rest_a, b["mass"]), F.least(a["mass"], rest_b)
        wins = _draw(a["order"], b["order"], F.lit(level)) * (to_a + to_b) < to_b
        # a gets to_a if it wins, else gives to_b; then a or b is 0 or full, exactly one side may stay open
        mass_a = F.when(wins, a["mass"] + to_a).otherwise(a["mass"] - to_b)
        mass_b = F.when(wins, b["mass"] - to_a).otherwise(b["mass"] + to_b)
        full_a = F.when(wins, rest_a <= b["mass"]).otherwise(F.lit(False))
        zero_a = F.when(wins, F.lit(False)).otherwise(a["mass"] <= rest_b)
        full_b = F.when(wins, F.lit(False)).otherwise(rest_b <= a["mass"])
        settled_a = full_a | zero_a
        keep = F.when(
            settled_a, F.struct(b["key"].alias("key"), b["order"].alias("order"), b["size"].alias("size"), mass_b.alias("mass"))
        ).otherwise(F.struct(a["key"].alias("key"), a["order"].alias("order"), a["size"].alias("size"), mass_a.alias("mass")))
        up = F.when(full_a, F.array(a["key"])).when(~settled_a & full_b, F.array(b["key"])).otherwise(_no_keys())
        return F.struct(keep.alias("open"), F.concat(acc["up"], up).alias("up"))

    return F.aggregate(F.slice(items, F.lit(2), F.greatest(F.size(items) - 1, F.lit(0))), state, meet)


def with_spread(rows: DataFrame) -> DataFrame:
    """``rows`` (source, order, row, ...) with ``spread``: 0, 1, 2... among the rows that repeat a document
    within a source, 0 for all others. Which of the equal rows gets which number does not matter, and
    the numbers do not depend on the partitions."""
    repeated = saved(rows.groupBy(F.col("order").alias("r_order")).agg(F.count(F.lit(1)).alias("same")).filter("same > 1").select("r_order"))
    if repeated.isEmpty():
        return rows.withColumn("spread", F.lit(0).cast("long"))
    again = rows.join(repeated, F.col("order") == F.col("r_order"), "left_semi").select("source", "order", "row")
    placed = saved(in_order(again, [F.col("source").asc_nulls_last(), F.col("order"), F.col("row")], "place"))
    first = placed.groupBy(F.col("source").alias("f_source"), F.col("order").alias("f_order")).agg(F.min("place").alias("first"))
    spread = placed.join(first, F.col("source").eqNullSafe(F.col("f_source")) & (F.col("order") == F.col("f_order"))).select(
        F.col("row").alias("s_row"), (F.col("place") - F.col("first")).alias("spread")
    )
    return rows.join(spread, F.col("row") == F.col("s_row"), "left").withColumn("spread", F.coalesce("spread", F.lit(0).cast("long"))).drop("s_row")


def copies(sized: DataFrame, by_source: DataFrame) -> DataFrame:
    """``sized`` with row (a number for each), n, source_size, target and ``copies`` (long)."""
    salts = 64
    # each source's row once per salt: a hot source's documents go to as many tasks
    salted = by_source.withColumn("b_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))).withColumnRenamed("source", "b_source")
    order = F.xxhash64("doc_id", "text_key", F.lit(SEED))
    rows = saved(sized.withColumn("order", order).withColumn("row", F.monotonically_increasing_id()))
    # rows that repeat doc_id and text have one order; their numbers spread them over blocks
    rows = saved(with_spread(rows))
    share = saved(
        rows.withColumn("salt", F.pmod("row", F.lit(salts)).cast("int"))
        .join(salted, F.col("source").eqNullSafe(F.col("b_source")) & (F.col("salt") == F.col("b_salt")))
        .select(*rows.columns, "n", "source_size", "target")
        .withColumn("expected", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
        .withColumn("whole", F.floor(F.col("expected") + EPS).cast("long"))
        .withColumn("mass", F.greatest(F.col("expected") - F.col("whole"), F.lit(0.0)) * F.col("size"))
    )
    # a residual keeps its source's count of open rows, so every level knows its number of blocks
    live = share.filter(f"size > 0 AND mass > {EPS} * size").select("source", "n", "order", "spread", "row", F.col("size").cast("double").alias("size"), "mass")
    most, level, raised = by_source.agg(F.max("n")).first()[0] or 0, 0, None
    while True:
        blocks = F.greatest(F.ceil(F.col("n") / F.lit(float(BLOCK ** (level + 1)))), F.lit(1))
        # equal documents may be left with unlike masses: the mass comes before the row's number, which is one of chance
        item = F.struct((-F.col("size")).alias("by"), "order", "mass", "row", "size")
        ordered = F.transform(F.sort_array(F.collect_list(item)), lambda x: F.struct(x["row"].alias("key"), x["order"].alias("order"), x["size"].alias("size"), x["mass"].alias("mass")))
        block = F.pmod(F.xxhash64("order", "spread", F.lit(level)), blocks).alias("block")
        paired = saved(
            live.groupBy("source", "n", block).agg(ordered.alias("items"))
            .select("source", "n", (_pivot(F.col("items"), level) if level else _pivot_pool(F.col("items"))).alias("p"))
        )
        up = paired.select(F.explode("p.up").alias("row"))
        raised = up if raised is None else raised.unionByName(up)
        rest = paired.select("source", "n", F.col("p.open.key").alias("row"), F.col("p.open.order").alias("order"), F.col("p.open.size").alias("size"), F.col("p.open.mass").alias("mass"))
        # a block that settles exactly leaves no document open: its place is held by one of size 0
        rest = rest.filter("size > 0")
        if most <= BLOCK ** (level + 1):
            break
        whole = rest.filter(F.col("mass") >= F.col("size") * (1 - EPS)).select("row")
        raised = raised.unionByName(whole)
        live = rest.filter((F.col("mass") > F.col("size") * EPS) & (F.col("mass") < F.col("size") * (1 - EPS))).select(
            "source", "n", "order", F.lit(0).cast("long").alias("spread"), "row", "size", "mass"
        )
        level += 1
    last = rest.filter(_draw(F.col("order"), F.lit(-1)) * F.col("size") < F.col("mass")).select("row")
    raised = raised.unionByName(last).withColumnRenamed("row", "up_row")
    return share.join(raised, F.col("row") == F.col("up_row"), "left").withColumn(
        "copies", F.col("whole") + F.when(F.col("up_row").isNotNull(), 1).otherwise(0)
    )


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """doc_id, text_key, source, size, source_size, target, copies, taken; a row per document."""
    sized = saved(sizes(docs))
    by_source = saved(targets(sized, weights, max_copies))
    return copies(sized, by_source).select(
        "doc_id", "text_key", "source", "size", "source_size", "target", "copies",
        (F.col("copies") * F.col("size")).alias("taken"),
    )


def mixed(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """The documents of the mix: each row as often as it is taken, with all its columns.

    Rows that repeat doc_id, source and text share their copies, the sum over them; where they
    differ in other columns, the smallest by those stands for the others.
    """
    plan = saved(mix(docs, weights, max_copies))
    per_key = saved(plan.groupBy("doc_id", "source", "text_key").agg(F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("rows")))
    keys = per_key.select(F.col("doc_id").alias("k_id"), F.col("source").alias("k_source"), F.col("text_key").alias("k_key"), "copies", "rows")
    table, name = numbered(docs)
    joined = table.withColumn("k_text", text_key(F.col(name["text"]))).join(
        keys,
        F.col(name["doc_id"]).eqNullSafe(F.col("k_id")) & F.col(name["source"]).eqNullSafe(F.col("k_source")) & (F.col("k_text") == F.col("k_key")),
    )
    columns = list(table.columns)
    emit = lambda df, times: df.select(*columns, F.explode(F.array_repeat(F.lit(1), times)).alias("copy")).select(*columns)
    single = emit(joined.filter("rows = 1"), F.col("copies").cast("int"))
    # repeated rows: a few tasks share a key, each emits its part of the copies by running counts
    several = joined.filter("rows > 1").withColumn("salt", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(64)))
    key = ["k_id", "k_source", "k_key", "copies", "rows"]
    others = F.to_json(F.struct(*(F.col(c) for c in columns if c != name["text"])))
    parts = several.groupBy(*key, "salt").agg(F.min_by(F.struct(*columns), others).alias("kept"), F.count(F.lit(1)).alias("own"))
    end = F.sum("own").over(Window.partitionBy(*key).orderBy("salt"))
    upto = lambda n: F.floor(F.col("copies") * n / F.col("rows"))
    parts = parts.withColumn("end", end).withColumn("times", (upto(F.col("end")) - upto(F.col("end") - F.col("own"))).cast("int"))
    spread = parts.select("kept", F.explode(F.array_repeat(F.lit(1), F.col("times"))).alias("copy")).select("kept.*")
    return single.unionByName(spread).toDF(*docs.columns)
