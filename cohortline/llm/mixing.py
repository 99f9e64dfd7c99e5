"""Mixing sources to target weights by Pfair scheduling.

Each source's documents are cut into blocks of ``block_rows``. Block b (from
0) of a source with weight w is released at slot floor(b / w) and due by slot
ceil((b + 1) / w); in every slot the released block with the earliest deadline
goes next. For weights that add up to one this meets every window (Baruah et
al. 1996), so after any number of slots no source is a whole block away from
its target share.

With ``slots`` given (``op8_pfair_mix``, as its SQL defines it) weights are
rounded to turns of a period of that many slots. One period is computed once as
a list of choices (a SQL ``aggregate`` over the slots; its size does not depend
on the data). A document then needs only its rank in its source: block b runs in period
b div (w * slots), at the slot of that source's (b mod (w * slots))-th turn.
The bound holds for the rounded weights; a source's share is off by up to
(1 - n * w) / slots of the mix for n sources.

Without ``slots`` (the pipeline), or with more sources than slots, the weights
are taken as they are, for any number of sources (:func:`paths`): the sources are the leaves of
a binary tree, and every node deals its turns to its two children so that the
left one has had round(k * left / node) of the first k. An
error of half a turn at a node shrinks on the way down with the child's part of
it, so a source's distance from its target does not grow with the mix. Slot and
turn follow from each other by integer divisions along the path.

Everything is DataFrame expressions and SQL functions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortline.llm.common import fresh, stage

#: Slots in one period of ``op8_pfair_mix``, and the resolution of its weights.
SLOTS = 1024
#: The weights add up to about two to this power where they are not rounded to turns.
WEIGHT_BITS = 56
#: Up to this many sources their paths are broadcast; more are joined by a shuffle.
BROADCAST_SOURCES = 20_000
#: Documents in a block.
BLOCK_ROWS = 8
#: Default targets: a source's share of the documents to this power, normalised.
EXPONENT = 0.7
#: Documents that are ranked together in one task, on average.
RANK_ROWS = 20_000


def target_weights(docs: DataFrame, source_col: str = "source", exponent: float = EXPONENT) -> DataFrame:
    """``(source, weight)``: shares of the documents to the power ``exponent``."""
    counts = docs.groupBy(F.col(source_col).alias("source")).agg(F.count(F.lit(1)).alias("n"))
    return counts.select("source", F.pow(F.col("n").cast("double"), F.lit(exponent)).alias("weight"))


def quotas(weights: DataFrame, slots: int = SLOTS) -> DataFrame:
    """``(source, turns)`` and other columns of ``weights``: turns per period, by largest remainder.

    Weights need not be normalised. Every source with a positive weight gets
    one turn at least; the other turns go by the weights, remainders first,
    ties by source name. Null or non-positive weights get no turn. The number
    of sources is bounded by ``slots`` (:func:`mix` uses :func:`paths` beyond that, :func:`period`
    checks it), so the one-partition window here is over a bounded list.
    """
    total = Window.partitionBy(F.lit(1))
    order = total.orderBy(F.col("rest").desc(), F.col("source").asc_nulls_first())
    some = weights.where("weight > 0").withColumn("weight", F.col("weight").cast("double"))
    kept = [c for c in weights.columns if c != "weight"]
    free = F.lit(slots) - F.count(F.lit(1)).over(total)
    exact = some.select(*kept, (F.col("weight") / F.sum("weight").over(total) * free).alias("exact"))
    whole = exact.select(*kept, F.floor("exact").alias("whole"),
                         F.round(F.col("exact") - F.floor("exact"), 9).alias("rest"))
    left = (F.lit(slots) - F.sum(F.col("whole") + 1).over(total))
    return (whole.withColumn("left", left).withColumn("k", F.row_number().over(order))
            .select(*kept, (F.col("whole") + 1 + F.when(F.col("k") <= F.col("left"), 1).otherwise(0))
                    .cast("int").alias("turns")))


def period(turns: DataFrame, slots: int = SLOTS) -> DataFrame:
    """``(source, turn, slot)`` of one period: earliest deadline first.

    ``turns(source, turns)`` adds up to ``slots``. The state of the schedule
    is the number of turns each source has had; in slot t the sources whose
    next turn j is released (floor(j * slots / turns) <= t) compete by deadline
    ceil((j + 1) * slots / turns), ties by source name.
    """
    listed = turns.agg(F.array_sort(F.collect_list(F.struct(F.col("source").alias("s"), F.col("turns").alias("w"))))
                       .alias("w"))
    checked = listed.withColumn("w", F.when((F.size("w") == 0) | F.expr(f"aggregate(w, 0, (a, x) -> a + x.w) = {slots} and forall(w, x -> x.w > 0)"),
                                            F.col("w")).otherwise(
        F.raise_error(F.lit(f"more sources than the {slots} slots of a period"))))
    # State: turns had so far by source, and the sources chosen. Deadlines are
    # packed with the source's place so that least() breaks ties by name.
    done = "a.had[i]"
    due = f"(((({done} + 1) * {slots} + w[i].w - 1) div w[i].w) * {slots * 2} + i)"
    ready = f"(({done} * {slots}) div w[i].w) <= t"
    pick = (f"array_min(transform(filter(sequence(0, size(w) - 1), i -> {ready}), i -> {due})) % {slots * 2}")
    plan = checked.select("w", F.expr(f"""
        if(size(w) = 0, cast(array() as array<struct<place: bigint, turn: bigint>>), aggregate(
            sequence(0L, {slots - 1}L),
            named_struct('had', transform(w, x -> 0L), 'out', cast(array() as array<struct<place: bigint, turn: bigint>>)),
            (s, t) -> aggregate(
                array(named_struct('had', s.had, 'out', s.out)),
                s,
                (b, a) -> transform(array({pick}), p -> named_struct(
                    'had', transform(a.had, (n, i) -> if(i = p, n + 1, n)),
                    'out', concat(a.out, array(named_struct('place', p, 'turn', a.had[cast(p as int)])))))[0]),
            s -> s.out))""").alias("plan"))
    return (plan.select("w", F.posexplode("plan").alias("slot", "p"))
            .select(F.expr("w[cast(p.place as int)].s").alias("source"), F.col("p.turn").alias("turn"),
                    F.col("slot").cast("long").alias("slot")))


def paths(weights: DataFrame) -> DataFrame:
    """``path`` and other columns of ``weights(source, weight)``: each source's way from its
    leaf to the root, ``(a, t, right)`` per node: the weights of the child and of the node, and
    whether the child is the right one.

    The tree is that of the Gilbert-Moore code: the sources lie on a line by
    falling weight, and the binary digits of a source's middle, as many as keep it
    apart from its neighbours, lead to its leaf. Weights need not be normalised; they become whole
    numbers of about WEIGHT_BITS bits together, at least 1. Null or non-positive
    weights are left out.
    """
    every = Window.partitionBy(F.lit(1))
    kept = [c for c in weights.columns if c not in ("source", "weight")]
    share = F.col("weight").cast("double") / F.sum(F.col("weight").cast("double")).over(every)
    whole = (weights.where("weight > 0")
             .withColumn("w", F.greatest(F.lit(1), F.round(share * 2.0 ** WEIGHT_BITS).cast("long"))))
    line = whole.withColumn("all", F.sum("w").over(every)).withColumn(
        "cum", F.sum("w").over(every.orderBy(F.col("w").desc(), F.col("source").asc_nulls_first())
                               .rowsBetween(Window.unboundedPreceding, 0)))
    coded = line.withColumn("code", F.expr(
        f"cast(2 * cum - w as decimal(20, 0)) * cast({2 ** 61} as decimal(19, 0)) div cast(all as decimal(20, 0))"))
    deep = coded.withColumn("d", F.expr("explode(sequence(0, cast(ceil(log2(all / w) + 1e-9) as int) + 1))"))
    steps = deep.withColumn("p", F.expr("shiftright(code, 62 - d)"))
    nodes = steps.groupBy(F.col("d").alias("nd"), F.col("p").alias("np")).agg(F.sum("w").alias("a"))
    whole_path = (steps.join(nodes, F.expr("d = nd and p = np"))
                  .groupBy("source").agg(*(F.first(c).alias(c) for c in kept),
                                         F.array_sort(F.collect_list(F.expr("struct(-d as up, a, p % 2 = 1 as right)"))).alias("s")))
    return whole_path.select("source", *kept, F.expr(
        "filter(transform(sequence(0, size(s) - 2), i -> named_struct('a', s[i].a, 't', s[i + 1].a, 'right', s[i].right)), "
        "x -> x.a < x.t)").alias("path"))


def slot_of(block: str) -> str:
    """SQL: the slot of a source's block, up its ``path``."""
    odd = "cast(2 * k + 1 as decimal(20, 0)) * cast(x.t as decimal(18, 0))"
    twice = "cast(2 * x.a as decimal(19, 0))"
    return (f"aggregate(path, cast({block} as bigint), (k, x) -> if(x.right, {odd} div {twice}, "
            f"({odd} + {twice} - 1) div {twice} - 1))")


def blocks_by(slot: str) -> str:
    """SQL: a source's blocks in the first ``slot`` slots, down its ``path``."""
    left = ("(cast(2 * k as decimal(20, 0)) * cast({} as decimal(18, 0)) + cast(x.t as decimal(18, 0))) "
            "div cast(2 * x.t as decimal(19, 0))")
    return (f"aggregate(reverse(path), cast({slot} as bigint), (k, x) -> if(x.right, k - {left.format('x.t - x.a')}, "
            f"{left.format('x.a')}))")


def ranked(rows: DataFrame) -> DataFrame:
    """``rows(row, source, id)`` plus ``rank`` (from 0 in its source, in the order of the
    md5 of the id) and ``n`` (the source's documents).

    A source is dealt into 16^d equal ranges of the md5, d chosen so that a range
    holds about RANK_ROWS documents, and only ranges are sorted: a source with a
    third of all rows is spread over as many tasks as its size asks for. A range's
    offset is the number of documents in the ranges before it.
    """
    total, digits = rows.count(), 0
    while total > RANK_ROWS * 16 ** digits:
        digits += 1
    keyed = (rows.withColumn("md5", F.md5(F.coalesce(F.col("id").cast("string"), F.lit("")).cast("binary")))
             .withColumn("range", F.substring("md5", 1, digits) if digits else F.lit("")))
    counts = keyed.groupBy(F.col("source").alias("of"), F.col("range").alias("in")).agg(F.count(F.lit(1)).alias("c"))
    by_source = Window.partitionBy("of")
    offsets = counts.select("of", "in", F.sum("c").over(by_source).alias("n"),
                            (F.sum("c").over(by_source.orderBy("in")) - F.col("c")).alias("before"))
    ties = [F.col("row").getField(f.name) for f in rows.schema["row"].dataType.fields
            if "map" not in f.dataType.simpleString() and f.dataType.simpleString() != "variant"]
    inside = Window.partitionBy("source", "range").orderBy("md5", *ties)
    return (keyed.withColumn("at", F.row_number().over(inside) - 1)
            .join(offsets, F.col("source").eqNullSafe(F.col("of")) & (F.col("range") == F.col("in")))
            .select("row", "source", "n", (F.col("before") + F.col("at")).alias("rank")))


def mix(docs: DataFrame, weights: DataFrame | None = None, source_col: str = "source", id_col: str = "doc_id",
        block_rows: int = BLOCK_ROWS, slots: int | None = None) -> DataFrame:
    """``docs`` repeated and placed to the target weights.

    With ``slots`` the weights are rounded to turns of a period of that many
    slots, unless there are more sources than that; otherwise they are taken as they are.

    Adds ``source_block``, ``slot`` (of the block, from 0), ``epoch`` and ``position`` (of
    the document, ascending along the mix); where ``docs`` has a column of that
    name, underscores are added to the new one's. The mix is just long enough
    for every document of every source to appear: a source short of its share
    starts another epoch, so none is dropped. ``weights(source, weight)``
    defaults to :func:`target_weights`; a source it does not name, or names with
    a null or non-positive weight, is not part of the mix, and a named source
    without documents is left out. A null source is a source like any other.
    Rows with equal or null ids keep one place each, in the order of their
    columns. An empty table gives an empty mix.
    """
    rows = docs.select(F.struct("*").alias("row"), F.col(source_col).alias("source"), F.col(id_col).alias("id"))
    present = rows.groupBy(F.col("source").alias("present")).agg(F.count(F.lit(1)).alias("docs"))
    weights = target_weights(docs, source_col) if weights is None else weights
    named = (weights.groupBy("source").agg(F.sum("weight").alias("weight"))
             .join(present, F.col("source").eqNullSafe(F.col("present"))).select("source", "weight", "docs"))
    sources = stage(named.where("weight > 0"), "sources")
    many = sources.count()
    if slots is None or many > slots:
        placed = _unrounded(rows, sources, many, block_rows)
    else:
        placed = _in_periods(rows, sources, block_rows, slots)
    placed = placed.withColumn("position", F.expr(f"slot * {block_rows} + i % {block_rows}"))
    new = [F.col(c).alias(fresh(c, docs.columns)) for c in ("source_block", "slot", "epoch", "position")]
    return placed.select("row.*", *new)


def _epochs(placed: DataFrame, length: str, block_rows: int) -> DataFrame:
    """Adds ``epoch``, ``i`` (place among the source's repeated documents) and ``source_block``."""
    return (placed.withColumn("epoch", F.expr(f"explode(if(rank < {length}, "
                                              f"sequence(0L, ({length} - 1 - rank) div n), null))"))
            .withColumn("i", F.expr("epoch * n + rank")).withColumn("source_block", F.expr(f"i div {block_rows}")))


def _unrounded(rows: DataFrame, sources: DataFrame, many: int, block_rows: int) -> DataFrame:
    """The repeated rows with their slots, by the weights as they are."""
    ways = stage(paths(sources), "paths")
    # The mix ends with the slot in which the last source has shown all its documents.
    fin = ways.agg(F.max(F.expr(slot_of(f"(docs - 1) div {block_rows}")))).first()[0]
    have = ways.select(F.col("source").alias("turns_source"), "path",
                       F.expr(f"{blocks_by('0L' if fin is None else f'{fin + 1}L')} * {block_rows}").alias("length"))
    have = F.broadcast(have) if many <= BROADCAST_SOURCES else have
    placed = ranked(rows).join(have, F.col("source").eqNullSafe(F.col("turns_source")))
    return _epochs(placed, "length", block_rows).withColumn("slot", F.expr(slot_of("source_block")))


def _in_periods(rows: DataFrame, sources: DataFrame, block_rows: int, slots: int) -> DataFrame:
    """The repeated rows with their slots, by the turns of a period."""
    # Both staged tables have at most `slots` rows.
    turns = stage(quotas(sources, slots), "turns")
    plan = stage(period(turns.select("source", "turns"), slots), "period")
    order = plan.select(F.col("source").alias("plan_source"), F.col("turn").alias("plan_turn"),
                        F.col("slot").alias("plan_slot"))
    # The mix ends with the slot in which the last source has shown all its documents.
    last = (turns.withColumn("b", F.expr(f"(docs - 1) div {block_rows}"))
            .join(order, F.col("source").eqNullSafe(F.col("plan_source")) & (F.expr("b % turns") == F.col("plan_turn"))))
    have = last.select(F.col("source").alias("turns_source"), "turns",
                       F.max(F.expr(f"(b div turns) * {slots} + plan_slot + 1")).over(Window.partitionBy(F.lit(1)))
                       .alias("fin"))
    placed = ranked(rows).join(F.broadcast(have), F.col("source").eqNullSafe(F.col("turns_source")))
    length = f"((fin + {slots - 1}) div {slots}) * turns * {block_rows}"
    placed = _epochs(placed, length, block_rows)
    placed = placed.join(F.broadcast(order), F.col("source").eqNullSafe(F.col("plan_source"))
                         & (F.expr("source_block % turns") == F.col("plan_turn")))
    return placed.withColumn("slot", F.expr(f"(source_block div turns) * {slots} + plan_slot")).where("slot < fin")


def op8_pfair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` mixed to the default target weights: one row per document and epoch.

    In periods of SLOTS slots, as the SQL below; with more sources than that by :func:`paths`.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "n_chars")
    return mix(docs, slots=SLOTS).select("doc_id", "source", "source_block", "slot", "epoch", "position")


#: The same mix in DuckDB SQL, from the definitions of release time and deadline.
OP8_SQL = f"""
with recursive n as (select source, count(*) n from documents group by source),
weighed as (select source, n, pow(n, {EXPONENT}) weight from n),
exact as (select source, n, weight / sum(weight) over () * ({SLOTS} - count(*) over ()) e from weighed),
turns as (
  select source, n, cast(floor(e) + 1 + case when row_number() over (order by round(e - floor(e), 9) desc, source)
    <= {SLOTS} - sum(floor(e) + 1) over () then 1 else 0 end as bigint) turns
  from exact),
run(t, source, turns, had, picked) as (
  select cast(0 as bigint), source, turns, cast(0 as bigint), false from turns
  union all
  select t + 1, source, turns, had + case when k = 1 then 1 else 0 end, k = 1
  from (select *, row_number() over (order by case when had * {SLOTS} // turns <= t then 0 else 1 end,
               ((had + 1) * {SLOTS} + turns - 1) // turns, source) k
        from run where t < {SLOTS})),
plan as (select source, had - 1 as turn, t - 1 as slot from run where picked),
ends as (
  select max(((n - 1) // {BLOCK_ROWS} // turns.turns) * {SLOTS} + slot + 1) as fin
  from turns join plan on plan.source = turns.source and (n - 1) // {BLOCK_ROWS} % turns.turns = turn),
places as (
  select doc_id, source, row_number() over (partition by source order by md5(cast(doc_id as varchar)), doc_id) - 1 r
  from documents),
again as (
  select doc_id, p.source, n, r, turns, unnest(range(0, (fin // {SLOTS} + 1) * turns * {BLOCK_ROWS} // n + 1)) as epoch
  from places p join turns using (source) cross join ends),
blocks as (select *, epoch * n + r as i, (epoch * n + r) // {BLOCK_ROWS} as b from again),
placed as (
  select doc_id, blocks.source, b as source_block, (b // turns) * {SLOTS} + slot as slot, epoch, i
  from blocks join plan on plan.source = blocks.source and b % turns = turn)
select doc_id, source, cast(source_block as bigint) as source_block, cast(slot as bigint) as slot,
  cast(epoch as bigint) as epoch, cast(slot * {BLOCK_ROWS} + i % {BLOCK_ROWS} as bigint) as position
from placed cross join ends where slot < fin
"""
