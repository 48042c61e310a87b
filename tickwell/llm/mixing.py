"""Mix sources to target weights by hierarchical budgets, in DataFrame functions only.

Weights go down a tree of levels (domain, language, source).  A node that has
fewer tokens than its share, counting every allowed epoch, leaves the shortage
to its siblings, in proportion to their weights; only what all siblings cannot
take goes up to the siblings of the parent.  Each leaf then takes whole epochs
and, of one more epoch, the token prefix of its documents in a seeded order.

Nothing is sorted as a whole: a leaf's prefix is found by token sums of hash
ranges, and rows are ordered only inside the one range where the prefix ends.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickwell.llm.frames import written

SEED = "mix-1"
DIGITS = [(1, 2), (3, 2), (5, 1)]  # places of the hex digits of the order key that make a range: about a million a leaf


def token_estimate(text: Column) -> Column:
    """Four characters a token, at least one for a text that is not empty."""
    return F.ceil(F.length(F.coalesce(text, F.lit(""))) / 4).cast("long")


def order_key(doc_id: Column, epoch: Column, seed: str = SEED) -> Column:
    """Position of a document in an epoch: a hash of seed, epoch and id."""
    return F.md5(F.concat_ws(":", F.lit(seed), epoch.cast("string"), F.coalesce(doc_id.cast("string"), F.lit(""))))


def filled(nodes: DataFrame, parent: list[str], budget: str, weight: str, room: str) -> DataFrame:
    """Split each parent's ``budget`` over its children by weight, no child beyond its ``room``.

    Exact: with children ordered by the level at which they are full
    (room / weight), the ones below the water line get their room, the others
    their weighted share of what is left.  Adds ``_got``.
    """
    by = Window.partitionBy(*parent)
    upto = by.orderBy(F.col("_level"), F.col("_name")).rowsBetween(Window.unboundedPreceding, -1)
    w = F.col(weight).cast("double")
    leveled = nodes.withColumn("_level", F.when(w > 0, F.col(room) / w).otherwise(F.lit(float("inf"))))
    summed = leveled.withColumns({
        "_below": F.coalesce(F.sum(F.when(w > 0, F.col(room)).otherwise(0.0)).over(upto), F.lit(0.0)),
        "_used": F.coalesce(F.sum(w).over(upto), F.lit(0.0)),
        "_all": F.sum(w).over(by),
    })
    # The water line when this child and those after it are not full.
    line = summed.withColumn("_line", (F.col(budget) - F.col("_below")) / F.greatest(F.col("_all") - F.col("_used"), F.lit(1e-300)))
    full = F.col("_line") >= F.col("_level")
    final = line.withColumn("_open", F.max(F.when(~full & (w > 0), F.col("_line"))).over(by))
    got = F.when(w <= 0, F.lit(0.0)).when(full | F.col("_open").isNull(), F.col(room)).otherwise(F.greatest(F.col("_open"), F.lit(0.0)) * w)
    return final.withColumn("_got", F.least(got, F.col(room))).drop("_level", "_below", "_used", "_all", "_line", "_open")


def weight_of(level: str, weights: dict[str, dict]) -> Column:
    named = [F.when(F.col(level) == F.lit(value), F.lit(float(w))) for value, w in weights.get(level, {}).items()]
    return F.coalesce(*named, F.lit(1.0))


def takes_part(levels: list[str], weights: dict[str, dict]) -> Column:
    """Whether a leaf and all nodes above it have a weight above 0."""
    return F.least(F.lit(1.0), *[weight_of(level, weights) for level in levels]) > 0


def leaf_budgets(leaves: DataFrame, levels: list[str], weights: dict[str, dict], budget: float, max_epochs: int) -> DataFrame:
    """Budget of every leaf; ``leaves`` has the level columns and ``tokens``.

    ``weights`` gives per level the weight of a value; a value not named has
    weight 1.  Leaves that take nothing, having a weight of 0 at some level, are
    no room of the nodes above them, so these get no budget for them.  The
    tables here have one row per node of the tree.
    """
    room = F.when(takes_part(levels, weights), F.col("tokens").cast("double") * max_epochs).otherwise(0.0)
    current = leaves.withColumn("_room", room).select(*levels, "_room")
    budgets = None
    for depth in range(1, len(levels) + 1):
        nodes = current.groupBy(*levels[:depth]).agg(F.sum("_room").alias("_room"))
        level = levels[depth - 1]
        nodes = nodes.withColumn("_weight", weight_of(level, weights)).withColumn("_name", F.coalesce(F.col(level).cast("string"), F.lit("")))
        if budgets is None:
            nodes = nodes.withColumn("_budget", F.lit(float(budget))).withColumn("_root", F.lit(0))
            split = filled(nodes, ["_root"], "_budget", "_weight", "_room")
        else:
            up = levels[:depth - 1]
            above = budgets.select(*[F.col(c).alias(f"_up_{c}") for c in up], F.col("_got").alias("_budget"))
            same = [F.col(c).eqNullSafe(F.col(f"_up_{c}")) for c in up]
            nodes = nodes.join(above, same).drop(*[f"_up_{c}" for c in up])
            split = filled(nodes, up, "_budget", "_weight", "_room")
        budgets = split.select(*levels[:depth], "_got")
    return budgets


def mix(documents: DataFrame, levels: dict[str, Column] | list[str], weights: dict[str, dict], budget: float | None = None,
        share: float = 0.5, max_epochs: int = 3, seed: str = SEED, tokens: Column | None = None,
        added: tuple[str, str] = ("mix_tokens", "mix_epoch")) -> DataFrame:
    """The documents of the mix, one row per copy, with their tokens and the epoch of the copy as the columns ``added``.

    ``levels`` names the tree from the root down: columns, or names with an
    expression each.  ``budget`` is in tokens; without one it is ``share`` of all
    tokens.  A document that crosses a leaf's budget is the last one taken.
    Null level values form nodes of their own, texts without tokens come along
    at no cost (once where a leaf has no others, never where a weight is 0),
    rows of one key follow each other by hash and are taken alike, an empty
    table gives an empty result.  The columns of ``documents`` are carried as
    one value, so whatever their names they come out as they went in; an added
    column whose name is taken gets underscores.
    """
    exprs = levels if isinstance(levels, dict) else {c: F.col(c) for c in levels}
    names = [f"level{i}" for i in range(len(exprs))]
    weights = {name: weights.get(level, {}) for name, level in zip(names, exprs, strict=True)}
    counted = documents.select(
        F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("doc"), F.col("doc_id").alias("id"),
        (token_estimate(F.col("text")) if tokens is None else tokens).alias("tokens"),
        *[e.alias(n) for n, e in zip(names, exprs.values(), strict=True)])
    leaves = written(counted.groupBy(*names).agg(F.sum("tokens").alias("tokens")), "leaves")
    amount = float(budget) if budget is not None else float((leaves.agg(F.sum("tokens")).first()[0] or 0) * share)
    budgets = leaf_budgets(leaves, names, weights, amount, max_epochs)
    leaf = [f"_l{i}" for i in range(len(names))]
    plan = _named(leaves.withColumn("_part", takes_part(names, weights)), names).join(_named(budgets, names), leaf).select(
        *leaf, F.col("tokens").alias("_tokens"), F.col("_got"), F.col("_part"))
    whole = F.when(F.col("_tokens") > 0, F.floor(F.col("_got") / F.col("_tokens"))).otherwise(F.col("_part").cast("int")).cast("int")
    plan = plan.withColumn("_epochs", F.least(whole, F.lit(max_epochs))).drop("_part").withColumn(
        "_need", F.greatest(F.lit(0.0), F.col("_got") - F.col("_epochs") * F.col("_tokens")))
    plan = written(plan, "plan")
    few = plan.count() <= LEAVES
    small = F.broadcast(plan) if few else plan
    keyed = _named(counted, names).join(small, leaf).withColumn("_key", order_key(F.col("id"), F.col("_epochs"), seed))
    cut = written(prefix_cut(keyed, leaf, few), "cuts")
    cuts = F.broadcast(cut) if few else cut
    placed = keyed.join(cuts, leaf, "left")
    partial = F.when((F.col("_need") > 0) & F.col("_cut").isNotNull() & (F.col("_key") <= F.col("_cut")), 1).otherwise(0)
    copies = F.col("_epochs") + partial
    rows = placed.where(copies > 0).withColumn("_epoch", F.explode(F.sequence(F.lit(0), copies - 1)))
    taken = set(documents.columns)
    free = [name if name not in taken else next(n for k in range(1, len(taken) + 2) if (n := name + "_" * k) not in taken) for name in added]
    return rows.select("doc.*", *[F.col(c).alias(n) for c, n in zip(("tokens", "_epoch"), free)])


LEAVES = 20_000  # rows of the plan that are sent to all executors, about 100 bytes each; more are joined by shuffle


def _named(df: DataFrame, levels: list[str]) -> DataFrame:
    """Level values as texts that are never null, so that leaves join by equality."""
    cols = {f"_l{i}": F.when(F.col(c).isNull(), F.lit("n")).otherwise(F.concat(F.lit("v"), F.col(c).cast("string"))) for i, c in enumerate(levels)}
    return df.withColumns(cols).drop(*levels)


def prefix_cut(keyed: DataFrame, leaf: list[str], few: bool) -> DataFrame:
    """Largest order key of each leaf that belongs to its token prefix of ``_need``.

    One pass sums the tokens of each range of keys.  The range where the prefix
    ends is found digits by digits, so a window sees at most 256 sums of a
    leaf; a second pass orders the rows of that range alone.
    """
    digits = [F.substring("_key", at, size).alias(f"_d{i}") for i, (at, size) in enumerate(DIGITS)]
    spread = keyed.where("_need > 0").select(*leaf, "_need", "_key", "tokens", *digits)
    steps = [f"_d{i}" for i in range(len(DIGITS))]
    sums = written(spread.groupBy(*leaf, *steps).agg(F.sum("tokens").alias("_sum"), F.first("_need").alias("_need")), "ranges")
    found = sums.groupBy(*leaf).agg(F.first("_need").alias("_goal")).withColumn("_before", F.lit(0).cast("long"))
    for depth, step in enumerate(steps):
        known = [*leaf, *steps[:depth]]
        inside = sums.join(F.broadcast(found) if few else found, known).groupBy(*known, step).agg(
            F.sum("_sum").alias("_sum"), F.first("_goal").alias("_goal"), F.first("_before").alias("_start"))
        before = Window.partitionBy(*leaf).orderBy(step).rowsBetween(Window.unboundedPreceding, -1)
        passed = inside.withColumn("_before", F.col("_start") + F.coalesce(F.sum("_sum").over(before), F.lit(0)))
        ends = passed.where((F.col("_before") < F.col("_goal")) & (F.col("_before") + F.col("_sum") >= F.col("_goal")))
        found = written(ends.select(*known, step, "_goal", "_before"), "ends")
    edge = spread.join(F.broadcast(found) if few else found, [*leaf, *steps])
    # Rows of one key count together, so ties are taken or left as a whole.
    keys = edge.groupBy(*leaf, "_key").agg(F.sum("tokens").alias("_sum"), F.first("_goal").alias("_goal"), F.first("_before").alias("_before"))
    up = Window.partitionBy(*leaf).orderBy("_key").rowsBetween(Window.unboundedPreceding, -1)
    reached = keys.withColumn("_have", F.col("_before") + F.coalesce(F.sum("_sum").over(up), F.lit(0)))
    return reached.where(F.col("_have") < F.col("_goal")).groupBy(*leaf).agg(F.max("_key").alias("_cut"))
