"""One-to-many relations as arrays of structs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adjudika.session import cut_lineage

#: Slices of a hot key's children that are ranked apart, a power of two.
SLICES = 1024
#: Children of a key and relation that one row may gather before they are cut into parts.
ROW_SIZE = 10_000


def _items(columns) -> Column:
    return F.sort_array(F.collect_list(F.struct(*columns)))


def nest(children: DataFrame, key: str, columns, name: str, part_size: int = 10_000) -> DataFrame:
    """Children of each key as sorted arrays: ``(key, part, name)``, one row per key and part; see ``dossier``."""
    return _gathered(_dealt({name: (children, columns)}, key, part_size), key, {name: (children, columns)}).drop("_own")


def dossier(parents: DataFrame, key: str, relations: dict[str, tuple[DataFrame, tuple]], part_size: int = 10_000) -> DataFrame:
    """Parents (unique by key) with child relations as sorted arrays, in one pass over each relation: their columns, ``part`` and the arrays.

    ``relations`` gives each array's name, its children and their columns. A key with up to ``part_size`` children in every relation has part
    0 alone. Those of a larger one are ranked by a hash of their content, then by content, and part p holds the ranks from ``p * part_size`` on:
    ``part_size`` children each, the last one the rest. Rank and part depend on the children only, not on files, partitions or cores; equal
    children may stand in two parts. Children without a parent are left out, nothing else is dropped, and no task holds all children of a
    large key. A parent without children gets empty arrays.

    Keys are counted first, over the key columns alone. All relations of those with up to ``ROW_SIZE`` children travel together, once, and a row
    that has gathered a key's children cuts them into parts itself. Only keys with more take the longer way, if there are any: equal children are
    counted before the first exchange, offsets of hash slices come from the counts, and the second exchange brings parents and children together.
    """
    # A NULL key has no parent. Left in, the joins below would drop it on some branches only, and these could not share their exchange.
    relations = {n: (df.filter(F.col(key).isNotNull()), columns) for n, (df, columns) in relations.items()}
    every = reduce(lambda a, b: a.unionByName(b), [df.select(key, F.lit(at).alias("_rel")) for at, (df, _) in enumerate(relations.values())])
    counts = every.groupBy(key, "_rel").agg(F.count(F.lit(1)).alias("_total")).filter(F.col("_total") > ROW_SIZE)
    hot = cut_lineage(counts.select(key).distinct(), "hot")
    if hot.isEmpty():
        return _dossier_in_rows(parents, key, relations, part_size)

    def split(how: str) -> tuple:
        return parents.join(hot, key, how), key, {n: (df.join(hot, key, how), columns) for n, (df, columns) in relations.items()}, part_size

    return _dossier_in_rows(*split("left_anti")).unionByName(_dossier_in_slices(*split("left_semi")))


def _dossier_in_rows(parents: DataFrame, key: str, relations: dict, part_size: int) -> DataFrame:
    """For keys whose children fit into one row: gathered whole, then cut into the same parts as by ``_dealt``."""
    own = F.struct(*(c for c in parents.columns if c != key)).alias("_own")
    tagged = [df.select(key, F.struct(*columns).alias(f"_{name}")) for name, (df, columns) in relations.items()]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [*tagged, parents.select(key, own)])
    whole = rows.groupBy(key).agg(F.first("_own", ignorenulls=True).alias("_own"), *(F.collect_list(f"_{n}").alias(n) for n in relations)).filter(
        F.col("_own").isNotNull())
    parts = F.greatest(F.lit(1), *(F.ceil(F.size(n) / F.lit(part_size)) for n in relations)).cast("int")
    placed = whole.withColumns({n: _ranked(n, columns, part_size) for n, (_, columns) in relations.items()}).withColumn(
        "part", F.explode(F.sequence(F.lit(0), parts - 1)))
    cut = {n: F.sort_array(F.when(F.size(n) > part_size, F.slice(n, F.col("part") * part_size + 1, F.lit(part_size)))
                           .when(F.col("part") == 0, F.col(n)).otherwise(F.slice(n, 1, 0))) for n in relations}
    return placed.select(key, "_own.*", "part", *(c.alias(n) for n, c in cut.items())).select(*parents.columns, "part", *relations)


def _ranked(name: str, columns, part_size: int) -> Column:
    """The items of an array in the order of their ranks, where it has to be cut."""
    def marked(x):
        h = F.xxhash64(*(x[c] for c in columns))
        return F.struct(h.bitwiseAND(F.lit(SLICES - 1)).alias("slice"), h.alias("hash"), x.alias("item"))

    ranked = F.transform(F.sort_array(F.transform(F.col(name), marked)), lambda m: m.item)
    return F.when(F.size(name) > part_size, ranked).otherwise(F.col(name))


def _dossier_in_slices(parents: DataFrame, key: str, relations: dict, part_size: int) -> DataFrame:
    """For keys with any number of children: ranked in slices, so that no task holds all of them."""
    dealt = _dealt(relations, key, part_size)
    own = F.struct(*(c for c in parents.columns if c != key)).alias("_own")
    first = parents.select(key, F.lit(0).alias("part"), own)
    further = dealt.filter("part > 0").select(key, "part").distinct()
    rows = dealt.unionByName(first, allowMissingColumns=True).unionByName(parents.join(further, key).select(key, "part", own), allowMissingColumns=True)
    whole = _gathered(rows, key, relations).filter(F.col("_own").isNotNull())
    return whole.select(key, "_own.*", "part", *relations).select(*parents.columns, "part", *relations)


def _gathered(rows: DataFrame, key: str, relations: dict) -> DataFrame:
    own = F.first("_own", ignorenulls=True) if "_own" in rows.columns else F.lit(None)
    return rows.groupBy(key, "part").agg(own.alias("_own"), *(
        F.sort_array(F.flatten(F.collect_list(F.when(F.col(f"_{n}").isNotNull(), F.array_repeat(f"_{n}", F.col("_held").cast("int")))))).alias(n)
        for n in relations))


def _dealt(relations: dict, key: str, part_size: int) -> DataFrame:
    """Distinct children with their part and how often it holds them: key, part, _held and one struct a relation, of which one is set."""
    tagged = []
    for at, (name, (children, columns)) in enumerate(relations.items()):
        item = F.struct(*columns)
        tagged.append(children.select(key, F.lit(at).alias("_rel"), F.xxhash64(*columns).alias("_hash"), item.alias(f"_{name}")))
    items = [f"_{n}" for n in relations]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    once = rows.groupBy(key, "_rel", "_hash", *items).agg(F.count(F.lit(1)).alias("_n"))
    by = [key, "_rel", "_slice"]
    sliced = once.withColumn("_slice", F.col("_hash").bitwiseAND(F.lit(SLICES - 1)))
    sizes = sliced.groupBy(*by).agg(F.sum("_n").alias("_size"))
    # At most SLICES rows a key and relation.
    whole = Window.partitionBy(key, "_rel")
    before = F.sum("_size").over(whole.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.withColumns({"_offset": F.coalesce(before, F.lit(0)), "_total": F.sum("_size").over(whole)})
    large = offsets.filter(F.col("_total") > part_size).select(*by, "_offset")
    met = sliced.join(large, by, "left")
    cold = met.filter(F.col("_offset").isNull()).select(key, F.lit(0).alias("part"), F.col("_n").alias("_held"), *items)
    within = Window.partitionBy(*by).orderBy("_hash", *items).rowsBetween(Window.unboundedPreceding, -1)
    ranked = met.filter(F.col("_offset").isNotNull()).withColumn("_first", F.col("_offset") + F.coalesce(F.sum("_n").over(within), F.lit(0)))
    last = F.col("_first") + F.col("_n") - 1
    parts = F.explode(F.sequence(F.floor(F.col("_first") / part_size), F.floor(last / part_size)))
    spread = ranked.withColumn("part", parts)
    held = F.least(last + 1, (F.col("part") + 1) * part_size) - F.greatest(F.col("_first"), F.col("part") * part_size)
    hot = spread.select(key, F.col("part").cast("int").alias("part"), held.alias("_held"), *items)
    return cold.unionByName(hot)


def attach(parents: DataFrame, key: str, *nested: DataFrame) -> DataFrame:
    """Parents with their nested relations; a parent without children gets empty arrays.

    The relations are aligned part by part before the join, so two of them never multiply each other.
    """
    relations = reduce(lambda a, b: a.join(b, [key, "part"], "full_outer"), nested)
    names = [c for c in relations.columns if c not in (key, "part")]
    joined = parents.join(relations, key, "left")
    empty = {
        n: F.coalesce(F.col(n), F.array().cast(relations.schema[n].dataType)) for n in names
    }
    return joined.withColumns({**empty, "part": F.coalesce("part", F.lit(0))})
