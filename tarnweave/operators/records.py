"""Record fusion: ordered merges, upserts and slices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_known(x: Column | str, order: Column) -> Column:
    """Aggregate: x of the least order among rows where x is known."""
    x = F.col(x) if isinstance(x, str) else x
    return F.min_by(x, F.when(x.isNotNull(), order))


def last_known(x: Column | str, order: Column) -> Column:
    x = F.col(x) if isinstance(x, str) else x
    return F.max_by(x, F.when(x.isNotNull(), order))


def ordered_values(df: DataFrame, keys: list[str], x: str, order: str, name: str) -> DataFrame:
    """``(keys, name)``: distinct known values of each key, each at the place of its first row.

    Equal values meet before anything is gathered, so a key of very many rows gathers its distinct values only.
    """
    one = df.where(F.col(x).isNotNull()).groupBy(*keys, F.col(x).alias("_x")).agg(F.min(order).alias("_first"))
    rows = F.array_sort(F.collect_list(F.struct("_first", "_x")))
    return one.groupBy(*keys).agg(F.transform(rows, lambda r: r["_x"]).alias(name))


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def cap_per_key(df: DataFrame, keys: list[str], order: list[Column], cap: int) -> DataFrame:
    """The first ``cap`` rows of each key; the cap is the operator."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= cap)


MERGED_SCALARS = ("oggetto", "natura", "importoBase", "procedura", "dataPubblicazione", "dataScadenza")


def merge_lots(contributions: DataFrame, order: Column) -> DataFrame:
    """One canonical lot per ``cig`` from contributions in ``order``.

    Scalars, place and links: first known, field by field; buyer: first known as a whole; cpv and
    sources: distinct in order; notices, awards and amendments: first per key; ids of the source: last known.

    Contributions are read twice, for the scalars and for all lists at once.  Equal values and keys of a lot meet before anything is
    gathered, so a lot of very many contributions gathers its distinct ones only.
    """
    c = contributions.withColumn("_o", order)
    o = F.col("_o")
    types = {n: contributions.select(x).schema[0].dataType for n, x in (("a", "avviso"), ("w", F.get("aggiudicazioni", 0)))}
    amendment = F.struct(F.col("avviso.idAvviso").alias("idAvviso"), F.col("avviso.nuovoAvviso").alias("rifAvviso"), F.col("avviso.data").alias("data"))
    types["r"] = contributions.select(amendment).schema[0].dataType

    def entry(kind: str, key: Column, p: Column, **x: Column) -> Column:
        values = [x.get(n, F.lit(None)).cast(t).alias(n) for n, t in types.items()]
        return F.struct(F.lit(kind).alias("kind"), key.alias("key"), p.cast("int").alias("p"), *values)

    zero = F.lit(0)
    amended = (F.col("stadio") == "amendment") & F.col("avviso.nuovoAvviso").isNotNull()
    entries = F.concat(
        F.transform(F.coalesce("cpv", F.array()), lambda x, i: entry("cpv", x, i)),
        F.array(entry("_sources", F.col("fonte"), zero), entry("avvisi", F.col("avviso.idAvviso"), zero, a=F.col("avviso")), entry("rettifiche", F.when(amended, F.col("avviso.idAvviso")), zero, r=amendment)),
        F.transform(F.coalesce("aggiudicazioni", F.array()), lambda x, i: entry("aggiudicazioni", x["impresa"]["cf"], i, w=x)),
    )
    each = c.select("cig", "_o", F.explode(entries).alias("e")).where("e.key IS NOT NULL").select("cig", "_o", "e.*")
    first = F.min_by(F.struct("_o", "p", *types, "key"), F.struct("_o", "p")).alias("r")  # meets in the map side already
    one = each.groupBy("cig", "kind", "key").agg(first)
    rows = one.groupBy("cig").agg(F.collect_list(F.struct("kind", "r")).alias("_rows"))
    value = {"cpv": "key", "_sources": "key", "avvisi": "a", "aggiudicazioni": "w", "rettifiche": "r"}

    def of(kind: str) -> Column:
        own = F.array_sort(F.transform(F.filter("_rows", lambda x: x["kind"] == kind), lambda x: x["r"]))
        return F.transform(own, lambda x: x[value[kind]]).alias(kind)

    lists = rows.select("cig", *map(of, value))
    lots = c.groupBy("cig").agg(
        *[first_known(n, o).alias(n) for n in MERGED_SCALARS],
        F.struct(first_known("luogo.nuts", o).alias("nuts"), first_known("luogo.istat", o).alias("istat")).alias("luogo"),
        F.struct(first_known("link.piattaforma", o).alias("piattaforma"), first_known("link.ted", o).alias("ted")).alias("link"),
        first_known("stazioneAppaltante", o).alias("stazioneAppaltante"),
        F.struct(
            *[last_known(F.when(F.col("fonte") == s, F.col("garaId")), o).alias(s) for s in ("pl", "ocds")]
        ).alias("garaId"),
    )
    return lots.join(lists, "cig", "left").select(*lots.columns, *[F.coalesce(k, F.array()).alias(k) for k in value])


def upsert(old: DataFrame, new: DataFrame, key: str, keep_flag: str | None = None) -> DataFrame:
    """Rows of ``new`` replace rows of ``old`` with the same key; a flag may keep its old value."""
    names = [c for c in new.columns if c != key]
    o, n = old.alias("o"), new.alias("n")

    def value(c: str) -> Column:
        if c == keep_flag:
            return F.coalesce(f"o.{c}", f"n.{c}").alias(c)
        return F.when(F.col(f"n.{key}").isNotNull(), F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c)

    return o.join(n, F.col(f"o.{key}") == F.col(f"n.{key}"), "full_outer").select(F.coalesce(f"n.{key}", f"o.{key}").alias(key), *map(value, names))


def insert_absent(known: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Rows of ``new`` whose key isn't known, the first of each key."""
    return new.join(known.select(key), key, "left_anti").dropDuplicates([key])
