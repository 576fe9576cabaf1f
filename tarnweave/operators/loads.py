"""Flagged loads, delta scopes, graph frames and the small readers around them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pending(rows: DataFrame, flag: str = "_synced") -> DataFrame:
    """Rows that no run has processed yet."""
    return rows.where(~F.coalesce(F.col(flag), F.lit(False)))


def written(old: DataFrame, new: DataFrame, key: str, flag: str = "_synced") -> DataFrame:
    """``old`` with the rows of ``new`` put in by key; every written row is to be processed again."""
    return old.join(new.select(key), key, "left_anti").unionByName(new.withColumn(flag, F.lit(False)))


def processed(rows: DataFrame, done: DataFrame, key: str, flag: str = "_synced") -> DataFrame:
    """``rows`` with the flag on where the key is among ``done``."""
    seen = done.select(F.col(key).alias("_key")).distinct()
    joined = rows.join(seen, F.col(key) == F.col("_key"), "left")
    return joined.withColumn(flag, F.coalesce(flag, F.lit(False)) | F.col("_key").isNotNull()).drop("_key")


def changed_since(rows: DataFrame, column: str, log: DataFrame, at: str, keys: DataFrame | None = None, key: str | None = None) -> DataFrame:
    """Rows changed at or after the last run of a log, all of them without one; or those of a list of keys."""
    if keys is not None:
        return rows.join(keys.select(key).distinct(), key, "left_semi")
    last = log.agg(F.max(at).alias("_last"))  # one row
    return rows.join(F.broadcast(last), F.lit(True)).where(F.col("_last").isNull() | (F.col(column) >= F.col("_last"))).drop("_last")


def fill_known(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Vertices: a known new value replaces the old one, an unknown one leaves it."""
    o, n = old.alias("o"), new.alias("n")
    values = [F.coalesce(f"n.{c}", f"o.{c}").alias(c) for c in old.columns if c != key]
    return o.join(n, F.col(f"o.{key}") == F.col(f"n.{key}"), "full_outer").select(F.coalesce(f"n.{key}", f"o.{key}").alias(key), *values)


def new_edges(known: DataFrame, edges: DataFrame, keys: list[str]) -> DataFrame:
    """``known`` and the edges it lacks; properties are set only when an edge is made."""
    return known.unionByName(edges.join(known.select(keys), keys, "left_anti"))


def with_any_key(rows: DataFrame, columns: list[str], value) -> DataFrame:
    """Rows that have the value in one of the columns; without a value none."""
    if value is None or value == "":
        return rows.limit(0)
    hit = F.lit(False)
    for c in columns:
        hit = hit | F.coalesce(F.col(c) == F.lit(value), F.lit(False))
    return rows.where(hit)


def named_like(entities: DataFrame, text: str, role: str, k: int = 8) -> DataFrame:
    """Entities of ``(id, name, roles)`` with a role whose name holds the first 24 characters of a text of two or more."""
    part = " ".join(text.lower().split())[:24]
    if len(part) < 2:
        return entities.limit(0)
    return entities.where(F.contains(F.lower("name"), F.lit(part)) & F.array_contains("roles", role)).orderBy("name", "id").limit(k)


def tolerant_time(x: Column) -> Column:
    """A timestamp from text: as it stands, else the first date in it with an optional time, else null."""
    day = F.regexp_extract(x, r"([0-9]{4}-[0-9]{2}-[0-9]{2})", 1)
    clock = F.regexp_extract(x, r"[0-9]{4}-[0-9]{2}-[0-9]{2}[T\s]+([0-9]{2}:[0-9]{2}(?::[0-9]{2})?)", 1)
    whole = F.when(clock != "", F.concat_ws(" ", day, clock)).otherwise(day)
    return F.coalesce(F.try_to_timestamp(x), F.try_to_timestamp(F.nullif(whole, F.lit(""))))


def euro(x: Column) -> Column:
    """An amount with points between thousands, a decimal comma and the sign."""
    return F.concat(F.translate(F.format_number(x, 2), ",.", ".,"), F.lit(" €"))


def printed(x: Column, kind: str) -> Column:
    """A value as text: booleans as words, days as day/month/year."""
    if kind == "boolean":
        return F.when(x, "sì").when(~x, "no")
    return F.date_format(x, "dd/MM/yyyy") if kind in ("date", "timestamp") else x.cast("string")


def humanised(x: Column) -> Column:
    return F.initcap(F.regexp_replace(x, "[_-]+", " "))


def last_value(entries: Column, key: str) -> Column:
    """The value of the last entry ``(k, v)`` with a key."""
    same = F.filter(entries, lambda e: e["k"] == key)
    return F.when(F.size(same) > 0, F.element_at(same, -1)["v"])


def level_of(a: Column, b: Column) -> Column:
    """Level at which two normalised names would be linked: equal, near or not at all."""
    from tarnweave.functions.codes import near_names

    return F.when((a == b) & (a != ""), "L2").when(near_names(a, b), "L3").otherwise("none")


def chart_columns(rows: DataFrame) -> tuple[str, str]:
    """Label and value column of a result: the value is the first numeric one, the label the first other."""
    numeric = [f.name for f in rows.schema if f.dataType.typeName() in ("byte", "short", "integer", "long", "float", "double", "decimal")]
    value = numeric[0] if numeric else rows.columns[-1]
    return next((c for c in rows.columns if c != value), value), value


def complete(rows: DataFrame, required: list[str], defaults: dict) -> DataFrame:
    """Rows whose required columns are neither null nor empty, with defaults for nulls of other columns."""
    kept = rows.where(F.forall(F.array(*[F.coalesce(F.col(x).cast("string"), F.lit("")) for x in required]), lambda x: x != ""))
    return kept.withColumns({k: F.coalesce(F.col(k), F.lit(v)) for k, v in defaults.items()})


def provenance(rows: DataFrame, source: str) -> DataFrame:
    """Rows marked as not yet processed, with their source and the time of the load."""
    return rows.withColumns({"_synced": F.lit(False), "_ingestedAt": F.current_timestamp(), "_source": F.lit(source)})


def backfilled(rows: DataFrame, values: DataFrame, key: str, column: str) -> DataFrame:
    """Rows whose null `column` is filled from `values` (key, column); known values stay. A key with several values takes the least."""
    found = values.groupBy(key).agg(F.min(column).alias("_found"))
    return rows.join(found, key, "left").withColumn(column, F.coalesce(column, "_found")).drop("_found")


def agreement(human: Column, verdict: Column) -> Column:
    """How a label given by name alone stands to the verdict by code: agree, name_misled, code_found or other.

    Labels are `same`, `diff`, `?` or empty (null is empty); verdicts are `same` or `diff`.
    """
    said = F.lower(F.trim(F.coalesce(human, F.lit(""))))
    return (
        F.when(said == verdict, "agree")
        .when((said == "same") & (verdict == "diff"), "name_misled")
        .when(said.isin("diff", "?") & (verdict == "same"), "code_found")
        .otherwise("other")
    )


def seeded(key: Column, seed: int) -> Column:
    """A number from 0 to 1 that the seed and the key fix, alike in any partitioning; sorting by it shuffles, ties go by key. Null for a null key."""
    drawn = F.md5(F.concat_ws(":", F.lit(seed), key.cast("string")))
    return F.when(key.isNotNull(), F.conv(F.substring(drawn, 1, 8), 16, 10).cast("double") / 2**32)


RUNS = "run string, status string, rows long, message string, at timestamp"


def recorded(spark, path: str, run: str, work) -> bool:
    """Runs ``work()``, which returns a number of rows, and appends to a log that it began and how it ended.

    An error is logged, not raised; True where the work was done.
    """

    def note(status, rows=None, message=None):
        row = spark.createDataFrame([(run, status, rows, message)], "run string, status string, rows long, message string")
        row.withColumn("at", F.current_timestamp()).write.mode("append").parquet(path)

    note("running")
    try:
        note("completed", work())
    except Exception as e:  # whatever stops a load belongs in its log
        note("error", message=str(e)[:1000])
        return False
    return True


def last_status(spark, path: str) -> DataFrame:
    """``(run, status, rows)``: the last entry of each run."""
    log = spark.read.schema(RUNS).parquet(path)
    last = F.max_by(F.struct("status", "rows"), F.struct("at", F.col("status") != "running"))
    return log.groupBy("run").agg(last.alias("l")).select("run", "l.status", "l.rows")


def upsert_flagged(old: DataFrame, new: DataFrame, key: str, flag: str = "_synced") -> DataFrame:
    """``old`` with the rows of ``new`` in place of those of the same key; every written row is pending again."""
    written = new.withColumn(flag, F.lit(False))
    return old.join(written.select(key), key, "left_anti").unionByName(written)


def sharded(rows: DataFrame, key: str, shards: int) -> DataFrame:
    """Rows with their ``shard``, a hash of the key, and dealt by it."""
    return rows.withColumn("shard", F.pmod(F.xxhash64(key), F.lit(shards)).cast("int")).repartition(shards, "shard")


def tag_code(tags: Column) -> Column:
    """Code made from the tags of a release; null tags count as none."""
    has = lambda *some: F.forall(F.array(*[F.lit(x) for x in some]), lambda x: F.array_contains(F.coalesce(tags, F.array().cast("array<string>")), x))
    # fixed values: tags and codes, in the order in which they are tried
    known = ((("award", "contract"), "OCDS-AC"), (("award",), "OCDS-A"), (("tender",), "OCDS-T"), (("contract",), "OCDS-C"), (("planning",), "OCDS-P"))
    return F.coalesce(*[F.when(has(*some), code) for some, code in known], F.lit("OCDS-X"))


def as_text(v: Column, path: str) -> Column:
    """A member of a variant as text where it is text and not empty, else null."""
    return F.when(F.schema_of_variant(F.try_variant_get(v, path, "variant")) == "STRING", F.nullif(F.try_variant_get(v, path, "string"), F.lit("")))


def as_number(v: Column, path: str) -> Column:
    """A member of a variant as a number; text may have a decimal comma."""
    return F.replace(F.try_variant_get(v, path, "string"), F.lit(","), F.lit(".")).try_cast("double")


def first_filled(parts: Column, field) -> Column:
    """The first value of ``field(part)`` over an array of parts that is neither null nor empty."""
    found = F.filter(F.transform(parts, field), lambda x: x.isNotNull() & (x.cast("string") != ""))
    return F.get(found, F.lit(0))


def summary(sections: Column) -> Column:
    """Struct of the first known code, title, nature and amount over all items of all sections, and the direct awards."""
    items = F.flatten(F.filter(F.transform(sections, lambda s: s["items"]), lambda x: x.isNotNull()))
    awards = F.flatten(F.filter(F.transform(items, lambda i: i["aggiudicatari_ad"]), lambda x: x.isNotNull()))
    return F.struct(
        first_filled(items, lambda i: i["cig"]).alias("cig"),
        first_filled(items, lambda i: i["descrizione"]).alias("oggetto"),
        first_filled(items, lambda i: i["natura_principale"]).alias("natura"),
        first_filled(items, lambda i: F.coalesce(i["valore_affidamento"], i["valore_totale"], i["importo"])).alias("importo"),
        awards.alias("aggiudicatari"),
    )
