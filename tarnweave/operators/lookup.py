"""Fuzzy entity search and read-only SQL with bound parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnweave.operators.linkage import spellings

READING = frozenset(
    "Project Filter Aggregate Sort GlobalLimit LocalLimit Distinct SubqueryAlias UnresolvedRelation UnresolvedWith"
    " CTERelationDef Join Union Except Intersect UnresolvedInlineTable OneRowRelation UnresolvedHaving Window"
    " WithCTE Generate Pivot LateralJoin UnresolvedSubqueryColumnAliases Offset UnresolvedTableValuedFunction".split()
)


#: Functions that a reading statement may call; none of them reaches files, classes or the session.
CALLS = frozenset(
    "abs array array_contains array_distinct array_join array_sort avg bool_and bool_or cardinality ceil coalesce collect_list collect_set concat concat_ws"
    " contains corr count count_if date_add date_diff date_format date_sub date_trunc datediff day dayofweek dense_rank element_at exists explode"
    " filter first floor forall greatest if ifnull initcap instr lag last lcase lead least left length levenshtein ln log10 lower lpad ltrim map max max_by"
    " md5 mean median min min_by mod month nullif nvl percentile percentile_approx pmod posexplode power quarter rank regexp_extract regexp_like regexp_replace"
    " replace reverse right round row_number rpad rtrim sequence sha2 sign size slice split sqrt startswith endswith stddev struct substr substring sum to_date"
    " to_timestamp transform trim try_cast try_divide ucase upper variance when year zip_with % * + - / < <= <=> <> = == > >= and or not like rlike in".split()
)


def tokens(text: str) -> list[str]:
    """Search words: runs of letters and digits, words of one letter go."""
    import re

    return [w for w in re.findall(r"[^\W_]+", text.lower()) if len(w) > 1]


def token_index(entities: DataFrame, edit: int = 2) -> tuple[DataFrame, DataFrame]:
    """Index of ``(id, name, ...)`` for ``search``: ``(key, token)``, each distinct token under what it leaves without up to ``edit``
    characters, and ``(token, id)``.  To be written in folders by key and by token, and kept."""
    own = F.filter(F.split(F.lower("name"), r"[^\p{L}\p{N}#]+"), lambda w: w != "")
    postings = entities.select(F.explode(F.array_distinct(own)).alias("token"), "id")
    keys = postings.select("token").distinct().select(F.explode(spellings(F.col("token"), edit)).alias("key"), "token")
    return keys, postings


def near_tokens(keys: DataFrame, words: DataFrame, edit: int = 2) -> DataFrame:
    """``(word, token, d)``: tokens within ``edit`` edits of each of few words; only tokens that share a key are compared."""
    asked = words.select("word", F.explode(spellings(F.col("word"), edit)).alias("key"))  # as many as the query's text allows
    met = keys.join(F.broadcast(asked), "key").select("word", "token").distinct()
    return met.withColumn("d", F.levenshtein("word", "token", edit)).where("d >= 0")


def search(entities: DataFrame, text: str, edit: int = 2, k: int = 10, index: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """Entities of ``(id, name, wins)`` in whose names every word of the query is within ``edit`` edits.

    Ranked by the mean of 1 - edits / longest over the query words, then wins, then id.  With a ``token_index`` that
    was kept, only its matching keys are read.
    """
    words = sorted(tokens(text))
    if not words:
        return entities.select("id", "name", "wins", F.lit(0.0).alias("score")).limit(0)
    keys, postings = index or token_index(entities, edit)
    asked = entities.sparkSession.createDataFrame([(w,) for w in sorted(set(words))], "word string")
    near = near_tokens(keys, asked, edit).withColumn("m", F.greatest(F.length("word"), F.length("token")))
    best = postings.join(near, "token").groupBy("id", "word").agg(F.min(F.struct("d", "m")).alias("b"))
    often = F.element_at(F.create_map(*[F.lit(x) for w in sorted(set(words)) for x in (w, words.count(w))]), F.col("word"))
    each = best.groupBy("id").agg(F.count("*").alias("met"), (F.sum((1 - F.col("b.d") / F.col("b.m")) * often) / len(words)).alias("score"))
    found = each.where(F.col("met") == len(set(words))).join(entities, "id").select("id", "name", "wins", F.round("score", 6).alias("score"))
    return found.orderBy(F.col("score").desc(), F.col("wins").desc(), "id").limit(k)


def _items(seq) -> list:
    return [seq.apply(i) for i in range(seq.size())]


def is_reading(spark: SparkSession, text: str) -> bool:
    """The parsed plan and all plans inside it only read: allow-lists of plan nodes and of functions, and relations
    that are tables or views of the session (no files)."""
    try:
        plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(text)
    except Exception:
        return False
    from py4j.java_gateway import is_instance_of

    def tree(x, kind: str) -> bool:
        return is_instance_of(spark.sparkContext._gateway, x, f"org.apache.spark.sql.catalyst.{kind}")

    stack, read, named = [plan], [], set()
    while stack:
        p = stack.pop()
        kind = p.getClass().getSimpleName().rstrip("$")
        if tree(p, "plans.logical.LogicalPlan"):
            if kind not in READING:
                return False
            if kind == "UnresolvedRelation":
                read.append(_items(p.multipartIdentifier()))
            if kind == "UnresolvedTableValuedFunction":
                return False
            if kind == "UnresolvedWith":
                named |= {_items(x.productIterator().toSeq())[0].lower() for x in _items(p.cteRelations())}
                stack += [_items(x.productIterator().toSeq())[1] for x in _items(p.cteRelations())]
            stack += [*_items(p.children()), *_items(p.expressions())]
        else:
            if kind == "UnresolvedFunction" and ".".join(_items(p.nameParts())).lower() not in CALLS:
                return False
            if tree(p, "expressions.PlanExpression"):
                stack.append(p.plan())
            stack += _items(p.children())
    return all(len(x) == 1 and (x[0].lower() in named or spark.catalog.tableExists(x[0])) for x in read)


def run_sql(spark: SparkSession, text: str, args: dict | None = None, most: int = 50) -> DataFrame:
    """Rows of a reading statement, ``most`` at most; others raise."""
    if not is_reading(spark, text):
        raise PermissionError("only reading statements are allowed")
    return spark.sql(text, args=args or {}).limit(most)
