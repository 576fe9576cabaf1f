"""Personal data: rule spans, candidate generators and a boosted tree model, DataFrame only.

Rule spans (``email ip card phone``) are always kept.  High-recall generators then propose
number runs, address-like runs and opaque tokens; each candidate becomes a code of format and
context bits.  The counts of (code, label) over *all* texts form a table of at most 2**17 rows,
on which boosted trees of depth two are fitted; scores are calibrated by isotonic regression and
a candidate is added when its calibrated precision reaches ``precision``.  Labels: a number or
address run is positive where it meets a rule span, an opaque token where a credential word
introduces it; neither check is among the features.  So the model adds what looks and
stands like personal data though a rule rejects it.

Null texts are empty; empty texts have no spans.  Repeated rows are judged alike.  Positions
are code points, end exclusive.  An empty table trains no model and gives no rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone", "number", "address", "secret")
N_BITS = 16
#: Possessive forms of the rules: same matches, no backtracking and no recursion.
BASE = {
    "email": (r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@"),
    "ip": (r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}", "."),
    "card": (r"[0-9](?:[\x20-]?[0-9]){11,}+", None),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", "+"),
}
GENERATORS = {
    "number": (r"\+?(?<![0-9])[0-9][0-9\x20().-]{6,}(?<=[0-9])(?![0-9])", None),
    "address": (
        r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?(?:@|[(\[]at[)\]])\x20?[A-Za-z0-9-]++"
        r"(?:\x20?(?:\.|[(\[]dot[)\]])\x20?[A-Za-z0-9-]++)++",
        None,
    ),
    "secret": (r"(?<![A-Za-z0-9_+/])(?=[A-Za-z_+/]*+[0-9])[A-Za-z0-9_+/]{16,}+", None),
}
CREDENTIAL = r"(?i)(?:password|passwd|pwd|token|secret|key)\s*[:=]\s*[\"']?$"
STEP = 256


def _total(a: Column) -> Column:
    return F.aggregate(a, F.lit(0), lambda s, x: s + x)


def _bind(x: Column, f) -> Column:
    """f(x) with x evaluated once, whatever the optimizer does to projections."""
    return F.transform(F.array(x), f)[0]


def _placed(t: Column, regex: str, sign: str | None) -> Column:
    """Array of (s, e, m, before, after) for each match; prefix sums go by blocks of STEP."""
    found = F.regexp_extract_all(t, F.lit(regex), F.lit(0))
    if sign:
        found = F.when(F.contains(t, F.lit(sign)), found).otherwise(F.array().cast("array<string>"))
    none = F.array().cast("array<struct<s:int,e:int,m:string,before:string,after:string>>")

    def block(i):
        return F.floor(i / STEP).cast("int")

    def place(found, gaps, sizes, sums):
        def one(m, i):
            start = (
                _total(F.slice(sums, F.lit(1), block(i)))
                + _total(F.slice(sizes, block(i) * STEP + 1, i % STEP))
                + F.length(F.get(gaps, i))
            )
            return F.struct(
                start.alias("s"),
                (start + F.length(m)).alias("e"),
                m.alias("m"),
                F.right(F.get(gaps, i), F.lit(24)).alias("before"),
                F.left(F.get(gaps, i + 1), F.lit(1)).alias("after"),
            )
        return F.transform(found, one)

    def with_sizes(found, gaps, sizes):
        sums = F.transform(
            F.sequence(F.lit(0), block(F.size(sizes))),
            lambda b: _total(F.slice(sizes, b * STEP + 1, F.lit(STEP))),
        )
        return _bind(sums, lambda x: place(found, gaps, sizes, x))

    def with_gaps(found, gaps):
        sizes = F.transform(found, lambda m, i: F.length(F.get(gaps, i)) + F.length(m))
        return _bind(sizes, lambda x: with_sizes(found, gaps, x))

    return _bind(
        found,
        lambda x: F.when(F.size(x) == 0, none).otherwise(_bind(F.split(t, regex, -1), lambda g: with_gaps(x, g))),
    )


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]+", "")


def _luhn(d: Column) -> Column:
    def add(s, i):
        x = F.substring(d, F.length(d) - i, F.lit(1)).cast("int") * (1 + i % 2)
        return s + x - F.when(x > 9, 9).otherwise(0)
    return F.aggregate(F.sequence(F.lit(0), F.length(d) - 1), F.lit(0), add) % 10 == 0


VALID = {
    "email": lambda m: F.lit(True),
    "ip": lambda m: F.forall(F.split(m, r"\."), lambda p: F.coalesce(p.try_cast("int") <= 255, F.lit(False))),
    "card": lambda m: F.when(F.length(_digits(m)).between(12, 19), _luhn(_digits(m))).otherwise(False),
    "phone": lambda m: F.length(_digits(m)).between(9, 15),
}


def _code(k: str, x: Column) -> Column:
    m, d = x["m"], F.length(_digits(x["m"]))
    bits = (
        F.lit(k == "number"), F.lit(k == "address"), d >= 9, d >= 12, d >= 16, d >= 20,
        m.startswith("+"), m.contains("("), m.contains(" "), m.contains("-"),
        F.length(m) - F.length(F.replace(m, F.lit("."), F.lit(""))) == 3,
        x["before"].rlike(r"[=:\"']$"), x["before"].rlike(r"(?:^|\s)$"), x["after"].rlike(r"^(?:$|[\s.,;:!?)\"'])"),
        m.rlike("[A-Za-z]"), F.length(m) >= 24,
    )
    code = F.lit(0)
    for i, b in enumerate(bits):
        code = code + F.when(b, 1 << i).otherwise(0)
    return code


def candidates(df: DataFrame) -> DataFrame:
    """``(doc_id, text)`` with ``base`` (array of s, k, e) and ``cand`` (array of s, k, e, code, y)."""
    t = F.col("text")
    a = df.withColumn("text", F.coalesce(t, F.lit("")))
    rules = F.struct(*[_placed(t, *v).alias(k) for k, v in BASE.items()])
    runs = F.struct(*[_placed(t, *v).alias(k) for k, v in GENERATORS.items()])

    def kept(found, k):
        return F.transform(
            F.filter(found[k], lambda x: VALID[k](x["m"])),
            lambda x: F.struct(x["s"].alias("s"), F.lit(KINDS.index(k)).alias("k"), x["e"].alias("e")),
        )

    def proposed(found, base, k):
        def one(x):
            met = F.exists(base, lambda y: (y["s"] < x["e"]) & (x["s"] < y["e"]))
            return _bind(
                met,
                lambda hit: F.struct(
                    x["s"].alias("s"),
                    F.lit(KINDS.index(k)).alias("k"),
                    x["e"].alias("e"),
                    _code(k, x).alias("code"),
                    (x["before"].rlike(CREDENTIAL) if k == "secret" else hit).alias("y"),
                    hit.alias("met"),
                ),
            )
        return F.transform(found[k], one)

    def both(base):
        cand = _bind(runs, lambda found: F.concat(*[proposed(found, base, k) for k in GENERATORS]))
        return F.struct(base.alias("base"), cand.alias("cand"))

    base = _bind(rules, lambda found: F.sort_array(F.concat(*[kept(found, k) for k in BASE])))
    return a.withColumn("_pii", _bind(base, both)).select(*df.columns, "_pii.base", "_pii.cand")


def fit(codes: np.ndarray, pos: np.ndarray, neg: np.ndarray, rounds: int = 20, rate: float = 0.5) -> list[tuple]:
    """Boosted trees of depth two on weighted binary codes: [(bit, (bit, v00, v01), (bit, v10, v11))]."""
    x = (codes[:, None] >> np.arange(N_BITS)) & 1
    f, n, trees = np.zeros(len(codes)), pos + neg, []
    def leaf(g, h):
        return g / (h + 1.0)
    def split(rows, g, h):
        on = x[rows].astype(float)
        g1, h1 = g[rows] @ on, h[rows] @ on
        g0, h0 = g[rows].sum() - g1, h[rows].sum() - h1
        gain = g1 * g1 / (h1 + 1) + g0 * g0 / (h0 + 1)
        b = int(np.argmax(gain))
        return gain[b], b, rate * leaf(g0[b], h0[b]), rate * leaf(g1[b], h1[b])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-f))
        g, h = pos - n * p, n * p * (1 - p)
        best = None
        for b in range(N_BITS):
            lo, hi = split(x[:, b] == 0, g, h), split(x[:, b] == 1, g, h)
            if best is None or lo[0] + hi[0] > best[0]:
                best = (lo[0] + hi[0], b, lo[1:], hi[1:])
        _, b, lo, hi = best
        trees.append((b, lo, hi))
        f += margin(x, [trees[-1]])
    return trees


def margin(x: np.ndarray, trees: list[tuple]) -> np.ndarray:
    out = np.zeros(len(x))
    for b, lo, hi in trees:
        a = np.where(x[:, lo[0]] == 1, lo[2], lo[1])
        c = np.where(x[:, hi[0]] == 1, hi[2], hi[1])
        out += np.where(x[:, b] == 1, c, a)
    return out


def calibrate(f: np.ndarray, pos: np.ndarray, neg: np.ndarray, precision: float, support: int) -> float:
    """Least margin from which isotonic precision holds with enough examples; inf if none."""
    order = np.argsort(f, kind="stable")
    blocks: list[list[float]] = []  # least margin, positives, all
    for i in order:
        blocks.append([f[i], float(pos[i]), float(pos[i] + neg[i])])
        while len(blocks) > 1 and (
            blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2] or blocks[-1][0] - blocks[-2][0] < 1e-9
        ):
            last = blocks.pop()
            blocks[-1][1] += last[1]
            blocks[-1][2] += last[2]
    good = [b for b in blocks if b[2] >= support and b[1] >= precision * b[2]]
    return good[0][0] if good else float("inf")


def train(cands: DataFrame, precision: float = 0.9, support: int = 20) -> tuple[list[tuple], float]:
    """Trees and threshold from the labelled code counts of all candidates."""
    rows = (
        cands.select(F.inline("cand")).groupBy("code").agg(F.count_if("y").alias("p"), F.count_if(~F.col("y")).alias("n"))
    ).collect()  # at most 2**N_BITS rows
    if not rows:
        return [], float("inf")
    rows.sort()
    codes, pos, neg = (np.array([r[i] for r in rows], float if i else np.int64) for i in range(3))
    trees = fit(codes, pos, neg)
    f = margin((codes[:, None] >> np.arange(N_BITS)) & 1, trees)
    return trees, calibrate(f, pos, neg, precision, support)


def _score(code: Column, trees: list[tuple]) -> Column:
    def bit(b):
        return code.bitwiseAND(F.lit(1 << b)) != 0
    def leaf(b, v0, v1):
        return F.when(bit(b), F.lit(float(v1))).otherwise(F.lit(float(v0)))
    total = F.lit(0.0)
    for b, lo, hi in trees:
        total = total + F.when(bit(b), leaf(*hi)).otherwise(leaf(*lo))
    return total


def detect(df: DataFrame, precision: float = 0.9) -> DataFrame:
    """Input with ``text`` whole, ``base`` and ``spans``: arrays of (s, k, e) sorted by start and kind."""
    found = candidates(df)
    trees, least = train(found, precision)
    added = F.transform(
        F.filter("cand", lambda x: ~x["met"] & (_score(x["code"], trees) >= least - 1e-9)),
        lambda x: F.struct(x["s"].alias("s"), x["k"].alias("k"), x["e"].alias("e")),
    ) if trees and least < float("inf") else F.slice("base", 1, 0)
    return found.withColumn("spans", F.sort_array(F.concat("base", added))).drop("cand")


def redact(df: DataFrame, precision: float = 0.9) -> DataFrame:
    """``df`` with every span of ``text`` replaced by its kind in square brackets; null stays null."""
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns if c != "text"])  # whatever their names
    found = detect(df.select(row.alias("_rest"), "text", F.col("text").isNull().alias("_null")), precision)
    # overlapping spans: each starts where the ones before it have ended
    cut = F.transform(
        "spans",
        lambda x, i: F.struct(
            F.greatest(x["s"], F.coalesce(F.get("reach", i - 1), F.lit(0))).alias("s"),
            F.greatest(x["e"], F.coalesce(F.get("reach", i - 1), F.lit(0))).alias("e"),
            F.coalesce(F.get("reach", i - 1), F.lit(0)).alias("from"),
            x["k"].alias("k"),
        ),
    )
    # the furthest end so far: of whole chunks of about the root of the number of spans, and of the own chunk
    side = F.ceil(F.sqrt(F.greatest(F.size("spans"), F.lit(1)))).cast("int")
    chunk = F.transform(F.sequence(F.lit(0), F.col("side") - 1), lambda j: F.array_max(F.transform(F.slice("spans", j * F.col("side") + 1, F.col("side")), lambda y: y["e"])))
    def furthest(x, i):
        j = F.floor(i / F.col("side")).cast("int")
        near = F.slice("spans", j * F.col("side") + 1, i - j * F.col("side") + len(KINDS))  # with those of the same start
        return F.greatest(F.array_max(F.slice("chunk", F.lit(1), j)), F.array_max(F.transform(near, lambda y: F.when(y["s"] <= x["s"], y["e"]))))
    a = found.withColumn("side", side).withColumn("chunk", chunk).withColumn("reach", F.transform("spans", furthest)).withColumn("cut", cut)
    name = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    body = F.array_join(
        F.transform(
            "cut",
            lambda x: F.when(x["e"] <= x["from"], F.lit("")).otherwise(
                F.concat(F.substring("text", x["from"] + 1, x["s"] - x["from"]), F.when(x["s"] < x["e"], F.get(name, x["k"])))
            ),
        ),
        "",
    )
    tail = F.coalesce(F.array_max("reach"), F.lit(0))
    new = F.concat(body, F.substring("text", tail + 1, F.greatest(F.length("text") - tail, F.lit(0))))
    new = F.when(F.col("_null"), F.lit(None)).when(F.size("spans") == 0, F.col("text")).otherwise(new)
    return a.select(*[new.alias("text") if c == "text" else F.col(f"_rest.`{c}`") for c in df.columns])


def _joined(spans: str) -> Column:
    name = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(name, x["k"]), x["s"], x["e"])), ",")


def op3_pii(spark, sf_dir: str) -> DataFrame:
    found = detect(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return found.select(
        "doc_id",
        *[
            F.expr(f"size(filter(base, x -> x.k = {i}))").cast("long").alias(f"n_{k}")
            for i, k in enumerate(KINDS[:4])
        ],
        F.sha2(_joined("base"), 256).alias("base_sha256"),
        _joined("spans").alias("spans"),
    )
