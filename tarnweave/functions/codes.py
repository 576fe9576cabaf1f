"""Tax codes and organisation names as Column expressions; nothing here needs Python on an executor."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Company forms that names lose, letters that they keep, and the odd-position values of the
#: person code's checksum for 0-9 and A-Z.
COMPANY_FORMS = (
    r"s\.?r\.?l\.?", r"s\.?p\.?a\.?", r"s\.?n\.?c\.?", r"s\.?a\.?s\.?", r"s\.?c\.?r\.?l\.?",
    r"s\.?c\.?p\.?a\.?", r"scarl", r"coop\.?", r"cooperativa", r"s\.?[\s\x{A0}]*coop\.?",
)
KEPT = "a-z0-9àèéìòù"
ODD = (
    1, 0, 5, 7, 9, 13, 15, 17, 19, 21,
    1, 0, 5, 7, 9, 13, 15, 17, 19, 21, 2, 4, 18, 20, 11, 3, 6, 8, 12, 14, 16, 10, 22, 25, 24, 23,
)
PERSON = "^[A-Z]{6}[0-9A-Z]{2}[A-Z][0-9A-Z]{2}[A-Z][0-9A-Z]{3}[A-Z]$"


def normalize_code(raw: Column) -> Column:
    """Upper-cased code without a leading IT and white space; null unless 8 to 16 letters and digits."""
    v = F.regexp_replace(F.regexp_replace(F.upper(F.trim(raw)), "^IT", ""), r"[\s\x{A0}]+", "")
    return F.when(v.rlike("^[0-9A-Z]{8,16}$"), v)


def normalize_name(raw: Column) -> Column:
    """Lower-cased name without company forms and punctuation; null gives the empty string.

    Word boundaries are ASCII ones, so a form that follows an accented letter is dropped too.
    """
    forms = f"(?:{'|'.join(COMPANY_FORMS)})"
    edge = r"(?:(?<=[0-9A-Za-z_])(?![0-9A-Za-z_])|(?<![0-9A-Za-z_])(?=[0-9A-Za-z_]))"
    v = F.regexp_replace(F.lower(raw), edge + forms + edge, "")
    v = F.regexp_replace(v, rf"[^{KEPT}\s\x{{A0}}]+", " ")
    return F.coalesce(F.trim(F.regexp_replace(v, r"[\s\x{A0}]+", " ")), F.lit(""))


def _digit(s: Column, i: Column) -> Column:
    return F.substring(s, i, F.lit(1)).try_cast("int")


def vat_valid(s: Column) -> Column:
    """Eleven digits whose weighted sum of ten ends in what the last completes to ten."""

    def add(total, i):
        x = _digit(s, i) * F.when(i % 2 == 0, 2).otherwise(1)
        return total + x - F.when(x > 9, 9).otherwise(0)

    total = F.aggregate(F.sequence(F.lit(1), F.lit(10)), F.lit(0), add)
    check = (F.lit(10) - total % 10) % 10
    return F.coalesce(F.when(s.rlike("^[0-9]{11}$"), check == _digit(s, F.lit(11))), F.lit(False))


def person_valid(s: Column) -> Column:
    """A 16-character person code whose check letter holds."""
    odd = F.array(*[F.lit(v) for v in ODD])

    def place(i):
        return F.instr(F.lit("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"), F.substring(s, i, F.lit(1))) - 1

    def add(total, i):
        even = F.when(place(i) > 9, place(i) - 10).otherwise(place(i))
        return total + F.when(i % 2 == 1, F.get(odd, place(i))).otherwise(even)

    total = F.aggregate(F.sequence(F.lit(1), F.lit(15)), F.lit(0), add)
    return F.coalesce(F.when(s.rlike(PERSON), F.char(total % 26 + 65) == F.substring(s, 16, 1)), F.lit(False))


def classify(raw: Column) -> Column:
    """Struct (kind, valid): PIVA, CF, NUM_BAD, FOREIGN or OTHER, tested in this order."""
    s = F.upper(F.trim(F.coalesce(raw, F.lit(""))))
    kind = (
        F.when(s.rlike("^[0-9]{11}$"), "PIVA")
        .when(F.length(s) == 16, F.when(s.rlike(PERSON), "CF"))
    )
    kind = F.coalesce(
        kind,
        F.when(s.rlike("^[0-9]{8,13}$"), "NUM_BAD").when(s.rlike("^[A-Z]{2}[0-9A-Z]{3,}$"), "FOREIGN").otherwise("OTHER"),
    )
    valid = F.when(kind == "PIVA", vat_valid(s)).when(kind == "CF", person_valid(s)).otherwise(False)
    return F.struct(kind.alias("kind"), valid.alias("valid"))


def relation(left: Column, right: Column, typo: int = 2) -> Column:
    """same, diff or inconclusive for two codes."""
    a, b = (F.upper(F.trim(F.coalesce(c, F.lit("")))) for c in (left, right))
    x, y = classify(a), classify(b)
    near = F.levenshtein(a, b) <= typo
    both = lambda k: (x["kind"] == k) & (y["kind"] == k)
    typed = F.when(x["valid"] & y["valid"], "diff").when(near, "same").otherwise("inconclusive")
    bad = ((x["kind"] == "PIVA") & x["valid"] & (y["kind"] == "NUM_BAD")) | ((y["kind"] == "PIVA") & y["valid"] & (x["kind"] == "NUM_BAD"))
    return (
        F.when((a != "") & (a == b), "same")
        .when(both("PIVA") | both("CF"), typed)
        .when((x["kind"] == "FOREIGN") | (y["kind"] == "FOREIGN"), "diff")
        .when(bad & near, "same")
        .otherwise("inconclusive")
    )


def verdict(left: Column, right: Column, left_name: Column, right_name: Column) -> Column:
    """merge, bridge, review or reject: the code decides, the name only between a person and a VAT code."""
    rel = relation(left, right)
    x, y = classify(left), classify(right)
    bare = lambda c: F.regexp_replace(F.coalesce(c, F.lit("")), r"[\s\x{A0}]+", "")
    pair = lambda p, q: (p["kind"] == "CF") & p["valid"] & (q["kind"] == "PIVA") & q["valid"]
    named = bare(left_name) == bare(right_name)
    return (
        F.when(rel == "diff", "reject")
        .when(rel == "same", "merge")
        .when(named & (pair(x, y) | pair(y, x)), "bridge")
        .otherwise("review")
    )


def near_names(a: Column, b: Column, least: int = 8, edit: int = 2, share: float = 0.2) -> Column:
    """Candidate names: equal and not empty, or long, of similar length and few edits apart."""
    d = F.pmod(F.levenshtein(a, b, edit) - 1, F.lit(1 << 30)) + 1  # 0 and -1 (too far) become very large, so the distance is computed once
    short = F.least(F.length(a), F.length(b))
    fuzzy = (short >= least) & (F.abs(F.length(a) - F.length(b)) <= edit) & (d / short <= share)
    return ((a == b) & (a != "")) | fuzzy


def money(x: Column) -> Column:
    """Sum of amounts as decimals, so that it doesn't depend on the order of rows; 0 for none."""
    return F.coalesce(F.sum(x.cast("decimal(18,2)")), F.lit(0)).cast("double")


def percentile_floor(x: str, p: float) -> Column:
    """Aggregate: the element at floor(p * n) of the sorted values, the last one at most; null without values.

    From the other end that is the first value that at least a share 1 - p reaches.  Spark counts equal values on the map side,
    so a group takes as much memory as it has different values.
    """
    return F.expr(f"percentile_disc({round(1 - p, 12)!r}D) WITHIN GROUP (ORDER BY `{x}` DESC)")
