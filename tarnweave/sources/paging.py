"""Paged and windowed reads: keyset pages, balanced date ranges, scans up to what is known, and a source of pages."""

from __future__ import annotations

import datetime as dt
import json
import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceStreamReader,
    EqualTo,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    LessThan,
    LessThanOrEqual,
)

from tarnweave.plans.durable import cut


def keyset_page(df: DataFrame, order: list[str], after: tuple | None, size: int) -> DataFrame:
    """The next ``size`` rows after a key in a total order."""
    if after is not None:
        past, same = F.lit(False), F.lit(True)
        for name, value in zip(order, after, strict=True):
            past = past | (same & (F.col(name) > F.lit(value)))
            same = same & (F.col(name) == F.lit(value))
        df = df.where(past)
    return df.orderBy(*order).limit(size)


def balanced_ranges(days: dict[dt.date, int], first: dt.date, last: dt.date, most: int) -> list[tuple[dt.date, dt.date, int]]:
    """Disjoint ranges of days, in order, with at most ``most`` rows unless it is one day.

    A range with more is halved; empty ranges are dropped.  ``days`` has one entry a day.
    """
    out, stack = [], [(first, last)]
    while stack:
        a, b = stack.pop()
        n = sum(c for d, c in days.items() if a <= d <= b)
        if n <= most or a == b:
            if n:
                out.append((a, b, n))
            continue
        mid = a + dt.timedelta(days=(b - a).days // 2)
        stack += [(mid + dt.timedelta(days=1), b), (a, mid)]
    return out


def window_plan(df: DataFrame, column: str, most: int) -> list[tuple[dt.date, dt.date, int]]:
    """``balanced_ranges`` of a table; only one count per day comes to the driver."""
    rows = df.groupBy(F.col(column).cast("date").alias("d")).agg(F.count("*").alias("n")).where("d IS NOT NULL").collect()
    days = {r.d: r.n for r in rows}
    return balanced_ranges(days, min(days), max(days), most) if days else []


def windows(df: DataFrame, column: str, most: int) -> DataFrame:
    """``(first_day, last_day, n)``: disjoint ranges of days with at most ``most`` rows unless it is one day, as ``balanced_ranges``.

    One row a day carries its window; each round halves the windows that hold too much, so there are as many rounds as the span has binary digits.
    """
    days = df.groupBy(F.col(column).cast("date").alias("d")).agg(F.count("*").alias("n")).where("d IS NOT NULL")
    ends = days.agg(F.min("d").alias("a"), F.max("d").alias("b")).first()
    if ends.a is None:
        return days.select(F.col("d").alias("first_day"), F.col("d").alias("last_day"), "n")
    at = days.select("d", "n", F.lit(ends.a).alias("a"), F.lit(ends.b).alias("b"))
    for _ in range((ends.b - ends.a).days.bit_length()):
        held = at.groupBy("a", "b").agg(F.sum("n").alias("held"))
        mid = F.expr("date_add(a, CAST(floor(datediff(b, a) / 2) AS INT))")
        at = at.join(held, ["a", "b"]).withColumn("mid", F.when((F.col("held") > most) & (F.col("a") < F.col("b")), mid))
        right = F.col("d") > F.col("mid")
        at = at.select("d", "n", F.when(right, F.date_add("mid", 1)).otherwise(F.col("a")).alias("a"), F.when(~right, F.col("mid")).otherwise(F.col("b")).alias("b"))
        at = cut(at)
    return at.groupBy(F.col("a").alias("first_day"), F.col("b").alias("last_day")).agg(F.sum("n").alias("n"))


def until_known(pages: DataFrame, known: DataFrame, key: str, wave: int = 1) -> DataFrame:
    """Rows of a list of pages, newest first (``page`` from 0), that a scan brings in: unseen ones of the pages before
    the first wave of ``wave`` pages in which every row is known."""
    at = F.floor(F.col("page") / wave).alias("_wave")
    unseen = pages.join(known.select(key).distinct(), key, "left_anti").withColumn("_wave", at)
    all_known = pages.select(at).distinct().join(unseen.select("_wave").distinct(), "_wave", "left_anti")
    stop = all_known.agg(F.min("_wave").alias("_stop"))  # one row
    return unseen.join(F.broadcast(stop), F.col("_stop").isNull() | (F.col("_wave") < F.col("_stop"))).drop("_wave", "_stop")


def paged(df: DataFrame, order: list[str], size: int) -> DataFrame:
    """Rows with the number of their ``page`` of ``size`` rows in ``order``, from 0."""
    from tarnweave.operators.network import numbered

    return numbered(df, order, "_row").withColumn("page", F.floor((F.col("_row") - 1) / size)).drop("_row")


def write_pages(df: DataFrame, path: str, order: list[str], size: int, day: str | None = None) -> None:
    """Numbered pages of ``size`` rows in ``order``, as a paged service keeps them: ``page=<n>``, under ``day=<date>`` of a column if one is named."""
    rows = paged(df, order, size)
    if day:
        rows = rows.withColumn("day", F.col(day).cast("date"))
    by = ["day", "page"] if day else ["page"]
    rows.repartition("page").write.mode("append").partitionBy(*by).json(path)


class Pages(DataSource):
    """A paged list of JSON rows in a folder that the cluster shares (any address that Arrow's file systems open).

    Options: ``path``, ``columns`` (the schema), ``id`` (a column that equal filters look up), ``most`` (pages of a read task).

    In batch, filters on ``day`` are pushed down: only days inside the window are listed, and the window is split into balanced
    ranges of days with at most ``most`` pages (unless a day has more), a task each.  An equal filter on the id is taken at the page.
    As a stream, tasks read ``most`` pages each and an offset is the number of pages read so far, so a poll reads pages that it doesn't know and stops at the first
    that it does; after a stop it goes on from the checkpoint and reads no page again.
    """

    @classmethod
    def name(cls) -> str:
        return "pages"

    def schema(self) -> str:
        return self.options["columns"]

    def reader(self, schema) -> DataSourceReader:
        return _PageReader(self.options, schema)

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _PageStream(self.options, schema)


class _Task(InputPartition):
    def __init__(self, files: list[str], wanted: list | None = None):
        self.files, self.wanted = files, wanted


def _listed(path: str) -> list[tuple[dt.date | None, int, str]]:
    """(day, page, file) of a folder of pages."""
    from pyarrow import fs

    system, root = fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{os.path.abspath(path)}")
    found = []
    for x in system.get_file_info(fs.FileSelector(root, recursive=True)):
        parts = dict(p.split("=", 1) for p in x.path.split("/") if "=" in p)
        if x.is_file and x.path.endswith(".json") and "page" in parts:
            found.append((dt.date.fromisoformat(parts["day"]) if "day" in parts else None, int(parts["page"]), x.path))
    return sorted(found, key=lambda f: (f[0] or dt.date.min, f[1], f[2]))


def _rows(path: str, files: list[str], fields, key: str | None, wanted: list | None):
    from pyarrow import fs

    system, _ = fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{os.path.abspath(path)}")
    for name in files:
        parts = dict(p.split("=", 1) for p in name.split("/") if "=" in p)
        with system.open_input_stream(name) as f:
            text = f.read().decode()
        for line in text.splitlines():
            row = json.loads(line) | {"page": int(parts["page"]), "day": parts.get("day")}
            if wanted is None or row.get(key) in wanted:
                yield tuple(_value(row.get(n), kind) for n, kind in fields)


def _value(x, kind: str):
    if x is None:
        return None
    if kind == "date":
        return dt.date.fromisoformat(x[:10])
    if kind == "string" and not isinstance(x, str):
        return json.dumps(x)
    return float(x) if kind in ("double", "float") else x


class _PageReader(DataSourceReader):
    def __init__(self, options, schema):
        self.path, self.key, self.most = options["path"], options.get("id"), int(options.get("most", "8"))
        self.fields = [(f.name, f.dataType.simpleString()) for f in schema.fields]
        self.first, self.last, self.wanted = dt.date.min, dt.date.max, None

    def pushFilters(self, filters):
        day, one = dt.timedelta(days=1), dt.date
        for f in filters:
            of = getattr(f, "attribute", None)
            if of == ("day",) and isinstance(f, GreaterThanOrEqual | EqualTo) and isinstance(f.value, one):
                self.first = max(self.first, f.value)
            if of == ("day",) and isinstance(f, LessThanOrEqual | EqualTo) and isinstance(f.value, one):
                self.last = min(self.last, f.value)
            if of == ("day",) and isinstance(f, GreaterThan):
                self.first = max(self.first, f.value + day)
            if of == ("day",) and isinstance(f, LessThan):
                self.last = min(self.last, f.value - day)
            if self.key and of == (self.key,) and isinstance(f, EqualTo | In):
                self.wanted = [f.value] if isinstance(f, EqualTo) else list(f.value)
            elif of != ("day",) or not isinstance(f, GreaterThanOrEqual | LessThanOrEqual | GreaterThan | LessThan | EqualTo | IsNotNull):
                yield f

    def partitions(self):
        pages = [x for x in _listed(self.path) if x[0] is None or self.first <= x[0] <= self.last]
        days: dict[dt.date, int] = {}
        for day, _, _ in pages:
            days[day or dt.date.min] = days.get(day or dt.date.min, 0) + 1
        ranges = balanced_ranges(days, min(days), max(days), self.most) if days else []
        return [_Task([f for d, _, f in pages if a <= (d or dt.date.min) <= b], self.wanted) for a, b, _ in ranges] or [_Task([])]

    def read(self, partition):
        yield from _rows(self.path, partition.files, self.fields, self.key, partition.wanted)


class _PageStream(DataSourceStreamReader):
    def __init__(self, options, schema):
        self.path, self.key, self.most = options["path"], options.get("id"), int(options.get("most", "8"))
        self.fields = [(f.name, f.dataType.simpleString()) for f in schema.fields]

    def initialOffset(self) -> dict:
        return {"pages": 0}

    def latestOffset(self) -> dict:
        return {"pages": max((p for _, p, _ in _listed(self.path)), default=-1) + 1}

    def partitions(self, start: dict, end: dict):
        new: dict[int, list[str]] = {}
        for _, page, name in _listed(self.path):
            if start["pages"] <= page < end["pages"]:
                new.setdefault(page, []).append(name)
        pages = list(new.values())
        return [_Task(sum(pages[i : i + self.most], [])) for i in range(0, len(pages), self.most)] or [_Task([])]

    def read(self, partition):
        yield from _rows(self.path, partition.files, self.fields, self.key, None)

    def commit(self, end: dict) -> None:
        pass
