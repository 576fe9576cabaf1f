from pyspark.sql import functions as F

from tarnweave.streaming.incremental import Buckets, latest_events, merge_batches, run_available


def test_stream_equals_batch_and_replay_changes_nothing(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.repartition(4, "event_id").write.parquet(f"{tmp_path}/in")
    table = Buckets(spark, f"{tmp_path}/out", ["user_id"], 4)
    got = latest_events(spark, f"{tmp_path}/in", table, f"{tmp_path}/one")
    want = events.groupBy("user_id").agg(F.max_by("event_id", F.struct("ts", "event_id")).alias("event_id"))
    rows = got.select("user_id", "event_id")
    assert rows.exceptAll(want).isEmpty() and want.exceptAll(rows).isEmpty()
    before = sorted(map(tuple, got.collect()))
    again = latest_events(spark, f"{tmp_path}/in", table, f"{tmp_path}/two")
    assert sorted(map(tuple, again.collect())) == before


def test_merge_over_batches_equals_batch_and_replay_changes_nothing(spark, tmp_path):
    from tarnweave.plans.storage import first_known_events

    schema = "event_id long, ts long, user_id long, event_type string, value double"
    batches = [[(3, 3, 1, "view", None), (4, 4, None, "view", 4.0)], [(2, 2, 1, "purchase", 2.0)], [(1, 1, 1, "click", None), (5, 5, 2, None, None)]]
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    kept, merged = Buckets(spark, f"{tmp_path}/kept", ["user_id"], 4), Buckets(spark, f"{tmp_path}/merged", ["user_id"], 4)
    for turn in ("one", "two"):
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
        run_available(stream, merge_batches(kept, merged, ["user_id"], ["event_id"], [F.col("ts")], first_known_events), f"{tmp_path}/{turn}")
        rows = sorted((tuple(r) for r in merged.read().collect()), key=str)
        assert rows == sorted([(1, 2.0, 2, "click,purchase,view"), (2, None, None, ""), (None, 4.0, None, "view")], key=str)
    assert kept.read().count() == 5


def test_only_touched_folders_are_rewritten(spark, tmp_path):
    import glob
    import os

    table = Buckets(spark, f"{tmp_path}/t", ["k"], 8)
    put = lambda rows: table.change(rows, lambda old: rows if old is None else old.join(rows.select("k"), "k", "left_anti").unionByName(rows))
    put(spark.range(200).select(F.col("id").alias("k"), F.lit(1).alias("v")))
    before = set(glob.glob(f"{tmp_path}/t/data/*/*.parquet"))
    put(spark.createDataFrame([(7, 2)], "k long, v int"))
    after = set(glob.glob(f"{tmp_path}/t/data/*/*.parquet"))
    assert len(before) == len(after) == 8 and len(before - after) == 1 and len(after - before) == 1  # old files go
    apply, table._apply = table._apply, lambda: None  # stopped before the folders are replaced
    put(spark.createDataFrame([(8, 3)], "k long, v int"))
    table._apply = apply
    assert os.path.exists(f"{tmp_path}/t/aside/_SUCCESS")
    got = dict(map(tuple, table.read().collect()))  # applied now
    assert got == dict.fromkeys(range(200), 1) | {7: 2, 8: 3} and not os.path.exists(f"{tmp_path}/t/aside")


def test_late_amendments_equal_the_batch_and_replay_changes_nothing(spark, tmp_path):
    from tarnweave.streaming.corrections import keep_amendments

    schema = "lot string, notice long, ref string, day string"
    batches = [
        [("a", 1, "x", "2024-02"), ("b", 1, "q", None)],
        [("a", 1, "y", "2024-01"), ("a", 2, "z", "2024-05"), ("b", 1, "r", "2024-01"), (None, 3, "n", "2024-01")],
        [("a", 1, "w", "2024-03"), ("c", 9, None, "2023-01"), ("c", 9, None, "2023-01")],
    ]
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    want = {}
    for row in sorted((r for b in batches for r in b), key=lambda r: (r[3] or "", r[2] or "")):
        want.setdefault(row[:2], row)
    table = Buckets(spark, f"{tmp_path}/out", ["lot", "notice"], 4)
    for turn in ("one", "two"):
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
        keep_amendments(stream, table, ["lot", "notice"], ["day", "ref"], f"{tmp_path}/{turn}")
        assert {tuple(r) for r in table.read().collect()} == set(want.values())


def test_arriving_subjects(spark, tmp_path):
    """Against the rule applied batch by batch; a batch that stops before its last table is repeated."""
    import random

    from tarnweave.streaming.resolution import Resolver

    r = random.Random(4)
    value = {i: r.randrange(60) for i in range(1, 25)}
    batches = [sorted(value)[k::3] for k in range(3)]
    cluster = {}
    for batch in batches:
        root = {i: cluster.get(i, i) for i in [*cluster, *batch]}
        size = {c: list(cluster.values()).count(c) for c in cluster.values()}
        group = {x: {x} for x in set(root.values())}
        for i in root:
            for j in root:
                if (i in batch or j in batch) and abs(value[i] - value[j]) <= 1:
                    both = group[root[i]] | group[root[j]]
                    for x in both:
                        group[x] = both
        cluster = {i: min(group[x], key=lambda c: (-size.get(c, 0), c)) for i, x in root.items()}
    found = Resolver(
        spark, str(tmp_path), lambda df: df.select(F.explode(F.array(F.col("x"), F.col("x") + 1)).alias("key"), "id"), lambda p: p.where("abs(a_x - b_x) <= 1"), 3
    )
    for n, batch in enumerate(batches):
        df = spark.createDataFrame([(i, value[i]) for i in batch], "id long, x int").cache()
        if n == 1:
            change, found.subjects.change = found.subjects.change, lambda *_: None
            found(df, n)
            found.subjects.change = change
        found(df, n)
        found(df, n)
    assert dict(map(tuple, found.clusters().collect())) == cluster
    sizes = {x.entity: x.size for x in found.entities.read().where("entity = parent").collect()}
    assert sizes == {c: list(cluster.values()).count(c) for c in cluster.values()}


def test_polls_read_no_page_twice(spark, tmp_path):
    from tarnweave.sources.paging import Pages, write_pages

    spark.dataSource.register(Pages)
    got = []
    for k in range(3):
        write_pages(spark.range(k * 40, k * 40 + 40), f"{tmp_path}/some-{k}", ["id"], 10)
        spark.read.json(f"{tmp_path}/some-{k}").withColumn("page", F.col("page") + 4 * k).write.mode("append").partitionBy("page").json(f"{tmp_path}/list")
        stream = spark.readStream.format("pages").option("path", f"{tmp_path}/list").option("columns", "id long, page long").load()
        run_available(stream, lambda batch, n, k=k: got.extend((k, r.page, r.id) for r in batch.collect()), f"{tmp_path}/checkpoint")
    assert sorted(got) == [(i // 40, i // 10, i) for i in range(120)]


def test_tasks_of_a_poll_read_several_pages(tmp_path):
    """One task a page made as many tasks as pages."""
    from pyspark.sql.types import StructType

    from tarnweave.sources.paging import Pages

    for page in range(40):
        (tmp_path / f"page={page}").mkdir()
        for part in "ab":
            (tmp_path / f"page={page}" / f"{part}.json").write_text('{"id": %d}\n' % page)
    options = {"path": str(tmp_path), "columns": "id long, page long", "most": "16"}
    reader = Pages(options).streamReader(StructType.fromDDL(options["columns"]))
    tasks = reader.partitions({"pages": 3}, {"pages": 40})
    assert [len(x.files) for x in tasks] == [32, 32, 10]
    assert [r for x in tasks for r in reader.read(x)] == [(i, i) for i in range(3, 40) for _ in range(2)]


def test_batches_have_adaptive_plans(spark, tmp_path):
    """A stream's session has none, so every join of a batch had all shuffle partitions and no skew handling."""
    spark.range(10).write.parquet(f"{tmp_path}/in")
    seen = []
    stream = spark.readStream.schema("id long").parquet(f"{tmp_path}/in")
    run_available(stream, lambda batch, n: seen.append((batch.sparkSession.conf.get("spark.sql.adaptive.enabled"), batch.count())), f"{tmp_path}/checkpoint")
    assert seen == [("true", 10)]


def test_amendments_are_a_streaming_aggregate(spark, tmp_path):
    """No row goes through a Python worker, and the query's batches are written by all tasks."""
    import inspect

    from tarnweave.plans import flows
    from tarnweave.streaming.corrections import amendments

    spark.range(4).selectExpr("id AS lot", "id AS notice", "'x' AS day").write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("lot long, notice long, day string").parquet(f"{tmp_path}/in")
    plan = amendments(stream, ["lot", "notice"], ["day"])._jdf.queryExecution().analyzed().toString()
    assert "Aggregate" in plan and "TransformWithState" not in plan
    assert "coalesce(1)" not in inspect.getsource(flows)


def test_scan_stops_at_the_first_known_wave(spark):
    from tarnweave.sources.paging import until_known

    pages = spark.createDataFrame([(i, i // 3) for i in range(30)], "id int, page int")
    for wave in (1, 2, 4):
        for known in ([], [9, 10, 11], [6, 7, 8, 9, 10, 11, 12], list(range(30)), [0, 1, 2]):
            want = []
            for w in range(0, 10, wave):
                here = [i for i in range(30) if w <= i // 3 < w + wave]
                if all(i in known for i in here):
                    break
                want += [i for i in here if i not in known]
            k = spark.createDataFrame([(i,) for i in known], "id int")
            assert sorted(r.id for r in until_known(pages, k, "id", wave).collect()) == want


def test_windows_are_pushed_to_the_pages(spark, tmp_path):
    import datetime as dt

    from pyspark.sql.datasource import EqualTo, GreaterThanOrEqual, LessThan
    from pyspark.sql.types import StructType

    from tarnweave.sources.paging import Pages, write_pages

    days = spark.range(60).select("id", F.date_add(F.lit("2024-01-01"), (F.col("id") / 6).cast("int")).alias("d"))
    write_pages(days, f"{tmp_path}/p", ["id"], 2, "d")
    options = {"path": f"{tmp_path}/p", "columns": "id long, day date", "id": "id", "most": "4"}
    schema = StructType.fromDDL(options["columns"])
    reader = Pages(options).reader(schema)
    window = [GreaterThanOrEqual(("day",), dt.date(2024, 1, 3)), LessThan(("day",), dt.date(2024, 1, 6))]
    assert list(reader.pushFilters(window)) == []
    tasks = reader.partitions()
    assert len(tasks) == 3 and sum(len(x.files) for x in tasks) == 9  # three days of three pages, at most four pages a task
    point = Pages(options).reader(schema)
    assert list(point.pushFilters([EqualTo(("id",), 13)])) == []
    assert [x for task in point.partitions() for x in point.read(task)] == [(13, dt.date(2024, 1, 3))]
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(Pages)
    rows = spark.read.format("pages").options(**options).load().where("day >= DATE '2024-01-03' AND day < DATE '2024-01-06'")
    assert sorted(r.id for r in rows.collect()) == list(range(12, 30)) and rows.rdd.getNumPartitions() == 3


def test_one_json_document_in_many_ranges(spark, tmp_path):
    """Any splits give the records that a whole parse gives; other arrays, nested values and brackets in strings are no records."""
    import json
    import random

    from tarnweave.sources.bigjson import json_records

    r = random.Random(6)
    odd = ['"', "\\", "{", "}", "[", "]", "}}", "a", "é", "\n", ",", ":", '\\"}', "releases"]
    value = lambda depth: r.choice(
        [lambda: "".join(r.choice(odd) for _ in range(r.randrange(6))), lambda: r.randrange(100), lambda: None, lambda: [value(depth + 1) for _ in range(r.randrange(3))] if depth < 3 else [], lambda: {r.choice(odd): value(depth + 1) for _ in range(r.randrange(3))} if depth < 3 else {}]
    )()
    releases = [{"id": i, "x": value(0), "y{": value(0)} for i in range(150)] + [{}]
    docs = {
        "first": {"releases": releases, "other": [{"id": 1}], "z": {"releases": [{"id": 2}]}},
        "last": {"uri": 'a"{[', "n": 3, "publisher": {"name": "}"}, "tags": ["a", "}"], "links": [{"id": 5}, {}], "releases": releases},
        "none": {"other": [{"id": 1}, {"a": {"b": {}}}]},
        "empty": {"releases": [], "after": [{"id": 9}]},
    }
    for name, doc in docs.items():
        for indent in (None, 1):
            at = tmp_path / f"{name}-{indent}.json"
            at.write_text(json.dumps(doc, ensure_ascii=indent is None, indent=indent))
            for size in (1 << 20, 600) if len(doc.get("releases", [])) > 9 else (1 << 20, 7):
                spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
                spark.conf.set("spark.sql.files.openCostInBytes", "0")
                got = [json.loads(x.text) for x in json_records(spark, str(at)).orderBy("number").collect()]
                assert got == doc.get("releases", []), (name, indent, size)
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")
