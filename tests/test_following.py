"""Kept views by deltas, change rows, history, row reconciliation, hot lookups, streams, profiles."""

import glob
import os
import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import millrace as m
from conftest import plan, rows

SALES = "id long, day string, kind string, price decimal(10,2)"
VIEW = {
    "group_by": ["day", "kind"],
    "measures": {"n": "count", "priced": ("count", "price"), "total": ("sum", "price"), "mean": ("avg", "price"),
                 "low": ("min", "price"), "high": ("max", "price")},
}


def sales(spark, seed, n=200, days=4):
    pick = random.Random(seed)
    data = [(i, pick.choice([f"0{pick.randrange(days)}", None]), pick.choice(["a", "b", None]),
             pick.choice([None, Decimal(pick.randrange(500)) / 100])) for i in range(n)]
    return spark.createDataFrame(data, SALES)


def whole(df):
    return rows(df.groupBy("day", "kind").agg(
        F.count(F.lit(1)), F.count("price"), F.sum("price"), F.sum("price").cast("double") / F.count("price"),
        F.min("price"), F.max("price")))


def shown(spark, path):
    view = m.read_view(spark, path, **VIEW)
    return rows(view)


def files(path):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/**/*.parquet", recursive=True)}


# --- views ----------------------------------------------------------------------------------


@pytest.mark.parametrize("parts", [["day"], []])
def test_a_view_follows_its_source(spark, tmp_path, parts):
    path, table = str(tmp_path / "view"), sales(spark, 1)
    m.create_view(table, path, **VIEW, partition_by=parts)
    assert shown(spark, path) == whole(table)
    more = sales(spark, 2).withColumn("id", F.col("id") + 1000)
    m.apply_delta(path, **VIEW, added=more, partition_by=parts)
    table = table.union(more)
    assert shown(spark, path) == whole(table)
    # Rows are replaced and taken away, extremes and whole groups among them.
    gone = table.filter("id % 3 = 0 OR price IN (0.01, 4.99) OR day = '02' AND kind = 'a'")
    new = gone.filter("id % 2 = 0").withColumn("kind", F.lit("c"))
    after = table.join(gone.select("id"), "id", "left_anti").select(*table.columns).union(new)
    m.apply_delta(path, **VIEW, added=new, removed=gone, source=after, partition_by=parts)
    assert shown(spark, path) == whole(after)


def test_a_delta_rewrites_only_the_partitions_it_touches_and_may_be_repeated(spark, tmp_path):
    path, table = str(tmp_path / "view"), sales(spark, 3)
    m.create_view(table, path, **VIEW, partition_by=["day"])
    before = files(path)
    more = spark.createDataFrame([(900, "01", "z", None), (901, None, "z", Decimal("1.00"))], SALES)
    for _ in range(2):
        m.apply_delta(path, **VIEW, added=more, partition_by=["day"], run_id="r1")
        assert shown(spark, path) == whole(table.union(more))
    after = files(path)
    kept = {f for f in before if "day__part=01" not in f and "HIVE_DEFAULT" not in f}
    assert kept and all(after[f] == before[f] for f in kept)
    assert not {f for f in before if "day__part=01" in f} & set(after)
    assert m.apply_delta(path, **VIEW, added=more.limit(0), partition_by=["day"]) == []
    assert files(path) == after


def test_a_delta_reads_only_the_partitions_it_touches(spark, tmp_path):
    path = str(tmp_path / "view")
    m.create_view(sales(spark, 4), path, **VIEW, partition_by=["day"])
    for f in glob.glob(f"{path}/day__part=00/*.parquet"):
        with open(f, "wb") as broken:
            broken.write(b"not to be read")
    more = spark.createDataFrame([(900, "01", "z", Decimal("2.00"))], SALES)
    assert m.apply_delta(path, **VIEW, added=more, partition_by=["day"]) == [("01",)]


def test_views_that_cannot_be_kept_are_refused(spark, tmp_path):
    df = sales(spark, 5)
    with pytest.raises(ValueError, match="decimal"):
        m.create_view(df.withColumn("price", F.col("price").cast("double")), "x", ["day"], {"t": ("sum", "price")})
    with pytest.raises(ValueError, match="source"):
        m.apply_delta("x", **VIEW, added=df, removed=df)
    with pytest.raises(ValueError, match="grouping"):
        m.create_view(df, "x", ["day"], {"n": "count"}, partition_by=["kind"])
    with pytest.raises(ValueError, match="measure"):
        m.create_view(df, "x", ["day"], {"n": ("median", "price")})


def test_a_hot_group_is_merged_before_the_shuffle(spark, tmp_path):
    df = spark.range(30_000).selectExpr("id", "'1' AS day", "IF(id % 3 = 0, 'hot', string(id)) AS kind", "CAST(1 AS DECIMAL(10,2)) AS price")
    path = str(tmp_path / "view")
    m.create_view(df.limit(0), path, **VIEW)
    m.apply_delta(path, **VIEW, added=df)
    assert m.read_view(spark, path, **VIEW).filter("kind = 'hot'").first()["n"] == 10_000


# --- change rows ------------------------------------------------------------------------------

CHANGE = "k long, part string, v string, seq int, operation string"


def applied(state, changes):
    for k, part, v, seq, op in changes:
        if k not in state or seq >= state[k][2]:
            state[k] = (part, v, seq, op.lower() == "delete")
    return state


@pytest.mark.parametrize("rule", [{"partition_by": ["part"]}, {"buckets": 5}])
def test_changes_are_merged_in_any_order(spark, tmp_path, rule):
    path, state, pick = str(tmp_path / "kept"), {}, random.Random(7)
    stamps = random.Random(8).sample(range(1000), 300)
    for lot in range(3):
        changes = []
        for _ in range(100):
            k = pick.choice([1, pick.randrange(40)])  # half of all changes are of one key
            changes.append((k, f"p{k % 3}", pick.choice(["x", "y", None]), stamps.pop(), pick.choice(["insert", "update", "DELETE"])))
        frame = spark.createDataFrame(changes, CHANGE)
        for _ in range(2 if lot == 1 else 1):
            m.apply_changes(frame, path, ["k"], "seq", **rule)
        applied(state, changes)
        want = sorted((k, p, v, s) for k, (p, v, s, dead) in state.items() if not dead)
        got = m.read_kept(spark, path).select("k", "part", "v", "seq")
        assert sorted(map(tuple, got.collect()), key=lambda r: r[0]) == sorted(want, key=lambda r: r[0])


def test_untouched_partitions_are_neither_read_nor_written(spark, tmp_path):
    path = str(tmp_path / "kept")
    data = [(k, f"p{k % 3}", "x", 1, "insert") for k in range(9)]
    m.apply_changes(spark.createDataFrame(data, CHANGE), path, ["k"], "seq", partition_by=["part"])
    for f in glob.glob(f"{path}/part=p2/*.parquet"):
        with open(f, "wb") as broken:
            broken.write(b"not to be read")
    before = files(path)
    change = spark.createDataFrame([(0, "p0", "y", 2, "update"), (1, "p1", None, 2, "delete")], CHANGE)
    assert sorted(m.apply_changes(change, path, ["k"], "seq", partition_by=["part"])) == [("p0",), ("p1",)]
    after = files(path)
    assert {f for f in after if f in before} == {f for f in before if "p2" in f}


def test_tombstones_hold_late_rows_back_until_they_are_forgotten(spark, tmp_path):
    path, rule = str(tmp_path / "kept"), {"key": ["k"], "sequence": "seq", "partition_by": ["part"]}

    def put(*change, **more):
        m.apply_changes(spark.createDataFrame([change], CHANGE), path, **rule, **more)
        return rows(m.read_kept(spark, path).select("k", "v"))

    assert put(1, "p", "a", 5, "delete") == []
    assert put(1, "p", "late", 4, "insert") == []
    assert put(2, "p", "b", 9, "insert", forget_before=6) == [(2, "b")]
    assert put(1, "p", "late", 4, "insert") == [(1, "late"), (2, "b")]


def test_unfit_changes_are_refused_before_anything_is_written(spark, tmp_path):
    path = str(tmp_path / "kept")
    for bad in [(None, "p", "a", 1, "insert"), (1, "p", "a", None, "insert"), (1, "p", "a", 1, "upsert"), (1, "p", "a", 1, None)]:
        with pytest.raises(ValueError, match="change rows"):
            m.apply_changes(spark.createDataFrame([bad, (2, "p", "a", 1, "insert")], CHANGE), path, ["k"], "seq", partition_by=["part"])
    assert not os.path.exists(path)
    with pytest.raises(ValueError, match="either"):
        m.apply_changes(spark.createDataFrame([], CHANGE), path, ["k"], "seq")
    assert m.apply_changes(spark.createDataFrame([], CHANGE), path, ["k"], "seq", buckets=3) == []


# --- history ------------------------------------------------------------------------------------

T0 = datetime(2024, 1, 1)


def test_versions_and_joins_as_of_a_time_match_plain_python(spark):
    """One key has a third of the rows; times tie; keys and times are null."""
    pick = random.Random(11)
    key = lambda: pick.choice([1, pick.randrange(6), None])
    at = lambda: pick.choice([T0 + timedelta(hours=pick.randrange(3000)), None])
    changes = [(key(), at(), pick.choice(["a", "b", None]), pick.randrange(2)) for _ in range(400)]
    facts = [(i, key(), at()) for i in range(400)]
    history = m.version_history(
        spark.createDataFrame(changes, "k int, t timestamp_ntz, x string, y int"), ["k"], "t", ["x", "y"], bucket=86_400 * 9
    )
    known = {}
    for k, t, x, y in changes:
        if k is not None and t is not None:
            order = lambda v: (v[0] is not None, v[0] or "", v[1])
            known.setdefault(k, {})[t] = max([known.get(k, {}).get(t, (None, -1)), (x, y)], key=order)
    versions = []
    for k, by_time in known.items():
        last, own = object(), []
        for t in sorted(by_time):
            if by_time[t] != last:
                own.append((k, *by_time[t], t))
                last = by_time[t]
        versions += [(*v, own[i + 1][3] if i + 1 < len(own) else None) for i, v in enumerate(own)]
    assert rows(history) == sorted(versions, key=repr)

    def expected(k, t):
        held = [v for v in versions if v[0] == k and t is not None and v[3] <= t]
        return max(held, key=lambda v: v[3])[1:3] if k is not None and held else (None, None)

    frame = spark.createDataFrame(facts, "id int, k int, t timestamp_ntz")
    joined = m.as_of_join(frame, history, ["k"], "t", until="valid_to", bucket=86_400 * 5)
    assert rows(joined) == sorted(((i, k, t, *expected(k, t)) for i, k, t in facts), key=repr)
    text = plan(joined)
    assert "CartesianProduct" not in text and "BroadcastNestedLoop" not in text
    assert m.as_of_join(frame.limit(0), history, ["k"], "t").count() == 0
    assert rows(m.as_of_join(frame, history.limit(0), ["k"], "t").select("id", "x")) == sorted(((i, None) for i, *_ in facts), key=repr)


def test_an_ended_version_holds_no_more_and_numbers_are_times_too(spark):
    versions = spark.createDataFrame([(1, 10, 20, "a"), (1, 30, None, "b")], "k int, valid_from int, valid_to int, v string")
    facts = spark.createDataFrame([(1, t) for t in (5, 10, 19, 20, 35)], "key int, t int")
    joined = m.as_of_join(facts, versions, {"key": "k"}, "t", until="valid_to", bucket=8)
    assert rows(joined.select("t", "v")) == sorted([(5, None), (10, "a"), (19, "a"), (20, None), (35, "b")], key=repr)
    with pytest.raises(ValueError, match="exist already"):
        m.as_of_join(facts.withColumn("v", F.lit(1)), versions, {"key": "k"}, "t")


def test_a_hot_key_is_sorted_in_buckets(spark):
    facts = spark.range(20_000).selectExpr("1 AS k", "id AS t")
    versions = spark.range(0, 20_000, 50).selectExpr("1 AS k", "id AS valid_from", "id AS v")
    joined = m.as_of_join(facts, versions, ["k"], "t", bucket=500)
    assert joined.filter("v <> t - t % 50").count() == 0
    assert "hashpartitioning(k0" in plan(joined) and "bucket" in plan(joined)
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # which would merge small partitions
    try:
        joined = m.as_of_join(facts, versions, ["k"], "t", bucket=500)
        sizes = joined.filter("v >= 0").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert max(r["count"] for r in sizes) < 8_000


def test_episodes_of_failures(spark):
    pick = random.Random(13)
    log = [(pick.choice([1, 1, 2, 3, None]), pick.choice([T0 + timedelta(minutes=pick.randrange(2000)), None]), pick.random() < 0.6) for _ in range(300)]
    got = m.failure_episodes(spark.createDataFrame(log, "job int, t timestamp_ntz, bad boolean"), ["job"], "t", F.col("bad"), bucket=3600)
    want = []
    for job in (1, 2, 3):
        times = {}
        for j, t, bad in log:
            if j == job and t is not None:
                times[t] = times.get(t, 0) + bad
        run = []
        for t in sorted(times):
            if times[t]:
                run.append(t)
            elif run:
                want.append((job, run[0], run[-1], sum(times[x] for x in run), t, int((t - run[0]).total_seconds())))
                run = []
        if run:
            want.append((job, run[0], run[-1], sum(times[x] for x in run), None, None))
    assert rows(got) == sorted(want, key=repr)


# --- row reconciliation -------------------------------------------------------------------------

ROW = "k long, part string, v string, w long"


def test_keys_that_differ_are_listed(spark):
    same = [(k, "p", "x", k) for k in range(200)] + [(None, "p", None, 1), (5, "p", "again", 1)]
    source = same + [(500, "p", "gone", 1), (501, "p", "a", None), (502, "p", None, 1), (503, "p", "twice", 1), (503, "p", "twice", 1)]
    target = same + [(600, "p", "new", 1), (501, "p", None, None), (502, "p", None, 2), (503, "p", "twice", 1)]
    frames = [spark.createDataFrame(t, ROW) for t in (source, target)]
    want = [(500, "missing"), (501, "changed"), (502, "changed"), (503, "changed"), (600, "added")]
    for buckets in (1, 7, 1024):
        assert rows(m.reconcile_rows(*frames, ["k"], buckets=buckets)) == want
    assert m.reconcile_rows(frames[0], frames[0], ["k"]).collect() == []
    assert rows(m.reconcile_rows(frames[0].limit(0), frames[1].filter("k = 600"), ["k"])) == [(600, "added")]
    swapped = [spark.createDataFrame([(1, a, b)], "k int, a int, b int") for a, b in ((None, 1), (1, None))]
    assert rows(m.reconcile_rows(*swapped, ["k"])) == [(1, "changed")]


def test_equal_partitions_are_not_read_again(spark, tmp_path):
    data = spark.range(300).selectExpr("id AS k", "CAST(id % 5 AS STRING) AS part", "'x' AS v", "id AS w")
    paths = [str(tmp_path / n) for n in ("source", "target")]
    m.write_table(data, paths[0], partition_by=["part"])
    m.write_table(data.withColumn("v", F.expr("IF(k = 7, 'y', v)")), paths[1], partition_by=["part"])
    source, target = [spark.read.schema(data.schema).parquet(p) for p in paths]
    found = m.reconcile_rows(source, target, ["k"], ["v", "w"], within=["part"], buckets=16)
    for path in paths:
        for f in glob.glob(f"{path}/part=[0134]/*.parquet"):
            with open(f, "wb") as broken:
                broken.write(b"not to be read")
    assert rows(found) == [(7, "changed")]
    assert "PartitionFilters: [isnotnull" in plan(found) or "part" in plan(found).split("PartitionFilters")[1][:80]


# --- hot lookups --------------------------------------------------------------------------------


def test_hot_keys_are_dealt_over_tasks_without_a_setting(spark):
    facts = spark.range(60_000).selectExpr("id", "IF(id % 3 = 0, 7, IF(id % 3 = 1, CAST(NULL AS BIGINT), id % 5000)) AS k")
    names = spark.range(5000).selectExpr("id AS key", "concat('n', id) AS name")
    off = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in off}
    for k, v in off.items():
        spark.conf.set(k, v)
    try:
        largest = {}
        for join in (m.enrich, m.enrich_hot):
            joined = join(facts, names, {"k": "key"}, unique=True)
            assert "SortMergeJoin" in plan(joined)
            sizes = joined.groupBy(F.spark_partition_id()).count().collect()
            largest[join] = max(r["count"] for r in sizes)
            assert joined.count() == 60_000 and joined.filter("k = 7 AND name = 'n7'").count() >= 20_000
            assert joined.filter("k IS NULL AND name IS NOT NULL").count() == 0
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert largest[m.enrich] > 20_000 and largest[m.enrich_hot] < 13_000


def test_hot_lookups_equal_plain_ones(spark):
    pick = random.Random(3)
    facts = spark.createDataFrame([(i, pick.choice([1, 1, None, pick.randrange(9)]), "f") for i in range(200)], "id int, k int, __salt string")
    names = spark.createDataFrame([(k, pick.choice(["a", "b"]), s) for k in [None, *range(6)] for s in range(2)], "key int, name string, at int")
    for more in ({}, {"order_by": "at"}):
        plain, hot = (rows(f(facts, names.drop("at") if not more else names, {"k": "key"}, ["name"], **more)) for f in (m.enrich, m.enrich_hot))
        assert plain == hot
    assert m.hot_keys(facts.limit(0), ["k"]) == []
    assert rows(m.enrich_hot(facts.limit(0), names, {"k": "key"}, ["name"])) == []


# --- streams --------------------------------------------------------------------------------------


def test_files_are_landed_once_and_a_failed_batch_is_replaced(spark, tmp_path, monkeypatch):
    import millrace.streaming.landing as landing

    schema = "id long, t timestamp, v string"
    raw, out, progress = (str(tmp_path / n) for n in ("raw", "out", "progress"))

    def arrive(*ids, day=1):
        data = [(i, None if i % 10 == 9 else datetime(2024, 1, day, i % 24), "x") for i in ids]
        m.write_table(spark.createDataFrame(data, schema), raw, mode="append")

    def land():
        return m.land_stream(spark, raw, schema, out, progress, ["id"], "t", "3 days")

    arrive(1, 2, 2, 9)
    assert land() == 1
    assert land() == 0
    arrive(2, 3, 9)
    write = landing.write_table

    def fails(*args, **kwargs):
        write(*args, **kwargs)
        raise OSError("after the batch was written")

    with monkeypatch.context() as patch:
        patch.setattr(landing, "write_table", fails)
        with pytest.raises(Exception, match="after the batch was written"):
            land()
    land()
    got = sorted(r.id for r in spark.read.parquet(out).collect())
    assert got == [1, 2, 3, 9, 9]  # a row without a time is landed as it comes
    arrive(30, day=20)
    land()
    arrive(4, 31, day=20)
    land()
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == [1, 2, 3, 4, 9, 9, 30, 31]


def test_streams_that_cannot_be_landed_are_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="time column"):
        m.land_stream(spark, "x", "id long", "y", "z", ["id"])
    with pytest.raises(ValueError, match="not one of"):
        m.land_stream(spark, "x", "id long", "y", "z", fmt="orc")
    os.makedirs(tmp_path / "raw")
    with pytest.raises(ValueError, match="exists already"):
        m.land_stream(spark, str(tmp_path / "raw"), "batch_id long", "y", "z")


# --- profiles -------------------------------------------------------------------------------------


def test_profiles_of_partitions_merge_to_that_of_the_table(spark, tmp_path):
    path = str(tmp_path / "profiles")
    data = spark.range(40_000).selectExpr(
        "id % 3 AS part", "IF(id % 4 = 0, NULL, id % 9000) AS k", "CAST(id AS STRING) AS s",
        "CAST(id / 7 AS DECIMAL(10,2)) AS d", "CAST(NULL AS DATE) AS never", "map('a', id) AS odd")
    columns = ["k", "s", "d", "never"]
    m.refresh_profiles(data.filter("part < 2"), path, ["part"])
    m.refresh_profiles(data.filter("part = 2"), path, ["part"])
    m.refresh_profiles(data.filter("part = 2"), path, ["part"])  # replaced, not added
    merged = m.merged_profile(m.read_profiles(spark, path), columns)
    got = {r["column"]: r for r in merged.collect()}
    for c in columns:
        exact = data.agg(F.count(F.lit(1)), F.count_if(F.col(c).isNull()), F.min(c).cast("string"), F.max(c).cast("string"), F.countDistinct(c)).first()
        assert tuple(got[c])[1:5] == tuple(exact)[:4]
        assert got[c]["distinct_count"] == pytest.approx(exact[4], rel=4 * 1.04 / 2**7)
    lines = {(r["check"], r["subject"]): r for r in m.profile_gate(merged, {"null_threshold": 0.3, "row_count_min": 40_001}).collect()}
    assert lines["null_rate", "k"]["passed"] and not lines["null_rate", "never"]["passed"]
    assert not lines["row_count", "rows"]["passed"]
    empty = m.merged_profile(m.partition_profiles(data.limit(0), ["part"]), columns).collect()
    assert {(r["row_count"], r["distinct_count"]) for r in empty} == {(0, 0)}
