"""Operators on small tables whose answers are known by hand."""

import pytest
from pyspark.sql import functions as F

from voxelyard.functions import frames, text
from voxelyard.operators import calibre, cohort, ledger, paths, skeleton, sweep, tables, volume
from voxelyard.sources import readers, sinks
from voxelyard.streaming.merge import BLOCKS, BlockStore, Breaker, merge


def boxes(spark):
    """Body 100 in [4:12]³, 200 in z 20:28 y, x 6:10, 300 in z 12:20 y, x 24:28, of a volume of 32³."""
    parts = [(100, (4, 12), (4, 12), (4, 12)), (200, (20, 28), (6, 10), (6, 10)), (300, (12, 20), (24, 28), (24, 28))]
    rows = [(z, y, x, b) for b, zs, ys, xs in parts for z in range(*zs) for y in range(*ys) for x in range(*xs)]
    return spark.createDataFrame(rows, "z int, y int, x int, body_id long")


def test_counts_boxes_and_volumes(spark):
    got = {r["body_id"]: r for r in sweep.boxes(boxes(spark)).collect()}
    assert {b: r["voxel_count"] for b, r in got.items()} == {100: 512, 200: 128, 300: 128}
    assert tuple(got[300][f"{a}{e}"] for e in (0, 1) for a in "zyx") == (12, 24, 24, 20, 28, 28)
    assert {r["volume_nm3"] for r in sweep.volumes(boxes(spark), (8, 8, 8)).collect()} == {512 * 512.0, 128 * 512.0}
    keep = spark.createDataFrame([(100,), (300,)], "body_id long")
    assert sweep.volumes(boxes(spark), (8, 8, 8), keep=keep).count() == 2
    assert sweep.volumes(boxes(spark), (8, 8, 8), keep=keep.limit(0)).count() == 0


def test_joint_counts_and_verify(spark):
    seg = boxes(spark)
    sem = seg.where("body_id = 100").select("z", "y", "x", F.when(F.col("z") < 8, 3).otherwise(5).alias("label")).unionByName(seg.where("body_id = 200").select("z", "y", "x", F.lit(1).alias("label")))
    counts = sweep.joint_counts(sweep.labelled(seg, sem))
    assert {(r[0], r[1]): r[2] for r in counts.collect()} == {(100, 3): 256, (100, 5): 256, (200, 1): 128, (300, 0): 128}
    bodies = sweep.volumes(seg, (8, 8, 8))
    assert sweep.verify_summary(sweep.verify(bodies, counts)).first()["n_mismatched"] == 0
    short = sweep.verify(bodies, counts.where("body_id <> 200"))
    assert tuple(sweep.verify_summary(short).first())[:3] == (3, 1, 128) and sweep.worst(short).first()["body_id"] == 200
    with pytest.raises(Exception, match="label too large"):
        sweep.joint_counts(seg.withColumn("label", F.lit(99))).collect()


def test_block_merges_are_idempotent(spark):
    names = "block string, body_id long, z0 long, y0 long, x0 long, z1 long, y1 long, x1 long, voxel_count long"
    batch = spark.createDataFrame([("0_0_0", 7, 0, 0, 0, 10, 10, 10, 100), ("0_0_0", 9, 0, 0, 0, 4, 4, 4, 8), ("1_0_0", 7, 10, 2, 2, 20, 8, 8, 50)], names)
    none = batch.limit(0)
    once = ledger.merge_blocks(none, batch, none.select("block"), 512.0)
    row = once.where("body_id = 7").first()
    assert [row[c] for c in ledger.BOX] == [0, 0, 0, 20, 10, 10] and (row["voxel_count"], row["volume_nm3"]) == (150, 76800.0)
    again = ledger.merge_blocks(once, batch, batch.select("block"), 512.0)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, once.collect()))
    unknown = spark.createDataFrame([(7, None, None, None, None, None, None, 0)], names.replace("block string, ", ""))
    assert ledger.merge_blocks(unknown, batch, none.select("block"), 512.0).where("body_id = 7").first()["z1"] == 20


def test_crops_and_boxes(spark):
    body = spark.createDataFrame([(5, 16, 16, 16, 48, 48, 48)], "body_id long, z0 int, y0 int, x0 int, z1 int, y1 int, x1 int")
    assert tuple(volume.cropped(body, 8, 1, (10, 10, 10)).first())[1:] == (1, 1, 1, 7, 7, 7)
    assert frames.parse_box(None) is None and frames.parse_box("0,0,0,1,2,3") == (0, 0, 0, 1, 2, 3)
    for bad in ("", "0,1,2,3", "1,0,0,1,5,5"):
        with pytest.raises(ValueError):
            frames.parse_box(bad)
    assert frames.grid(spark, (128, 128, 128), 32).where(frames.overlaps({c: F.col(c) for c in ("z0", "y0", "x0", "z1", "y1", "x1")}, (32, 0, 0, 96, 64, 64))).count() == 8


def test_dilation_does_not_wrap(spark):
    corner = spark.createDataFrame([(0, 0, 0)], "bz int, by int, bx int")
    assert frames.dilate(corner, (3, 3, 3)).count() == 4
    middle = spark.createDataFrame([(5, 5, 5)], "bz int, by int, bx int")
    assert frames.dilate(middle, (16, 16, 16)).count() == 7


def rod(spark, spacing=100.0, n=5, radius=10.0):
    nodes = spark.createDataFrame([(1, i, i * spacing, 0.0, 0.0, radius) for i in range(n)], "body_id long, node_id long, z_nm double, y_nm double, x_nm double, radius_nm double")
    edges = spark.createDataFrame([(1, i, i, i + 1) for i in range(n - 1)], "body_id long, edge_id long, src long, dst long")
    return nodes, edges


def test_rod_measures(spark):
    nodes, edges = rod(spark)
    row = skeleton.measure(nodes, edges, paths.components(nodes, edges), "d", "all").first()
    assert (row["cable_nm"], row["n_tips"], row["n_branches"], row["n_components"]) == (400, 2, 0, 1)
    assert row["volume_nm3"] == pytest.approx(3.14159265 * 100 * 400) and row["area_nm2"] == pytest.approx(3.14159265 * 20 * 400)
    bare = skeleton.measure(nodes, edges.limit(0), paths.components(nodes, edges.limit(0)), "d", "all").first()
    assert (bare["cable_nm"], bare["n_components"], bare["volume_nm3"]) == (0, 5, None)


def test_weighted_quantile_is_a_step(spark):
    rows = spark.createDataFrame([(1, i, 2.0, 10.0) for i in range(9)] + [(1, 9, 200.0, 900.0), (1, 10, float("nan"), 5.0), (1, 11, 7.0, 0.0)], "k int, i int, v double, w double")
    got = skeleton.weighted_quantiles(rows, ["k"], "v", "w", (0.05, 0.5), ["i"]).first()
    assert (got["p5"], got["p50"]) == (2.0, 200.0)
    with pytest.raises(Exception, match="negative"):
        skeleton.weighted_quantiles(rows.withColumn("w", -F.col("w")), ["k"], "v", "w", (0.5,), ["i"]).collect()


def test_log_histogram_conserves_weight(spark):
    rows = spark.createDataFrame([(1.0, 1.0), (50.0, 2.0), (5000.0, 4.0), (1000.0, 8.0), (float("nan"), 16.0), (None, 32.0)], "d double, w double")
    got = [r["weight"] for r in calibre.log_histogram(rows, F.col("d"), 10, 1000, 8, F.col("w")).orderBy("bin").collect()]
    assert len(got) == 10 and got[0] == 1 and got[-1] == 12 and sum(got) == 15
    with pytest.raises(ValueError):
        calibre.log_edges(0, 5, 3)


def test_tables(spark):
    rows = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 10.0), (None, float("nan"))], "g string, v double")
    got = {r["g"]: r for r in tables.summarize(rows, ["v"], "g").collect()}
    assert got["a"]["v_p50"] == 2 and got[None]["n"] == 1 and got[None]["v_p50"] is None
    left, right = (spark.createDataFrame([(float(x),) for x in xs], "v double") for xs in ((1, 2, 3), (1, 1, 1)))
    assert tables.compare(left, right, ["v", "none"]).first()["ratio"] == 2.0
    assert tables.compare(left, right.limit(0), ["v"]).first()["ratio"] is None
    bodies = spark.createDataFrame([(1, 5), (2, 900), (3, 50)], "body_id long, voxel_count long")
    assert [r[0] for r in tables.by_size(bodies, 10, 0).select("body_id").collect()] == [2, 3]
    assert tables.equal_width(left.withColumn("v", F.lit(4.0)), "v", 8).count() == 1


def test_cohorts(spark):
    good = spark.createDataFrame([(2**60 + 12345,), (7,)], "body_id long")
    assert cohort.checked(good).count() == 2
    with pytest.raises(TypeError):
        cohort.checked(good.withColumn("body_id", F.col("body_id").cast("double")))
    for ids in ([1, 1], [-4]):
        with pytest.raises(ValueError):
            cohort.checked(spark.createDataFrame([(i,) for i in ids], "body_id long"))
    assert cohort.keep_union(None) is None and cohort.keep_union([]) is None
    assert cohort.membership({}, spark).columns == ["dataset", "cohort", "body_id"]


def test_tags(spark):
    tags = spark.createDataFrame([(1, ["superclass:ol", "somaSide:L"]), (2, ["superclass:ol", "somaSide:L", "somaSide:R", "cropped"]), (3, [])], "body_id long, tags array<string>")
    names, flags = cohort.discover(tags)
    assert (names, flags) == (["somaSide", "superclass"], ["cropped"])
    got = {r["body_id"]: r.asDict() for r in cohort.wide(tags, names, flags).collect()}
    assert got[2]["somaSide"] == "L" and got[2]["somaSide_all"] == ["L", "R"] and got[2]["tags_cropped"] and got[3]["tags_cropped"] is False and got[3]["superclass"] is None
    flags_ = spark.createDataFrame([(1, True), (2, False)], "body_id long, is_x boolean")
    kept = cohort.merge_properties(tags.select("body_id"), flags_)
    assert kept.where(~F.col("is_x")).count() == 2 and dict(kept.dtypes)["is_x"] == "boolean"


def test_ledger(spark):
    rows = spark.createDataFrame([("a", "failed", 1), ("a", "written", 2), ("b", "failed", 3), ("b", "failed", 4), ("c", "empty", 5)], "key string, status string, seq long")
    assert {r[0] for r in ledger.done(rows, ["key"]).collect()} == {"a", "c"}
    assert {r["key"]: r["streak"] for r in ledger.streaks(rows, ["key"]).collect()} == {"a": 1, "b": 2, "c": 0}
    assert not ledger.tripped(rows, 3) and ledger.tripped(rows.where("seq < 5 and seq > 2"), 2)
    keys = spark.createDataFrame([("a",), ("b",), ("d",)], "key string")
    assert {r[0] for r in ledger.todo(keys, rows, ["key"]).collect()} == {"b", "d"}


def test_upsert_keeps_what_is_not_named(spark):
    old = spark.createDataFrame([(1, 5.0, 2.0), (2, 6.0, None)], "body_id long, a double, b double")
    new = spark.createDataFrame([(2, None, 9.0), (3, 1.0, 1.0)], "body_id long, a double, b double")
    got = {r["body_id"]: (r["a"], r["b"]) for r in ledger.upsert(old, new, ["body_id"], ["a", "b"]).collect()}
    assert got == {1: (5.0, 2.0), 2: (6.0, 9.0), 3: (1.0, 1.0)}


def test_transforms(spark):
    nodes, _ = rod(spark)
    moved = skeleton.transformed(nodes, [[2, 0, 0, 0], [0, 2, 0, 0], [0, 0, 2, 0]]).first()
    assert moved["radius_nm"] == 20
    uneven = [[2, 0, 0, 0], [0, 1, 0, 0], [0, 0, 1, 0]]
    with pytest.raises(ValueError):
        skeleton.transformed(nodes, uneven)
    assert skeleton.transformed(nodes, uneven, require_radii=False).first()["radius_nm"] is None


def test_readers_and_sinks(spark, tmp_path):
    ids = tmp_path / "ids.csv"
    ids.write_text("body_id,size\n5,1\n 6\nx\n5,2\n")
    assert {r[0] for r in readers.allowlist(spark, str(ids)).collect()} == {5, 6}
    (tmp_path / "none.txt").write_text("header\n")
    with pytest.raises(ValueError):
        readers.allowlist(spark, str(tmp_path / "none.txt"))
    (tmp_path / "m.jsonl").write_text('{"group":"g","key":"a","status":"written"}\n{"level":"l","key":"b","status":"failed"}\n{"note":1}\n{"group":"g","ke')
    assert {tuple(r) for r in readers.manifest(spark, str(tmp_path / "m.jsonl")).collect()} == {("g", "a", "written"), ("l", "b", "failed")}
    (tmp_path / "p.json").write_text('{"inline":{"ids":["1","2"],"properties":[{"id":"t","type":"tags","tags":["a","b:c"],"tag_values":[[0,1],[]]},{"id":"l","type":"label","values":["x","y"]}]}}')
    got = {(r["body_id"], r["property"]): (r["value"], r["tags"]) for r in readers.segment_properties(spark, str(tmp_path / "p.json")).collect()}
    assert got[(1, "t")][1] == ["a", "b:c"] and got[(2, "l")][0] == "y"
    bodies = spark.createDataFrame([(1, 5), (2, 900)], "body_id long, voxel_count long")
    assert sinks.allowlist(bodies, str(tmp_path / "out"), 1, 1) == 1
    assert not sinks.failures(bodies.limit(0), str(tmp_path / "f")) and not (tmp_path / "f").exists()
    assert readers.rod(spark, (4, 9, 9), 2.0).count() == 4 * 13


def test_text(spark):
    row = spark.range(1).select(text.slug(F.lit(" A--b! ")).alias("a"), text.slug(F.lit("--")).alias("b"), text.bucket(F.lit(4097)).alias("c"), text.human(F.lit(1500.0)).alias("d"), text.bar(F.lit(5), F.lit(10), 4).alias("e")).first()
    assert tuple(row) == ("a_b", "tag", "h001", "1.5 µm", "##--")
    assert text.scale_range("all", 3) == [0, 1, 2] and text.scale_range("0,2-3", 5) == [0, 2, 3]
    with pytest.raises(ValueError):
        text.scale_range("7", 3)


def test_stream_merges_once(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    line = '{{"block":"{}","body_id":7,"z0":0,"y0":0,"x0":0,"z1":4,"y1":4,"x1":4,"voxel_count":{}}}\n'
    (source / "1.json").write_text(line.format("a", 10) + line.format("b", 5))
    store = BlockStore(spark, str(tmp_path / "store"))
    stream = lambda: spark.readStream.schema(BLOCKS).json(str(source))
    merge(stream(), store, str(tmp_path / "check")).awaitTermination()
    (source / "2.json").write_text(line.format("b", 5) + line.format("c", 1))
    merge(stream(), store, str(tmp_path / "check")).awaitTermination()
    assert store.bodies(1.0).first()["voxel_count"] == 16


def test_breaker(spark):
    rows = lambda *s: spark.createDataFrame([(i, x) for i, x in enumerate(s)], "seq long, status string")
    stop = Breaker(3)
    stop(rows("failed", "failed"), 0)
    stop(rows("written", "failed"), 1)
    stop(rows("failed"), 2)
    with pytest.raises(RuntimeError):
        stop(rows("failed"), 3)


def test_nearest_by_pyramid_is_exact(spark):
    """Clusters, outliers and ties: as by all pairs, for nodes and for edges."""
    import numpy as np

    draw = np.random.default_rng(4)
    spots = np.concatenate([draw.random((150, 3)) * 1000, draw.random((100, 3)), [[5e6, 0, 0], [-3e4, 1, 1]], np.round(draw.random((60, 3)) * 4)])
    nodes = [(1 + i % 2, i, *map(float, v), 1.0 + i % 5) for i, v in enumerate(spots)]
    links = [(1 + k, k, k, k + 2 * int(draw.integers(1, 9))) for k in range(290)]
    links = [(1 + k % 2, i, a, b) for (k, i, a, b) in [(a, i, a, b) for _, i, a, b in links] if b < len(spots)]
    asked = np.concatenate([draw.random((80, 3)) * 1200 - 100, draw.random((40, 3)) * 3, [[1e7, 1e7, 1e7], [0, 0, 0]], np.round(draw.random((30, 3)) * 4)])
    points = spark.createDataFrame([(i, 1 + i % 3, *map(float, v)) for i, v in enumerate(asked)], "point_id long, body_id long, z double, y double, x double")
    nodes = spark.createDataFrame(nodes, "body_id long, node_id long, z_nm double, y_nm double, x_nm double, radius_nm double")
    edges = spark.createDataFrame(links, "body_id long, edge_id long, src long, dst long")
    rows = lambda df: sorted(tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in df.collect())
    want = rows(calibre.nearest_nodes(points, nodes, [], small=10**9))
    assert len(want) == sum(i % 3 < 2 for i in range(len(asked)))  # body 3 has none
    assert rows(calibre.nearest_nodes(points, nodes, [], small=0)) == want == rows(calibre.nearest_by_grid(points, nodes, 7.0))
    assert rows(calibre.attach(points, nodes, edges, small=0)) == rows(calibre.attach(points, nodes, edges, small=10**9))


def test_large_bodies_are_joined_by_cells(spark):
    points = spark.range(500).select(F.col("id").alias("point_id"), F.lit(1).cast("long").alias("body_id"), *[F.rand(k).alias(a) for k, a in enumerate("zyx")])
    nodes = spark.range(200).select(F.lit(1).cast("long").alias("body_id"), F.col("id").alias("node_id"), *[F.rand(9 + k).alias(f"{a}_nm") for k, a in enumerate("zyx")], F.lit(1.0).alias("radius_nm"))
    plan = calibre.bin_to_nodes(points, nodes)._jdf.queryExecution().optimizedPlan().toString()
    assert "level" in plan and plan.count("cz") > 2


def test_a_star_of_balls_is_one_node():
    """All children within the hub's ball go, however many there are, and a long run is thinned to its ends."""
    import numpy as np

    from voxelyard.operators.simplify import Chain

    n = 1000
    place = np.random.default_rng(3).uniform(-1, 1, (n, 3))
    place[0] = 0
    chain = Chain.rooted(place, np.r_[10.0, np.full(n - 1, 1.0)], np.array([(0, i) for i in range(1, n)]))
    chain.settle(1.2, 2.0)
    assert chain.there.sum() == 1 and chain.radius[chain.there] == 10
    covers = Chain.rooted(place * 0.1, np.r_[2.0, np.full(n - 1, 2.0)], np.array([(0, i) for i in range(1, n)]))
    covers.settle(1.2, 2.0)
    assert not (covers.redundant(1.2, 2.0) > 0).any()
    line = np.array([[float(i), 0.0, 0.0] for i in range(2000)])
    run = Chain.rooted(line, np.full(2000, 3.0), np.array([(i, i + 1) for i in range(1999)]))
    run.settle(1.2, 2.0)
    assert not (run.redundant(1.2, 2.0) > 0).any() and run.there.sum() < 700


def test_quantiles_of_few_rows_are_those_of_ranges(spark, monkeypatch):
    from voxelyard.operators import tables

    rows = [(None if i % 11 == 0 else i % 3, float("nan") if i % 13 == 0 else None if i % 17 == 0 else float(i * i % 101), i * 0.5 if i % 3 else None) for i in range(200)]
    df = spark.createDataFrame(rows, "g int, a double, b double")
    few = {r["g"]: r.asDict() for r in tables.summarize(df, ["a", "b"], "g", (0.1, 0.5, 0.9)).collect()}
    whole = tables.summarize(df, ["a", "b"]).first().asDict()
    monkeypatch.setattr(tables, "RANGE_ROWS", 0)
    many = {r["g"]: r.asDict() for r in tables.summarize(df, ["a", "b"], "g", (0.1, 0.5, 0.9)).collect()}
    assert few.keys() == many.keys()
    near = lambda x, y: all(x[k] == y[k] or abs(x[k] - y[k]) < 1e-9 for k in y)
    assert all(near(few[g], many[g]) for g in few) and near(whole, tables.summarize(df, ["a", "b"]).first().asDict())
    assert tables.summarize(df.limit(0), ["a"]).first()["n"] == 0
