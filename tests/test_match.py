"""The match from detections to fused rows, crossings' outcomes, files, plug-ins and streams."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from test_operators import scene

from touchline.operators import assembly, calibration, crossings, sequence
from touchline.plans import match, plugins
from touchline.plans.runner import Runner
from touchline.sources import files
from touchline.streaming import activity

TEAMS = (0, 0, 0, 1, 1, 1)


@pytest.fixture(scope="module")
def clip(spark, tmp_path_factory):
    """Six players of two colours, one of them away for a while, and a ball that some frames miss."""
    colours = np.eye(128)[[3, 90]].tolist()
    rows = [(i, s, f, *map(float, b), p, "player", colours[TEAMS[i % 10]]) for i, s, f, *b, p in scene()]
    for f in range(150):
        x, y = 60 + 3.5 * f, 300 - 2 * f + 0.02 * f * f
        if f % 7 != 3 and 0 <= x < 640 and 0 <= y < 360:
            rows.append((100_000 + f, 0, f, x - 4, y - 4, x + 4, y + 4, 0.7, "ball", None))
    path = str(tmp_path_factory.mktemp("clip") / "detections")
    schema = "det_id long, shot_no long, frame long, x1 double, y1 double, x2 double, y2 double, score double, cls string, hist array<double>"
    spark.createDataFrame(rows, schema).write.parquet(path)
    return path


def test_a_match_ends_in_six_identities(spark, clip, tmp_path):
    runner = Runner(spark, str(tmp_path / "run"))
    t = runner.run(match.stages({"detections": clip, "width": 640, "height": 360}))
    assert not [r.status for r in runner.manifest().collect() if r.status.startswith("failed")]
    assert set(t) == {s.name for s in match.stages({"detections": clip})}
    tracks = t["tracks"].toPandas()
    assert 6 <= tracks.track_id.nunique() <= 8 and tracks.groupby("frame").size().median() >= 5
    known = t["identities"].filter("NOT abstained").toPandas()
    assert known.identity_id.nunique() == 6 and t["links"].count() >= 1
    assert known.drop_duplicates("identity_id").groupby("team").size().to_dict() == {0: 3, 1: 3}
    assert sorted(known.identity_id.unique()) == list(range(1, 7))
    states = t["ball"].groupBy("state").count().toPandas().set_index("state")["count"]
    assert states.get("visible", 0) + states.get("in_flight", 0) > 0.5 * states.sum() and states["occluded"] > 0
    fused = t["fused"].toPandas()
    assert len(fused) == len(tracks) and fused.reentry.sum() == t["links"].count()
    roster = t["roster"].toPandas()
    assert set(roster.state) >= {"visible", "off_frame"} and roster.groupby("identity_id").size().between(1, 30).all()


def test_identities_abstain_and_keep_to_the_number_of_players(spark):
    # Twelve players of a team at once, of which the least sure gives way; a lone short one; officials don't count.
    nodes = [(k, 0, 100, 0, 99) for k in range(13)] + [(13, 1, 10, 0, 9), (14, 2, 100, 0, 99), (15, 1, 100, 200, 299), (16, 1, 10, 300, 309)]
    links = [(16, 15, 0.7), (12, 11, 0.6)]
    n = spark.createDataFrame(nodes, "node long, team long, n_frames long, start_frame long, end_frame long")
    got = assembly.identities(n, spark.createDataFrame(links, "node long, pred long, belief double"), spark.createDataFrame([(3,)], "node long")).toPandas().set_index("node")
    assert sorted(got.identity_id.unique()) == list(range(1, 16)) and got.identity_id[12] == got.identity_id[11] == 12 and got.identity_id[16] == got.identity_id[15]
    assert got.confidence[16] == 0.7 and got.confidence[3] == 0.3 and got.confidence[0] == 1.0
    assert set(got.index[got.abstained]) == {3, 12, 13}


def test_roster_of_overlapping_spans(spark):
    spans = [(1, 0, 0, 10, 1.0, 1.0), (1, 0, 8, 20, 2.0, 2.0), (1, 0, 400, 410, 3.0, 3.0), (2, 1, 12, 14, 4.0, 4.0)]
    got = assembly.roster(spark.createDataFrame(spans, "identity_id long, team long, start_frame long, end_frame long, lx double, ly double"))
    rows = {(r.identity_id, r.frame): r for r in got.collect()}
    assert len(rows) == got.count() and (2, 10) not in rows
    assert rows[1, 5].state == rows[1, 10].state == rows[1, 15].state == "visible" and rows[1, 5].last_x is None
    assert (rows[1, 25].state, rows[1, 25].frames_since_seen, rows[1, 25].last_x) == ("off_frame", 5, 2.0)
    assert rows[1, 275].state == "uncertain" and rows[1, 400].last_x == 2.0
    assert (rows[2, 15].state, rows[2, 15].last_x) == ("off_frame", 4.0)


# Crossings


def outcomes(spark, after, late=False):
    e = {1: [1.0, 0.0], 2: [0.0, 1.0]}
    data = []
    for f in range(205):
        for t, y in ((1, 100.0), (2, 110.0)):
            if late and t == 2 and f >= 105:
                t = 7  # the tracker lost it and gave a new number
            v = None if 100 <= f < 105 else e[t] if f < 100 else after[t]
            data.append((0, f, t, float(f), y, float(f) + 18, y + 44, v))
    tracks = spark.createDataFrame(data, "shot_no long, frame long, track_id long, x1 double, y1 double, x2 double, y2 double, emb array<double>")
    return crossings.resolve(tracks, spark.createDataFrame([(0, 1, 2, 100, 104)], "shot_no long, a long, b long, f0 long, f1 long"))


def test_outcomes_of_crossings(spark):
    e = {1: [1.0, 0.0], 2: [0.0, 1.0]}
    swapped = outcomes(spark, {1: e[2], 2: e[1]})
    rows = crossings.relabelled(swapped).toPandas()
    moved = rows[rows.frame > 104]
    assert (moved.track_id == 3 - moved.raw_track_id).all() and (rows[rows.frame <= 104].track_id == rows[rows.frame <= 104].raw_track_id).all()
    assert rows[rows.frame.between(105, 204)].swap_conf.max() <= 1.0 and (rows[rows.frame <= 104].swap_conf == 1).all()
    cut = outcomes(spark, {1: e[1], 2: e[1]})
    rows, parts = crossings.relabelled(cut).toPandas(), crossings.splits(cut).toPandas()
    assert set(rows[rows.frame > 104].track_id) == {2002, 2003} == set(parts.track_id)
    assert set(parts.split_frame) == {105} and [sorted(c) for c in parts.cands] == [[1, 2]] * 2
    born = outcomes(spark, {1: e[1], 7: e[2]}, late=True)
    told = crossings.decisions(born).first()
    assert (told.decision, told.births) == ("swap", [7])
    assert set(crossings.relabelled(born).toPandas().query("frame > 104").track_id) == {1, 2}
    apart = crossings.decisions(outcomes(spark, {1: e[1], 2: None})).first()
    assert (apart.decision, apart.confidence) == ("undecidable", 0.3)
    none = spark.createDataFrame([(0, 5, 6, 10, 20)], "shot_no long, a long, b long, f0 long, f1 long")
    tracks = spark.createDataFrame([(0, f, 1, 0.0, 0.0, 18.0, 44.0, None) for f in range(30)], "shot_no long, frame long, track_id long, x1 double, y1 double, x2 double, y2 double, emb array<double>")
    assert crossings.decisions(crossings.resolve(tracks, none)).first().decision == "undecidable"
    assert crossings.relabelled(crossings.resolve(tracks, none.limit(0))).count() == 30


def test_motion_matrix_equals_its_expression(spark):
    from touchline.functions import geometry as g

    rng = np.random.default_rng(2)
    p1, v, p0 = rng.normal(0, 50, (4, 2)), rng.normal(0, 9, (4, 2)), rng.normal(0, 50, (3, 2))
    h, f1, f0 = rng.uniform(20, 90, 4), np.array([10, 12, 30, 9]), np.array([20, 31, 11])
    got = crossings.motion_log_likelihoods(p1, v, h, f1, p0, f0)
    rows = [(*map(float, p1[i]), *map(float, v[i]), float(h[i]), float(f0[j] - f1[i]), *map(float, p0[j])) for i in range(4) for j in range(3)]
    df = spark.createDataFrame(rows, "x double, y double, vx double, vy double, h double, gap double, tx double, ty double")
    told = df.select(g.motion_log_likelihood(*map(F.col, ("x", "y", "vx", "vy", "h", "gap", "tx", "ty"))).alias("m")).toPandas().m
    assert got.ravel() == pytest.approx(told.to_numpy())


# Sequences


def test_suppression_equals_a_plain_loop(spark):
    rng = np.random.default_rng(3)
    x, y = rng.uniform(0, 100, 60), rng.uniform(0, 100, 60)
    rows = [(k, 0, k % 3, float(x[k]), float(y[k]), float(x[k] + 40), float(y[k] + 40), float(rng.choice([0.2, 0.5, 0.9]))) for k in range(60)]
    d = spark.createDataFrame(rows, "det_id long, shot_no long, frame long, x1 double, y1 double, x2 double, y2 double, score double")

    def over(a, b):
        w, h = min(a[5], b[5]) - max(a[3], b[3]), min(a[6], b[6]) - max(a[4], b[4])
        inter = max(w, 0) * max(h, 0)
        return inter / (3200 - inter)

    want = set()
    for f in range(3):
        kept = []
        for r in sorted((r for r in rows if r[2] == f), key=lambda r: (-r[7], r[0])):
            if all(over(r, k) < 0.4 for k in kept):
                kept.append(r)
        want |= {r[0] for r in kept}
    assert {r.det_id for r in sequence.nms(d, ["shot_no", "frame"], 0.4).collect()} == want


BALLS = [(0, 0, 0.4, 10, 10), (1, 0, 0.9, 100, 100), (2, 1, 0.5, 104, 100), (3, 1, 0.9, 150, 100), (4, 2, 0.9, 400, 300), (5, 4, 0.3, 116, 100), (6, 5, 0.3, 120, 101)]


def test_the_ball_keeps_to_its_path(spark):
    d = spark.createDataFrame([(i, 0, f, x - 4.0, y - 4.0, x + 4.0, y + 4.0, s) for i, f, s, x, y in BALLS], "det_id long, shot_no long, frame long, x1 double, y1 double, x2 double, y2 double, score double")
    got = sorted((r.frame, r.x) for r in sequence.gate_ball(d).collect())
    assert got == [(0, 100.0), (1, 104.0), (4, 116.0), (5, 120.0)]


def test_streams_gate_balls_and_count_activity(spark, tmp_path):
    rows = pd.DataFrame(BALLS, columns=["det_id", "frame", "score", "x", "y"]).assign(shot_no=0).astype({"x": float, "y": float})
    schema = "shot_no long, frame long, x double, y double, score double"
    for k, part in enumerate((rows[rows.frame < 2], rows[rows.frame >= 2])):
        spark.createDataFrame(part[["shot_no", "frame", "x", "y", "score"]], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in" / str(k)))
    stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    q = activity.gated_balls(stream).writeStream.format("memory").queryName("gated").outputMode("append").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    assert q.awaitTermination(120)
    got = {r.frame: r.x for r in spark.table("gated").collect()}
    assert got[5] == 120.0 and got[0] == 100.0 and 2 not in got
    e = spark.createDataFrame([("2024-01-01 00:01:00", "a"), ("2024-01-01 00:09:00", "a"), ("2024-01-01 00:11:00", "b")], "ts string, event_type string")
    assert sorted((r.event_type, r.n) for r in activity.activity(e).collect()) == [("a", 2), ("b", 1)]


def test_relabelling_sees_earlier_changes(spark):
    t = spark.createDataFrame([(0, f, k) for f in range(4) for k in (1, 2)], "shot_no long, frame long, track_id long")
    changes = spark.createDataFrame([(0, 1, 1, 5, 1), (0, 2, 5, 9, 3)], "shot_no long, at long, old long, new long, from_frame long")
    got = {(r.frame, r.raw_track_id): r.track_id for r in sequence.relabel(t, changes).collect()}
    assert [got[f, 1] for f in range(4)] == [1, 5, 5, 9] and all(got[f, 2] == 2 for f in range(4))


def test_diverse_candidates_stay_apart(spark):
    rng = np.random.default_rng(5)
    rows = [(k % 2, k, float(a), float(b), float(c)) for k, (a, b, c) in enumerate(rng.uniform(0, 10, (80, 3)))]
    df = spark.createDataFrame(rows, "shot_no long, det_id long, p double, q double, cost double")
    want = set()
    for s in (0, 1):
        kept = []
        for r in sorted((r for r in rows if r[0] == s), key=lambda r: r[4]):
            if len(kept) < 6 and all(max(abs(r[2] - k[2]) / 3, abs(r[3] - k[3]) / 2) >= 1 for k in kept):
                kept.append(r)
        want |= {r[1] for r in kept}
    assert {r.det_id for r in calibration.diverse(df, ["shot_no"], {"p": 3.0, "q": 2.0}, "cost", 6).collect()} == want


# Files and plug-ins


def test_files(spark, tmp_path):
    uri = f"file://{tmp_path}/a/b.json"
    files.put(spark, uri, b'{"x": [1, 2]}')
    files.put(spark, uri, b'{"x": [1, 2, 3]}')
    assert files.exists(spark, uri) and not files.exists(spark, uri + "x") and files.size(spark, uri) == 16
    assert files.read_range(spark, uri, 2, 3) == b"x\"" and files.read_range(spark, uri, 14, 99) == b"]}" and files.read_range(spark, uri, 50, 60) == b""
    assert files.read_document(spark, uri) == {"x": [1, 2, 3]}
    files.put(spark, f"file://{tmp_path}/a/c.yaml", b"track: {high: 0.5}\n")
    assert files.read_document(spark, f"file://{tmp_path}/a/c.yaml") == {"track": {"high": 0.5}}
    local = files.localize(spark, uri, str(tmp_path))
    files.upload(spark, local, f"file://{tmp_path}/d.json")
    assert files.read_document(spark, f"file://{tmp_path}/d.json") == {"x": [1, 2, 3]}
    assert [r.path.rpartition("/")[2] for r in files.listed(spark, f"file://{tmp_path}/a", ".json").collect()] == ["b.json"]
    assert files.read_json(spark, uri, "x array<int>").first().x == [1, 2, 3]
    assert files.read_tables(spark, f"file://{tmp_path}/none", spark.range(1).schema).columns == ["id", "shot_id", "stage"]
    assert files.joined("gs://b/", "/a/", "c") == "gs://b/a/c" and files.is_remote("gs://b/a") and not files.is_remote("/a") and files.bucket_and_key("gs://b/a/c") == ("gs://b", "a/c")


def test_plugins(spark):
    plugins.register("detector", "constant", lambda: lambda batch: batch.assign(x1=1.0, y1=2.0, x2=3.0, y2=4.0, score=0.5, cls="player"))
    frames = spark.createDataFrame([(0, 1), (0, 2)], "shot_no long, frame long")
    assert plugins.apply(frames, "detector", "constant").filter("x2 = 3 AND cls = 'player'").count() == 2
    assert plugins.names("detector") == ["constant"]
    with pytest.raises(ValueError):
        plugins.apply(frames, "encoder", "constant")
    with pytest.raises(ValueError):
        plugins.register("nothing", "x", lambda: None)
    assert plugins.probed({"width": "640", "height": 360, "r_frame_rate": "30000/1001", "avg_frame_rate": "0/0"}) == {"width": 640, "height": 360, "fps_nominal": 30000 / 1001, "fps_avg": 30000 / 1001}


def test_frames_come_a_partition_a_shot(spark):
    spark.dataSource.register(plugins.FrameSource)
    df = spark.read.format("frames").option("path", "x").option("shots", "0-2,3-4").option("decoder", "touchline.plans.synthetic:frames").load()
    rows = df.withColumn("p", F.spark_partition_id()).toPandas()
    assert rows.frame.tolist() == list(range(5)) and rows.shot_no.tolist() == [0, 0, 0, 1, 1] and rows.p.tolist() == [0, 0, 0, 1, 1]
