"""Unit tests of vector operators with hand-written values and edge cases."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinefold.functions.draws import integer, uniform
from kinefold.functions.vectors import TWO_ARMS, mirror_spec, mirrored
from kinefold.operators import metrics, planning, prefilter, resample, selection, smoothing
from kinefold.plans import jobs
from kinefold.plans.recipes import RECIPES, resolve
from kinefold.sources import datasets


def frames_of(spark, episodes):
    """Frames from {episode: [action, ...]}; the state is the action plus 100."""
    rows = [(e, i, "t", None if a is None else [float(x) for x in a], None if a is None else [float(x) + 100 for x in a]) for e, seq in episodes.items() for i, a in enumerate(seq)]
    return spark.createDataFrame(rows, "episode_index long, frame_index long, task string, action array<double>, state array<double>")


def test_decimation_pattern(spark):
    got = spark.range(10).select(selection.decimated(F.col("id"), 5)).collect()
    assert [r[0] for r in got] == [True, True, True, True, False] * 2
    for bad in (lambda: selection.decimated(F.col("id"), 1), lambda: selection.strided(F.col("id"), 0), lambda: selection.strided(F.col("id"), 3, 3)):
        with pytest.raises(ValueError):
            bad()


def test_mirror_of_counting_vector(spark):
    frame = frames_of(spark, {0: [range(14)]})
    one = frame.select(mirrored(F.col("action"), TWO_ARMS.action_signs, 7).alias("a"), mirrored(F.col("state"), TWO_ARMS.state_signs, 7).alias("s")).first()
    assert (one["a"][1], one["a"][8], one["s"][1], one["s"][8]) == (-8.0, -1.0, -108.0, -101.0)
    twice = frame.select(mirrored(mirrored(F.col("action"), TWO_ARMS.action_signs, 7), TWO_ARMS.action_signs, 7).alias("a")).first()
    assert twice["a"] == [float(x) for x in range(14)]
    with pytest.raises(ValueError):
        mirror_spec(None, [1.0], None)
    assert mirror_spec(TWO_ARMS, [1.0] * 14, None).state_signs == TWO_ARMS.state_signs


def test_motion_of_known_episodes(spark):
    moving = [(0, 0, 0, 0), (0.05, 0.02, 0.01, 0), (0.10, 0.05, 0.03, 0.01), (0.16, 0.09, 0.05, 0.02)]
    got = {r["episode_index"]: r for r in metrics.motion(frames_of(spark, {1: [(0, 0, 0, 0)] * 6, 2: moving, 3: [(1, 2, 3, 4)], 4: [(0,) * 4, (1,) * 4]}), 7.0).collect()}
    assert got[1]["action_delta"] == 0.0 and got[2]["action_delta"] == pytest.approx(0.32 / 12)
    assert (got[3]["action_delta"], got[3]["action_jerk"], got[3]["saturation"]) == (0.0, 0.0, 0.0)
    assert (got[4]["action_delta"], got[4]["action_jerk"], got[4]["saturation"]) == (1.0, 0.0, 1.0)


def test_spectral_arc_length():
    t = np.arange(200) / 50
    clean = np.sin(2 * np.pi * t)[:, None]
    rough = clean + np.random.default_rng(1).normal(0, 0.1, clean.shape)
    assert metrics.spectral_arc_length(rough, 50) < metrics.spectral_arc_length(clean, 50) < 0
    assert metrics.spectral_arc_length(clean[:1], 50) == 0.0
    bins = 51
    assert metrics.spectral_arc_length(np.ones((100, 2)), 50) == pytest.approx(-(bins - 1) / (2 * bins))


def test_gate_edges(spark):
    frames = frames_of(spark, {1: [(0.0, 0.0)], 2: [(0, 0), (1, 1), (0, 1)], 3: [(0, 0), (1,)], 4: [None, None]})
    episodes = spark.createDataFrame([(k,) for k in range(5)], "episode_index long")
    fast = {r["episode_index"]: r for r in prefilter.scores(episodes, frames, prefilter.Gate("fast", max_action_jerk=0.1)).collect()}
    assert fast[0]["reason"] == fast[1]["reason"] == fast[4]["reason"] == "insufficient sampled action data"
    assert fast[2]["reason"] == "jerky_action (jerk=1.5000)" and not fast[2]["kept"]
    assert fast[3]["reason"] == "vectors of 1 to 2 elements"
    full = {r["episode_index"]: r for r in prefilter.scores(episodes, frames.where("episode_index <> 3"), prefilter.Gate("full", min_action_delta=5.0, saturation_limit=0.5)).collect()}
    assert full[0]["reason"] == full[4]["reason"] == "missing action/state"
    assert full[2]["reason"].startswith("low_movement") and len(full[2]["reasons"]) >= 2


@pytest.mark.parametrize(("name", "wanted"), [("tier1", {0: 99}), ("tier2", {-1: 396, 0: 133, 1: 132, 2: 132}), ("tier3", {0: 198, 1: 132, 2: 99})])
def test_known_lengths(spark, name, wanted):
    t = resolve(name, tail_drop_max=0).temporal()
    plan = planning.build_plan(spark.createDataFrame([(7, 400)], "episode_index long, length long"), t)
    assert {r["segment"]: r["usable_len"] for r in plan.collect()} == wanted


@pytest.mark.parametrize("n", [1, 2, 3, 5])
def test_closed_forms(spark, n):
    for length in range(0, 23):
        for offset in range(n):
            kept = [i for i in range(length) if (i - offset) % n == 0 and i >= offset]
            row = spark.range(1).select(planning.selected_length(F.lit(length), F.lit(n), F.lit(offset), F.lit(0)).alias("n"), F.transform(F.sequence(F.lit(0), F.lit(max(0, len(kept) - 1))), lambda s: planning.source_frame(s, F.lit(n), F.lit(offset), F.lit(0))).alias("f")).first()
            if n > 1 or offset == 0:
                assert row["n"] == len(kept) and (not kept or row["f"] == kept)
        break_at = [i for i in range(length) if (i + 1) % 4 != 0]
        assert spark.range(1).select(planning.selected_length(F.lit(length), F.lit(1), F.lit(0), F.lit(4))).first()[0] == len(break_at)
        if length > 6:
            break


def test_effective_shift(spark):
    for shift, stride, want in ((4, 3, 1), (6, 3, 2), (0, 3, 0), (4, 1, 4), (1, 2, 0), (3, 2, 2)):
        assert spark.range(1).select(planning.effective_shift(shift, F.lit(stride))).first()[0] == want


def test_smoothing(spark):
    line = [(k * k * 0.1, 5.0 - k) for k in range(20)]
    frames = frames_of(spark, {1: line, 2: line[:2], 3: [*line[:5], None, *line[6:]], 4: line[:4]})
    rows = frames.join(datasets.episodes(frames), "episode_index")
    got = smoothing.smooth(rows, 7, 2, (), 2, ("episode_index",), "frame_index", "length").orderBy("episode_index", "frame_index").collect()
    for r, f in zip(got, rows.orderBy("episode_index", "frame_index").collect(), strict=True):
        assert (r["action"] is None and f["action"] is None) or r["action"] == pytest.approx(f["action"], abs=1e-9)
    assert [smoothing.effective_window(n, 7, 2) for n in (2, 3, 4, 5, 6, 7, 100)] == [0, 3, 3, 5, 5, 7, 7]
    assert (smoothing.hat(7, 2)[3] * 21).round(6).tolist() == [-2, 3, 6, 7, 6, 3, -2]
    assert (smoothing.hat(7, 2)[0] * 42).round(6).tolist() == [32, 15, 3, -4, -6, -3, 5]


def test_repeated_ids_and_partitions(spark):
    frames = frames_of(spark, {k: [(i + k,) * 14 for i in range(30)] for k in range(6)})
    episodes = selection.select_episodes(datasets.episodes(frames), [3, 1, 3])
    recipe = resolve("v7", prefilter=False, num_passes=1, keep_every_n=2)
    runs = []
    for parts in (1, 7):
        made = jobs.augment_job(frames.repartition(parts), recipe, episodes)
        rows = made.frames.orderBy("index").collect()
        assert [r["index"] for r in rows] == list(range(len(rows)))
        assert made.plan.agg(F.sum("usable_len")).first()[0] == len(rows)
        runs.append([(r["episode_index"], r["frame_index"], r["source_episode"], tuple(r["action"]), tuple(r["state"])) for r in rows])
    assert runs[0] == runs[1]
    assert [r[2] for r in runs[0] if r[1] == 0] == [3, 1, 3, 3, 1, 3]


def test_empty_and_short_plans(spark):
    episodes = spark.createDataFrame([(1, 0), (2, 3), (3, 5)], "episode_index long, length long")
    plan = planning.build_plan(episodes, planning.Temporal(num_passes=1, action_shift=4, tail_drop_max=0))
    assert [(r["episode_index"], r["usable_len"]) for r in plan.collect()] == [(3, 1)]
    totals = planning.plan_totals(episodes, plan, planning.Temporal(num_passes=1)).first()
    assert (totals["planned"], totals["written"], totals["frames"]) == (3, 1, 1)


def test_interpolation(spark):
    frames = frames_of(spark, {0: [(float(k),) for k in range(11)]})
    plan = planning.build_plan(datasets.episodes(frames), planning.Temporal(num_passes=1, jitter=0.3, seed=5))
    rows = resample.resample(frames, plan, True).orderBy("out_idx").collect()
    target = len(rows)
    for r in rows:
        pos = r["out_idx"] * 10 / (target - 1)
        assert r["state"][0] == pytest.approx(100 + pos) and r["src_frame"] == round(pos) and r["action"][0] == round(pos)


def test_recipes():
    assert resolve("tier1").keep_every_n == 4 and resolve("tier1", keep_every_n=1).keep_every_n == 1
    assert [planning.segments(resolve("tier3").temporal())[k][1:3] for k in range(3)] == [(2, 0), (3, 1), (4, 2)]
    assert resolve("v7").excluded() == (6, 13) and resolve("v9").background_history == 200 and set(RECIPES) >= {"tier1", "tier2", "tier3", "v7", "v8", "v9", "v9_boxes", "v7_sam"}
    for bad in (dict(name="v0"), dict(augmentations=("nothing",)), dict(temporal_jitter=2.0), dict(smooth_window=2), dict(nonsense=1), dict(augmentations=("random_erasing", "background"))):
        with pytest.raises(ValueError):
            resolve(bad.pop("name", None), **bad)


def test_draws(spark):
    row = spark.range(1).select(uniform("42", 0, 3, "tail").alias("u"), integer(4, "42", 0, 3, "tail").alias("k")).first()
    assert row["u"] == pytest.approx(0.596910810796544, abs=1e-15) and row["k"] == math.floor(row["u"] * 5)


def test_output_schema_and_files(spark, tmp_path):
    schema = datasets.output_schema(datasets.FRAMES, ["top", "side", "top"], (8, 8))
    assert schema.fieldNames() == ["task", "action", "state", "mask_top", "mask_side"] and schema["mask_top"].metadata["shape"] == [8, 8, 3]
    frames = frames_of(spark, {0: [(1.0,)]})
    datasets.write_frames(frames, str(tmp_path / "out"))
    with pytest.raises(Exception, match="(?i)exist"):
        datasets.write_frames(frames, str(tmp_path / "out"))
    datasets.write_frames(frames, str(tmp_path / "out"), force=True)
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "3_12_top.raw").write_bytes(bytes(range(12)))
    (tmp_path / "raw" / "3_13_top.raw").write_bytes(b"short")
    one = datasets.read_loose_images(spark, str(tmp_path / "raw"), 2, 2).collect()
    assert [(r["episode_index"], r["frame_index"], r["camera"], bytes(r["pixels"])) for r in one] == [(3, 12, "top", bytes(range(12)))]


def test_chunk_length_beyond_the_first_lags(spark):
    x = [math.cos(2 * math.pi * k / 216) for k in range(2160)]
    lag = next(k for k in range(1, 2160) if np.corrcoef(x[:-k], x[k:])[0, 1] < 0.5)
    assert lag > 20
    got = metrics.first_chunk_length(frames_of(spark, {1: [(v,) for v in x]})).first()
    assert (got["steps"], got["seconds"]) == (lag, lag / 50)
    assert metrics.first_chunk_length(frames_of(spark, {1: [(1.0,), (2.0,), (3.0,)]})).first()["steps"] is None
