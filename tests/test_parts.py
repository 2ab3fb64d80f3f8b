"""Operators that work on parts of episodes give what whole episodes give."""

import numpy as np
import pytest

from kinefold.operators import metrics, planning, prefilter, resample, statistics
from kinefold.operators.spectra import arc_lengths
from kinefold.sources import datasets


def frames_of(spark, rows):
    return spark.createDataFrame(rows, "episode_index long, frame_index long, action array<double>, state array<double>")


@pytest.mark.parametrize("wide", [3, 64])
def test_spectra_in_parts(spark, wide):
    rng = np.random.default_rng(1)
    series = {e: np.cumsum(rng.normal(size=(n, 3)), 0) for e, n in enumerate((2, 3, 4, 5, 17, 64, 97, 500, 1021))}
    rows = [(e, 3 * k, None, x.tolist()) for e, s in series.items() for k, x in enumerate(s)]  # frame numbers with gaps
    rows += [(8, 3 * k + 1, None, None) for k in range(50)]  # and frames without a state
    got = {r["episode_index"]: r["sparc"] for r in arc_lengths(frames_of(spark, rows).repartition(5), 50.0, wide).collect()}
    assert got == {e: pytest.approx(metrics.spectral_arc_length(s, 50.0), rel=1e-9) for e, s in series.items()}


def test_long_episodes_take_the_way_in_parts(spark):
    rng = np.random.default_rng(2)
    series = {1: rng.normal(size=(30, 2)), 2: rng.normal(size=(301, 2)), 3: rng.normal(size=(40, 2))}
    rows = [(e, k, x.tolist(), x.tolist()) for e, s in series.items() for k, x in enumerate(s)] + [(3, 40, [1.0], [1.0]), (4, 0, None, None)]
    got = {r["episode_index"]: r["sparc"] for r in metrics.smoothness(frames_of(spark, rows), 50.0, whole=100).collect()}
    assert got == {e: pytest.approx(metrics.spectral_arc_length(series[e], 50.0), rel=1e-9) for e in (1, 2)} | {3: None, 4: None}


def test_smoothness_change(spark):
    rng = np.random.default_rng(5)
    before, after = ({e: np.cumsum(rng.normal(size=(40, 2)), 0) for e in range(n)} for n in (3, 2))
    tables = [metrics.smoothness(frames_of(spark, [(e, k, None, x.tolist()) for e, s in t.items() for k, x in enumerate(s)])) for t in (before, after)]
    one, two = (np.mean([metrics.spectral_arc_length(s, 50.0) for s in t.values()]) for t in (before, after))
    got = statistics.smoothness_change(*tables).first()
    assert (got["before"], got["after"], got["change"]) == (pytest.approx(one), pytest.approx(two), pytest.approx((two - one) / abs(one)))


def test_gate_moves_frames_once(spark):
    rows = [(e, k, [float(k % 3)] * 2, [0.0] * 2) for e in range(3) for k in range(20)]
    frames = frames_of(spark, rows).repartition(3)
    found = prefilter.scores(datasets.episodes(frames).select("episode_index"), frames, prefilter.Gate(dims=2))
    assert found.count() == 3
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") == 1


def brute(frames, lags):
    """Correlations over pairs of frames of one episode, by lag."""
    out = {}
    for lag in lags:
        a, b = [], []
        for e in {e for e, *_ in frames}:
            held = {k: v for f, k, v, _ in frames if f == e and v is not None and None not in v}
            for k, v in held.items():
                w = held.get(k + lag)
                if w is not None and len(w) == len(v):
                    a += v
                    b += w
        if a:
            flat = np.std(a) == 0 or np.std(b) == 0
            out[lag] = (len(a), None if flat else pytest.approx(np.corrcoef(a, b)[0, 1], abs=1e-9))
    return out


@pytest.mark.parametrize(("low", "high", "chunk"), [(1, 12, 8), (30, 45, 16), (1, 3, 1024), (7, 7, 5)])
def test_lag_products_of_chunks(spark, monkeypatch, low, high, chunk):
    monkeypatch.setattr(metrics, "CHUNK", chunk)
    rng = np.random.default_rng(low)
    rows = [(e, int(k), rng.normal(size=2).tolist(), None) for e, n in ((1, 90), (2, 41), (3, 1)) for k in range(n) if rng.random() < 0.9]
    rows += [(4, 0, [1.0], None), (4, 7, [2.0], None), (4, 8, [1.0, 2.0], None), (4, 14, [1.5], None), (5, 0, None, None), (5, 1, [None, 1.0], None), (5, 2, [3.0, 1.0], None)]
    got = {r["lag"]: (r["pairs"], r["correlation"]) for r in metrics.autocorrelation(frames_of(spark, rows).repartition(4), high, low).collect()}
    assert got == brute(rows, range(low, high + 1))


def test_frames_move_no_oftener_for_more_lags(spark):
    frames = frames_of(spark, [(1, k, [float(k)], None) for k in range(5000)])
    counts = []
    for high in (20, 1000):
        dealt = metrics.autocorrelation(frames, high)
        counts.append(dealt._jdf.queryExecution().optimizedPlan().toString().count("Generate explode"))
    assert counts == [1, 1]


def looked_up(rows, plan):
    """Output frames one by one, by the rules of the reference's lookups."""
    held = {(e, k): (a, s) for e, k, a, s in rows}
    out = {}
    for p in plan:
        def frame(place, p=p):
            place = max(0, min(place, p["n_selected"] - 1))
            if p["stride"] > 1:
                return place * p["stride"] + p["start_offset"]
            return place + (place // (p["remove"] - 1) if p["remove"] > 0 else 0)

        def at(pos, which, p=p, frame=frame):
            low, high = int(np.floor(pos)), int(np.ceil(pos))
            v, w = (held.get((p["episode_index"], frame(x)), (None, None))[which] for x in (low, high))
            if v is None or w is None or pos - low <= 1e-8:
                return v
            return [a * (1 - (pos - low)) + b * (pos - low) for a, b in zip(v, w, strict=True)]

        for k in range(p["usable_len"]):
            place = lambda i, p=p: i * (p["n_selected"] - 1) / (p["target_len"] - 1) if p["jittered"] else float(i)
            pos = place(k)
            near = held.get((p["episode_index"], frame(round(pos))), (None, None))
            action = at(place(k + p["effective_shift"]), 0) if p["effective_shift"] > 0 else near[0]
            state = near[1]
            if p["jittered"]:
                state = at(pos, 1) or near[1]
            out[p["segment"], p["list_pos"], k] = (frame(round(pos)), action, state)
    return out


@pytest.mark.parametrize(("jitter", "shift", "stride", "remove", "block"), [(0.3, 4, (2, 3), 0, 8), (0.3, 9, (), 4, 16), (0.0, 5, (), 0, 8), (0.2, 0, (), 0, 1024)])
def test_resampling_in_blocks(spark, jitter, shift, stride, remove, block):
    rng = np.random.default_rng(shift)
    rows = [(e, k, None if rng.random() < 0.1 else rng.normal(size=2).tolist(), None if rng.random() < 0.1 else rng.normal(size=2).tolist()) for e, n in ((0, 70), (1, 33), (2, 9)) for k in range(n) if e != 1 or k % 9]
    frames = frames_of(spark, rows).repartition(4)
    t = planning.Temporal(num_passes=2, stride_cycle=stride or None, remove_every_n=remove or None, jitter=jitter, action_shift=shift, tail_drop_max=3, include_originals=True)
    lengths = spark.createDataFrame([(0, 70, 0), (1, 33, 1), (2, 9, 2), (0, 70, 3)], "episode_index long, length long, list_pos long")
    plan = planning.build_plan(lengths, t)
    want = looked_up(rows, [r.asDict() for r in plan.collect()])
    got = {(r["segment"], r["list_pos"], r["out_idx"]): (r["src_frame"], r["action"], r["state"]) for r in resample.resample(frames, plan, jitter > 0, block).collect()}
    close = lambda x: None if x is None else pytest.approx(x, abs=1e-9)
    assert set(got) == set(want)
    for key, (f, a, s) in want.items():
        assert got[key] == (f, close(a), close(s)), key
