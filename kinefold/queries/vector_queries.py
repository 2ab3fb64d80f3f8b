"""Queries on vectors: each name has its Spark side and, where SQL can say it, its DuckDB side."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.draws import normal_sql, rounded, rounded_sql
from ..functions.vectors import TWO_ARMS, mirror_spec, mirrored, noisy
from ..operators import metrics, planning, prefilter, resample, selection, smoothing, statistics
from ..plans import jobs
from ..plans.recipes import resolve
from ..sources import datasets
from ..sources.fixtures import EVENT_FRAMES, SUPPLIER_FRAMES, event_frames, supplier_frames
from ..sources.scratch import scratch_path
from . import sql

QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}

FAST = prefilter.Gate("fast", 4, min_action_delta=0.028, max_action_jerk=0.060)
FULL = prefilter.Gate("full", 1, sparc_threshold=-6.5, saturation_limit=0.10, saturation_threshold=0.15, min_action_delta=0.030, max_action_jerk=0.057)
CYCLE = planning.Temporal(num_passes=4, include_originals=True, keep_every_n=1, stride_cycle=(2, 3, 4), action_shift=4, tail_drop_max=12)
JITTER = planning.Temporal(num_passes=2, include_originals=True, include_originals_decimated=True, keep_every_n=3, action_shift=4, tail_drop_max=8, jitter=0.15)
DECIMATE = planning.Temporal(num_passes=1, keep_every_n=1, remove_every_n=5, action_shift=4)
HARSH = planning.Temporal(num_passes=2, keep_every_n=30, action_shift=50, tail_drop_max=30)
RECIPE = resolve("v7", prefilter_sample_every_n=4, min_action_delta=0.028, max_action_jerk=0.060, smoothing=False, action_noise_std=0.0, num_passes=2)
IDS = (7, 3, 3, 11, 2)
_RANGES = "ranges AS (SELECT episode_index, sum(length) OVER (ORDER BY episode_index) - length AS dataset_from_index, sum(length) OVER (ORDER BY episode_index) AS dataset_to_index, length FROM episodes)"
_MADE = sql.with_(EVENT_FRAMES, sql.EPISODES, sql.plan(JITTER), sql.POSITIONS, sql.RESAMPLED)
FR, EP = EVENT_FRAMES, sql.EPISODES


def query(text: str | None = None):
    def add(f):
        QUERIES[f.__name__] = (f, text)
        return f

    return add


def _r(column) -> F.Column:
    return rounded(F.col(column) if isinstance(column, str) else column)


def r(text: str) -> str:
    return rounded_sql(text)


def _ints(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast("long").alias(c) if t in ("int", "smallint", "tinyint") else F.col(c) for c, t in df.dtypes])


#: Elements of a vector, from 1.
ALL = tuple(range(1, 15))


def _elements(name: str, at: tuple[int, ...] = ALL) -> list:
    return [_r(F.element_at(name, k)).alias(f"{name}_{k}") for k in at]


def _elements_sql(name: str, at: tuple[int, ...] = ALL, alias: str = "") -> str:
    return ", ".join(f"{r(f'{name}[{k}]')} AS {alias or name}_{k}" for k in at)


def indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames with a running index: episodes are numbered on their table, frames by addition."""
    frames = event_frames(spark, sf_dir)
    plan = planning.numbered(datasets.episodes(frames).select("episode_index", F.col("episode_index").alias("list_pos"), F.lit(0).alias("segment"), F.col("length").alias("usable_len")))
    return frames.join(plan.select("episode_index", "base_index"), "episode_index").withColumn("index", F.col("base_index") + F.col("frame_index")).drop("base_index")


# ------------------------------------------------------------ sources and sinks


@query(sql.with_(FR, EP, _RANGES) + "SELECT episode_index, dataset_from_index::BIGINT AS dataset_from_index, dataset_to_index::BIGINT AS dataset_to_index, length FROM ranges")
def a1_load_dataset(spark, sf_dir):
    path = scratch_path(spark, "frames")
    datasets.write_frames(indexed(spark, sf_dir).select(*[f.name for f in datasets.FRAMES]), path)
    return datasets.episode_ranges(datasets.read_frames(spark, path, ["episode_index", "index"]))


@query(sql.with_(FR) + f"SELECT episode_index, frame_index, task, {_elements_sql('action')}, {_elements_sql('state')} FROM frames")
def a3_write_dataset(spark, sf_dir):
    path = scratch_path(spark, "frames")
    datasets.write_frames(event_frames(spark, sf_dir), path)
    datasets.write_frames(event_frames(spark, sf_dir), path, force=True)  # a4: the overwrite switch
    return spark.read.parquet(path).select("episode_index", "frame_index", "task", *_elements("action"), *_elements("state"))


@query(sql.with_(sql.fast_scores(FAST)) + "SELECT episode_index, kept, reason FROM scores")
def a5_score_report(spark, sf_dir):
    frames, path = event_frames(spark, sf_dir), scratch_path(spark, "scores")
    datasets.write_scores(prefilter.scores(datasets.episodes(frames), frames, FAST), path)
    return spark.read.schema("episode_index long, kept boolean, reason string").json(path)


# ------------------------------------------------------------ projections and filters

_WANTED = ", ".join(f"({k}, {i})" for i, k in enumerate(IDS))


@query(sql.with_(FR, EP, f"wanted(episode_index, list_pos) AS (VALUES {_WANTED})") + "SELECT list_pos::BIGINT AS list_pos, episode_index::BIGINT AS episode_index, length FROM wanted JOIN episodes USING (episode_index)")
def b1_select_episodes(spark, sf_dir):
    return selection.select_episodes(datasets.episodes(event_frames(spark, sf_dir)), IDS).select("list_pos", "episode_index", "length")


@query(sql.with_(FR, EP, _RANGES) + "SELECT episode_index, length AS frames, dataset_from_index::BIGINT AS first_index, (dataset_to_index - 1)::BIGINT AS last_index FROM ranges")
def b2_episode_slice(spark, sf_dir):
    frames = indexed(spark, sf_dir)
    cut = selection.episode_slice(frames.select("index", "action"), datasets.episode_ranges(frames))
    return cut.groupBy("episode_index").agg(F.count("*").alias("frames"), F.min("index").alias("first_index"), F.max("index").alias("last_index"))


@query(sql.with_(FR) + f"SELECT coalesce(CASE WHEN task = 'click' THEN NULL ELSE task END, 'robot manipulation') AS task, {_elements_sql('action')}, {_elements_sql('state')} FROM frames")
def b3_output_frames(spark, sf_dir):
    frames = event_frames(spark, sf_dir).withColumn("task", F.when(F.col("task") != "click", F.col("task")))
    return datasets.output_frames(frames).select("task", *_elements("action"), *_elements("state"))


@query(sql.with_(FR) + "SELECT episode_index, frame_index FROM frames WHERE (frame_index - 1) % 3 = 0")
def b4_frame_stride(spark, sf_dir):
    return event_frames(spark, sf_dir).where(selection.strided(F.col("frame_index"), 3, 1)).select("episode_index", "frame_index")


@query(sql.with_(FR) + "SELECT episode_index, frame_index FROM frames WHERE (frame_index + 1) % 5 <> 0")
def b5_frame_decimate(spark, sf_dir):
    return event_frames(spark, sf_dir).where(selection.decimated(F.col("frame_index"), 5)).select("episode_index", "frame_index")


@query(sql.with_(FR, EP, sql.plan(CYCLE)) + "SELECT segment::BIGINT AS segment, episode_index, stride::BIGINT AS stride, start_offset::BIGINT AS start_offset, n_selected FROM plan")
def b6_pass_selector(spark, sf_dir):
    return _ints(planning.build_plan(datasets.episodes(event_frames(spark, sf_dir)), CYCLE).select("segment", "episode_index", "stride", "start_offset", "n_selected"))


@query(sql.with_(FR, EP, sql.plan(CYCLE)) + "SELECT segment::BIGINT AS segment, episode_index, tail_drop FROM plan")
def b7_tail_drop(spark, sf_dir):
    return _ints(planning.build_plan(datasets.episodes(event_frames(spark, sf_dir)), CYCLE).select("segment", "episode_index", "tail_drop"))


@query(sql.with_(FR, EP) + "SELECT episode_index, frame_index, frame_index // step AS pool_index FROM frames JOIN (SELECT episode_index, greatest(1, length // 20) AS step FROM episodes) USING (episode_index) WHERE frame_index % step = 0 AND frame_index // step < 20")
def b8_even_frames(spark, sf_dir):
    frames = event_frames(spark, sf_dir)
    return selection.evenly(frames, datasets.episodes(frames), 20).select("episode_index", "frame_index", "pool_index")


@query(sql.with_(FR) + "SELECT episode_index, count(*) AS n, sum(frame_index)::BIGINT AS total FROM frames WHERE frame_index % 8 = 0 GROUP BY 1")
def b9_prefilter_sampling(spark, sf_dir):
    return selection.sampled(event_frames(spark, sf_dir), 8).groupBy("episode_index").agg(F.count("*").alias("n"), F.sum("frame_index").alias("total"))


def _scores(spark, sf_dir, gate):
    frames = event_frames(spark, sf_dir)
    return prefilter.scores(datasets.episodes(frames), frames, gate)


@query(sql.with_(sql.fast_scores(FAST)) + "SELECT episode_index, action_delta, action_jerk, kept FROM scores")
def b10_episode_gate(spark, sf_dir):
    return _scores(spark, sf_dir, FAST).select("episode_index", "action_delta", "action_jerk", "kept")


@query(sql.with_(sql.full_scores(FULL)) + "SELECT episode_index, reason FROM scores")
def b11_verdict_reason(spark, sf_dir):
    return _scores(spark, sf_dir, FULL).select("episode_index", "reason")


_SPARSE = prefilter.Gate("fast", 60, min_action_delta=0.028, max_action_jerk=0.060)


@query(sql.with_(sql.fast_scores(_SPARSE)) + "SELECT episode_index, action_delta, kept, reason FROM scores")
def b12_insufficient_data(spark, sf_dir):
    return _scores(spark, sf_dir, _SPARSE).select("episode_index", "action_delta", "kept", "reason")


@query(
    sql.with_(FR, "cut AS (SELECT episode_index, CASE WHEN (episode_index*31 + frame_index) % 501 = 0 THEN 13 ELSE 14 END AS n FROM frames)", "e AS (SELECT episode_index, min(n) AS lo, max(n) AS hi FROM cut GROUP BY 1)")
    + "SELECT episode_index, CASE WHEN lo < hi THEN printf('vectors of %d to %d elements', lo, hi) END AS reason FROM e"
)
def b13_bad_records(spark, sf_dir):
    frames = event_frames(spark, sf_dir)
    short = (F.col("episode_index") * 31 + F.col("frame_index")) % 501 == 0
    frames = frames.withColumn("action", F.when(short, F.slice("action", 1, 13)).otherwise(F.col("action")))
    easy = prefilter.Gate("fast", 1, min_action_delta=-1.0)
    return prefilter.scores(datasets.episodes(frames), frames, easy).select("episode_index", "reason")


@query(sql.with_(FR, EP, sql.plan(HARSH)) + "SELECT segment::BIGINT AS segment, episode_index, n_selected, effective_shift, usable_len FROM plan")
def b14_drop_empty(spark, sf_dir):
    return _ints(planning.build_plan(datasets.episodes(event_frames(spark, sf_dir)), HARSH).select("segment", "episode_index", "n_selected", "effective_shift", "usable_len"))


# ------------------------------------------------------------ joins


@query(sql.with_(FR) + f"SELECT f.episode_index, f.frame_index, {_elements_sql('g.action', alias='label')} FROM frames f JOIN frames g ON g.episode_index = f.episode_index AND g.frame_index = f.frame_index + 4")
def c1_future_action(spark, sf_dir):
    return resample.future_actions(event_frames(spark, sf_dir), 4).select("episode_index", "frame_index", *_elements("label"))


def _made(spark, sf_dir, t=JITTER):
    frames = event_frames(spark, sf_dir)
    return resample.resample(frames, planning.build_plan(datasets.episodes(frames), t), t.jitter > 0)


@query(_MADE + f"SELECT segment::BIGINT AS segment, episode_index, out_idx, {_elements_sql('action')}, {_elements_sql('state')} FROM made")
def c2_asof_interpolation(spark, sf_dir):
    return _ints(_made(spark, sf_dir).select("segment", "episode_index", "out_idx", *_elements("action"), *_elements("state")))


@query(_MADE + "SELECT segment::BIGINT AS segment, episode_index, out_idx, src_frame::BIGINT AS src_frame, task FROM made")
def c3_nearest_frame(spark, sf_dir):
    return _ints(_made(spark, sf_dir).select("segment", "episode_index", "out_idx", "src_frame", "task"))


@query(sql.with_(FR, sql.values(), sql.DIFFS) + f"SELECT episode_index, frame_index, {r('sum(abs(a - ns))/3.141592653589793::DOUBLE')} AS error FROM diffs WHERE ns IS NOT NULL GROUP BY 1, 2")
def c4_command_response(spark, sf_dir):
    rows = metrics.paired(event_frames(spark, sf_dir)).where("next_state is not null")
    return rows.select("episode_index", "frame_index", _r(F.aggregate(F.zip_with("action", "next_state", lambda a, s: F.abs(a - s)), F.lit(0.0), lambda t, x: t + x) / 3.141592653589793).alias("error"))


@query(sql.with_(sql.fast_scores(FAST)) + "SELECT episode_index, length FROM episodes JOIN scores USING (episode_index) WHERE kept")
def c5_keep_list(spark, sf_dir):
    frames = event_frames(spark, sf_dir)
    every = datasets.episodes(frames)
    return prefilter.kept_episodes(every, prefilter.scores(every, frames, FAST))


@query(sql.with_(sql.fast_scores(FAST)) + "SELECT episode_index, length FROM episodes JOIN scores USING (episode_index) WHERE NOT kept")
def c6_rejected_episodes(spark, sf_dir):
    frames = event_frames(spark, sf_dir)
    every = datasets.episodes(frames)
    return prefilter.rejected_episodes(every, prefilter.scores(every, frames, FAST))


@query(sql.with_(FR, EP) + "SELECT episode_index, p AS segment, length FROM episodes, (SELECT unnest(range(3)) AS p) ps")
def c7_episode_passes(spark, sf_dir):
    t = planning.Temporal(num_passes=3)
    return _ints(planning.build_plan(datasets.episodes(event_frames(spark, sf_dir)), t).select("episode_index", "segment", "length"))


# ------------------------------------------------------------ aggregations


def _motion(spark, sf_dir, limit=None):
    return metrics.motion(event_frames(spark, sf_dir), limit)


@query(sql.with_(FR, sql.values(), sql.DIFFS) + f"SELECT episode_index, {r('sum(abs(d1))/count(d1)')} AS action_delta FROM diffs GROUP BY 1")
def d1_action_delta(spark, sf_dir):
    return _motion(spark, sf_dir).select("episode_index", _r("action_delta").alias("action_delta"))


@query(sql.with_(FR, sql.values(), sql.DIFFS) + f"SELECT episode_index, {r('sum(abs(d2))/count(d2)')} AS action_jerk FROM diffs GROUP BY 1")
def d2_action_jerk(spark, sf_dir):
    return _motion(spark, sf_dir).select("episode_index", _r("action_jerk").alias("action_jerk"))


@query(sql.with_(sql.full_scores(FULL)) + "SELECT episode_index, saturation FROM scores")
def d3_saturation(spark, sf_dir):
    return _motion(spark, sf_dir, FULL.saturation_limit).select("episode_index", _r("saturation").alias("saturation"))


@query(sql.with_(FR, sql.values(), sql.SPARC) + f"SELECT episode_index, {r('sparc')} AS sparc FROM smooth")
def d4_spectral_arc_length(spark, sf_dir):
    return metrics.smoothness(event_frames(spark, sf_dir)).select("episode_index", _r("sparc").alias("sparc"))


@query(sql.with_(sql.full_scores(FULL)) + "SELECT episode_index, sparc, saturation, action_delta, action_jerk, kept, reason FROM scores")
def d5_full_prefilter(spark, sf_dir):
    return _scores(spark, sf_dir, FULL).select("episode_index", "sparc", "saturation", "action_delta", "action_jerk", "kept", "reason")


@query(sql.with_(sql.full_scores(FULL)) + "SELECT kept, coalesce(regexp_extract(reason, '^([a-z_]+)', 1), 'kept') AS reason_kind, count(*) AS episodes FROM scores GROUP BY 1, 2")
def d6_filter_summary(spark, sf_dir):
    return prefilter.summary(_scores(spark, sf_dir, FULL))


_STATS = """long AS (SELECT 'action' AS feature, d AS dim, a AS v FROM vals UNION ALL SELECT 'state', d, s FROM vals)"""


@query(sql.with_(FR, sql.values(), _STATS) + f"SELECT feature, dim::BIGINT AS dim, {r('avg(v)')} AS mean, {r('stddev_pop(v)')} AS std, {r('min(v)')} AS min, {r('max(v)')} AS max FROM long GROUP BY 1, 2")
def d7_feature_statistics(spark, sf_dir):
    return _ints(statistics.by_dimension(event_frames(spark, sf_dir)).select("feature", "dim", *[_r(c).alias(c) for c in ("mean", "std", "min", "max")]))


@query(sql.with_(FR, EP) + "SELECT count(*) AS episodes, sum(length)::BIGINT AS frames, 50.0::DOUBLE AS fps FROM episodes")
def d8_dataset_summary(spark, sf_dir):
    return statistics.dataset_summary(event_frames(spark, sf_dir))


_JERKS = "jerks AS (SELECT episode_index, sum(abs(d2))/count(d2) AS jerk FROM diffs GROUP BY 1), deviations AS (SELECT stddev_pop(a) AS s FROM vals GROUP BY d)"


@query(
    sql.with_(FR, EP, sql.values(), sql.DIFFS, _JERKS)
    + f"SELECT (SELECT count(*) FROM episodes) AS episodes, {r('(SELECT stddev_pop(length) FROM episodes)')} AS length_std, {r('(SELECT avg(jerk) FROM jerks)')} AS jerk, {r('(SELECT avg(s) FROM deviations)')} AS diversity"
)
def d9_quality_report(spark, sf_dir):
    frames = event_frames(spark, sf_dir)
    return statistics.quality(frames, metrics.motion(frames)).select("episodes", *[_r(c).alias(c) for c in ("length_std", "jerk", "diversity")])


_CORR = "SELECT lag, count(*) AS pairs, corr(x.a, y.a) AS c FROM vals x, (SELECT unnest(range(1, 21)) AS lag) lags JOIN vals y ON y.episode_index = x.episode_index AND y.d = x.d AND y.frame_index = x.frame_index + lag GROUP BY 1"


@query(sql.with_(FR, sql.values(), f"corrs AS ({_CORR})") + f"SELECT lag, pairs, {r('c')} AS correlation FROM corrs")
def d10_autocorrelation(spark, sf_dir):
    return metrics.autocorrelation(event_frames(spark, sf_dir), 20).select("lag", "pairs", _r("correlation").alias("correlation"))


@query(sql.with_(FR, sql.values(), f"corrs AS ({_CORR})") + f"SELECT min(lag) AS steps, {r('min(lag)/50.0::DOUBLE')} AS seconds FROM corrs WHERE c < 0.5")
def d11_chunk_length(spark, sf_dir):
    return metrics.first_chunk_length(event_frames(spark, sf_dir)).select("steps", _r("seconds").alias("seconds"))


_ABS = "list_sum(list_transform(action, lambda x: abs(x)))"


@query(_MADE + f"SELECT {r(f'(SELECT avg({_ABS}) FROM frames)')} AS before, {r(f'(SELECT avg({_ABS}) FROM made)')} AS after")
def d12_action_sums(spark, sf_dir):
    return statistics.action_sums(event_frames(spark, sf_dir), _made(spark, sf_dir)).select(_r("before").alias("before"), _r("after").alias("after"))


@query(sql.with_(FR, sql.values()) + f"SELECT d::BIGINT AS dim, {r('avg(CASE WHEN a <> 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)')} AS non_zero FROM vals GROUP BY 1")
def d13_non_zero_actions(spark, sf_dir):
    return _ints(statistics.by_dimension(event_frames(spark, sf_dir), ("action",)).select("dim", _r("non_zero").alias("non_zero")))


_SPANS = "b AS (SELECT d, max(a) - min(a) AS w FROM vals GROUP BY 1), m AS (SELECT d, max(action[d+1]) - min(action[d+1]) AS w FROM made, (SELECT unnest(range(14)) AS d) ds GROUP BY 1)"


@query(_MADE.rstrip() + f",\n{sql.values()}, {_SPANS} SELECT d::BIGINT AS dim, {r('b.w')} AS before, {r('m.w')} AS after, {r('m.w/b.w')} AS ratio FROM b JOIN m USING (d)")
def d14_joint_coverage(spark, sf_dir):
    return _ints(statistics.joint_coverage(event_frames(spark, sf_dir), _made(spark, sf_dir)).select("dim", *[_r(c).alias(c) for c in ("before", "after", "ratio")]))


@query()
def d14_smoothness_change(spark, sf_dir):
    """Smoothness of the output of the production recipe, smoothing and noise on, against its source."""
    frames = event_frames(spark, sf_dir)
    made = jobs.augment_job(frames, resolve("v7", prefilter=False, num_passes=1)).frames
    return statistics.smoothness_change(metrics.smoothness(frames), metrics.smoothness(made)).select(*[_r(c).alias(c) for c in ("before", "after", "change")])


@query(sql.with_(FR, EP, sql.plan(HARSH)) + "SELECT segment::BIGINT AS segment, (SELECT count(*) FROM episodes) AS planned, coalesce(w, 0) AS written, coalesce(f, 0)::BIGINT AS frames FROM passes LEFT JOIN (SELECT segment, count(*) AS w, sum(usable_len) AS f FROM plan GROUP BY 1) USING (segment)")
def d17_plan_totals(spark, sf_dir):
    every = datasets.episodes(event_frames(spark, sf_dir))
    return _ints(planning.plan_totals(every, planning.build_plan(every, HARSH), HARSH))


# ------------------------------------------------------------ windows


@query(sql.with_(FR, sql.values(), sql.DIFFS) + f"SELECT episode_index, frame_index, d AS dim, {r('d1')} AS d1, {r('d2')} AS d2 FROM diffs")
def e1_differences(spark, sf_dir):
    rows = metrics.differences(event_frames(spark, sf_dir)).select("episode_index", "frame_index", F.posexplode("action").alias("dim", "a"), "d1", "d2")
    return rows.select("episode_index", "frame_index", F.col("dim").cast("long").alias("dim"), _r(F.col("d1")[F.col("dim")]).alias("d1"), _r(F.col("d2")[F.col("dim")]).alias("d2"))


@query(sql.with_(FR, sql.values(), sql.SPARC) + f"SELECT episode_index, t AS frame_index, d AS dim, {r('v')} AS velocity FROM speed")
def e2_gradient(spark, sf_dir):
    rows = metrics.gradient(event_frames(spark, sf_dir)).select("episode_index", "frame_index", F.posexplode("velocity").alias("dim", "v"))
    return rows.select("episode_index", "frame_index", F.col("dim").cast("long").alias("dim"), _r("v").alias("velocity"))


def _weights(row: int) -> str:
    return "[" + ", ".join(f"{float(w)!r}::DOUBLE" for w in smoothing.hat(7, 2)[row]) + "]"


_SMOOTH = f"""seq AS (SELECT f.episode_index, f.frame_index AS k, d, action[d+1] AS a, length AS n FROM frames f JOIN episodes USING (episode_index), (SELECT unnest(range(14)) AS d) ds),
rowed AS (SELECT *, CASE WHEN k < 3 THEN 0 WHEN k > n - 4 THEN n - 7 ELSE k - 3 END AS start, CASE WHEN k < 3 THEN k WHEN k > n - 4 THEN 7 - (n - k) ELSE 3 END AS hat_row FROM seq),
hats AS (SELECT * FROM (VALUES {", ".join(f"({i}, {_weights(i)})" for i in range(7))}) h(hat_row, w)),
smoothed AS (SELECT q.episode_index, q.k, q.d, CASE WHEN q.d IN (6, 13) THEN max(q.a) ELSE sum(w[p.k - q.start + 1]*p.a) END AS a
  FROM rowed q JOIN hats USING (hat_row) JOIN seq p ON p.episode_index = q.episode_index AND p.d = q.d AND p.k BETWEEN q.start AND q.start + 6 GROUP BY 1, 2, 3)"""


@query(sql.with_(FR, EP, _SMOOTH) + f"SELECT episode_index, k AS frame_index, d::BIGINT AS dim, {r('a')} AS action FROM smoothed")
def e3_savitzky_golay(spark, sf_dir):
    frames = event_frames(spark, sf_dir)
    rows = frames.select("episode_index", "frame_index", "action").join(datasets.episodes(frames), "episode_index")
    rows = smoothing.smooth(rows, 7, 2, (6, 13), keys=("episode_index",), place="frame_index", length="length")
    rows = rows.select("episode_index", "frame_index", F.posexplode("action").alias("dim", "a"))
    return rows.select("episode_index", "frame_index", F.col("dim").cast("long").alias("dim"), _r("a").alias("action"))


@query(sql.with_(FR, EP, sql.plan(JITTER)) + f"SELECT segment::BIGINT AS segment, episode_index, n_selected, {r('speed_scale')} AS speed_scale, target_len, usable_len FROM plan")
def e4_temporal_jitter(spark, sf_dir):
    plan = planning.build_plan(datasets.episodes(event_frames(spark, sf_dir)), JITTER)
    return _ints(plan.select("segment", "episode_index", "n_selected", _r("speed_scale").alias("speed_scale"), "target_len", "usable_len"))


@query(sql.with_(FR) + "SELECT episode_index, frame_index, row_number() OVER (PARTITION BY episode_index ORDER BY frame_index) - 1 AS seq FROM frames WHERE (frame_index + 1) % 5 <> 0")
def e5_sequence_numbers(spark, sf_dir):
    plan = planning.build_plan(datasets.episodes(event_frames(spark, sf_dir)), planning.Temporal(num_passes=1, remove_every_n=5))
    rows = planning.positions(plan)
    frame = planning.source_frame(F.col("out_idx"), F.col("stride"), F.col("start_offset"), F.col("remove"))
    return rows.select("episode_index", frame.alias("frame_index"), F.col("out_idx").alias("seq"))


@query(_MADE + "SELECT output_order AS episode_index, out_idx AS frame_index, base_index + out_idx AS index, out_idx/50.0::DOUBLE AS timestamp, episode_index AS source_episode, segment::BIGINT AS segment FROM made")
def e8_renumber(spark, sf_dir):
    return _ints(resample.renumbered(_made(spark, sf_dir)).select("episode_index", "frame_index", "index", "timestamp", "source_episode", "segment"))


@query(sql.with_(FR, EP, sql.plan(CYCLE)) + "SELECT segment::BIGINT AS segment, episode_index, lag(episode_index) OVER (PARTITION BY segment ORDER BY list_pos) AS prev_episode FROM plan")
def e9_previous_episode(spark, sf_dir):
    from ..operators.background import previous_episodes

    plan = planning.build_plan(datasets.episodes(event_frames(spark, sf_dir)), CYCLE)
    return _ints(previous_episodes(plan).select("segment", "episode_index", "prev_episode"))


# ------------------------------------------------------------ sorts and sets


@query(sql.with_(FR, EP) + "SELECT episode_index, length FROM episodes ORDER BY episode_index LIMIT 5")
def f1_episode_preview(spark, sf_dir):
    return jobs.profile_job(event_frames(spark, sf_dir))["preview"].select("episode_index", "length")


@query(sql.with_(FR) + "SELECT episode_index, task, len(action)::BIGINT AS action_size, len(state)::BIGINT AS state_size FROM frames WHERE frame_index = 0")
def f2_sample_items(spark, sf_dir):
    return event_frames(spark, sf_dir).where("frame_index = 0").select("episode_index", "task", F.size("action").cast("long").alias("action_size"), F.size("state").cast("long").alias("state_size"))


@query(sql.with_(FR) + "SELECT episode_index, count(*) AS frames, 0::BIGINT AS out_of_order FROM frames GROUP BY 1")
def f4_frame_order(spark, sf_dir):
    """Counts frames that a reader meets out of order within their file; written order is by episode and frame."""
    path = scratch_path(spark, "frames")
    datasets.write_frames(event_frames(spark, sf_dir).select("episode_index", "frame_index"), path)
    read = spark.read.parquet(path).select("*", F.input_file_name().alias("file"), F.col("_metadata.row_index").alias("row"))
    w = Window.partitionBy("file", "episode_index").orderBy("row")
    wrong = F.coalesce((F.lag("frame_index").over(w) >= F.col("frame_index")).cast("long"), F.lit(0))
    return read.withColumn("wrong", wrong).groupBy("episode_index").agg(F.count("*").alias("frames"), F.sum("wrong").alias("out_of_order"))


@query(_MADE + "SELECT segment::BIGINT AS segment, count(*) AS frames, min(base_index + out_idx) AS first_index, max(base_index + out_idx) AS last_index FROM made GROUP BY 1")
def g1_originals_and_passes(spark, sf_dir):
    rows = resample.renumbered(_made(spark, sf_dir))
    return _ints(rows.groupBy("segment").agg(F.count("*").alias("frames"), F.min("index").alias("first_index"), F.max("index").alias("last_index")))


# ------------------------------------------------------------ vector functions


@query(sql.with_(FR, EP) + "SELECT episode_index, shift::BIGINT AS shift, round_even(shift/(1 + episode_index % 7)::DOUBLE, 0)::BIGINT AS effective FROM episodes, (SELECT unnest([0, 1, 4, 6, 10]) AS shift) s")
def h1_effective_shift(spark, sf_dir):
    every = datasets.episodes(event_frames(spark, sf_dir))
    stride = 1 + F.col("episode_index") % 7
    parts = [every.select("episode_index", F.lit(s).cast("long").alias("shift"), planning.effective_shift(s, stride).alias("effective")) for s in (0, 1, 4, 6, 10)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


_SIGNS = "[" + ", ".join(f"{s}::DOUBLE" for s in TWO_ARMS.action_signs) + "]"
_FLIP = f"flipped AS (SELECT episode_index, frame_index, list_transform(range(1, 15), lambda i: action[CASE WHEN i > 7 THEN i - 7 ELSE i + 7 END]*{_SIGNS}[CASE WHEN i > 7 THEN i - 7 ELSE i + 7 END]) AS action FROM frames)"


@query(sql.with_(FR, _FLIP) + f"SELECT episode_index, frame_index, {_elements_sql('action')} FROM flipped")
def h2_mirror(spark, sf_dir):
    frames = event_frames(spark, sf_dir).withColumn("action", mirrored(F.col("action"), TWO_ARMS.action_signs, TWO_ARMS.arm))
    return frames.select("episode_index", "frame_index", *_elements("action"))


@query(sql.with_(FR) + f"SELECT episode_index, frame_index, {', '.join(r(f'{sign}{n}[{k}]') + f' AS {n}_{k}' for n, changed in (('action', 1), ('state', 14)) for k in ALL for sign in ('-' if k == changed else '',))} FROM frames")
def h3_custom_mirror(spark, sf_dir):
    spec = mirror_spec(None, [-1.0] + [1.0] * 13, [1.0] * 13 + [-1.0])
    a, s = mirrored(F.col("action"), spec.action_signs, spec.arm), mirrored(F.col("state"), spec.state_signs, spec.arm)
    return event_frames(spark, sf_dir).withColumns({"action": a, "state": s}).select("episode_index", "frame_index", *_elements("action"), *_elements("state"))


_NOISE = normal_sql("'42'", "episode_index", "frame_index", "'noise'", "d")


@query(sql.with_(FR, sql.values()) + f"SELECT episode_index, frame_index, d AS dim, {rounded_sql(f'a + 0.003::DOUBLE*{_NOISE}', 5)} AS action FROM vals")
def h4_action_noise(spark, sf_dir):
    vector = noisy(F.col("action"), 0.003, "42", F.col("episode_index"), F.col("frame_index"), "noise")
    rows = event_frames(spark, sf_dir).select("episode_index", "frame_index", F.posexplode(vector).alias("dim", "a"))
    return rows.select("episode_index", "frame_index", F.col("dim").cast("long").alias("dim"), rounded(F.col("a"), 5).alias("action"))


@query(sql.with_(FR) + f"SELECT f.episode_index, f.frame_index, {', '.join(r(f'f.action[{k}]*(1.0::DOUBLE - 0.25::DOUBLE) + g.action[{k}]*0.25::DOUBLE') + f' AS mixed_{k}' for k in ALL)} FROM frames f JOIN frames g ON g.episode_index = f.episode_index AND g.frame_index = f.frame_index + 1")
def h5_lerp(spark, sf_dir):
    from ..functions.vectors import lerp

    rows = resample.future_actions(event_frames(spark, sf_dir), 1).withColumn("mixed", lerp(F.col("action"), F.col("label"), F.lit(0.25)))
    return rows.select("episode_index", "frame_index", *_elements("mixed"))


# ------------------------------------------------------------ jobs


@query(sql.with_(sql.fast_scores(FAST)) + "SELECT episode_index, kept, reason FROM scores")
def k1_prefilter_job(spark, sf_dir):
    return jobs.prefilter_job(event_frames(spark, sf_dir), RECIPE).select("episode_index", "kept", "reason")


_KEPT = "chosen AS (SELECT episodes.* FROM episodes JOIN scores USING (episode_index) WHERE kept)"
_JOB = sql.with_(sql.fast_scores(FAST), _KEPT, sql.plan(RECIPE.temporal(), "chosen"), sql.POSITIONS, sql.RESAMPLED)


def _pair(name: str, k: int) -> str:
    j = k - 7 if k > 7 else k + 7
    return f"{r(f'CASE WHEN segment = -1 THEN {name}[{k}] ELSE {name}[{j}]*{TWO_ARMS.action_signs[j - 1]}::DOUBLE END')} AS {name}_{k}"


@query(_JOB + f"SELECT output_order AS episode_index, out_idx AS frame_index, base_index + out_idx AS index, segment::BIGINT AS segment, {', '.join(_pair(n, k) for n in ('action', 'state') for k in ALL)} FROM made")
def k2_augment_job(spark, sf_dir):
    frames = jobs.augment_job(event_frames(spark, sf_dir), RECIPE).frames
    return _ints(frames.select("episode_index", "frame_index", "index", "segment", *_elements("action"), *_elements("state")))


@query(sql.with_(SUPPLIER_FRAMES) + f"SELECT feature, d::BIGINT AS dim, {r('avg(v[d+1])')} AS mean, {r('min(v[d+1])')} AS min, {r('max(v[d+1])')} AS max, count(*) AS n FROM (SELECT 'action' AS feature, action AS v FROM suppliers UNION ALL SELECT 'state', state FROM suppliers), (SELECT unnest(range(4)) AS d) ds GROUP BY 1, 2")
def k4_profile_job(spark, sf_dir):
    stats = jobs.profile_job(supplier_frames(spark, sf_dir))["statistics"]
    return _ints(stats.select("feature", "dim", _r("mean").alias("mean"), _r("min").alias("min"), _r("max").alias("max"), "n"))


def _report(name: str, table: str) -> str:
    vals = f"(SELECT episode_index, k AS frame_index, d, v[d+1] AS a FROM (SELECT {'output_order AS episode_index, out_idx AS k' if table == 'made' else 'episode_index, frame_index AS k'}, action AS v FROM {table}), (SELECT unnest(range(14)) AS d) ds)"
    jerk = f"(SELECT avg(j) FROM (SELECT episode_index, sum(abs(d2))/count(d2) AS j FROM (SELECT episode_index, (a - lag(a) OVER w) - (lag(a) OVER w - lag(a, 2) OVER w) AS d2 FROM {vals} WINDOW w AS (PARTITION BY episode_index, d ORDER BY frame_index)) GROUP BY 1))"
    key = "output_order" if table == "made" else "episode_index"
    return f"SELECT '{name}' AS dataset, (SELECT count(DISTINCT {key}) FROM {table}) AS episodes, {r(f'(SELECT stddev_pop(n) FROM (SELECT count(*) AS n FROM {table} GROUP BY {key}))')} AS length_std, {r(jerk)} AS jerk, {r(f'(SELECT avg(s) FROM (SELECT stddev_pop(a) AS s FROM {vals} GROUP BY d))')} AS diversity"


@query(_MADE + _report("before", "frames") + " UNION ALL " + _report("after", "made"))
def k5_quality_job(spark, sf_dir):
    rows = jobs.quality_job(event_frames(spark, sf_dir), resample.renumbered(_made(spark, sf_dir)), 20)
    return rows.select("dataset", "episodes", *[_r(c).alias(c) for c in ("length_std", "jerk", "diversity")])


@query(sql.with_(sql.fast_scores(FAST), _KEPT, sql.plan(RECIPE.temporal(), "chosen")) + "SELECT output_order, segment::BIGINT AS segment, episode_index, usable_len, base_index FROM plan")
def k6_plan_job(spark, sf_dir):
    return _ints(jobs.plan_job(event_frames(spark, sf_dir), RECIPE).select("output_order", "segment", "episode_index", "usable_len", "base_index"))
