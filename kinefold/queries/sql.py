"""Building blocks of the DuckDB side."""

from __future__ import annotations

from ..functions.draws import between_sql, integer_sql, rounded_sql
from ..operators.planning import Temporal, segments
from ..operators.prefilter import Gate
from ..sources.fixtures import EVENT_FRAMES

EPISODES = "episodes AS (SELECT episode_index, count(*) AS length FROM frames GROUP BY 1)"


def values(dims: int = 14) -> str:
    return f"vals AS (SELECT episode_index, frame_index, d, action[d+1] AS a, state[d+1] AS s FROM frames, (SELECT unnest(range({dims})) AS d) ds)"


DIFFS = """diffs AS (
  SELECT episode_index, frame_index, d, a, s, a - lag(a) OVER w AS d1,
         (a - lag(a) OVER w) - (lag(a) OVER w - lag(a, 2) OVER w) AS d2, lead(s) OVER w AS ns
  FROM vals WINDOW w AS (PARTITION BY episode_index, d ORDER BY frame_index))"""


def with_(*parts: str, recursive: bool = False) -> str:
    return f"WITH {'RECURSIVE ' if recursive else ''}" + ",\n".join(parts) + "\n"


def plan(t: Temporal, episodes: str = "episodes") -> str:
    """The plan of all rows of ``episodes`` as table ``plan``."""
    rows = ", ".join(str(s) for s in segments(t))
    key = (f"'{t.seed}'", "segment", "episode_index", "list_pos")
    drop = integer_sql(t.tail_drop_max, *key, "'tail'") if t.tail_drop_max > 0 else "0::BIGINT"
    jittered = "segment <> -1 AND n_selected > 1" if t.jitter > 0 else "false"
    scale = between_sql(1.0 - t.jitter, 1.0 + t.jitter, *key, "'speed'") if t.jitter > 0 else "1.0::DOUBLE"
    return f"""passes(segment, stride, start_offset, remove) AS (VALUES {rows}),
p0 AS (SELECT e.episode_index, e.length, e.episode_index AS list_pos, passes.* FROM {episodes} e, passes),
p1 AS (SELECT *, {drop} AS tail_drop FROM p0),
p2 AS (SELECT *, greatest(0, length - tail_drop) AS len FROM p1),
p3 AS (SELECT *, (CASE WHEN stride > 1 THEN greatest(0, (len - start_offset + stride - 1) // stride)
                      WHEN remove > 0 THEN len - len // greatest(remove, 2) ELSE len END)::BIGINT AS n_selected FROM p2),
p4 AS (SELECT *, ({jittered}) AS jittered, CASE WHEN {jittered} THEN {scale} ELSE 1.0::DOUBLE END AS speed_scale,
              round_even({float(max(0, t.action_shift))}::DOUBLE / stride, 0)::BIGINT AS effective_shift FROM p3),
p5 AS (SELECT *, CASE WHEN jittered THEN greatest(2, round_even(n_selected*speed_scale, 0)::BIGINT) ELSE n_selected END AS target_len FROM p4),
p6 AS (SELECT *, target_len - effective_shift AS usable_len FROM p5),
plan AS (SELECT *, row_number() OVER (ORDER BY segment, list_pos) - 1 AS output_order,
                coalesce(sum(usable_len) OVER (ORDER BY segment, list_pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS base_index
         FROM p6 WHERE n_selected > 0 AND usable_len > 0)"""


def source(place: str) -> str:
    return f"(CASE WHEN stride > 1 THEN ({place})*stride + start_offset WHEN remove > 0 THEN ({place}) + ({place}) // greatest(remove - 1, 1) ELSE ({place}) END)"


POSITIONS = """places AS (
  SELECT *, CASE WHEN jittered THEN (out_idx*(n_selected-1))::DOUBLE/(target_len-1) ELSE out_idx::DOUBLE END AS pos,
         CASE WHEN jittered THEN ((out_idx+effective_shift)*(n_selected-1))::DOUBLE/(target_len-1) ELSE (out_idx+effective_shift)::DOUBLE END AS label_pos
  FROM (SELECT *, unnest(range(usable_len)) AS out_idx FROM plan))"""


def _clamp(x: str) -> str:
    return f"greatest(0, least(({x})::BIGINT, n_selected - 1))"


def _lerp(low: str, high: str, pos: str) -> str:
    alpha = f"({pos} - floor({pos}))"
    return f"(CASE WHEN {alpha} <= 1e-8 OR {high} IS NULL THEN {low} ELSE list_transform(range(1, len({low})+1), lambda i: {low}[i]*(1.0::DOUBLE-{alpha}) + {high}[i]*{alpha}) END)"


#: Output frames of a plan, as the table ``made``.
RESAMPLED = f"""made AS (
  SELECT p.segment, p.list_pos, p.episode_index, p.output_order, p.base_index, p.usable_len, p.out_idx,
         {source(_clamp("round_even(pos, 0)"))} AS src_frame, near.task AS task,
         CASE WHEN effective_shift > 0 THEN CASE WHEN jittered THEN {_lerp("al.action", "ah.action", "label_pos")} ELSE al.action END ELSE near.action END AS action,
         CASE WHEN jittered THEN {_lerp("sl.state", "sh.state", "pos")} ELSE near.state END AS state
  FROM places p
  LEFT JOIN frames near ON near.episode_index = p.episode_index AND near.frame_index = {source(_clamp("round_even(pos, 0)"))}
  LEFT JOIN frames al ON al.episode_index = p.episode_index AND al.frame_index = {source(_clamp("floor(label_pos)"))}
  LEFT JOIN frames ah ON ah.episode_index = p.episode_index AND ah.frame_index = {source(_clamp("ceil(label_pos)"))}
  LEFT JOIN frames sl ON sl.episode_index = p.episode_index AND sl.frame_index = {source(_clamp("floor(pos)"))}
  LEFT JOIN frames sh ON sh.episode_index = p.episode_index AND sh.frame_index = {source(_clamp("ceil(pos)"))})"""


def fast_scores(gate: Gate, frames: str = EVENT_FRAMES) -> str:
    """``scores`` in fast mode."""
    n = max(1, gate.sample_every_n)
    jerk = f"WHEN action_jerk > {gate.max_action_jerk}::DOUBLE THEN printf('jerky_action (jerk=%.4f)', {rounded_sql('action_jerk', 4)})" if gate.max_action_jerk is not None else ""
    return f"""{frames}, {EPISODES},
vals AS (SELECT episode_index, frame_index, d, action[d+1] AS a, state[d+1] AS s FROM frames, (SELECT unnest(range(14)) AS d) ds WHERE frame_index % {n} = 0),
{DIFFS},
found AS (SELECT episode_index, count(DISTINCT frame_index) AS n, {rounded_sql("coalesce(sum(abs(d1))/count(d1), 0)")} AS action_delta,
                 {rounded_sql("CASE WHEN count(d2) = 0 THEN 0 ELSE sum(abs(d2))/count(d2) END")} AS action_jerk FROM diffs GROUP BY 1),
judged AS (SELECT e.episode_index, CASE WHEN n < 2 THEN NULL ELSE action_delta END AS action_delta, CASE WHEN n < 2 THEN NULL ELSE action_jerk END AS action_jerk,
                  CASE WHEN coalesce(n, 0) < 2 THEN 'insufficient sampled action data' {jerk}
                       WHEN action_delta < {gate.min_action_delta}::DOUBLE THEN printf('low_movement (delta=%.4f)', {rounded_sql("action_delta", 4)}) END AS reason
           FROM episodes e LEFT JOIN found USING (episode_index)),
scores AS (SELECT *, reason IS NULL AS kept FROM judged)"""


#: Spectral arc length by an explicit Fourier transform, as the table ``smooth``.
SPARC = """speed AS (
  SELECT episode_index, d, frame_index AS t, count(*) OVER (PARTITION BY episode_index, d) AS n,
         50.0::DOUBLE * CASE WHEN lag(s) OVER w IS NULL THEN lead(s) OVER w - s WHEN lead(s) OVER w IS NULL THEN s - lag(s) OVER w ELSE (lead(s) OVER w - lag(s) OVER w)/2 END AS v
  FROM vals WINDOW w AS (PARTITION BY episode_index, d ORDER BY frame_index)),
bins AS (SELECT DISTINCT episode_index, d, n, unnest(range(n//2 + 1)) AS k FROM speed),
spectrum AS (
  SELECT b.episode_index, b.d, b.n, b.k, sqrt(pow(sum(v*cos(2*pi()*b.k*t/b.n)), 2) + pow(sum(v*sin(2*pi()*b.k*t/b.n)), 2)) AS m
  FROM bins b JOIN speed s ON s.episode_index = b.episode_index AND s.d = b.d GROUP BY 1, 2, 3, 4),
normed AS (SELECT *, m/(max(m) OVER (PARTITION BY episode_index, d) + 1e-8) AS q FROM spectrum),
steps AS (SELECT *, q - lag(q) OVER (PARTITION BY episode_index, d ORDER BY k) AS dq, 1.0::DOUBLE/(2*(n//2 + 1)) AS df FROM normed),
smooth AS (SELECT episode_index, avg(arc) AS sparc FROM (SELECT episode_index, d, -sum(sqrt(df*df + dq*dq)) AS arc FROM steps WHERE dq IS NOT NULL GROUP BY 1, 2) GROUP BY 1)"""


def full_scores(gate: Gate) -> str:
    """``scores`` in full mode, all limits set."""
    return f"""{EVENT_FRAMES}, {EPISODES}, {values()}, {DIFFS}, {SPARC},
sat AS (SELECT episode_index, avg(hit) AS saturation FROM (SELECT episode_index, frame_index, max(CASE WHEN abs(a - ns) > {gate.saturation_limit}::DOUBLE THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS hit FROM diffs WHERE ns IS NOT NULL GROUP BY 1, 2) GROUP BY 1),
found AS (SELECT episode_index, {rounded_sql("sum(abs(d1))/count(d1)")} AS action_delta, {rounded_sql("sum(abs(d2))/count(d2)")} AS action_jerk FROM diffs GROUP BY 1),
judged AS (SELECT episode_index, {rounded_sql("sparc")} AS sparc, {rounded_sql("saturation")} AS saturation, action_delta, action_jerk FROM found JOIN sat USING (episode_index) JOIN smooth USING (episode_index)),
scores AS (SELECT *, reason IS NULL AS kept FROM (SELECT *,
  CASE WHEN action_jerk > {gate.max_action_jerk}::DOUBLE THEN printf('jerky_action (jerk=%.4f)', {rounded_sql("action_jerk", 4)})
       WHEN action_delta < {gate.min_action_delta}::DOUBLE THEN printf('low_movement (delta=%.4f)', {rounded_sql("action_delta", 4)})
       WHEN saturation > {gate.saturation_threshold}::DOUBLE THEN printf('saturation (frac=%.2f)', {rounded_sql("saturation", 2)})
       WHEN sparc > {gate.sparc_threshold}::DOUBLE THEN printf('jerky_motion (sparc=%.2f)', {rounded_sql("sparc", 2)}) END AS reason FROM judged))"""
