"""Independent SQL oracle (DuckDB dialect) for every registered query.

The oracle recomputes each intermediate from the raw ``customer`` / ``orders``
views with deliberately different formulations from the Spark plan, so that
agreement means something:

* gap fill with correlated ``arg_max`` / ``arg_min`` lookups (Spark: last/first
  ignoring NULLs over running frames);
* rolling statistics with a self-join on row numbers (Spark: ROWS frames);
* stage-2 runs with the row-number-difference islands trick (Spark: running sum);
* milestones with correlated scalar subqueries, one CTE per link (Spark:
  chained whole-loan windows);
* branch membership with NOT EXISTS (Spark: per-loan aggregate + left join);
* month differences with DuckDB's ``date_diff('month', ..)`` (Spark: year/month
  arithmetic).
"""

from __future__ import annotations

# The fixtures' 40 paths and their codes are inputs, not results, so they are shared.
from stagecraft.sources.fixtures import ARCH_CODES, ARCHETYPES

# Fixed values of the job and of the fixtures, written out here so that a wrong one in the
# library shows.
POOLS = "2, 3, 4, 6, 7"
NATURAL_MIN_FACTOR_DATE, NATURAL_BASE_DATE, NATURAL_CURE_MONTHS = "1995-01-31", "1995-01-15", 12
ARCH_MIN_FACTOR_DATE, ARCH_COB_DATE, ARCH_PREVIOUS_SNAPSHOT, ARCH_CURE_MONTHS = "2017-04-30", "2019-03-31", "2019-02-28", 12
RUN_TS = "TIMESTAMP '2024-01-31 12:00:00'"

NATURAL_FIXTURE = f"""
p AS (
  SELECT DATE '{NATURAL_MIN_FACTOR_DATE}' AS min_d,
         last_day(max(o_orderdate)) AS seg_d,
         last_day(last_day(max(o_orderdate)) - INTERVAL 1 MONTH) AS rep_d,
         {NATURAL_CURE_MONTHS} AS x
  FROM orders
),
seg AS (
  SELECT 'D' || CAST(c_custkey AS VARCHAR) AS deal_tfi_id,
         p.seg_d AS reporting_date,
         CAST(DATE '{NATURAL_BASE_DATE}' + to_months(CAST(c_custkey % 24 AS INTEGER)) AS DATE) AS value_date,
         1 AS segment_pool_id,
         CASE WHEN c_custkey % 3 = 0 THEN NULL
              ELSE CAST(DATE '{NATURAL_BASE_DATE}' + to_months(CAST(20 + (c_custkey * 7) % 56 AS INTEGER)) AS DATE)
         END AS restructure_start_date
  FROM customer CROSS JOIN p
),
dpd AS (
  SELECT deal_id, factor_date,
         max(CASE WHEN b <= 5 THEN 0 WHEN b = 6 THEN 20 WHEN b IN (7, 8) THEN 60 WHEN b = 9 THEN 120 END)
           AS factor_value
  FROM (SELECT 'D' || CAST(o_custkey AS VARCHAR) AS deal_id,
               last_day(CAST(o_orderdate AS DATE)) AS factor_date,
               CAST(floor(o_totalprice) AS BIGINT) % 10 AS b
        FROM orders) o
  GROUP BY deal_id, factor_date
)"""


def _arch_values() -> str:
    rows = []
    for i, (_name, path, vd, rsd) in enumerate(ARCHETYPES):
        rsd_sql = f"DATE '{rsd}'" if rsd else "CAST(NULL AS DATE)"
        rows.append(f"({i}, '{path}', DATE '{vd}', {rsd_sql})")
    return ",\n    ".join(rows)


def _arch_code_case() -> str:
    whens = " ".join(f"WHEN '{k}' THEN {v}" for k, v in ARCH_CODES.items())
    return f"CASE substr(a.path, CAST(t.m + 1 AS INTEGER), 1) {whens} END"


ARCHETYPE_FIXTURE = f"""
p AS (
  SELECT DATE '{ARCH_MIN_FACTOR_DATE}' AS min_d, DATE '{ARCH_COB_DATE}' AS seg_d,
         last_day(DATE '{ARCH_COB_DATE}' - INTERVAL 1 MONTH) AS rep_d, {ARCH_CURE_MONTHS} AS x
),
arch(arch_idx, path, value_date, restructure_start_date) AS (
  VALUES
    {_arch_values()}
),
arch_loans AS (
  SELECT c.c_custkey, a.* FROM customer c JOIN arch a ON c.c_custkey % {len(ARCHETYPES)} = a.arch_idx
),
seg AS (
  SELECT 'D' || CAST(a.c_custkey AS VARCHAR) AS deal_tfi_id,
         s.reporting_date,
         a.value_date,
         CASE a.c_custkey % 41 WHEN 40 THEN 2 WHEN 39 THEN NULL WHEN 26 THEN 3 WHEN 17 THEN 4 WHEN 9 THEN 6
              WHEN 30 THEN 7 WHEN 3 THEN 5 ELSE 1 END AS segment_pool_id,
         a.restructure_start_date
  FROM arch_loans a
  CROSS JOIN (VALUES (DATE '{ARCH_PREVIOUS_SNAPSHOT}'), (DATE '{ARCH_COB_DATE}')) s(reporting_date)
),
dpd AS (
  SELECT 'D' || CAST(a.c_custkey AS VARCHAR) AS deal_id,
         last_day(DATE '{ARCH_MIN_FACTOR_DATE}' + to_months(CAST(t.m AS INTEGER))) AS factor_date,
         CAST(CASE WHEN t.m = -1 THEN 120 WHEN t.m = 23 THEN 45 ELSE {_arch_code_case()} END AS INTEGER)
           AS factor_value
  FROM arch_loans a CROSS JOIN generate_series(-1, 23) t(m)
  WHERE t.m < 0 OR t.m > 22 OR substr(a.path, CAST(t.m + 1 AS INTEGER), 1) <> '.'
  UNION ALL
  SELECT CASE WHEN u.named THEN 'X' || CAST(c_custkey AS VARCHAR) END, DATE '{ARCH_MIN_FACTOR_DATE}', v.value
  FROM customer CROSS JOIN (VALUES (true), (false)) u(named) CROSS JOIN (VALUES (60), (120)) v(value)
  WHERE c_custkey % 50 = 0
)"""

# The natural fixture with fractional values.
FRACTIONAL_FIXTURE = NATURAL_FIXTURE.replace("dpd AS (", "dpd_whole AS (", 1) + """,
dpd AS (
  SELECT deal_id, factor_date,
         CASE factor_value WHEN 0 THEN CASE WHEN dayofyear(factor_date) % 3 = 0 THEN 0.5 ELSE 0.0 END
              WHEN 20 THEN 30.5
              WHEN 60 THEN CASE WHEN dayofyear(factor_date) % 2 = 0 THEN 90.5 ELSE 60.25 END
              ELSE factor_value END::DOUBLE AS factor_value
  FROM dpd_whole
)"""

# The natural fixture after an earlier run: an imputed row counts only where no observed row has its key.
LATE_FIXTURE = NATURAL_FIXTURE.replace("dpd AS (", "dpd_observed AS (", 1) + """,
dpd_imputed AS (
  SELECT deal_id, last_day(CAST(factor_date + INTERVAL 1 DAY AS DATE)) AS factor_date, 60 AS factor_value
  FROM dpd_observed WHERE CAST(substr(deal_id, 2) AS BIGINT) % 2 = 0
),
dpd AS (
  SELECT * FROM dpd_observed
  UNION ALL
  SELECT i.* FROM dpd_imputed i
  WHERE NOT EXISTS (SELECT 1 FROM dpd_observed o WHERE o.deal_id = i.deal_id AND o.factor_date = i.factor_date)
)"""

# The staging job over (p, seg, dpd). Placeholders are filled from the library's
# fixed values below.
_PIPELINE_TEMPLATE = """
pop AS (
  SELECT s.deal_tfi_id AS deal_id, p.rep_d AS reporting_date, s.value_date, s.segment_pool_id,
         CASE WHEN s.restructure_start_date > p.rep_d THEN NULL ELSE s.restructure_start_date END
           AS restructure_start_date
  FROM seg s CROSS JOIN p
  WHERE s.reporting_date = p.seg_d AND s.value_date <= p.rep_d AND s.segment_pool_id NOT IN ({POOLS})
),
obs AS (
  SELECT d.deal_id, d.factor_date, d.factor_value
  FROM dpd d CROSS JOIN p WHERE d.factor_date >= p.min_d AND d.factor_date <= p.rep_d
),
cal AS (SELECT DISTINCT factor_date FROM obs),
starts AS (
  SELECT o.deal_id,
         CASE WHEN p.min_d > pp.value_date THEN p.min_d ELSE pp.value_date END AS min_factor_date
  FROM (SELECT DISTINCT deal_id FROM obs) o
  LEFT JOIN pop pp ON pp.deal_id = o.deal_id
  CROSS JOIN p
),
spine AS (
  SELECT s.deal_id, c.factor_date
  FROM starts s JOIN cal c ON c.factor_date >= s.min_factor_date
),
na AS (
  SELECT sp.deal_id, sp.factor_date, o.factor_value,
         CASE WHEN o.deal_id IS NULL THEN 0 ELSE 1 END AS is_observed
  FROM spine sp LEFT JOIN obs o ON o.deal_id = sp.deal_id AND o.factor_date = sp.factor_date
),
ht AS (
  SELECT n.deal_id, n.factor_date, n.factor_value, n.is_observed,
         (SELECT arg_max(b.factor_value, b.factor_date) FROM na b
           WHERE b.deal_id = n.deal_id AND b.factor_date <= n.factor_date AND b.factor_value IS NOT NULL) AS head,
         (SELECT arg_min(b.factor_value, b.factor_date) FROM na b
           WHERE b.deal_id = n.deal_id AND b.factor_date >= n.factor_date AND b.factor_value IS NOT NULL) AS tail
  FROM na n
),
filled AS (
  SELECT deal_id, factor_date, head, tail, is_observed,
         CASE WHEN factor_value IS NOT NULL THEN factor_value
              WHEN head IS NULL THEN tail
              WHEN head >= coalesce(tail, 0) THEN head
              ELSE tail END AS factor_value
  FROM ht
),
imputed AS (
  SELECT f.deal_id, '{ENTITY}' AS entity, '{FACTOR_TYPE}' AS factor_type, f.factor_date, f.factor_value,
         {RUN_TS} AS last_modified, '{IMPUTE_BY}' AS modified_by
  FROM filled f
  WHERE NOT EXISTS (SELECT 1 FROM dpd d WHERE d.deal_id = f.deal_id AND d.factor_date = f.factor_date)
),
npl AS (
  SELECT u.deal_id, max(u.factor_date) AS npl_date
  FROM (SELECT deal_id, factor_date, factor_value FROM dpd
        UNION ALL
        SELECT deal_id, factor_date, factor_value FROM imputed) u
  CROSS JOIN p
  WHERE u.factor_value > 90 AND u.factor_date >= p.min_d AND u.factor_date <= p.rep_d
  GROUP BY u.deal_id
),
numbered AS (
  SELECT f.*, CAST(row_number() OVER (PARTITION BY deal_id ORDER BY factor_date) AS INTEGER) AS row_no
  FROM filled f
),
rolled AS (
  SELECT a.deal_id, a.factor_date, a.factor_value, a.row_no,
         CAST(sum(b.factor_value) FILTER (WHERE b.row_no > a.row_no - 3) AS {SUM_TYPE}) AS sum_dpd_3m,
         max(b.factor_value) FILTER (WHERE b.row_no > a.row_no - 9) AS max_dpd_9m,
         max(b.factor_value) FILTER (WHERE b.row_no > a.row_no - 12) AS max_dpd_12m,
         CAST(trunc(max(b.factor_value) FILTER (WHERE b.row_no > a.row_no - p.x)) AS INTEGER) AS max_x_nontdrm
  FROM numbered a
  JOIN numbered b ON b.deal_id = a.deal_id AND b.row_no <= a.row_no
  CROSS JOIN p
  WHERE b.row_no > a.row_no - greatest(12, p.x)
  GROUP BY a.deal_id, a.factor_date, a.factor_value, a.row_no, p.x
),
ev AS (
  SELECT r.deal_id, n.npl_date, pp.restructure_start_date, r.factor_date, r.factor_value, r.row_no,
         r.sum_dpd_3m, r.max_dpd_9m, r.max_dpd_12m, r.max_x_nontdrm,
         CASE WHEN r.max_dpd_12m = 0 AND r.row_no >= 12 THEN 1 ELSE 0 END AS dpd_12m_event,
         CASE WHEN r.max_dpd_9m <= 90 AND r.factor_value = 0 AND r.row_no > 8 THEN 1 ELSE 0 END AS dpd_9m_event,
         CASE WHEN r.sum_dpd_3m = 0 AND r.row_no >= 3 THEN 1 ELSE 0 END AS dpd_3m_event,
         CASE WHEN r.factor_value > 30 AND r.factor_value <= 90 THEN 1 ELSE 0 END AS dpd3090_event,
         CASE WHEN r.max_x_nontdrm = 0 AND r.row_no >= p.x THEN 1 ELSE 0 END AS dpd_x_nontdrm_event
  FROM rolled r
  JOIN pop pp ON pp.deal_id = r.deal_id
  LEFT JOIN npl n ON n.deal_id = r.deal_id
  CROSS JOIN p
),
hn AS (
  SELECT DISTINCT deal_id, restructure_start_date AS restructure_date, npl_date
  FROM ev WHERE npl_date IS NOT NULL AND restructure_start_date IS NOT NULL
),
hn_cure AS (
  SELECT h.deal_id, h.restructure_date, h.npl_date,
         (SELECT max(e.factor_date) FROM ev e
           WHERE e.deal_id = h.deal_id AND e.dpd_x_nontdrm_event = 1
             AND date_diff('month', h.npl_date, e.factor_date) >= (SELECT x FROM p)
             AND e.factor_date < h.restructure_date) AS zerobetween_date
  FROM hn h WHERE h.npl_date < h.restructure_date
),
reset AS (
  SELECT h.deal_id, h.restructure_date, c.zerobetween_date,
         CASE WHEN h.npl_date >= h.restructure_date THEN h.npl_date
              WHEN c.zerobetween_date IS NULL THEN last_day(h.restructure_date - INTERVAL 1 MONTH)
              ELSE NULL END AS npl_date
  FROM hn h LEFT JOIN hn_cure c ON c.deal_id = h.deal_id
),
transferred AS (SELECT deal_id FROM reset WHERE npl_date IS NULL),
evf AS (
  SELECT e.deal_id,
         CASE WHEN r.deal_id IS NULL THEN e.npl_date ELSE r.npl_date END AS npl_date,
         e.restructure_start_date, e.factor_date, e.factor_value, e.row_no,
         e.dpd_12m_event, e.dpd_9m_event, e.dpd_3m_event, e.dpd3090_event, e.dpd_x_nontdrm_event
  FROM ev e LEFT JOIN reset r ON r.deal_id = e.deal_id
),
runs_all AS (
  SELECT deal_id, min(factor_date) AS start_date, max(factor_date) AS end_date, count(*) AS streak
  FROM (SELECT deal_id, factor_date, dpd3090_event,
               row_number() OVER (PARTITION BY deal_id ORDER BY factor_date)
               - row_number() OVER (PARTITION BY deal_id, dpd3090_event ORDER BY factor_date) AS island
        FROM evf) t
  WHERE dpd3090_event = 1
  GROUP BY deal_id, island
),
ma1 AS (
  SELECT r.deal_id, r.npl_date, r.restructure_date,
         (SELECT min(e.factor_date) FROM evf e WHERE e.deal_id = r.deal_id AND e.dpd_3m_event = 1
             AND date_diff('month', e.npl_date, e.factor_date) >= 3) AS zero3_start,
         (SELECT max(e.factor_date) FROM evf e WHERE e.deal_id = r.deal_id AND e.dpd_3m_event = 1
             AND date_diff('month', e.npl_date, e.factor_date) >= 3) AS zero3_end
  FROM reset r WHERE r.npl_date IS NOT NULL
),
ma2 AS (
  SELECT m.*,
         (SELECT min(e.factor_date) FROM evf e WHERE e.deal_id = m.deal_id AND e.dpd_9m_event = 1
             AND date_diff('month', m.zero3_start, e.factor_date) >= 9) AS zero9_date
  FROM ma1 m
),
ma3 AS (
  SELECT m.*,
         (SELECT min(e.factor_date) FROM evf e WHERE e.deal_id = m.deal_id AND e.dpd3090_event = 1
             AND e.factor_date > m.zero9_date) AS stage2_first,
         (SELECT max(e.factor_date) FROM evf e WHERE e.deal_id = m.deal_id AND e.dpd3090_event = 1
             AND e.factor_date > m.zero9_date) AS stage2_last
  FROM ma2 m
),
ma4 AS (
  SELECT m.*,
         (SELECT max(e.factor_date) FROM evf e WHERE e.deal_id = m.deal_id AND e.dpd_3m_event = 1
             AND e.factor_date > m.stage2_first AND e.factor_date < m.stage2_last) AS zero_before_last2
  FROM ma3 m
),
ma AS (
  SELECT m.*,
         (SELECT min(e.factor_date) FROM evf e WHERE e.deal_id = m.deal_id AND e.dpd3090_event = 1
             AND e.factor_date > m.zero_before_last2 AND e.factor_date < m.stage2_last) AS stage2_after_zero
  FROM ma4 m
),
ca AS (
  SELECT m.*,
    CASE WHEN zero3_start IS NULL THEN 1 WHEN zero9_date IS NULL THEN 2 WHEN stage2_first IS NULL THEN 3
         WHEN zero3_end > stage2_last THEN 4 WHEN zero3_end < stage2_first THEN 5
         WHEN zero3_end < stage2_last AND zero_before_last2 IS NOT NULL THEN 6 END AS condition_no
  FROM ma m
),
cla AS (
  SELECT c.*,
    CASE condition_no WHEN 1 THEN 'c3' WHEN 2 THEN 'c2' WHEN 3 THEN 'c1' WHEN 4 THEN 'c1'
         WHEN 5 THEN 'c2' WHEN 6 THEN 'c2' END AS prev_status,
    CASE condition_no WHEN 1 THEN 3 WHEN 2 THEN 2 WHEN 3 THEN 1 WHEN 4 THEN 1 WHEN 5 THEN 2 WHEN 6 THEN 2 END
      AS calculated_stage,
    CASE WHEN condition_no IN (1, 2) THEN 'Y' WHEN condition_no IN (3, 4, 5, 6) THEN 'N' END AS stg3_flag,
    CASE WHEN condition_no IN (1, 2) THEN 'c3-c2-c1' WHEN condition_no IN (5, 6) THEN 'c2-c1' END AS path_tdr,
    CAST(CASE condition_no WHEN 1 THEN 0 WHEN 2 THEN date_diff('month', zero3_start, p.rep_d)
         WHEN 3 THEN 0 WHEN 4 THEN 0 WHEN 5 THEN date_diff('month', stage2_first, p.rep_d)
         WHEN 6 THEN date_diff('month', stage2_after_zero, p.rep_d) END AS INTEGER) AS m_stg2,
    CAST(NULL AS INTEGER) AS cure_flag
  FROM ca c CROSS JOIN p
),
bpop AS (
  SELECT pp.deal_id, pp.restructure_start_date
  FROM pop pp
  WHERE pp.restructure_start_date IS NOT NULL
    AND NOT EXISTS (SELECT 1 FROM evf e WHERE e.deal_id = pp.deal_id AND e.npl_date IS NOT NULL)
),
sb0 AS (
  SELECT b.deal_id, b.restructure_start_date,
         CASE WHEN b.restructure_start_date < p.min_d THEN NULL
              WHEN EXISTS (SELECT 1 FROM evf e WHERE e.deal_id = b.deal_id
                             AND e.factor_date = last_day(b.restructure_start_date - INTERVAL 1 MONTH)) THEN 2
              ELSE 1 END AS stage_before_restructure
  FROM bpop b CROSS JOIN p
),
sb AS (
  SELECT s.*,
         CASE WHEN s.stage_before_restructure = 2 THEN
           (SELECT max(r.start_date) FROM runs_all r WHERE r.deal_id = s.deal_id
              AND last_day(s.restructure_start_date - INTERVAL 1 MONTH) BETWEEN r.start_date AND r.end_date)
         END AS last2_before_restructure_date
  FROM sb0 s
),
mb1 AS (
  SELECT s.deal_id, s.restructure_start_date,
         coalesce(s.last2_before_restructure_date,
                  (SELECT min(e.factor_date) FROM evf e WHERE e.deal_id = s.deal_id AND e.dpd3090_event = 1
                     AND e.factor_date >= s.restructure_start_date)) AS stage2_first,
         (SELECT max(e.factor_date) FROM evf e WHERE e.deal_id = s.deal_id AND e.dpd3090_event = 1
            AND e.factor_date >= s.restructure_start_date) AS stage2_last,
         (SELECT min(e.factor_date) FROM evf e WHERE e.deal_id = s.deal_id AND e.dpd_3m_event = 1
            AND e.factor_date >= s.restructure_start_date) AS zero3_first,
         (SELECT max(e.factor_date) FROM evf e WHERE e.deal_id = s.deal_id AND e.dpd_3m_event = 1
            AND e.factor_date >= s.restructure_start_date) AS zero3_last
  FROM sb s
),
mb2 AS (
  SELECT m.*,
         (SELECT max(e.factor_date) FROM evf e WHERE e.deal_id = m.deal_id AND e.dpd_3m_event = 1
            AND e.factor_date < m.stage2_last AND e.factor_date >= m.restructure_start_date) AS zero_before_last2
  FROM mb1 m
),
mb AS (
  SELECT m.*,
         (SELECT min(e.factor_date) FROM evf e WHERE e.deal_id = m.deal_id AND e.dpd3090_event = 1
            AND e.factor_date > m.zero_before_last2 AND e.factor_date < m.stage2_last
            AND e.factor_date >= m.restructure_start_date) AS stage2_after_zero
  FROM mb2 m
),
cb AS (
  SELECT m.*,
    CASE WHEN stage2_first IS NULL THEN 7 WHEN zero3_last IS NULL THEN 8 WHEN zero3_last > stage2_last THEN 9
         WHEN zero3_last < stage2_last AND zero_before_last2 IS NULL THEN 10
         WHEN zero3_last < stage2_last AND stage2_after_zero IS NULL THEN 11
         WHEN zero3_last < stage2_last THEN 12 END AS condition_no
  FROM mb m
),
clb AS (
  SELECT c.*,
    CASE WHEN condition_no IN (8, 10, 11, 12) THEN 'c2' ELSE 'c1' END AS prev_status,
    CASE WHEN condition_no IN (8, 10, 11, 12) THEN 2 ELSE 1 END AS calculated_stage,
    'N' AS stg3_flag,
    CASE WHEN condition_no IN (7, 9) THEN NULL ELSE 'c2-c1' END AS path_tdr,
    CAST(CASE WHEN condition_no = 8 THEN date_diff('month', stage2_first, p.rep_d)
              WHEN condition_no IN (10, 11) THEN date_diff('month', stage2_last, p.rep_d)
              WHEN condition_no = 12 THEN date_diff('month', stage2_after_zero, p.rep_d)
              ELSE 0 END AS INTEGER) AS m_stg2,
    CASE WHEN c.deal_id IN (SELECT deal_id FROM transferred) THEN 1 END AS cure_flag
  FROM cb c CROSS JOIN p
),
cpop AS (
  SELECT pp.deal_id, e.npl_date, e.factor_value AS dpd_t
  FROM pop pp CROSS JOIN p
  JOIN evf e ON e.deal_id = pp.deal_id AND e.factor_date = p.rep_d
  WHERE pp.restructure_start_date IS NULL
),
clc AS (
  SELECT c.*,
         (SELECT max(e.factor_date) FROM evf e WHERE e.deal_id = c.deal_id AND e.dpd_x_nontdrm_event = 1
            AND date_diff('month', c.npl_date, e.factor_date) >= (SELECT x FROM p)) AS last_cure_date
  FROM cpop c
),
cc AS (
  SELECT c.*,
    CASE WHEN npl_date IS NULL AND dpd_t <= 30 THEN 12
         WHEN npl_date IS NULL AND dpd_t > 30 AND dpd_t <= 90 THEN 13
         WHEN npl_date IS NULL AND dpd_t > 90 THEN 14
         WHEN npl_date IS NOT NULL AND last_cure_date IS NULL THEN 15
         WHEN last_cure_date IS NOT NULL AND dpd_t <= 30 THEN 16
         WHEN last_cure_date IS NOT NULL AND dpd_t > 30 AND dpd_t <= 90 THEN 17
         WHEN last_cure_date IS NOT NULL AND dpd_t > 90 THEN 18 END AS condition_no,
    (SELECT max(r.streak) FROM runs_all r, p WHERE r.deal_id = c.deal_id AND r.end_date = p.rep_d) AS streak
  FROM clc c
),
clc_out AS (
  SELECT c.deal_id, c.npl_date, c.dpd_t, c.last_cure_date, c.condition_no,
    CAST(NULL AS VARCHAR) AS prev_status,
    CASE WHEN condition_no IN (13, 17) THEN 2 WHEN condition_no IN (14, 15, 18) THEN 3 ELSE 1 END
      AS calculated_stage,
    CASE WHEN condition_no IN (14, 15, 18) THEN 'Y' ELSE 'N' END AS stg3_flag,
    CAST(NULL AS VARCHAR) AS path_tdr,
    CAST(CASE WHEN condition_no IN (13, 17) THEN c.streak - 1 ELSE 0 END AS INTEGER) AS m_stg2,
    CASE WHEN condition_no IN (16, 17, 18) THEN 1 END AS cure_flag
  FROM cc c
),
published AS (
  SELECT deal_id, prev_status, stg3_flag, path_tdr,
         CAST(CASE WHEN calculated_stage = 2 THEN m_stg2 + 1 ELSE 0 END AS INTEGER) AS m_stg2,
         CAST(cure_flag AS INTEGER) AS cure_flag, {RUN_TS} AS last_modified, '{RESULT_BY}' AS modified_by
  FROM (SELECT deal_id, prev_status, stg3_flag, path_tdr, m_stg2, calculated_stage, cure_flag FROM cla
        UNION ALL
        SELECT deal_id, prev_status, stg3_flag, path_tdr, m_stg2, calculated_stage, cure_flag FROM clb
        UNION ALL
        SELECT deal_id, prev_status, stg3_flag, path_tdr, m_stg2, calculated_stage, cure_flag FROM clc_out) u
)"""


def _fill(template: str, sum_type: str) -> str:
    values = {
        "{POOLS}": POOLS,
        "{ENTITY}": "ENTITY",
        "{FACTOR_TYPE}": "DPD",
        "{IMPUTE_BY}": "stage_status(impute)",
        "{RESULT_BY}": "stage_status",
        "{RUN_TS}": RUN_TS,
        "{SUM_TYPE}": sum_type,
    }
    for key, value in values.items():
        template = template.replace(key, value)
    return template


PIPELINE = _fill(_PIPELINE_TEMPLATE, "BIGINT")
FRACTIONAL_PIPELINE = _fill(_PIPELINE_TEMPLATE, "DOUBLE")

OUTCOME = "CAST(condition_no AS INTEGER) AS condition_no, prev_status, CAST(calculated_stage AS INTEGER) AS calculated_stage, stg3_flag, path_tdr, m_stg2, CAST(cure_flag AS INTEGER) AS cure_flag"
A_COLS = "deal_id, npl_date, restructure_date, zero3_start, zero3_end, zero9_date, stage2_first, stage2_last, zero_before_last2, stage2_after_zero"
B_COLS = "deal_id, restructure_start_date, stage2_first, stage2_last, zero3_first, zero3_last, zero_before_last2, stage2_after_zero"

FINAL = {
    "param_dates": "SELECT min_d AS min_factor_date, seg_d AS segmentation_date, rep_d AS reporting_date, "
    "CAST(x AS INTEGER) AS x_nontdr FROM p",
    "src_population": "SELECT s.deal_tfi_id, s.reporting_date, s.value_date, CAST(s.segment_pool_id AS INTEGER) "
    "AS segment_pool_id, s.restructure_start_date FROM seg s CROSS JOIN p WHERE s.reporting_date = p.seg_d "
    f"AND s.value_date <= p.rep_d AND s.segment_pool_id NOT IN ({POOLS})",
    "src_dpd_window": "SELECT deal_id, factor_date, CAST(factor_value AS INTEGER) AS factor_value FROM obs",
    "population_normalised": "SELECT deal_id, reporting_date, value_date, CAST(segment_pool_id AS INTEGER) AS "
    "segment_pool_id, restructure_start_date FROM pop",
    "spine_dates": "SELECT factor_date FROM cal",
    "spine_start": "SELECT deal_id, min_factor_date FROM starts",
    "spine": "SELECT deal_id, factor_date FROM spine",
    "spine_filled_na": "SELECT deal_id, factor_date, factor_value, is_observed FROM na",
    "fill_groups": "SELECT deal_id, factor_date, factor_value, "
    "count(factor_value) OVER (PARTITION BY deal_id ORDER BY factor_date) AS head_group, "
    "count(factor_value) OVER (PARTITION BY deal_id ORDER BY factor_date DESC) AS tail_group FROM na",
    "fill_head_tail": "SELECT deal_id, factor_date, factor_value, head, tail FROM ht",
    "fill_value": "SELECT deal_id, factor_date, head, tail, factor_value FROM filled",
    "impute_writeback": "SELECT deal_id, entity, factor_type, factor_date, factor_value, last_modified, modified_by FROM imputed",
    "roll_max_x": "SELECT deal_id, factor_date, row_no, max_x_nontdrm FROM rolled",
    "event_base": "SELECT deal_id, npl_date, restructure_start_date, factor_date, factor_value, row_no, "
    "sum_dpd_3m, max_dpd_9m, max_dpd_12m, max_x_nontdrm FROM ev",
    "event_flags": "SELECT deal_id, npl_date, restructure_start_date, factor_date, factor_value, row_no, "
    "sum_dpd_3m, max_dpd_9m, max_dpd_12m, max_x_nontdrm, dpd_12m_event, dpd_9m_event, dpd_3m_event, "
    "dpd3090_event, dpd_x_nontdrm_event FROM ev",
    "last_npl_date": "SELECT deal_id, npl_date FROM npl",
    "cured_before_tdr": "SELECT deal_id, restructure_date, npl_date, zerobetween_date FROM hn_cure "
    "WHERE zerobetween_date IS NOT NULL",
    "npl_date_reset": "SELECT deal_id, restructure_date, zerobetween_date, npl_date FROM reset",
    "npl_date_rewritten": "SELECT deal_id, npl_date, restructure_start_date, factor_date, factor_value, "
    "dpd_12m_event, dpd_9m_event, dpd_3m_event, dpd3090_event, dpd_x_nontdrm_event FROM evf",
    "milestones_a": f"SELECT {A_COLS} FROM ma",
    "classify_a": f"SELECT {A_COLS}, {OUTCOME} FROM cla",
    "stage2_runs": "SELECT deal_id, start_date, end_date, streak FROM runs_all",
    "current_streak": "SELECT r.deal_id, r.start_date, r.end_date, r.streak FROM runs_all r CROSS JOIN p "
    "WHERE r.end_date = p.rep_d",
    "tdr_no_npl": "SELECT deal_id, restructure_start_date FROM bpop",
    "stage_before_tdr": "SELECT deal_id, restructure_start_date, CAST(stage_before_restructure AS INTEGER) AS "
    "stage_before_restructure, last2_before_restructure_date FROM sb",
    "milestones_b": f"SELECT {B_COLS} FROM mb",
    "classify_b": f"SELECT {B_COLS}, {OUTCOME} FROM clb",
    "cure_flag_b": "SELECT deal_id, CAST(cure_flag AS INTEGER) AS cure_flag FROM clb",
    "nontdr_population": "SELECT deal_id, npl_date, dpd_t FROM cpop",
    "last_cure_date": "SELECT deal_id, npl_date, dpd_t, last_cure_date FROM clc",
    "classify_c": f"SELECT deal_id, npl_date, dpd_t, last_cure_date, {OUTCOME} FROM clc_out",
    "publish_stage_status": "SELECT deal_id, prev_status, stg3_flag, path_tdr, m_stg2, cure_flag, last_modified, modified_by "
    "FROM published",
    "scalar_dates": "SELECT deal_id, last_day(restructure_start_date - INTERVAL 1 MONTH) AS "
    "restructure_prev_month_end, CAST(date_diff('month', value_date, reporting_date) AS INTEGER) AS "
    "months_on_book, CAST(date_diff('month', restructure_start_date, reporting_date) AS INTEGER) AS "
    "months_since_restructure FROM pop",
}

RUN_COUNTS = """
SELECT (SELECT count(*) FROM obs WHERE deal_id IS NULL) AS rows_without_id,{more}
  (SELECT count(*) FROM obs o WHERE deal_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM spine s WHERE s.deal_id = o.deal_id)) AS unmatched_rows,
  (SELECT count(DISTINCT deal_id) FROM obs o WHERE NOT EXISTS (SELECT 1 FROM spine s WHERE s.deal_id = o.deal_id)) AS unmatched_loans,
  (SELECT count(*) FROM na n JOIN filled f USING (deal_id, factor_date)
    WHERE n.is_observed = 1 AND n.factor_value IS NULL AND f.factor_value IS NOT NULL) AS filled_rows,
  (SELECT count(*) FROM pop) AS loans,
  (SELECT count(*) FROM pop WHERE restructure_start_date IS NULL AND deal_id NOT IN (SELECT deal_id FROM cpop)) AS loans_without_rep_row"""
FINAL |= {
    "append_missing": FINAL["impute_writeback"] + " WHERE month(factor_date) % 2 = 1",
    "event_after_restructure": "SELECT deal_id, value_date, restructure_start_date, "
    "(SELECT min(factor_date) FROM obs o WHERE o.deal_id = pop.deal_id AND factor_value > 30 "
    "AND factor_date > restructure_start_date) AS first_late, "
    "(SELECT max(factor_date) FROM obs o WHERE o.deal_id = pop.deal_id AND factor_value > 30 "
    "AND date_diff('month', value_date, factor_date) >= 3) AS last_late, "
    "(SELECT min(factor_date) FROM obs o WHERE o.deal_id = pop.deal_id AND factor_value > 30 "
    "AND factor_date >= value_date) AS first_from_origination FROM pop",
    "observations_in_runs": "SELECT o.deal_id, o.factor_date, o.factor_value, r.start_date, r.end_date, r.streak "
    "FROM obs o LEFT JOIN runs_all r ON r.deal_id = o.deal_id AND o.factor_date BETWEEN r.start_date AND r.end_date "
    "WHERE o.deal_id IS NOT NULL",
    "run_counts": RUN_COUNTS.replace("{more}", ""),
}
SUPERSEDED = """
  (SELECT count(*) FROM dpd_imputed i CROSS JOIN p WHERE i.factor_date BETWEEN p.min_d AND p.rep_d
    AND EXISTS (SELECT 1 FROM dpd_observed o WHERE o.deal_id = i.deal_id AND o.factor_date = i.factor_date)) AS superseded_rows,"""


def _query(fixture: str, final: str, pipeline: str = PIPELINE) -> str:
    return f"WITH {fixture},{pipeline}\n{final}"


def oracle_sql() -> dict[str, str]:
    out = {k: _query(NATURAL_FIXTURE, v) for k, v in FINAL.items()}
    out.update({f"{k}_arch": _query(ARCHETYPE_FIXTURE, v) for k, v in FINAL.items() if k != "param_dates"})
    for k in ("event_flags", "last_npl_date", "publish_stage_status"):
        out[f"{k}_dec"] = _query(FRACTIONAL_FIXTURE, FINAL[k], FRACTIONAL_PIPELINE)
    for k in ("spine_filled_na", "impute_writeback", "last_npl_date", "stage2_runs", "publish_stage_status"):
        out[f"{k}_late"] = _query(LATE_FIXTURE, FINAL[k])
    out["run_counts_late"] = _query(LATE_FIXTURE, RUN_COUNTS.replace("{more}", SUPERSEDED))
    return out
