"""SQL twins of the catalogue queries, for an independent engine."""

from __future__ import annotations

import hashlib

from churnspark.contracts import VARIANTS
from churnspark.functions import playbook
from churnspark.functions.columns import HIGH, LOW, MID
from churnspark.operators import segments
from churnspark.plans import catalog as Q
from churnspark.plans import model_checks, round_trips, serving_checks
from churnspark.plans.workspace import CENTRES, RARE_MIN, ROLES

SEG = list(ROLES.segment_features)

# ---- shared table expressions -----------------------------------------------------

SNAP = """snap AS (
  WITH li AS (
    SELECT l_orderkey, sum(CAST(l_quantity AS DECIMAL(18,2))) AS qty,
           sum(CASE WHEN l_discount >= 0.08::DOUBLE THEN CAST(l_quantity AS DECIMAL(18,2)) END) AS over_qty,
           count(*) FILTER (WHERE l_returnflag = 'R') AS returned
    FROM lineitem GROUP BY l_orderkey),
  o AS (
    SELECT o_custkey, o_orderstatus, o_orderpriority, CAST(o_totalprice AS DECIMAL(18,2)) AS price,
           CAST(o_orderdate AS DATE) AS d, qty, over_qty, returned
    FROM orders LEFT JOIN li ON o_orderkey = l_orderkey),
  act AS (
    SELECT o_custkey,
      count(*) FILTER (WHERE d < DATE '2001-01-01') AS n_history,
      count(*) FILTER (WHERE d >= DATE '2001-01-01') AS n_after,
      CAST(sum(price) FILTER (WHERE d >= DATE '2000-07-05' AND d < DATE '2001-01-01') AS DOUBLE) AS rev_recent,
      CAST(sum(price) FILTER (WHERE d >= DATE '2000-01-07' AND d < DATE '2000-07-05') AS DOUBLE) AS rev_prior,
      CAST(sum(price) FILTER (WHERE d < DATE '2001-01-01') AS DOUBLE) AS rev_all,
      CAST(sum(qty) FILTER (WHERE d >= DATE '2000-07-05' AND d < DATE '2001-01-01') AS DOUBLE) AS qty_recent,
      CAST(sum(qty) FILTER (WHERE d >= DATE '2000-01-07' AND d < DATE '2000-07-05') AS DOUBLE) AS qty_prior,
      CAST(sum(qty) FILTER (WHERE d < DATE '2001-01-01') AS DOUBLE) AS qty_all,
      CAST(sum(over_qty) FILTER (WHERE d < DATE '2001-01-01') AS DOUBLE) AS qty_over,
      CAST(sum(returned) FILTER (WHERE d < DATE '2001-01-01') AS DOUBLE) AS returned,
      count(*) FILTER (WHERE d < DATE '2001-01-01' AND o_orderstatus = 'P') AS care,
      count(*) FILTER (WHERE d < DATE '2001-01-01' AND d >= DATE '2000-01-07') AS active,
      min(d) FILTER (WHERE d < DATE '2001-01-01') AS first_day,
      max(d) FILTER (WHERE d < DATE '2001-01-01') AS last_day,
      count(*) FILTER (WHERE d >= DATE '2000-10-03' AND d < DATE '2001-01-01'
                         AND o_orderpriority = '1-URGENT') AS urgent,
      count(*) FILTER (WHERE d >= DATE '2000-10-03' AND d < DATE '2001-01-01'
                         AND o_orderpriority = '1-URGENT' AND o_orderstatus = 'F') AS urgent_done
    FROM o GROUP BY o_custkey)
  SELECT c_custkey AS customer_id,
    CASE WHEN n_after = 0 THEN 'Yes' ELSE 'No' END AS churn,
    round(rev_recent / 6, 4) AS monthly_revenue,
    round((rev_recent - rev_prior) / nullif(rev_prior, 0), 6) AS perc_change_revenues,
    coalesce(qty_all, 0) AS monthly_minutes,
    coalesce(qty_over, 0) AS overage_minutes,
    rev_all / n_history AS total_recurring_charge,
    round((qty_recent - qty_prior) / nullif(qty_prior, 0), 6) AS perc_change_minutes,
    coalesce(returned, 0) AS dropped_blocked_calls,
    CAST(care AS DOUBLE) AS customer_care_calls,
    CAST(active AS DOUBLE) AS active_subs,
    CAST(floor(date_diff('day', first_day, DATE '2001-01-01') / 30.0) AS DOUBLE) AS months_in_service,
    CAST(date_diff('day', last_day, DATE '2001-01-01') AS DOUBLE) AS current_equipment_days,
    CAST(CASE WHEN c_custkey % 53 = 0 THEN NULL WHEN c_nationkey % 3 = 0 THEN 0
         ELSE 20 + c_custkey % 50 END AS DOUBLE) AS age_hh1,
    CAST(CASE WHEN c_custkey % 53 = 0 THEN NULL WHEN c_nationkey % 2 = 0 THEN 0
         ELSE 18 + c_custkey % 60 END AS DOUBLE) AS age_hh2,
    CASE WHEN c_custkey % 97 <> 0 THEN lpad(CAST(c_nationkey AS VARCHAR), 3, '0')
         || upper(substr(c_mktsegment, 1, 3))
         || lpad(CAST(c_custkey % 1000 AS VARCHAR), 3, '0') END AS service_area,
    CASE WHEN c_acctbal < 0 THEN 'Unknown'
         ELSE CAST(CAST(floor(c_acctbal / 100) * 10 AS BIGINT) AS VARCHAR) END AS handset_price,
    CASE WHEN c_acctbal < 0 THEN '7-Lowest' WHEN c_acctbal < 1500 THEN '6-VeryLow'
         WHEN c_acctbal < 3000 THEN '5-Low' WHEN c_acctbal < 4500 THEN '4-Medium'
         WHEN c_acctbal < 6000 THEN '3-Good' WHEN c_acctbal < 8000 THEN '2-High'
         ELSE '1-Highest' END AS credit_rating,
    CASE c_custkey % 3 WHEN 0 THEN 'Yes' WHEN 1 THEN 'No' ELSE 'Unknown' END AS marital_status,
    CASE WHEN c_custkey % 7 = 0 THEN 'No' ELSE 'Yes' END AS handset_web_capable,
    CAST(urgent AS DOUBLE) AS retention_calls,
    CAST(urgent_done AS DOUBLE) AS retention_offers_accepted,
    CASE WHEN urgent > 0 THEN 'Yes' ELSE 'No' END AS made_call_to_retention_team
  FROM act JOIN customer ON o_custkey = c_custkey WHERE n_history > 0)"""

LAB = f"{SNAP}, lab AS (SELECT *, CAST(churn = 'Yes' AS INTEGER) AS y FROM snap)"

SPLIT = f"""{LAB}, cls AS (SELECT y, count(*) AS c FROM lab GROUP BY y),
tot AS (SELECT CAST(sum(c) AS BIGINT) AS n,
               CAST(ceil(0.2::DOUBLE * sum(c)) AS BIGINT) AS n_test FROM cls),
t1 AS (SELECT y, c, n, n_test, n_test * c // n AS base,
              row_number() OVER (ORDER BY (n_test * c) % n DESC, y) AS rk FROM cls, tot),
t2 AS (SELECT y, c, n, n_test, base + CAST(rk <= n_test - (SELECT sum(base) FROM t1) AS BIGINT) AS t FROM t1),
v0 AS (SELECT *, c - t AS rest, n - n_test AS n_rest,
              CAST(ceil(0.25::DOUBLE * (n - n_test)) AS BIGINT) AS n_val FROM t2),
v1 AS (SELECT *, n_val * rest // n_rest AS vbase,
              row_number() OVER (ORDER BY (n_val * rest) % n_rest DESC, y) AS vrk FROM v0),
v2 AS (SELECT y, t, vbase + CAST(vrk <= n_val - (SELECT sum(vbase) FROM v1) AS BIGINT) AS v FROM v1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY y ORDER BY md5('42:' || CAST(customer_id AS VARCHAR))) AS r FROM lab),
spl AS (SELECT ranked.*, CASE WHEN r <= t THEN 'test' WHEN r <= t + v THEN 'val' ELSE 'train' END AS split
        FROM ranked JOIN v2 USING (y)),
train AS (SELECT * FROM spl WHERE split = 'train')"""

_EQUIPMENT = ("(-0.4::DOUBLE + 0.004::DOUBLE * (current_equipment_days - 240)"
              " - 0.02::DOUBLE * (months_in_service - 64)"
              " + 0.1::DOUBLE * (customer_care_calls - 3))")
_USAGE = ("(-0.3::DOUBLE - 0.001::DOUBLE * (monthly_minutes - 930)"
          " + 0.002::DOUBLE * (overage_minutes - 230))")
_EXTRA = "0.5::DOUBLE * retention_calls"


def _p(x: str) -> str:
    return f"round(1 / (1 + exp(-({x}))), 6)"


SCORE = f"{LAB}, sc AS (SELECT customer_id, y, {_p(_EQUIPMENT)} AS p FROM lab)"
SCORES = f"""{LAB}, sc AS (
  SELECT customer_id, y, 'with_retention' AS feature_set, 'equipment_formula' AS model, {_p(_EQUIPMENT + ' + ' + _EXTRA)} AS p FROM lab
  UNION ALL SELECT customer_id, y, 'with_retention', 'usage_formula', {_p(_USAGE + ' + ' + _EXTRA)} FROM lab
  UNION ALL SELECT customer_id, y, 'without_retention', 'equipment_formula', {_p(_EQUIPMENT)} FROM lab
  UNION ALL SELECT customer_id, y, 'without_retention', 'usage_formula', {_p(_USAGE)} FROM lab)"""


def _metrics(groups: str = "", source: str = "sc") -> str:
    """CTEs ending in ``met``: one metric row per group of a score table."""
    g = f"{groups}, " if groups else ""
    part = f"PARTITION BY {groups} " if groups else ""
    by = f"GROUP BY {groups}" if groups else ""
    return f"""d0 AS (SELECT {g}p, count(*) AS n, sum(y) AS pos FROM {source} GROUP BY {g}p),
d1 AS (SELECT *, sum(n) OVER ({part}ORDER BY p DESC) AS cn, sum(pos) OVER ({part}ORDER BY p DESC) AS cp,
              sum(n) OVER ({part.strip()}) AS tn_, sum(pos) OVER ({part.strip()}) AS tp_ FROM d0),
m0 AS (SELECT {g}
   sum(CAST(n - pos AS DOUBLE) * (cp - pos + pos / 2.0)) / first(CAST(tp_ AS DOUBLE) * (tn_ - tp_)) AS roc_auc,
   sum(CAST(pos AS DOUBLE) / tp_ * cp / cn) AS pr_auc,
   CAST(coalesce(sum(n - pos) FILTER (WHERE p < 0.5::DOUBLE), 0) AS BIGINT) AS true_negative,
   CAST(coalesce(sum(n - pos) FILTER (WHERE p >= 0.5::DOUBLE), 0) AS BIGINT) AS false_positive,
   CAST(coalesce(sum(pos) FILTER (WHERE p < 0.5::DOUBLE), 0) AS BIGINT) AS false_negative,
   CAST(coalesce(sum(pos) FILTER (WHERE p >= 0.5::DOUBLE), 0) AS BIGINT) AS true_positive
  FROM d1 {by}),
met AS (SELECT {g}round(roc_auc, 6) AS roc_auc, round(pr_auc, 6) AS pr_auc, {_class_metrics()},
  true_negative, false_positive, false_negative, true_positive FROM m0)"""


def _class_metrics() -> str:
    tn, fp, fn, tp = "true_negative", "false_positive", "false_negative", "true_positive"
    rec = f"coalesce(CAST({tp} AS DOUBLE) / nullif({tp} + {fn}, 0), 0)"
    spec = f"coalesce(CAST({tn} AS DOUBLE) / nullif({tn} + {fp}, 0), 0)"
    return (f"round(CAST({tp} + {tn} AS DOUBLE) / ({tp} + {tn} + {fp} + {fn}), 6) AS accuracy, "
            f"round(({rec} + {spec}) / 2, 6) AS balanced_accuracy, "
            f"round(coalesce(CAST({tp} AS DOUBLE) / nullif({tp} + {fp}, 0), 0), 6) AS precision, "
            f"round({rec}, 6) AS recall, "
            f"round(coalesce(2.0 * {tp} / nullif(2 * {tp} + {fp} + {fn}, 0), 0), 6) AS f1")


def _cols(items, sep=", ") -> str:
    return sep.join(items)


def _per_column(template: str, columns, source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {template.format(c=c)} FROM {source}" for c in columns)


def _segment_cte() -> str:
    fill = _cols(f"coalesce({c}, (SELECT quantile_cont({c}, 0.5) FROM snap)) AS {c}" for c in SEG)
    clip = _cols(f"least(greatest({c}, (SELECT quantile_cont({c}, 0.01) FROM filled)),"
                 f" (SELECT quantile_cont({c}, 0.99) FROM filled)) AS {c}" for c in SEG)
    scale = _cols(f"({c} - (SELECT avg({c}) FROM clipped))"
                  f" / (SELECT stddev_pop({c}) FROM clipped) AS z_{c}" for c in SEG)
    dists = _cols(
        "(" + " + ".join(f"(z_{c} - ({float(v)!r})) * (z_{c} - ({float(v)!r}))"
                         for c, v in zip(SEG, centre)) + f") AS d{i}"
        for i, centre in enumerate(CENTRES))
    k = len(CENTRES)
    least = "least(" + _cols(f"d{i}" for i in range(k)) + ")"
    case = "CASE " + " ".join(f"WHEN d{i} = {least} THEN {i}" for i in range(k)) + " END"
    return f"""{SNAP}, filled AS (SELECT customer_id, {fill} FROM snap),
clipped AS (SELECT customer_id, {clip} FROM filled),
scaled AS (SELECT customer_id, {scale} FROM clipped),
dist AS (SELECT *, {dists} FROM scaled),
seg AS (SELECT snap.*, CAST({case} AS INTEGER) AS "Cluster" FROM dist JOIN snap USING (customer_id)),
segz AS (SELECT dist.*, CAST({case} AS INTEGER) AS "Cluster" FROM dist)"""


SEGMENTED = _segment_cte()

_INDEX = _cols(f"avg({c}) / (SELECT avg({c}) FROM seg) * 100 AS {c}" for c in SEG)
NAMED = f"""{SEGMENTED}, idx AS (SELECT "Cluster", {_INDEX} FROM seg GROUP BY "Cluster"),
n1 AS (SELECT "Cluster" FROM idx ORDER BY monthly_revenue DESC, "Cluster" LIMIT 1),
n2 AS (SELECT "Cluster" FROM idx WHERE "Cluster" NOT IN (SELECT * FROM n1)
       ORDER BY customer_care_calls DESC, "Cluster" LIMIT 1),
n3 AS (SELECT "Cluster" FROM idx WHERE "Cluster" NOT IN (SELECT * FROM n1 UNION SELECT * FROM n2)
       ORDER BY active_subs DESC, "Cluster" LIMIT 1),
n4 AS (SELECT "Cluster" FROM idx WHERE "Cluster" NOT IN
         (SELECT * FROM n1 UNION SELECT * FROM n2 UNION SELECT * FROM n3)
       ORDER BY months_in_service DESC, "Cluster" LIMIT 1),
n5 AS (SELECT "Cluster" FROM idx WHERE "Cluster" NOT IN
         (SELECT * FROM n1 UNION SELECT * FROM n2 UNION SELECT * FROM n3 UNION SELECT * FROM n4)
       ORDER BY "Cluster" LIMIT 1),
names AS (SELECT "Cluster", '{segments.PREMIUM}' AS "ClusterName" FROM n1
  UNION ALL SELECT "Cluster", '{segments.HIGH_MAINTENANCE}' FROM n2
  UNION ALL SELECT "Cluster", '{segments.MULTI_LINE}' FROM n3
  UNION ALL SELECT "Cluster", '{segments.LOYAL}' FROM n4
  UNION ALL SELECT "Cluster", '{segments.REGULAR}' FROM n5)"""

_GRADE = (f"CASE WHEN p >= 0.7::DOUBLE THEN '{HIGH}' WHEN p >= 0.4::DOUBLE THEN '{MID}' "
          f"ELSE '{LOW}' END")
_BAND = (f"CASE WHEN p <= 0.4::DOUBLE THEN '{LOW}' WHEN p <= 0.7::DOUBLE THEN '{MID}' "
         f"ELSE '{HIGH}' END")
_REGION = "coalesce(substr(service_area, 1, 3), 'Unknown')"
_RARE = f"""rare AS (SELECT {_REGION} AS service_area_region, count(*) AS n FROM train
  GROUP BY 1 HAVING count(*) < {RARE_MIN})"""
_GROUPED = (f"CASE WHEN {_REGION} IN (SELECT service_area_region FROM rare) THEN 'Other' "
            f"ELSE {_REGION} END")
_cells = " || ".join(
    f"CASE WHEN {c} IS NULL THEN '-' ELSE length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR) END"
    for c in ("customer_id", "churn", "service_area", "handset_price", "credit_rating",
              "marital_status"))
_slices = ", ".join(f"CAST(sum(CAST('0x' || substr(h, {at}, 16) AS HUGEINT)) AS VARCHAR)"
                    for at in (1, 17, 33, 49))
_CLASSES = "('train'), ('val'), ('test')"


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _steps_values(table) -> str:
    return ", ".join(
        f"({_text(name)}, {i}, {_text(label)}, {_text(title)}, {_text(desc)})"
        for name, steps in table.items() for i, (label, title, desc) in enumerate(steps, 1))


def _segment_playbook() -> str:
    rows = []
    for name, (title, icon, desc, actions) in playbook.SEGMENT_PROFILE.items():
        if name == segments.REGULAR:
            continue
        steps = playbook.SEGMENT_STEPS[name]
        if name == segments.LOYAL:
            steps = [(f"{i}{playbook.STEP_SUFFIX}", a, playbook.STEP_DESCRIPTION)
                     for i, a in enumerate(actions[:playbook.STEPS_SHOWN], 1)]
        rows += [(name, title, icon, desc, i, *s) for i, s in enumerate(steps, 1)]
    rows.append((segments.REGULAR, segments.REGULAR, playbook.DEFAULT_ICON,
                 playbook.DEFAULT_DESCRIPTION, 1, f"1{playbook.STEP_SUFFIX}",
                 playbook.DEFAULT_ACTION, playbook.STEP_DESCRIPTION))
    values = ", ".join("(" + ", ".join(str(v) if isinstance(v, int) else _text(v) for v in r) + ")"
                       for r in rows)
    return f"""WITH {NAMED}, pb("ClusterName", segment_title, segment_icon, segment_description, step, label, title, description)
  AS (VALUES {values})
SELECT customer_id, "ClusterName", segment_title, segment_icon, segment_description,
       CAST(step AS INTEGER) AS step, label, title, description
FROM seg JOIN names USING ("Cluster") JOIN pb USING ("ClusterName")"""


def _rate_ordered() -> str:
    values = ", ".join(f"({i}, '{v}')" for i, v in enumerate(Q.RATE_LEVELS, 1))
    return f"""WITH {LAB}, dim(level_order, level) AS (VALUES {values})
SELECT level, CAST(level_order AS INTEGER) AS level_order, count(y) AS n,
       round(avg(y), 6) AS churn_rate
FROM dim LEFT JOIN lab ON credit_rating = level GROUP BY level, level_order"""


def _standard(expr: str) -> str:
    cols = ("monthly_minutes", "months_in_service", "current_equipment_days")
    return _cols("round(" + expr.format(
        c=c, m=f"(SELECT avg({c}) FROM train)", s=f"(SELECT stddev_pop({c}) FROM train)")
        + f", 6) AS {c}" for c in cols)


def _describe() -> str:
    return "WITH " + SNAP + " " + _per_column(
        "count({c}) AS n, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, "
        "min({c}) AS min, round(quantile_cont({c}, 0.25), 6) AS q25, "
        "round(quantile_cont({c}, 0.5), 6) AS q50, round(quantile_cont({c}, 0.75), 6) AS q75, "
        "max({c}) AS max", Q.NUMERIC, "snap")


def _corr_matrix() -> str:
    names = ["y", *SEG]
    return f"WITH {LAB} " + " UNION ALL ".join(
        f"SELECT '{a}' AS column_a, '{b}' AS column_b, round(corr({a}, {b}), 6) AS correlation FROM lab"
        for a in names for b in names)


def _formula_importance() -> str:
    rows = [f"""SELECT '' AS feature, 0 AS repeat, y, {_p(_EQUIPMENT)} AS p FROM pos"""]
    for r in (1, 2, 3):
        digest = int(hashlib.md5(f"42:{r}".encode()).hexdigest()[:12], 16)
        shift = f"(1 + {digest} % (n - 1))"
        for f in Q.IMPORTANCE:
            swapped = _EQUIPMENT.replace(f, f"d_{f}")
            rows.append(f"SELECT '{f}' AS feature, {r} AS repeat, y, {_p(swapped)} AS p "
                        f"FROM pos JOIN (SELECT pos AS dp, "
                        + _cols(f"{c} AS d_{c}" for c in Q.IMPORTANCE)
                        + f" FROM pos) d ON d.dp = (pos - {shift} + n) % n")
    return f"""WITH {LAB}, pos AS (SELECT *, count(*) OVER () AS n, row_number() OVER (
  ORDER BY substr(md5('42:' || CAST(customer_id AS VARCHAR)), 1, 12), customer_id) - 1 AS pos FROM lab),
sc AS ({' UNION ALL '.join(rows)}), {_metrics("feature, repeat")},
drops AS (SELECT feature, (SELECT roc_auc FROM m0 WHERE repeat = 0) - roc_auc AS gap FROM m0 WHERE repeat > 0)
SELECT feature, round(avg(gap), 6) AS importance_mean, round(stddev_pop(gap), 6) AS importance_std
FROM drops GROUP BY feature"""


def _k_scan(sets: dict[int, list]) -> str:
    """Inertia and silhouette of sets of centres; null centres stand for the mean."""
    parts, z = [], [f"z_{c}" for c in SEG]
    pair = _cols((f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in z), " + ")
    for k, centres in sets.items():
        ds = ["(" + _cols((f"({c} - ({float(v)!r})) * ({c} - ({float(v)!r}))" if v is not None
                           else f"({c} - (SELECT avg({c}) FROM scaled)) ** 2"
                           for c, v in zip(z, centre)), " + ") + ")" for centre in centres]
        least = f"least({_cols(ds)})" if k > 1 else ds[0]
        case = "CASE " + " ".join(f"WHEN {d} = {least} THEN {i}" for i, d in enumerate(ds)) + " END"
        parts.append(f"SELECT {k} AS k, customer_id, {_cols(z)}, {case} AS c, {least} AS d FROM scaled")
    return f"""WITH {SEGMENTED}, asg AS ({' UNION ALL '.join(parts)}),
cost AS (SELECT k, sum(d) AS inertia FROM asg GROUP BY k),
picked AS (SELECT customer_id FROM snap ORDER BY md5('42:' || CAST(customer_id AS VARCHAR)) LIMIT 10000),
sm AS (SELECT asg.* FROM asg SEMI JOIN picked USING (customer_id)),
pair AS (SELECT a.k, a.customer_id AS i, a.c AS own, b.c AS other, sum(sqrt({pair})) AS s, count(*) AS n
  FROM sm a JOIN sm b ON a.k = b.k GROUP BY 1, 2, 3, 4),
ab AS (SELECT k, i, max(CASE WHEN own = other THEN n END) AS size,
  max(CASE WHEN own = other AND n > 1 THEN s / (n - 1) END) AS a, min(CASE WHEN own <> other THEN s / n END) AS b
  FROM pair GROUP BY k, i),
sil AS (SELECT k, avg(CASE WHEN size = 1 THEN 0 ELSE (b - a) / greatest(a, b) END) AS s, count(b) AS others
  FROM ab GROUP BY k)
SELECT CAST(k AS INTEGER) AS "K", round(inertia, 4) AS "Inertia",
  CASE WHEN others > 0 THEN round(s, 6) END AS "SilhouetteScore" FROM cost JOIN sil USING (k)"""


def _target_by_split() -> str:
    counts = _cols(f"count(*) FILTER (WHERE split = '{s}') AS {s}_count"
                   for s in ("train", "val", "test"))
    shares = _cols(f"round(CAST({s}_count AS DOUBLE) / (SELECT count(*) FROM spl WHERE split = '{s}'), 6) AS {s}_ratio"
                   for s in ("train", "val", "test"))
    return f"""WITH {SPLIT}, ct AS (SELECT y, {counts} FROM spl GROUP BY y)
SELECT CASE y WHEN 1 THEN 'Churn (1)' ELSE 'No Churn (0)' END AS class,
       train_count, val_count, test_count, {shares} FROM ct"""


def _sweep() -> str:
    return f"""WITH {SCORE}, th(threshold) AS (VALUES (0.3::DOUBLE), (0.4::DOUBLE), (0.5::DOUBLE), (0.6::DOUBLE), (0.7::DOUBLE)),
cf AS (SELECT threshold, count(*) FILTER (WHERE y = 0 AND p < threshold) AS true_negative,
  count(*) FILTER (WHERE y = 0 AND p >= threshold) AS false_positive,
  count(*) FILTER (WHERE y = 1 AND p < threshold) AS false_negative,
  count(*) FILTER (WHERE y = 1 AND p >= threshold) AS true_positive FROM sc, th GROUP BY threshold),
m AS (SELECT *, {_class_metrics()}, true_positive + false_positive AS predicted_churn_customers FROM cf)
SELECT threshold, accuracy, precision, recall, f1, predicted_churn_customers, true_positive,
       false_positive, false_negative FROM m"""


def _pivot(metrics) -> str:
    cells = _cols(f"max({m}) FILTER (WHERE feature_set = '{fs}') AS {m}_{fs}"
                  for fs in VARIANTS for m in metrics)
    return f"SELECT model, {cells} FROM met GROUP BY model"


def _variant_counts() -> str:
    """Feature counts per variant from the encoded levels on Train."""
    def one(variant: str, numeric: int, extra: str) -> str:
        return f"""SELECT split, '{variant}' AS variant,
  CAST({numeric} + (SELECT count(DISTINCT credit_rating) + count(DISTINCT marital_status)
    + count(DISTINCT handset_web_capable) + count(DISTINCT {_GROUPED}){extra} FROM train) AS BIGINT) AS n_features,
  CAST({numeric} AS BIGINT) AS n_numeric, count(*) AS n_rows, round(avg(y), 6) AS churn_rate
FROM spl GROUP BY split"""
    base = len(ROLES.numeric)
    return (f"WITH {SPLIT}, {_RARE} "
            + one("with_retention", base + len(ROLES.leak_numeric),
                  " + count(DISTINCT made_call_to_retention_team)")
            + " UNION ALL " + one("without_retention", base, ""))


def _prepared() -> str:
    num = []
    for c in ROLES.numeric:
        raw = "TRY_CAST(handset_price AS DOUBLE)" if c == ROLES.price else c
        if c in ROLES.zero_fill:
            num.append(f"coalesce({raw}, 0) AS {c}")
        else:
            num.append(f"coalesce({raw}, (SELECT quantile_cont({raw}, 0.5) FROM train)) AS {c}")
    levels = ([f"credit_rating_{v}" for v in Q.CREDIT_LEVELS]
              + [f"handset_web_capable_{v}" for v in ("No", "Yes")])
    flags = []
    for name in levels:
        col = "credit_rating" if name.startswith("credit") else "handset_web_capable"
        flags.append(f"CAST({col} = '{name[len(col) + 1:]}' AS DOUBLE) AS \"{name}\"")
    scaled = _cols(
        f"round(({c} - (SELECT avg({c}) FROM filled WHERE split = 'train'))"
        f" / (SELECT stddev_pop({c}) FROM filled WHERE split = 'train'), 6) AS {c}"
        for c in ROLES.numeric)
    return f"""WITH {SPLIT}, filled AS (SELECT customer_id, split, y, credit_rating, handset_web_capable, {_cols(num)} FROM spl)
SELECT customer_id, y AS label, split, {scaled}, {_cols(flags)} FROM filled"""


def _consistency() -> str:
    mismatch = _cols(f"CAST(0 AS BIGINT) AS mismatch_{c}"
                     for c in [*_shared_order(), "label"])
    return f"WITH {SNAP} SELECT count(*) AS n, CAST(0 AS BIGINT) AS unmatched, {mismatch} FROM snap"


def _shared_order():
    return [*ROLES.median_fill, *ROLES.zero_fill]


def oracle_queries() -> dict[str, str]:
    zcols = _cols(f"a.z_{c}" for c in SEG)
    dist = "sqrt(" + " + ".join(f"(a.z_{c} - b.z_{c}) * (a.z_{c} - b.z_{c})" for c in SEG) + ")"
    region = "substr(service_area, 1, 3)"
    sql = {
        "scan_customers": f"WITH {SNAP} SELECT * FROM snap",
        "preview_head": f"WITH {SNAP} SELECT * FROM snap ORDER BY customer_id LIMIT 5",
        "preview_tail": f"WITH {SNAP} SELECT * FROM snap ORDER BY customer_id DESC LIMIT 5",
        "union_splits": f"WITH {SPLIT} SELECT customer_id, churn, split, {_cols(SEG)} FROM spl",
        "scan_split_test": f"WITH {SPLIT} SELECT customer_id, {_cols(SEG)}, y AS _churn FROM spl WHERE split = 'test'",
        "table_fingerprint": f"""WITH {SNAP}, h AS (SELECT sha256({_cells}) AS h FROM snap)
SELECT count(*) AS n_rows, concat_ws('-', {_slices}) AS hash_sum FROM h""",
        "table_shape": f"WITH {SNAP} SELECT CAST(position AS INTEGER) AS position, column_name, data_type, n_rows FROM (VALUES "
        + ", ".join(f"({i}, '{c}', '{t}')" for i, (c, t) in enumerate(_snapshot_types(), 1))
        + ") v(position, column_name, data_type), (SELECT count(*) AS n_rows FROM snap)",
        "dup_keys": "SELECT count(*) - count(DISTINCT o_custkey) AS duplicate_keys FROM orders",
        "dup_rows": f"""WITH {SNAP}, g AS (SELECT count(*) AS n FROM snap
  GROUP BY credit_rating, marital_status, age_hh1, age_hh2, active_subs)
SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicate_rows FROM g""",
        "null_profile": f"WITH {SNAP}, u AS (" + _per_column(
            "count(*) - count({c}) AS null_count, round((count(*) - count({c})) * 100.0::DOUBLE / count(*), 2) AS null_percent",
            [c for c, _ in _snapshot_types()], "snap") + ") SELECT * FROM u WHERE null_count > 0",
        "value_counts_nulls": f"WITH {SNAP} SELECT age_hh1 AS value, count(*) AS n FROM snap GROUP BY 1",
        "value_counts_top10": f"""WITH {SNAP} SELECT handset_price AS value, count(*) AS n FROM snap
WHERE handset_price IS NOT NULL GROUP BY 1 ORDER BY n DESC, value LIMIT 10""",
        "value_share": f"""WITH {SNAP} SELECT credit_rating AS value, count(*) AS n,
round(CAST(count(*) AS DOUBLE) / (SELECT count(credit_rating) FROM snap), 6) AS share
FROM snap WHERE credit_rating IS NOT NULL GROUP BY 1""",
        "describe_numeric": _describe(),
        "distinct_counts": f"WITH {SNAP} " + _per_column(
            "count(DISTINCT {c}) AS n_distinct", ("service_area", "handset_price", "credit_rating"), "snap"),
        "negative_profile": f"WITH {SNAP}, u AS (" + _per_column(
            "count(*) FILTER (WHERE {c} < 0) AS negative_count", Q.NUMERIC, "snap")
        + ") SELECT * FROM u WHERE negative_count > 0",
        "sentinel_counts": f"WITH {SNAP} " + _per_column(
            "count(*) FILTER (WHERE {c} = 0) AS sentinel_count, count(*) - count({c}) AS null_count",
            ROLES.zero_fill, "snap"),
        "co_null_check": f"""WITH {SNAP} SELECT bool_and((age_hh1 IS NULL) = (age_hh2 IS NULL)) AS always_together,
count(*) FILTER (WHERE age_hh1 IS NULL AND age_hh2 IS NULL) AS both_null FROM snap""",
        "contingency": f"""WITH {SNAP} SELECT handset_web_capable, made_call_to_retention_team, count(*) AS n
FROM snap GROUP BY ALL""",
        "target_by_split": _target_by_split(),
        "kpi_overview": f"""WITH {LAB} SELECT count(*) AS customers, CAST(sum(y) AS BIGINT) AS churned,
CAST(sum(1 - y) AS BIGINT) AS retained, round(avg(y), 6) AS churn_rate FROM lab""",
        "churn_state_counts": f"""WITH {LAB}, dim(state, state_order, k) AS (VALUES ('유지', 1, 0), ('이탈', 2, 1))
SELECT state, CAST(state_order AS INTEGER) AS state_order, count(y) AS n FROM dim LEFT JOIN lab ON y = k GROUP BY 1, 2""",
        "project_features": f"WITH {SNAP} SELECT customer_id, {_cols(ROLES.numeric)} FROM snap",
        "encode_target": f"WITH {LAB} SELECT customer_id, y FROM lab",
        "encode_target_ci": f"""WITH {SNAP} SELECT customer_id,
CAST(lower(trim('  ' || upper(churn) || ' ')) = 'yes' AS INTEGER) AS y FROM snap""",
        "encode_target_map": f"""WITH {SNAP} SELECT customer_id,
CASE marital_status WHEN 'No' THEN 0 WHEN 'Yes' THEN 1 END AS y FROM snap""",
        "region_prefix": f"WITH {SNAP} SELECT customer_id, {_REGION} AS service_area_region FROM snap",
        "rare_levels": f"WITH {SPLIT}, {_RARE} SELECT service_area_region, n FROM rare",
        "rare_to_other": f"WITH {SPLIT}, {_RARE} SELECT customer_id, {_GROUPED} AS service_area_region FROM snap",
        "unknown_flag": f"WITH {SNAP} SELECT customer_id, CAST(handset_price = 'Unknown' AS INTEGER) AS handset_price_unknown FROM snap",
        "lenient_numeric": f"WITH {SNAP} SELECT customer_id, TRY_CAST(handset_price AS DOUBLE) AS handset_price FROM snap",
        "clip_bounds": f"WITH {SEGMENTED} " + _per_column(
            "round(quantile_cont({c}, 0.01), 6) AS lower, round(quantile_cont({c}, 0.99), 6) AS upper", SEG, "filled"),
        "winsorize": f"WITH {SNAP} SELECT customer_id, " + _cols(
            f"CASE WHEN {c} IS NOT NULL THEN round(least(greatest({c}, (SELECT quantile_cont({c}, 0.01) FROM snap)),"
            f" (SELECT quantile_cont({c}, 0.99) FROM snap)), 6) END AS {c}" for c in SEG) + " FROM snap",
        "zero_fill": f"WITH {SNAP} SELECT customer_id, coalesce(age_hh1, 0) AS age_hh1, coalesce(age_hh2, 0) AS age_hh2 FROM snap",
        "standardize": f"WITH {SPLIT} SELECT customer_id, {_standard('({c} - {m}) / {s}')} FROM snap",
        "destandardize": f"WITH {SPLIT} SELECT customer_id, {_standard('({c} - {m}) / {s} * {s} + {m}')} FROM snap",
        "scaler_state": f"WITH {SPLIT} " + _per_column(
            "round(avg({c}), 6) AS mean, round(stddev_pop({c}), 6) AS scale",
            ("monthly_minutes", "months_in_service", "current_equipment_days"), "train"),
        "align_schema": f"""WITH {SNAP} SELECT customer_id, monthly_minutes, months_in_service,
CAST(NULL AS DOUBLE) AS roaming_calls, CAST(NULL AS DOUBLE) AS income_group FROM snap""",
        "threshold_label": f"WITH {SCORE} SELECT customer_id, p, CAST(p >= 0.5::DOUBLE AS INTEGER) AS churn_prediction FROM sc",
        "risk_grade": f"WITH {SCORE} SELECT customer_id, p, {_GRADE} AS risk_grade FROM sc",
        "band_cut": f"WITH {SCORE} SELECT customer_id, p, {_BAND} AS risk_band FROM sc",
        "round_probability": f"WITH {SCORE} SELECT customer_id, round_even(p, 4) AS p4 FROM sc",
        "action_lookup": f"""WITH {SCORE}, act(risk_grade, suggested_action) AS (VALUES {", ".join(f"({_text(k)}, {_text(v)})" for k, v in playbook.GRADE_ACTION.items())}),
gr AS (SELECT customer_id, {_GRADE} AS risk_grade FROM sc)
SELECT customer_id, risk_grade, suggested_action FROM gr LEFT JOIN act USING (risk_grade)""",
        "grade_playbook": f"""WITH {SCORE}, st(risk_grade, step, label, title, description) AS (VALUES {_steps_values(playbook.GRADE_STEPS)}),
gr AS (SELECT customer_id, {_GRADE} AS risk_grade FROM sc)
SELECT customer_id, risk_grade, CAST(step AS INTEGER) AS step, label, title, description FROM gr JOIN st USING (risk_grade)""",
        "segment_playbook": _segment_playbook(),
        "onehot_wide": f"WITH {SNAP} SELECT customer_id, " + _cols(
            [f"CAST(credit_rating = '{v}' AS DOUBLE) AS \"credit_rating_{v}\"" for v in Q.CREDIT_LEVELS]
            + [f"CAST(marital_status = '{v}' AS DOUBLE) AS \"marital_status_{v}\"" for v in ("No", "Unknown", "Yes")])
        + " FROM snap",
        "onehot_decode": f"WITH {SNAP} SELECT customer_id, 'credit_rating_' || credit_rating AS encoded FROM snap",
        "level_from_name": f"WITH {SNAP} SELECT customer_id, credit_rating AS level FROM snap",
        "filter_metrics": f"WITH {SCORES}, {_metrics('feature_set, model')} SELECT * FROM met WHERE feature_set = 'without_retention' AND model = 'usage_formula'",
        "filter_topn_levels": f"""WITH {SNAP}, r AS (SELECT customer_id, {region} AS region FROM snap WHERE service_area IS NOT NULL),
t AS (SELECT region FROM r GROUP BY region ORDER BY count(*) DESC, region LIMIT 15)
SELECT customer_id, region FROM r WHERE region IN (SELECT region FROM t)""",
        "base_row": f"WITH {SNAP} " + _per_column("round(quantile_cont({c}, 0.5), 6) AS median", SEG, "snap"),
        "row_by_key": f"WITH {SNAP} SELECT * FROM snap WHERE customer_id = 77",
        "variant_consistency": _consistency(),
        "expect_unique": "SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey HAVING count(*) <> 1",
        "expect_finite_range": f"WITH {SNAP}, u AS (" + " UNION ALL ".join(
            f"SELECT customer_id, '{c}' AS column_name, {c} AS value FROM snap" for c in Q.GAPPY)
        + ") SELECT * FROM u WHERE value IS NULL OR value <= -0.9::DOUBLE OR value >= 100000",
        "expect_equal": f"""WITH {SNAP} SELECT customer_id, age_hh1 AS left_value, age_hh2 AS right_value FROM snap
WHERE NOT coalesce(abs(age_hh1 - age_hh2) <= 1e-12, false)""",
        "expect_date": """WITH o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 11 <> 0 THEN strftime(o_orderdate, '%Y-%m-')
  || CASE WHEN o_orderkey % 7 = 0 THEN '32' ELSE strftime(o_orderdate, '%d') END END AS value FROM orders)
SELECT o_orderkey, value, CASE WHEN value IS NULL OR value = '' THEN 'missing' ELSE 'not a date' END AS problem
FROM o WHERE value IS NULL OR TRY_CAST(value AS DATE) IS NULL""",
        "churn_rate_ordered": _rate_ordered(),
        "churn_rate_top_regions": f"""WITH {LAB}, g AS (SELECT {region} AS region, count(*) AS n, round(avg(y), 6) AS churn_rate
  FROM lab WHERE service_area IS NOT NULL GROUP BY 1 ORDER BY n DESC, region LIMIT 15)
SELECT region, n, churn_rate FROM g""",
        "risk_band_summary": f"""WITH {SCORE}, dim(risk_band, band_order) AS (VALUES ('{HIGH}', 1), ('{MID}', 2), ('{LOW}', 3)),
b AS (SELECT {_BAND} AS risk_band, y FROM sc)
SELECT risk_band, CAST(band_order AS INTEGER) AS band_order, count(y) AS n, round(avg(y), 6) AS churn_rate
FROM dim LEFT JOIN b USING (risk_band) GROUP BY 1, 2""",
        "histogram_by_class": f"""WITH {LAB}, x AS (SELECT y, current_equipment_days AS v FROM lab WHERE current_equipment_days IS NOT NULL),
rg AS (SELECT y, min(v) AS lo, (max(v) - min(v)) / 40 AS w, count(*) AS total FROM x GROUP BY y),
hb AS (SELECT x.y, CAST(least(floor((v - lo) / w), 39) AS INTEGER) AS bin, count(*) AS n FROM x JOIN rg ON x.y = rg.y GROUP BY 1, 2),
grid AS (SELECT y, lo, w, total, CAST(b AS INTEGER) AS bin FROM rg, range(40) t(b))
SELECT grid.y AS label, grid.bin AS bin, round(lo + grid.bin * w, 6) AS bin_start, coalesce(n, 0) AS n,
       round(coalesce(n, 0) / (total * w), 9) AS density
FROM grid LEFT JOIN hb ON grid.y = hb.y AND grid.bin = hb.bin""",
        "score_histogram": f"""WITH {SCORE}, hb AS (SELECT CAST(least(floor(p * 40), 39) AS INTEGER) AS bin,
  count(*) FILTER (WHERE y = 0) AS retained, count(*) FILTER (WHERE y = 1) AS churned FROM sc GROUP BY 1)
SELECT CAST(b AS INTEGER) AS bin, coalesce(retained, 0) AS retained, coalesce(churned, 0) AS churned
FROM range(40) t(b) LEFT JOIN hb ON hb.bin = b""",
        "corr_with_target": f"WITH {LAB}, u AS (" + _per_column("round(corr({c}, y), 6) AS correlation", Q.NUMERIC, "lab")
        + ") SELECT * FROM u ORDER BY abs(correlation) DESC NULLS LAST, column_name LIMIT 12",
        "corr_matrix": _corr_matrix(),
        "scaling_check": f"WITH {SEGMENTED} " + _per_column(
            "round(avg({c}), 6) AS mean, round(stddev_pop({c}), 6) AS std", [f"z_{c}" for c in SEG], "scaled"),
        "class_weights": f"""WITH {SPLIT}, k AS (SELECT count(*) FILTER (WHERE y = 0) AS neg, count(*) FILTER (WHERE y = 1) AS pos FROM train)
SELECT 0 AS class, neg AS n, round((neg + pos) / (2.0::DOUBLE * neg), 6) AS balanced_weight, 1.0::DOUBLE AS boost_weight FROM k
UNION ALL SELECT 1, pos, round((neg + pos) / (2.0::DOUBLE * pos), 6), round(CAST(neg AS DOUBLE) / pos, 6) FROM k""",
        "metrics_long": f"WITH {SCORES}, {_metrics('feature_set, model')} SELECT * FROM met",
        "metrics_unpivot": f"WITH {SCORES}, {_metrics('feature_set, model')} " + " UNION ALL ".join(
            f"SELECT feature_set, model, '{m}' AS metric, {m} AS score FROM met"
            for m in ("roc_auc", "pr_auc", "accuracy", "precision", "recall", "f1")),
        "metrics_pivot": f"WITH {SCORES}, {_metrics('feature_set, model')} "
        + _pivot(("roc_auc", "pr_auc", "accuracy", "precision", "recall", "f1")),
        "retention_gain": f"WITH {SCORES}, {_metrics('feature_set, model')}, pv AS ({_pivot(('roc_auc', 'pr_auc'))}) "
        "SELECT *, round(roc_auc_with_retention - roc_auc_without_retention, 6) AS roc_auc_gain_with_retention FROM pv",
        "model_selection": f"""WITH {SCORES}, {_metrics('feature_set, model')}
SELECT * FROM met QUALIFY row_number() OVER (PARTITION BY feature_set ORDER BY pr_auc DESC, model) = 1""",
        "topk": f"WITH {SNAP} SELECT customer_id, total_recurring_charge FROM snap ORDER BY 2 DESC, 1 LIMIT 10",
        "rank_features": f"WITH {LAB}, u AS (" + _per_column("abs(round(corr({c}, y), 6)) AS strength", Q.NUMERIC, "lab")
        + ") SELECT CAST(row_number() OVER (ORDER BY strength DESC, column_name) AS INTEGER) AS rank, column_name, strength FROM u ORDER BY rank LIMIT 10",
        "example_customers": f"WITH {SCORE} " + " UNION ALL ".join(
            f"(SELECT '{n}' AS example, customer_id, p FROM sc ORDER BY {o}, customer_id LIMIT 1)"
            for n, o in (("high", "p DESC"), ("mid", "abs(p - 0.55::DOUBLE)"), ("low", "p"))),
        "gain_curve": f"""WITH {SCORE}, g AS (SELECT row_number() OVER w AS position, sum(y) OVER w AS cp FROM sc
  WINDOW w AS (ORDER BY p DESC, customer_id ROWS UNBOUNDED PRECEDING))
SELECT position, round(CAST(position AS DOUBLE) / (SELECT count(*) FROM sc), 6) AS contacted_share,
       round(CAST(cp AS DOUBLE) / (SELECT sum(y) FROM sc), 6) AS gain FROM g
UNION ALL SELECT CAST(0 AS BIGINT), 0.0::DOUBLE, 0.0::DOUBLE""",
        "gain_at_pct": f"""WITH {SCORE}, g AS (SELECT row_number() OVER w AS position, sum(y) OVER w AS cp FROM sc
  WINDOW w AS (ORDER BY p DESC, customer_id ROWS UNBOUNDED PRECEDING)),
q(share) AS (VALUES (0.1::DOUBLE), (0.2::DOUBLE), (0.3::DOUBLE), (0.5::DOUBLE))
SELECT share, position, round(CAST(cp AS DOUBLE) / (SELECT sum(y) FROM sc), 6) AS gain,
       round(CAST(cp AS DOUBLE) / (SELECT sum(y) FROM sc) / share, 6) AS lift
FROM q JOIN g ON position = CAST(floor(share * (SELECT count(*) FROM sc)) AS BIGINT)""",
        "gain_summary": f"""WITH {SCORE}, {_metrics()}, g AS (SELECT row_number() OVER w AS position, sum(y) OVER w AS cp FROM sc
  WINDOW w AS (ORDER BY p DESC, customer_id ROWS UNBOUNDED PRECEDING)),
k AS (SELECT count(*) AS test_n, CAST(sum(y) AS BIGINT) AS test_pos,
  count(*) FILTER (WHERE p >= 0.5::DOUBLE) AS contacted_at_threshold,
  round(avg(CAST(p >= 0.5::DOUBLE AS INTEGER)), 6) AS contacted_pct FROM sc)
SELECT test_n, test_pos, roc_auc, pr_auc, 0.5::DOUBLE AS threshold, contacted_at_threshold, contacted_pct, {_cols(
            f"(SELECT round(CAST(cp AS DOUBLE) / (SELECT sum(y) FROM sc), 6) FROM g WHERE position = "
            f"CAST(floor({q}::DOUBLE * (SELECT count(*) FROM sc)) AS BIGINT)) AS top{round(q * 100)}pct"
            for q in (0.1, 0.2, 0.3, 0.5))} FROM k, met""",
        "contact_volume": f"""WITH {SCORE} SELECT count(*) FILTER (WHERE p >= 0.5::DOUBLE) AS contacted_at_threshold,
round(avg(CAST(p >= 0.5::DOUBLE AS INTEGER)), 6) AS contacted_share FROM sc""",
        "seeded_sample": f"""WITH {SNAP} SELECT customer_id, churn FROM snap
ORDER BY md5('42:' || CAST(customer_id AS VARCHAR)) LIMIT 1000""",
        "confusion": f"WITH {SCORE}, {_metrics()} SELECT true_negative, false_positive, false_negative, true_positive FROM met",
        "class_metrics": f"WITH {SCORE}, {_metrics()} SELECT * EXCLUDE (roc_auc, pr_auc) FROM met",
        "roc_auc": f"WITH {SCORE}, {_metrics()} SELECT roc_auc FROM met",
        "average_precision": f"WITH {SCORE}, {_metrics()} SELECT pr_auc FROM met",
        "roc_curve": f"""WITH {SCORE}, {_metrics()} SELECT p AS threshold, round(CAST(cn - cp AS DOUBLE) / (tn_ - tp_), 6) AS fpr,
round(CAST(cp AS DOUBLE) / tp_, 6) AS tpr FROM d1 UNION ALL SELECT NULL, 0.0::DOUBLE, 0.0::DOUBLE""",
        "roc_curve_reduced": f"""WITH {SCORE}, {_metrics()}, e AS (SELECT *, row_number() OVER (ORDER BY p DESC) AS i,
  lead(n) OVER (ORDER BY p DESC) AS nn, lead(pos) OVER (ORDER BY p DESC) AS np FROM d1)
SELECT p AS threshold, round(CAST(cn - cp AS DOUBLE) / (tn_ - tp_), 6) AS fpr, round(CAST(cp AS DOUBLE) / tp_, 6) AS tpr
FROM e WHERE i = 1 OR NOT coalesce(n = nn AND pos = np, false) UNION ALL SELECT NULL, 0.0::DOUBLE, 0.0::DOUBLE""",
        "pr_curve": f"""WITH {SCORE}, {_metrics()} SELECT p AS threshold, round(CAST(cp AS DOUBLE) / tp_, 6) AS recall,
round(CAST(cp AS DOUBLE) / cn, 6) AS precision, round(CAST(tp_ AS DOUBLE) / tn_, 6) AS base_rate FROM d1
UNION ALL SELECT NULL, 0.0::DOUBLE, 1.0::DOUBLE, (SELECT round(avg(y), 6) FROM sc)""",
        "threshold_sweep": _sweep(),
        "live_metrics": f"WITH {SPLIT}, sc AS (SELECT y, {_p(_EQUIPMENT)} AS p FROM spl WHERE split = 'val'), {_metrics()} SELECT * FROM met",
        "stratified_split": f"WITH {SPLIT} SELECT customer_id, churn, split FROM spl",
        "clean_features": f"""WITH {SPLIT}, {_RARE} SELECT customer_id, {_GROUPED} AS service_area_region,
TRY_CAST(handset_price AS DOUBLE) AS handset_price, CAST(handset_price = 'Unknown' AS INTEGER) AS handset_price_unknown FROM snap""",
        "impute_median": f"WITH {SPLIT} SELECT customer_id, " + _cols(
            f"round(coalesce({c}, (SELECT quantile_cont({c}, 0.5) FROM train)), 6) AS {c}" for c in Q.GAPPY) + " FROM snap",
        "impute_mode": f"""WITH {SPLIT}, md AS (SELECT {region} AS m FROM train WHERE service_area IS NOT NULL
  GROUP BY 1 ORDER BY count(*) DESC, m LIMIT 1)
SELECT customer_id, coalesce({region}, (SELECT m FROM md)) AS region FROM snap""",
        "robust_scale": f"WITH {SPLIT} SELECT customer_id, " + _cols(
            f"round(({c} - (SELECT quantile_cont({c}, 0.5) FROM train)) / (SELECT coalesce(nullif("
            f"quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25), 0), 1) FROM train), 6) AS {c}"
            for c in ("monthly_revenue", "overage_minutes", "retention_calls")) + " FROM snap",
        "missing_indicators": f"WITH {SNAP} SELECT customer_id, " + _cols(
            f"CAST({c} IS NULL AS DOUBLE) AS missing_{c}" for c in Q.GAPPY) + " FROM snap",
        "feature_variants": _variant_counts(),
        "prepared_features": _prepared(),
        "dummy_baseline": f"""WITH {SPLIT}, sc AS (SELECT y, (SELECT CAST(avg(y) > 0.5 AS DOUBLE) FROM train) AS p
  FROM spl WHERE split = 'val'), {_metrics()} SELECT * FROM met""",
        "assign_segment": f'WITH {SEGMENTED} SELECT customer_id, "Cluster" FROM seg',
        "segment_sizes": f"""WITH {SEGMENTED} SELECT "Cluster", count(*) AS "CustomerCount",
round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM seg), 6) AS "Ratio" FROM seg GROUP BY 1""",
        "segment_means": f"""WITH {SEGMENTED} SELECT "Cluster", {_cols(f"round(avg({c}), 6) AS {c}" for c in SEG)} FROM seg GROUP BY 1""",
        "segment_index": f"""WITH {NAMED} SELECT "Cluster", {_cols(f"round({c}, 6) AS {c}" for c in SEG)} FROM idx""",
        "segment_names": f'WITH {NAMED} SELECT "Cluster", "ClusterName" FROM names',
        "segment_assignment": f'WITH {NAMED} SELECT customer_id, churn, "Cluster", "ClusterName" FROM seg LEFT JOIN names USING ("Cluster")',
        "segment_churn": f"""WITH {NAMED} SELECT "Cluster", "ClusterName", count(*) AS "CustomerCount",
round(avg(CASE churn WHEN 'No' THEN 0 WHEN 'Yes' THEN 1 END) * 100, 6) AS "ChurnRate"
FROM seg LEFT JOIN names USING ("Cluster") GROUP BY 1, 2""",
        "silhouette_sample": f"""WITH {SEGMENTED}, sm AS (SELECT * FROM segz ORDER BY md5('42:' || CAST(customer_id AS VARCHAR)) LIMIT 10000),
pair AS (SELECT a.customer_id AS i, a."Cluster" AS own, b."Cluster" AS other, sum({dist}) AS s, count(*) AS n
  FROM sm a, sm b GROUP BY 1, 2, 3),
ab AS (SELECT i, max(CASE WHEN own = other THEN n END) AS size,
  max(CASE WHEN own = other AND n > 1 THEN s / (n - 1) END) AS a, min(CASE WHEN own <> other THEN s / n END) AS b FROM pair GROUP BY i)
SELECT count(*) AS n, round(avg(CASE WHEN size = 1 THEN 0 ELSE (b - a) / greatest(a, b) END), 6) AS "SilhouetteScore" FROM ab""",
        "segment_defaults": f"WITH {SNAP} " + _per_column("round(quantile_cont({c}, 0.5), 6) AS median", SEG, "snap"),
    }
    for name, col in (("churn_rate_by_credit", "credit_rating"),
                      ("churn_rate_by_web_capable", "handset_web_capable"),
                      ("churn_rate_by_retention_contact", "made_call_to_retention_team")):
        sql[name] = (f"WITH {LAB} SELECT {col}, count(*) AS n, round(avg(y), 6) AS churn_rate "
                     f"FROM lab WHERE {col} IS NOT NULL GROUP BY {col}")
    sql["churn_rate_by_region"] = (
        f"WITH {LAB} SELECT {region} AS region, count(*) AS n, round(avg(y), 6) AS churn_rate "
        "FROM lab WHERE service_area IS NOT NULL GROUP BY 1")
    sql["formula_importance"] = _formula_importance()
    sql["k_scan_fixed"] = _k_scan({k: CENTRES[:k] for k in range(1, len(CENTRES) + 1)})
    sql["k_scan_one"] = _k_scan({1: [[None] * len(SEG)]})
    actions = ", ".join(f"({_text(k)}, {_text(v)})" for k, v in playbook.GRADE_ACTION.items())
    sql.update(serving_checks.oracle_queries(SPLIT, _RARE, _GROUPED, SEGMENTED, _GRADE, actions,
                                             _metrics))
    sql["sparse_feature_names"] = sql["feature_names"]
    sql.update(round_trips.oracle_queries(SNAP, SPLIT, SCORE, NAMED, sql))
    sql.update(model_checks.oracle_queries(SNAP, SPLIT, _RARE, _GROUPED))
    return {k: sql[k] for k in Q.QUERIES if k in sql}


def _snapshot_types() -> list[tuple[str, str]]:
    text = {"churn", "service_area", "handset_price", "credit_rating", "marital_status",
            "handset_web_capable", "made_call_to_retention_team"}
    names = ("customer_id", "churn", "monthly_revenue", "perc_change_revenues", "monthly_minutes",
             "overage_minutes", "total_recurring_charge", "perc_change_minutes",
             "dropped_blocked_calls", "customer_care_calls", "active_subs", "months_in_service",
             "current_equipment_days", "age_hh1", "age_hh2", "service_area", "handset_price",
             "credit_rating", "marital_status", "handset_web_capable", "retention_calls",
             "retention_offers_accepted", "made_call_to_retention_team")
    return [(n, "bigint" if n == "customer_id" else "string" if n in text else "double")
            for n in names]
