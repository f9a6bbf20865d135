"""The SQL that each query must agree with, over the same tables."""

from __future__ import annotations

from workload import tables as t
from workload.queries import CV_FOLDS

# Spark's names for the types of the given tables.
_TYPE_NAME = """CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double'
              WHEN 'VARCHAR' THEN 'string' END"""

_GAPS = """
SELECT 'doc_id' AS "column", count(*) FILTER (doc_id IS NULL) AS n_missing FROM with_missing
UNION ALL SELECT 'lang', count(*) FILTER (lang IS NULL OR isnan(try_cast(lang AS DOUBLE))) FROM with_missing
UNION ALL SELECT 'source', count(*) FILTER (source IS NULL OR isnan(try_cast(source AS DOUBLE))) FROM with_missing
UNION ALL SELECT 'n_chars', count(*) FILTER (n_chars IS NULL) FROM with_missing
UNION ALL SELECT 'quality', count(*) FILTER (quality IS NULL) FROM with_missing
UNION ALL SELECT 'toxic', count(*) FILTER (toxic IS NULL) FROM with_missing
UNION ALL SELECT 'length', count(*) FILTER (length IS NULL OR isnan(length)) FROM with_missing
UNION ALL SELECT 'note', count(*) FILTER (note IS NULL OR isnan(try_cast(note AS DOUBLE))) FROM with_missing
UNION ALL SELECT 'lang_known', count(*) FILTER (lang_known IS NULL) FROM with_missing
UNION ALL SELECT 'good', count(*) FILTER (good IS NULL) FROM with_missing
UNION ALL SELECT 'day', count(*) FILTER (day IS NULL) FROM with_missing
UNION ALL SELECT 'seen', count(*) FILTER (seen IS NULL) FROM with_missing"""


def _index(relation: str, column: str, name: str) -> str:
    """CTE `name`(value, n, idx): the index of every value of a column."""
    return f"""{name} AS (
  SELECT {column} AS value, count(*) AS n,
         (row_number() OVER (ORDER BY count(*) DESC, {column}) - 1)::DOUBLE AS idx
  FROM {relation} WHERE {column} IS NOT NULL GROUP BY {column})"""


# Each small model is fitted per training set `train` (fold, price_band, one, zero, squares): the weights of the positive
# and the negative rows of a band, and the squares of all its weights. Its result is `fitted` (fold, price_band, p).

# A stump gives each band the weighted share of positives in it.
_SHARE = "fitted AS (SELECT fold, price_band, one / (one + zero) AS p FROM train)"


def _boosted(steps: int, step_size: float = 0.1) -> str:
    """Boosted stumps: the first is the mean of -1 and 1 in a band; each further one adds its share of the mean residual."""
    margins = ["m1 AS (SELECT *, (one - zero) / (one + zero) AS margin, one / (one + zero) AS share FROM train)"]
    for i in range(2, steps + 1):
        residual = "share * 4 / (1 + exp(2 * margin)) - (1 - share) * 4 / (1 + exp(-2 * margin))"
        margins.append(f"m{i} AS (SELECT * REPLACE (margin + {step_size} * ({residual}) AS margin) FROM m{i - 1})")
    margins.append(f"fitted AS (SELECT fold, price_band, 1 / (1 + exp(-2 * margin)) AS p FROM m{steps})")
    return ",\n".join(margins)


# Ridge logistic regression by Newton's method. The band is 0 or 1, and the penalty is on its coefficient times its
# standard deviation, the sample's, with weights.
_RIDGE = """bands AS (
  SELECT fold, sum(one + zero) AS w, sum(squares) AS squares,
         sum(one) FILTER (price_band = 'low') AS one0, sum(one + zero) FILTER (price_band = 'low') AS w0,
         sum(one) FILTER (price_band = 'high') AS one1, sum(one + zero) FILTER (price_band = 'high') AS w1
  FROM train GROUP BY fold),
known AS (SELECT *, 0.01 * (w0 * w1 / w) / (w - squares / w) AS ridge FROM bands),
newton AS (
  SELECT fold, 0 AS i, 0.0::DOUBLE AS b0, 0.0::DOUBLE AS b1 FROM known
  UNION ALL
  SELECT fold, i + 1, b0 - (h11 * g0 - h01 * g1) / (h00 * h11 - h01 * h01),
         b1 - (h00 * g1 - h01 * g0) / (h00 * h11 - h01 * h01)
  FROM (
    SELECT fold, i, b0, b1, (w0 * p0 + w1 * p1 - one0 - one1) / w AS g0, (w1 * p1 - one1) / w + ridge * b1 AS g1,
           (w0 * p0 * (1 - p0) + w1 * p1 * (1 - p1)) / w AS h00, w1 * p1 * (1 - p1) / w AS h01,
           w1 * p1 * (1 - p1) / w + ridge AS h11
    FROM (
      SELECT *, 1 / (1 + exp(-b0)) AS p0, 1 / (1 + exp(-b0 - b1)) AS p1
      FROM newton JOIN known USING (fold) WHERE i < 40))),
fitted AS (
  SELECT fold, price_band, 1 / (1 + exp(-b0 - CASE WHEN price_band = 'high' THEN b1 ELSE 0 END)) AS p
  FROM train JOIN newton USING (fold) WHERE i = 40)"""

_SUMS = """sum(w) FILTER (target = 'Yes') AS one, sum(w) FILTER (target = 'No') AS zero, sum(w * w) AS squares"""


def _trained(fitted: str) -> str:
    return f"""WITH RECURSIVE {t.BANDED_SQL},
train AS (SELECT 0 AS fold, price_band, {_SUMS} FROM banded GROUP BY price_band),
{fitted}
SELECT o_orderkey, (p > 0.5)::DOUBLE AS prediction, round(p, 6) AS probability
FROM banded JOIN fitted USING (price_band)"""


def _cross_validated(model: str, fitted: str) -> str:
    return f"""WITH RECURSIVE {t.BANDED_SQL},
folded AS (SELECT *, {t.fold_sql('o_orderkey', CV_FOLDS)} AS fold FROM banded),
sums AS (SELECT fold, price_band, {_SUMS} FROM folded GROUP BY fold, price_band),
train AS (
  SELECT tests.fold, others.price_band, sum(others.one) AS one, sum(others.zero) AS zero, sum(others.squares) AS squares
  FROM (SELECT DISTINCT fold FROM folded) AS tests JOIN sums AS others ON others.fold <> tests.fold
  GROUP BY tests.fold, others.price_band),
{fitted},
scored AS (
  SELECT folded.fold, (target = 'Yes')::INTEGER AS label, p AS score, (p > 0.5)::INTEGER AS prediction
  FROM folded JOIN fitted ON folded.fold = fitted.fold AND folded.price_band = fitted.price_band),
{t.metrics_sql('scored', 'fold')},
{t.long_metrics_sql('fold')}
SELECT '{model}' AS model, fold, n_rows, metric, round(value, 6) AS value FROM long_metrics"""


def _cross_validated_fold_weights(model: str, fitted: str) -> str:
    """The same, with weights from the class ratio of each training set."""
    return f"""WITH RECURSIVE {t.BANDED_SQL},
folded AS (SELECT *, {t.fold_sql('o_orderkey', CV_FOLDS)} AS fold FROM banded),
counts AS (
  SELECT fold, price_band, count(*) FILTER (target = 'Yes') AS yes, count(*) FILTER (target = 'No') AS no
  FROM folded GROUP BY fold, price_band),
others AS (
  SELECT tests.fold, counts.price_band, sum(yes)::DOUBLE AS yes, sum(no)::DOUBLE AS no
  FROM (SELECT DISTINCT fold FROM folded) AS tests JOIN counts ON counts.fold <> tests.fold
  GROUP BY tests.fold, counts.price_band),
ratios AS (SELECT fold, sum(no) / sum(yes) AS r FROM others GROUP BY fold),
train AS (
  SELECT fold, price_band, yes * r AS one, no AS zero, yes * r * r + no AS squares FROM others JOIN ratios USING (fold)),
{fitted},
scored AS (
  SELECT folded.fold, (target = 'Yes')::INTEGER AS label, p AS score, (p > 0.5)::INTEGER AS prediction
  FROM folded JOIN fitted ON folded.fold = fitted.fold AND folded.price_band = fitted.price_band),
{t.metrics_sql('scored', 'fold')},
{t.long_metrics_sql('fold')}
SELECT '{model}' AS model, fold, n_rows, metric, round(value, 6) AS value FROM long_metrics"""


def _shares(relation: str, column: str, name: str) -> str:
    """CTE `name`(value, n, one, total, share, idx, unseen): values by rising share of the weight of the positive class."""
    return f"""{name}_sums AS (
  SELECT {column} AS value, count(*) AS n, coalesce(sum(w) FILTER (target = 'Yes'), 0) AS one, sum(w) AS total,
         round(coalesce(sum(w) FILTER (target = 'Yes'), 0) / sum(w), 12) AS share
  FROM {relation} WHERE {column} IS NOT NULL GROUP BY {column}),
{name} AS (
  SELECT *, (row_number() OVER (ORDER BY share, value) - 1)::DOUBLE AS idx,
         (SELECT count(*) FROM {name}_sums AS o
          WHERE o.share < (SELECT round(sum(one) / sum(total), 12) FROM {name}_sums))::DOUBLE - 0.5 AS unseen
  FROM {name}_sums)"""


# The threshold on the order by share with the least weighted Gini impurity.
_STUMP_BY_SHARE = f"""
WITH {t.WEIGHTED_SQL},
named AS (
  SELECT weighted.o_orderkey, c_name, target, "classWeight" AS w
  FROM weighted JOIN orders USING (o_orderkey) JOIN customer ON o_custkey = c_custkey),
{_shares('named', 'c_name', 'c')},
running AS (
  SELECT idx, sum(one) OVER (ORDER BY idx) AS one_left, sum(total) OVER (ORDER BY idx) AS left_side,
         sum(one) OVER () AS one_all, sum(total) OVER () AS both_sides FROM c),
splits AS (
  SELECT idx, one_left / left_side AS p_left, (one_all - one_left) / (both_sides - left_side) AS p_right,
         left_side, both_sides - left_side AS right_side
  FROM running WHERE idx < (SELECT max(idx) FROM c)),
best AS (
  SELECT * FROM splits
  ORDER BY left_side * p_left * (1 - p_left) + right_side * p_right * (1 - p_right), idx LIMIT 1),
scored AS (
  SELECT o_orderkey, CASE WHEN c.idx <= best.idx THEN p_left ELSE p_right END AS p
  FROM named JOIN c ON c_name = c.value, best)
SELECT o_orderkey, (p > 0.5)::DOUBLE AS prediction, round(p, 6) AS probability FROM scored"""


# The same for three features: the index of a customer's name, the index of the band and the price, each less its mean and
# in units of its standard deviation. A step solves four equations by the factors of their symmetric matrix.
_RIDGE_BY_NAME = f"""
WITH RECURSIVE {t.BANDED_SQL},
named AS (
  SELECT o_orderkey, c_name, price_band, o.o_totalprice AS price, target, w
  FROM banded JOIN orders AS o USING (o_orderkey) JOIN customer ON o_custkey = c_custkey),
{_index('named', 'c_name', 'c')}, {_index('named', 'price_band', 'b')},
slots AS (
  SELECT o_orderkey, (target = 'Yes')::DOUBLE AS y, w::DOUBLE AS w, c.idx AS name, b.idx AS band, price
  FROM named JOIN c ON c_name = c.value JOIN b ON price_band = b.value),
means AS (
  SELECT sum(w) AS total, sum(w) - sum(w * w) / sum(w) AS freedom, sum(w * name) / sum(w) AS name,
         sum(w * band) / sum(w) AS band, sum(w * price) / sum(w) AS price
  FROM slots),
deviations AS (
  SELECT sqrt(sum(w * (s.name - m.name) ^ 2) / any_value(freedom)) AS name,
         sqrt(sum(w * (s.band - m.band) ^ 2) / any_value(freedom)) AS band,
         sqrt(sum(w * (s.price - m.price) ^ 2) / any_value(freedom)) AS price
  FROM slots AS s, means AS m),
units AS (
  SELECT o_orderkey, s.name AS name_index, y, w / total AS w, (s.name - m.name) / d.name AS x1,
         (s.band - m.band) / d.band AS x2, (s.price - m.price) / d.price AS x3
  FROM slots AS s, means AS m, deviations AS d),
newton AS (
  SELECT 0 AS i, 0.0::DOUBLE AS b0, 0.0::DOUBLE AS b1, 0.0::DOUBLE AS b2, 0.0::DOUBLE AS b3
  UNION ALL
  SELECT i + 1, b0 - s0, b1 - s1, b2 - s2, b3 - s3
  FROM (
    SELECT *, h01 / h00 AS l10, h02 / h00 AS l20, h03 / h00 AS l30,
           h11 - l10 * h01 AS d1, h12 - l10 * h02 AS e12, h13 - l10 * h03 AS e13, e12 / d1 AS l21, e13 / d1 AS l31,
           h22 - l20 * h02 - l21 * e12 AS d2, h23 - l20 * h03 - l21 * e13 AS e23, e23 / d2 AS l32,
           h33 - l30 * h03 - l31 * e13 - l32 * e23 AS d3,
           g1 - l10 * g0 AS z1, g2 - l20 * g0 - l21 * z1 AS z2, g3 - l30 * g0 - l31 * z1 - l32 * z2 AS z3,
           z3 / d3 AS s3, z2 / d2 - l32 * s3 AS s2, z1 / d1 - l21 * s2 - l31 * s3 AS s1,
           g0 / h00 - l10 * s1 - l20 * s2 - l30 * s3 AS s0
    FROM (
      SELECT i, b0, b1, b2, b3, sum(r) AS g0, sum(r * x1) + 0.01 * b1 AS g1, sum(r * x2) + 0.01 * b2 AS g2,
             sum(r * x3) + 0.01 * b3 AS g3, sum(v) AS h00, sum(v * x1) AS h01, sum(v * x2) AS h02, sum(v * x3) AS h03,
             sum(v * x1 * x1) + 0.01 AS h11, sum(v * x1 * x2) AS h12, sum(v * x1 * x3) AS h13,
             sum(v * x2 * x2) + 0.01 AS h22, sum(v * x2 * x3) AS h23, sum(v * x3 * x3) + 0.01 AS h33
      FROM (
        SELECT newton.*, x1, x2, x3, 1 / (1 + exp(-b0 - b1 * x1 - b2 * x2 - b3 * x3)) AS p,
               w * (p - y) AS r, w * p * (1 - p) AS v
        FROM newton, units WHERE i < 25)
      GROUP BY i, b0, b1, b2, b3))),
scored AS (
  SELECT o_orderkey, name_index, 1 / (1 + exp(-b0 - b1 * x1 - b2 * x2 - b3 * x3)) AS p FROM units, newton WHERE i = 25)
SELECT o_orderkey, name_index, true AS same_score, (p > 0.5)::DOUBLE AS prediction, round(p, 2) AS probability FROM scored"""


_RIVAL_METRICS = f"""{t.RIVAL_SCORES_SQL},
folded AS (SELECT *, {t.fold_sql('o_orderkey', 10)} AS fold FROM rival_scores),
{t.metrics_sql('folded', 'model, fold')}"""


# A tree of depth 2: the split with the greatest Gini gain at the root, then
# in both children; a feature scores the weighted gains of its splits.
def _ranked(rows: str = "SELECT * FROM three_bands") -> str:
    return f"""
WITH {t.THREE_BANDS_SQL.replace("three_bands AS (", "all_bands AS (")},
three_bands AS ({rows.replace("three_bands", "all_bands")}),
cells AS (
  SELECT o_orderkey, y, w, 0 AS slot, 'haste' AS feature, haste AS value FROM three_bands
  UNION ALL SELECT o_orderkey, y, w, 1, 'price', price FROM three_bands
  UNION ALL SELECT o_orderkey, y, w, 2, 'segment', segment FROM three_bands),
root_sides AS (
  SELECT slot, feature, value, sum(w) AS weight, sum(w * y) / sum(w) AS p FROM cells GROUP BY ALL),
root_total AS (SELECT sum(w) AS weight, sum(w * y) / sum(w) AS p FROM three_bands),
root_gain AS (
  SELECT slot, feature, any_value(t.weight * 2 * t.p * (1 - t.p)) - sum(s.weight * 2 * s.p * (1 - s.p)) AS gain
  FROM root_sides AS s, root_total AS t GROUP BY slot, feature),
root AS (SELECT feature, gain FROM root_gain ORDER BY gain DESC, slot LIMIT 1),
node_of AS (SELECT o_orderkey, value AS node FROM cells WHERE feature = (SELECT feature FROM root)),
sides AS (
  SELECT node, slot, feature, value, sum(w) AS weight, sum(w * y) / sum(w) AS p
  FROM cells JOIN node_of USING (o_orderkey) GROUP BY ALL),
totals AS (
  SELECT node, sum(w) AS weight, sum(w * y) / sum(w) AS p
  FROM three_bands JOIN node_of USING (o_orderkey) GROUP BY node),
gains AS (
  SELECT node, slot, feature, any_value(t.weight * 2 * t.p * (1 - t.p)) - sum(s.weight * 2 * s.p * (1 - s.p)) AS gain
  FROM sides AS s JOIN totals AS t USING (node) GROUP BY node, slot, feature),
splits AS (
  SELECT feature, gain FROM gains
  QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, slot) = 1 AND gain > 1e-9
  UNION ALL SELECT feature, gain FROM root),
scores AS (
  SELECT slot, feature, coalesce((SELECT sum(gain) FROM splits WHERE splits.feature = f.feature), 0)
                        / (SELECT sum(gain) FROM splits) AS score
  FROM (SELECT DISTINCT slot, feature FROM cells) AS f)
SELECT (row_number() OVER (ORDER BY score DESC, slot))::INTEGER AS rank, feature, round(score, 6) AS score
FROM scores"""


_RANKED = _ranked()
_FOLD_RANKED = "\nUNION ALL ".join(
    f"SELECT {i} AS fold, * FROM ({_ranked(f'SELECT * FROM three_bands WHERE {t.fold_sql("o_orderkey", 3)} <> {i}')})"
    for i in range(3)
)

ORACLES: dict[str, str] = {
    "dataset_shape": """
SELECT count(*) AS n_rows,
       (SELECT count(*)::INTEGER FROM information_schema.columns WHERE table_name = 'lineitem') AS n_columns
FROM lineitem""",
    "schema_report": f"""
WITH present AS (
  SELECT 'c_custkey' AS "column", count(c_custkey) AS n_values FROM customer
  UNION ALL SELECT 'c_name', count(c_name) FROM customer
  UNION ALL SELECT 'c_nationkey', count(c_nationkey) FROM customer
  UNION ALL SELECT 'c_acctbal', count(c_acctbal) FROM customer
  UNION ALL SELECT 'c_mktsegment', count(c_mktsegment) FROM customer)
SELECT (ordinal_position - 1)::INTEGER AS position, "column", {_TYPE_NAME} AS type,
       is_nullable = 'YES' AS nullable, n_values
FROM information_schema.columns JOIN present ON column_name = "column"
WHERE table_name = 'customer'""",
    "missing_counts": f"WITH {t.MISSING_SQL}{_GAPS}",
    "missing_columns": f"WITH {t.MISSING_SQL}, gaps AS ({_GAPS}) SELECT * FROM gaps WHERE n_missing > 0",
    "column_profile": f"""
WITH {t.MISSING_SQL}, gaps AS ({_GAPS}),
present AS (
  UNPIVOT (SELECT count(COLUMNS(*)) FROM with_missing) ON COLUMNS(*) INTO NAME "column" VALUE n_values)
SELECT "column", (SELECT count(*) FROM with_missing) AS n_rows, n_values, n_missing
FROM present JOIN gaps USING ("column")""",
    "class_balance": f"""
WITH {t.MISSING_SQL}
SELECT toxic, count(*) AS count, round(count(*) * 100.0 / (SELECT count(*) FROM with_missing), 6)::DOUBLE AS percent
FROM with_missing GROUP BY toxic""",
    "imbalance_flag": f"""
WITH {t.PLANTED_SQL}, classes AS (SELECT count(*) AS n FROM planted GROUP BY target)
SELECT round(min(n) * 100.0::DOUBLE / sum(n), 6) AS minority_percent,
       min(n) * 100.0::DOUBLE / sum(n) < 15 AS severe
FROM classes""",
    "csv_roundtrip": "SELECT * REPLACE (o_orderdate::DATE AS o_orderdate) FROM orders",
    "csv_with_schema": "SELECT * REPLACE (o_orderdate::DATE AS o_orderdate) FROM orders",
    "columns_present": """
SELECT "column", "column" IN (SELECT column_name FROM information_schema.columns WHERE table_name = 'orders') AS present,
       CASE "column" WHEN 'o_orderkey' THEN (SELECT count(o_orderkey) FROM orders)
                     WHEN 'o_orderdate' THEN (SELECT count(o_orderdate) FROM orders) END AS n_values
FROM (VALUES ('o_orderkey'), ('o_orderdate'), ('O_ORDERKEY'), ('n_name'), ('o_orderkey ')) AS names("column")""",
    "csv_rejected": """
SELECT CASE WHEN o_orderkey % 7 = 3 OR o_orderkey % 11 = 5 OR o_orderkey % 13 = 0 THEN 'rejected' ELSE 'kept' END AS side,
       count(*) AS n_rows, sum(o_orderkey)::BIGINT AS keys
FROM orders GROUP BY side""",
    "table_versions": """
SELECT back::INTEGER AS back, o_orderstatus, count(*) AS n_rows, sum(o_orderkey)::BIGINT AS keys
FROM orders, range(2) AS versions(back) WHERE back = 0 OR o_orderstatus <> 'F' GROUP BY back, o_orderstatus""",
    "parquet_roundtrip": f"""
WITH {t.WEIGHTED_SQL}
SELECT o_orderkey, c_mktsegment, target, round("classWeight", 6) AS "classWeight" FROM weighted""",
    "class_ratio": f"""
WITH {t.PLANTED_SQL}
SELECT count(*) FILTER (target = 'Yes') AS n_positive, count(*) FILTER (target = 'No') AS n_negative,
       round(count(*) FILTER (target = 'No') / count(*) FILTER (target = 'Yes'), 6) AS ratio
FROM planted""",
    "class_weight": """
WITH ratio AS (SELECT count(*) FILTER (toxic = 0) / count(*) FILTER (toxic = 1) AS r FROM labels)
SELECT doc_id, toxic, round(CASE WHEN toxic = 1 THEN r ELSE 1.0 END, 6) AS "classWeight"
FROM documents LEFT JOIN labels USING (doc_id), ratio""",
    "class_weight_lazy": f"""
WITH {t.WEIGHTED_SQL}
SELECT o_orderkey, target, round("classWeight", 6) AS "classWeight" FROM weighted""",
    "weight_totals": f"""
WITH {t.WEIGHTED_SQL}
SELECT target, count(*) AS n_rows, round(sum("classWeight"), 6) AS total_weight FROM weighted GROUP BY target""",
    "column_roles": f"""
WITH {t.PLANTED_SQL}
SELECT 'c_nationkey' AS "column", 'numeric' AS role, 0 AS slot, NULL::BIGINT AS n_categories
UNION ALL SELECT 'c_acctbal', 'numeric', 1, NULL
UNION ALL SELECT 'o_totalprice', 'numeric', 2, NULL
UNION ALL SELECT 'o_orderstatus', 'string', 3, count(DISTINCT o_orderstatus) FROM planted
UNION ALL SELECT 'o_orderpriority', 'string', 4, count(DISTINCT o_orderpriority) FROM planted
UNION ALL SELECT 'c_mktsegment', 'string', 5, count(DISTINCT c_mktsegment) FROM planted
UNION ALL SELECT 'target', 'target', NULL, count(DISTINCT target) FROM planted
UNION ALL SELECT 'classWeight', 'weight', NULL, NULL""",
    "category_counts": f"""
WITH {t.MISSING_SQL}
SELECT 'source' AS "column", source AS value, count(*) AS n FROM with_missing WHERE source IS NOT NULL GROUP BY source
UNION ALL SELECT 'lang_known', lang_known, count(*) FROM with_missing WHERE lang_known IS NOT NULL GROUP BY lang_known
UNION ALL SELECT 'note', note, count(*) FROM with_missing WHERE note IS NOT NULL GROUP BY note""",
    "string_index_skip": f"""
WITH {t.MISSING_SQL}, {_index('with_missing', 'source', 's')}, {_index('with_missing', 'lang_known', 'l')}
SELECT doc_id, source, lang_known, s.idx AS source_idx, l.idx AS lang_known_idx
FROM with_missing JOIN s ON source = s.value JOIN l ON lang_known = l.value""",
    "string_index_keep": f"""
WITH {t.MISSING_SQL}, {_index('with_missing', 'source', 's')}, {_index('with_missing', 'lang_known', 'l')}
SELECT doc_id, source, lang_known, coalesce(s.idx, (SELECT count(*) FROM s)::DOUBLE) AS source_idx,
       coalesce(l.idx, (SELECT count(*) FROM l)::DOUBLE) AS lang_known_idx
FROM with_missing LEFT JOIN s ON source = s.value LEFT JOIN l ON lang_known = l.value""",
    "category_table": f"""
WITH named AS (
  SELECT o_orderkey, c_name, nullif(o_orderpriority, '5-LOW') AS priority
  FROM orders JOIN customer ON o_custkey = c_custkey),
{_index('named', 'c_name', 'c')}, {_index('named', 'priority', 'p')}
SELECT 'c_name' AS "column", value, n, sum(n) OVER ()::BIGINT AS total, idx AS index FROM c
UNION ALL SELECT 'priority', value, n, sum(n) OVER ()::BIGINT, idx FROM p""",
    "string_index_joined": f"""
WITH named AS (
  SELECT o_orderkey, c_name, nullif(o_orderpriority, '5-LOW') AS priority
  FROM orders JOIN customer ON o_custkey = c_custkey),
{_index('named', 'c_name', 'c')}, {_index('named', 'priority', 'p')}
SELECT o_orderkey, c_name, priority, c.idx AS c_name_idx,
       coalesce(p.idx, (SELECT count(*) FROM p)::DOUBLE) AS priority_idx
FROM named LEFT JOIN c ON c_name = c.value LEFT JOIN p ON priority = p.value""",
    "string_cardinality": f"""
WITH {t.PLANTED_SQL},
named AS (
  SELECT c_name, nullif(o.o_orderpriority, '5-LOW') AS priority, planted.c_mktsegment
  FROM planted JOIN orders AS o USING (o_orderkey) JOIN customer ON o_custkey = c_custkey),
sizes AS (
  SELECT 'c_name' AS "column", count(*) AS n_rows, count(c_name) AS n_values, count(DISTINCT c_name) AS m FROM named
  UNION ALL SELECT 'priority', count(*), count(priority), count(DISTINCT priority) FROM named
  UNION ALL SELECT 'c_mktsegment', count(*), count(c_mktsegment), count(DISTINCT c_mktsegment) FROM named)
SELECT "column", n_rows, n_values, sum(m) OVER (ORDER BY m, "column") > 500 AS wide FROM sizes""",
    "share_table": f"""
WITH {t.WEIGHTED_SQL},
named AS (
  SELECT c_name, nullif(o.o_orderpriority, '5-LOW') AS priority, target, "classWeight" AS w
  FROM weighted JOIN orders AS o USING (o_orderkey) JOIN customer ON o_custkey = c_custkey),
{_shares('named', 'c_name', 'c')}, {_shares('named', 'priority', 'p')}
SELECT 'c_name' AS "column", value, n, sum(n) OVER ()::BIGINT AS total, idx AS index, unseen FROM c
UNION ALL SELECT 'priority', value, n, sum(n) OVER ()::BIGINT, idx, unseen FROM p""",
    "label_index": f"""
WITH {t.PLANTED_SQL}, {_index('planted', 'target', 'y')}
SELECT o_orderkey, target, y.idx AS label FROM planted JOIN y ON target = y.value""",
    "assemble": f"""
WITH {t.PLANTED_SQL}, {_index('planted', 'target', 'y')}, {_index('planted', 'o_orderstatus', 'a')},
{_index('planted', 'o_orderpriority', 'b')}, {_index('planted', 'c_mktsegment', 'c')}
SELECT o_orderkey, y.idx AS label, c_nationkey::DOUBLE AS slot0, c_acctbal AS slot1, o_totalprice AS slot2,
       a.idx AS slot3, b.idx AS slot4, c.idx AS slot5
FROM planted JOIN y ON target = y.value JOIN a ON o_orderstatus = a.value
JOIN b ON o_orderpriority = b.value JOIN c ON c_mktsegment = c.value""",
    "rank_features": _RANKED,
    "top_features": f"SELECT * FROM ({_RANKED}) WHERE rank <= 2",
    "project_top": f"""
WITH {t.WEIGHTED_SQL}
SELECT o_orderkey, target, round("classWeight", 6) AS "classWeight", c_mktsegment, o_totalprice FROM weighted""",
    "train_lr": _trained(_RIDGE),
    "train_rf": _trained(_SHARE),
    "train_gbt": _trained(_boosted(3)),
    "train_lr_wide": _RIDGE_BY_NAME,
    "train_rf_wide": _STUMP_BY_SHARE,
    "cv_lr_wide": _cross_validated("lr", _RIDGE),
    "cv_lr_fold_weights": _cross_validated_fold_weights("lr", _RIDGE),
    "cv_rf_fold_weights": _cross_validated_fold_weights("rf", _SHARE),
    "cv_resumed": f"SELECT * FROM ({_cross_validated('rf', _SHARE)}) UNION ALL SELECT * FROM ({_cross_validated('lr', _RIDGE)})",
    "fold_rankings": _FOLD_RANKED,
    "feature_contract": f"""
WITH known(slot, "column", role) AS (
  VALUES (0, 'c_nationkey', 'feature'), (1, 'c_acctbal', 'feature'), (2, 'o_totalprice', 'feature'),
         (3, 'o_orderstatus', 'feature'), (4, 'o_orderpriority', 'feature'), (5, 'c_mktsegment', 'feature')),
types AS (
  SELECT column_name, {_TYPE_NAME} AS type FROM information_schema.columns WHERE table_name IN ('orders', 'customer'))
SELECT "column", type, role, slot::INTEGER AS slot FROM known JOIN types ON column_name = "column"
UNION ALL SELECT 'target', 'string', 'target', NULL""",
    "random_folds": """
SELECT fold::INTEGER AS fold, (SELECT count(*) FROM orders) AS n_rows, true AS even FROM range(10) AS folds(fold)""",
    "hash_folds": f"SELECT o_orderkey, {t.fold_sql('o_orderkey', 10)} AS fold FROM orders",
    "fold_assembly": f"""
WITH {t.PLANTED_SQL}, folded AS (SELECT o_orderkey, {t.fold_sql('o_orderkey', 10)} AS fold FROM planted)
SELECT part::INTEGER AS fold, CASE WHEN fold = part THEN 'test' ELSE 'train' END AS side, count(*) AS n_rows,
       sum(o_orderkey)::BIGINT AS keys
FROM folded, range(10) AS parts(part) GROUP BY ALL""",
    "confusion_matrix": f"""
WITH {t.FIXED_SCORES_SQL}
SELECT label, prediction, count(*) AS n FROM fixed_scores GROUP BY label, prediction""",
    "metrics_table": f"""
WITH {t.FIXED_SCORES_SQL}, {t.metrics_sql('fixed_scores')}, {t.long_metrics_sql()}
SELECT n_rows, metric, round(value, 6) AS value FROM long_metrics""",
    "positive_class_metrics": f"""
WITH {t.FIXED_SCORES_SQL},
folded AS (SELECT *, {t.fold_sql('o_orderkey', CV_FOLDS)} AS fold FROM fixed_scores)
SELECT fold, round(avg(label) FILTER (prediction = 1), 6) AS positive_precision,
       round(avg(prediction) FILTER (label = 1), 6) AS positive_recall,
       round(2 * sum(label * prediction) / (sum(label) + sum(prediction)), 6) AS positive_f1
FROM folded GROUP BY fold""",
    "roc_auc": f"""
WITH {t.RIVAL_SCORES_SQL}, {t.metrics_sql('rival_scores', 'model')}
SELECT model, round(auc, 6) AS auc FROM measured""",
    "roc_auc_binned": f"""
WITH {t.FIXED_SCORES_SQL}, rounded AS (SELECT label, round(score, 3) AS score, prediction FROM fixed_scores),
{t.metrics_sql('rounded')}
SELECT round(auc, 6) AS auc FROM measured""",
    "roc_auc_binned_by_model": f"""
WITH {t.RIVAL_SCORES_SQL},
distinct_scores AS (SELECT DISTINCT model, score FROM rival_scores),
places AS (
  SELECT model, score, row_number() OVER (PARTITION BY model ORDER BY score DESC) - 1 AS place,
         greatest(count(*) OVER (PARTITION BY model) // 100, 1) AS grouping
  FROM distinct_scores),
chunked AS (
  SELECT model, label, prediction, -(place // grouping)::DOUBLE AS score
  FROM rival_scores AS r JOIN places AS p USING (model, score)),
{t.metrics_sql('chunked', 'model')}
SELECT model, round(auc, 6) AS auc FROM measured""",
    "cv_lr": _cross_validated("lr", _RIDGE),
    "cv_rf": _cross_validated("rf", _SHARE),
    "cv_gbt": _cross_validated("gbt", _boosted(3)),
    "cv_summary": f"""
WITH {_RIVAL_METRICS}, {t.long_metrics_sql('model, fold')}
SELECT model, metric, round(avg(value), 6) AS mean, round(avg(value) * 100, 2) AS pct, count(value) AS n_folds
FROM long_metrics GROUP BY model, metric""",
    "leaderboard": f"""
WITH {_RIVAL_METRICS},
means AS (
  SELECT model, avg(accuracy) AS accuracy, avg(precision) AS precision, avg(recall) AS recall,
         avg(f1) AS f1, avg(auc) AS auc
  FROM measured GROUP BY model)
SELECT (row_number() OVER (ORDER BY auc DESC, model))::INTEGER AS rank, model, round(accuracy, 6) AS accuracy,
       round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, round(auc, 6) AS auc
FROM means""",
    "model_roundtrip": _trained(_SHARE),
    "batch_score": _trained(_boosted(2)),
    "prediction_view": f"""
WITH {t.FIXED_SCORES_SQL}
SELECT o_orderkey, round(score, 4) AS "Heart_Attack_Probability", prediction::INTEGER AS "Predicted_Class"
FROM fixed_scores""",
    "prediction_sample": f"""
WITH {t.FIXED_SCORES_SQL}
SELECT o_orderkey, round(score, 4) AS "Heart_Attack_Probability", prediction::INTEGER AS "Predicted_Class"
FROM fixed_scores ORDER BY o_orderkey LIMIT 20""",
    "prediction_distribution": f"""
WITH {t.FIXED_SCORES_SQL}
SELECT prediction::INTEGER AS "Predicted_Class", count(*) AS count FROM fixed_scores GROUP BY prediction""",
}
