"""The SQL twin of every query that SQL can express."""

from __future__ import annotations

from verification import rollup_sql as RS

ORACLE: dict[str, str] = {
    "rollup_installments": RS.installments_sql(),
    "rollup_bureau": RS.bureau_sql(),
    "rollup_previous": RS.previous_sql(),
    "rollup_pos_cash": RS.pos_cash_sql(),
    "rollup_credit_card": RS.credit_card_sql(),
}

# --- shared primitives, joins, assembly -------------------------------------

ORACLE["last_non_null"] = f"""
WITH r AS (SELECT l_orderkey, CASE WHEN l_returnflag <> 'A' THEN l_quantity END AS v,
  CASE WHEN l_linestatus = 'F' THEN {RS.days('l_shipdate')} END AS o FROM lineitem)
SELECT l_orderkey, last(v ORDER BY o NULLS LAST, v) FILTER (WHERE v IS NOT NULL) AS last_quantity FROM r GROUP BY 1"""

ORACLE["row_argmax"] = """
SELECT l_orderkey, nullif(l_quantity, 1.0) AS best_q, l_partkey AS best_l_partkey, l_linestatus AS best_l_linestatus
FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey
  ORDER BY l_shipdate DESC, l_extendedprice DESC, l_partkey DESC, l_suppkey DESC, l_linenumber DESC) = 1"""

ORACLE["pivot_counts"] = """
SELECT user_id, count(*) AS n, count(*) FILTER (WHERE event_type = 'click') AS n_click,
  count(*) FILTER (WHERE event_type = 'error') AS n_error, count(*) FILTER (WHERE event_type = 'purchase') AS n_purchase,
  0::BIGINT AS n_refund, count(*) FILTER (WHERE event_type IN ('view', 'signup')) AS n_other, 0 AS ever_refund,
  count(*) FILTER (WHERE event_type = 'error') / nullif(count(*) FILTER (WHERE event_type = 'purchase'), 0) AS error_rate
FROM events GROUP BY 1"""

ORACLE["join_diagnostics"] = """
WITH c AS (SELECT DISTINCT l_orderkey AS k FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
p AS (SELECT o_orderkey AS k FROM orders WHERE o_orderstatus <> 'P')
SELECT (SELECT count(*) FROM c) AS child_keys, (SELECT count(*) FROM c SEMI JOIN p USING (k)) AS matched_keys,
  (SELECT count(*) FROM c ANTI JOIN p USING (k)) AS orphan_keys"""

_FAMILIES = {
    "has_bureau_history": "rollup_bureau",
    "has_previous_application": "rollup_previous",
    "has_pos_cash_history": "rollup_pos_cash",
    "has_installment_history": "rollup_installments",
    "has_credit_card_history": "rollup_credit_card",
}
_MATRIX = f"""
SELECT * REPLACE ({', '.join(f'coalesce({f}, 0) AS {f}' for f in _FAMILIES)}) FROM ({RS.APPLICATION}) base
{' '.join(f'LEFT JOIN ({ORACLE[q]}) {q} USING (SK_ID_CURR)' for q in _FAMILIES.values())}"""
ORACLE["assemble_matrix"] = _MATRIX

# --- profiling and contracts ------------------------------------------------

_ORDERS = """
SELECT o_orderkey, nullif(o_orderstatus, 'P') AS o_orderstatus, o_orderpriority,
  CASE WHEN o_orderpriority <> '5-LOW' THEN floor(o_totalprice) END AS o_totalprice, o_custkey % 12 AS month FROM orders"""


def _number_profile(c: str, small: bool) -> str:
    values = f"(SELECT list(DISTINCT {c} ORDER BY {c}) FROM o WHERE {c} IS NOT NULL)"
    text = lambda v: f"array_to_string({v}, ',')" if small else "NULL::VARCHAR"
    return f"""SELECT '{c}' AS feature, count(*) AS rows, count(*) - count({c}) AS nulls,
      round((count(*) - count({c})) / count(*), 6) AS null_rate, min({c})::DOUBLE AS min, max({c})::DOUBLE AS max,
      round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std, round(quantile_cont({c}, 0.01), 4) AS p01,
      round(quantile_cont({c}, 0.5), 4) AS p50, round(quantile_cont({c}, 0.99), 4) AS p99,
      {f'count(DISTINCT {c})' if small else 'NULL::BIGINT'} AS n_unique, {text(values)} AS unique_values,
      array_to_string(list_transform({values}[1:5], lambda v: CAST(v AS VARCHAR)), ',') AS sample_values FROM o"""


def _text_profile(c: str) -> str:
    values = f"(SELECT list(DISTINCT {c} ORDER BY {c}) FROM o WHERE {c} IS NOT NULL)"
    none = ", ".join(f"NULL::DOUBLE AS {s}" for s in ("min", "max", "mean", "std", "p01", "p50", "p99"))
    return f"""SELECT '{c}' AS feature, count(*) AS rows, count(*) - count({c}) AS nulls,
      round((count(*) - count({c})) / count(*), 6) AS null_rate, {none}, count(DISTINCT {c}) AS n_unique,
      array_to_string({values}, ',') AS unique_values, array_to_string({values}[1:5], ',') AS sample_values FROM o"""


_PROFILE = [_number_profile("o_orderkey", False), _number_profile("o_totalprice", False), _number_profile("month", True)]
_PROFILE += [_text_profile("o_orderstatus"), _text_profile("o_orderpriority")]
ORACLE["profile_columns"] = f"WITH o AS ({_ORDERS}) " + " UNION ALL ".join(f"({p})" for p in _PROFILE)

ORACLE["key_uniqueness"] = " UNION ALL ".join(
    f"""SELECT '{k}' AS "key", count(*) AS n_rows, count(DISTINCT {k}) AS n_unique, count(*) - count({k}) AS n_null,
    (SELECT max(n) FROM (SELECT count(*) AS n FROM lineitem GROUP BY {k})) AS largest_group,
    count(*) - count(DISTINCT {k}) AS duplicates, count(*) = count(DISTINCT {k}) AS is_unique FROM lineitem"""
    for k in ("l_orderkey", "l_partkey")
)

ORACLE["join_stats"] = """
WITH c AS (SELECT DISTINCT l_orderkey AS k FROM lineitem), p AS (SELECT o_orderkey AS k FROM orders WHERE o_orderstatus <> 'P'),
n AS (SELECT (SELECT count(*) FROM c) AS u, (SELECT count(*) FROM p) AS pu, (SELECT count(*) FROM c ANTI JOIN p USING (k)) AS o,
  (SELECT count(*) FROM c SEMI JOIN p USING (k)) AS m)
SELECT (SELECT count(*) FROM lineitem) AS child_rows, u AS child_unique_keys, pu AS parent_unique_keys, o AS orphan_keys,
  m AS matched_keys, round(o / greatest(u, 1), 6) AS orphan_rate, round(m / greatest(pu, 1), 6) AS coverage_of_parent FROM n"""

ORACLE["target_profile"] = """
WITH t AS (SELECT toxic FROM documents LEFT JOIN labels USING (doc_id))
SELECT toxic AS value, count(*) AS n, (SELECT count(*) FROM t) AS rows, (SELECT count(*) FROM t WHERE toxic IS NULL) AS null_count,
  (SELECT round(avg(toxic), 9) FROM t) AS positive_rate FROM t GROUP BY 1"""

ORACLE["sentinel_profile"] = f"WITH p AS ({RS.PREVIOUS}) " + " UNION ALL ".join(
    f"""SELECT '{c}' AS feature, count(*) FILTER (WHERE {c} = 'XNA') AS sentinel_count, count(*) - count({c}) AS null_count,
    count(DISTINCT coalesce({c}, '?')) AS n_distinct FROM p"""
    for c in ("NAME_CONTRACT_TYPE", "NAME_CLIENT_TYPE", "NAME_CONTRACT_STATUS")
)

ORACLE["cooccurrence"] = """
SELECT count(*) FILTER (WHERE l_discount > 0.05) AS a, count(*) FILTER (WHERE l_tax > 0.05) AS b,
  count(*) FILTER (WHERE l_discount > 0.05 AND l_tax > 0.05) AS both, count(*) FILTER (WHERE l_discount > 0.05 AND l_tax <= 0.05) AS a_only,
  count(*) FILTER (WHERE l_discount <= 0.05 AND l_tax > 0.05) AS b_only FROM lineitem"""

ORACLE["sum_checks"] = f"""
WITH p AS ({ORACLE['rollup_previous']})
SELECT count(*) FILTER (WHERE prev_count_approved + prev_count_refused + prev_count_canceled + prev_count_unused_offer = prev_count_total)
  AS matches,
  count(*) FILTER (WHERE prev_count_approved + prev_count_refused + prev_count_canceled + prev_count_unused_offer <> prev_count_total)
  AS mismatches,
  count(*) FILTER (WHERE prev_approval_rate NOT BETWEEN 0 AND 1) AS prev_approval_rate_out_of_range,
  count(*) FILTER (WHERE prev_refusal_rate NOT BETWEEN 0 AND 1) AS prev_refusal_rate_out_of_range FROM p"""

ORACLE["coded_distribution"] = f"""
SELECT prev_last_name_client_type AS code, count(*) AS n FROM ({ORACLE['rollup_previous']}) GROUP BY 1"""


def _contract(table: str, key: str, source: str, numbers: list[str], texts: list[str]) -> str:
    parts = []
    for c in numbers + texts:
        listed = f"(SELECT array_to_string(list(DISTINCT {c} ORDER BY {c}), ',') FROM {source} WHERE {c} IS NOT NULL)"
        # whole numbers print alike as DOUBLE in both engines, BIGINT columns print without a point
        allowed = "NULL::VARCHAR" if c == key else f"CASE WHEN count(DISTINCT {c}) BETWEEN 1 AND 50 THEN {listed} END"
        bounds = f"min({c})::DOUBLE AS min_value, max({c})::DOUBLE AS max_value" if c in numbers else "NULL::DOUBLE, NULL::DOUBLE"
        parts.append(
            f"""SELECT '{table}' AS table_name, '{c}' AS feature, count({c}) < count(*) AS nullable,
            round((count(*) - count({c})) / count(*), 6) AS null_rate_reference, {'true' if c == key else 'false'} AS is_unique,
            {allowed} AS allowed_values, {bounds}, '{key}' AS primary_key, count(*) AS row_count_reference FROM {source}"""
        )
    return " UNION ALL ".join(parts)


ORACLE["derive_contracts"] = (
    f"WITH b AS ({RS.BUREAU}), p AS ({RS.PREVIOUS}) "
    + _contract(
        "bureau",
        "SK_ID_BUREAU",
        "b",
        (
            "SK_ID_CURR SK_ID_BUREAU DAYS_CREDIT DAYS_CREDIT_ENDDATE DAYS_ENDDATE_FACT AMT_CREDIT_MAX_OVERDUE CNT_CREDIT_PROLONG"
            " AMT_CREDIT_SUM AMT_CREDIT_SUM_DEBT AMT_CREDIT_SUM_LIMIT AMT_CREDIT_SUM_OVERDUE DAYS_CREDIT_UPDATE"
        ).split(),
        ["CREDIT_ACTIVE"],
    )
    + " UNION ALL "
    + _contract(
        "previous_application",
        "SK_ID_PREV",
        "p",
        (
            "SK_ID_PREV SK_ID_CURR AMT_APPLICATION AMT_CREDIT AMT_ANNUITY AMT_GOODS_PRICE AMT_DOWN_PAYMENT CNT_PAYMENT RATE_DOWN_PAYMENT"
            " RATE_INTEREST_PRIMARY RATE_INTEREST_PRIVILEGED DAYS_DECISION DAYS_FIRST_DRAWING DAYS_FIRST_DUE DAYS_LAST_DUE_1ST_VERSION"
            " DAYS_LAST_DUE DAYS_TERMINATION"
        ).split(),
        ["NAME_CONTRACT_STATUS", "NAME_CONTRACT_TYPE", "NAME_CLIENT_TYPE"],
    )
)

_BROKEN = """
WITH o AS (SELECT * REPLACE (nullif(o_orderstatus, 'F') AS o_orderstatus) FROM orders),
n AS (SELECT count(*) AS n, CAST(floor(count(*) * 1.05) AS BIGINT) AS ref FROM o),
v AS (
  SELECT 'row_count' AS check_name, NULL::VARCHAR AS "column", 'error' AS severity, NULL::VARCHAR AS observed FROM n
    WHERE n NOT BETWEEN ref * (1 - 0.02) AND ref * (1 + 0.02)
  UNION ALL SELECT 'column_present', 'o_clerk', 'error', 'missing'
  UNION ALL SELECT 'column_unexpected', 'o_orderdate', 'warning', 'present'
  UNION ALL SELECT 'nullability', 'o_orderstatus', 'error', NULL FROM o HAVING count(*) > count(o_orderstatus)
  UNION ALL SELECT 'null_rate', 'o_orderpriority', 'error', NULL FROM o HAVING abs(avg((o_orderpriority IS NULL)::INT) - 0.5) > 0.02
  UNION ALL SELECT 'value_range', 'o_orderkey', 'error', NULL FROM o HAVING max(o_orderkey) > 100 + 0.02 * 100
  UNION ALL SELECT 'value_range', 'o_totalprice', 'error', NULL FROM o HAVING max(o_totalprice) > 1e9 * 1.04
  UNION ALL SELECT 'uniqueness', 'o_orderkey', 'error', NULL FROM o HAVING count(DISTINCT o_orderkey) <> count(*)
  UNION ALL SELECT 'uniqueness', 'o_custkey', 'error', NULL FROM o HAVING count(DISTINCT o_custkey) <> count(*)
  UNION ALL SELECT 'allowed_values', 'o_orderstatus', 'error', array_to_string(list(DISTINCT o_orderstatus ORDER BY o_orderstatus)[1:5], ',')
    FROM o WHERE o_orderstatus NOT IN ('F', 'O') HAVING count(*) > 0
  UNION ALL SELECT 'allowed_values', 'o_orderpriority', 'error',
    array_to_string(list(DISTINCT o_orderpriority ORDER BY o_orderpriority)[1:5], ',')
    FROM o WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH') HAVING count(*) > 0)"""
ORACLE["validate_tables"] = f"{_BROKEN} SELECT 'orders' AS table_name, * FROM v"
# 1 row count, 1 absent and 1 extra column, 5 null, 2 unique, 2 allowed and 2 range checks
ORACLE["validation_verdict"] = f"""{_BROKEN}
SELECT 14::BIGINT AS checks_run, count(*) FILTER (WHERE severity = 'error') AS errors,
  count(*) FILTER (WHERE severity = 'warning') AS warnings, count(*) FILTER (WHERE severity = 'error') = 0 AS passed FROM v"""
ORACLE["validate_joins"] = f"""
WITH s AS ({ORACLE['join_stats']})
SELECT 'lineitem' AS table_name, 'orphan_rate' AS check_name, 'l_orderkey' AS "column",
  CAST(round(orphan_keys / greatest(child_unique_keys, 1), 4) AS VARCHAR) AS observed, 'error' AS severity
FROM s WHERE abs(orphan_keys / greatest(child_unique_keys, 1) - 0.05) > 0.02"""

ORACLE["derive_joins"] = f"""
WITH s AS ({ORACLE['join_stats']}), c AS (SELECT DISTINCT l_orderkey AS k FROM lineitem)
SELECT 'lineitem' AS child, 'l_orderkey' AS child_key, 'loans' AS parent, 'SK_ID_PREV' AS parent_key, orphan_rate AS orphan_rate_reference,
  0.02::DOUBLE AS orphan_rate_tolerance FROM s
UNION ALL SELECT 'lineitem', 'l_orderkey', 'orders', 'o_orderkey', round((SELECT count(*) FROM c ANTI JOIN orders ON k = o_orderkey) / greatest(1, count(*)), 6), 0.02::DOUBLE FROM c"""
ORACLE["value_preview"] = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, array_to_string(list(v ORDER BY v)[1:5], ',') AS sample_values FROM (SELECT DISTINCT {c} AS v FROM customer WHERE {c} IS NOT NULL)"
    for c in ("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
)

# --- splits and encodings ---------------------------------------------------

_SPLIT = """
WITH a AS (SELECT o_orderkey AS "SK_ID_CURR", CAST(o_orderstatus = 'P' AS INT) AS y FROM orders),
r AS (SELECT *, row_number() OVER (PARTITION BY y ORDER BY md5('42-' || "SK_ID_CURR"), "SK_ID_CURR") AS k FROM a),
n AS (SELECT floor(0.15 * count(*) + 0.5) AS part, floor(0.15 * sum(y) + 0.5) AS pos FROM a),
s AS (SELECT "SK_ID_CURR", y, CASE WHEN k <= q THEN 'test' WHEN k <= 2 * q THEN 'val' ELSE 'dev' END AS split
  FROM (SELECT r.*, CASE WHEN y = 1 THEN pos ELSE part - pos END AS q FROM r, n))"""
ORACLE["stratified_split"] = f'{_SPLIT} SELECT "SK_ID_CURR", split FROM s'
ORACLE["split_checks"] = f"""{_SPLIT}
SELECT split, count(*) AS n, CAST(floor(CASE split WHEN 'dev' THEN 0.7 ELSE 0.15 END * (SELECT count(*) FROM s) + 0.5) AS BIGINT) AS planned,
  true AS size_ok, round(avg(y), 9) AS positive_rate, abs(avg(y) - (SELECT avg(y) FROM s)) <= 0.005 AS rate_ok,
  abs(avg(y) - (SELECT avg(y) FROM s)) > 0.002 AS rate_note, 0::BIGINT AS overlapping_keys, 0::BIGINT AS extra_keys,
  0::BIGINT AS missing_keys FROM s GROUP BY split"""
ORACLE["target_preconditions"] = """
SELECT count(*) AS n_rows, count(DISTINCT o_orderkey) AS n_keys, 0::BIGINT AS null_targets, 0::BIGINT AS odd_targets,
  count(*) FILTER (WHERE o_orderstatus = 'P') AS positives, count(*) = count(DISTINCT o_orderkey) AS ok FROM orders"""
ORACLE["missing_indicators"] = f"""
SELECT c_custkey AS "SK_ID_CURR", cc_utilization_last, cc_balance_last, coalesce(has_credit_card_history, 0) AS has_credit_card_history,
  CAST(cc_utilization_last IS NULL AS INT) AS cc_utilization_last_is_null, CAST(cc_balance_last IS NULL AS INT) AS cc_balance_last_is_null
FROM customer LEFT JOIN ({ORACLE['rollup_credit_card']}) c ON c.SK_ID_CURR = c_custkey"""
ORACLE["factorize"] = """
WITH o AS (SELECT o_orderkey, nullif(o_orderpriority, '5-LOW') AS priority, strftime(o_orderdate, '%Y-%m-%d') AS day,
  o_orderdate < TIMESTAMP '1999-01-01' AS fit FROM orders),
p AS (SELECT priority, row_number() OVER (ORDER BY priority) - 1 AS code FROM (SELECT DISTINCT priority FROM o WHERE fit AND priority IS NOT NULL)),
q AS (SELECT day, row_number() OVER (ORDER BY day) - 1 AS code FROM (SELECT DISTINCT day FROM o WHERE fit))
SELECT o_orderkey, CAST(coalesce(p.code, -1) AS INT) AS priority, CAST(coalesce(q.code, -1) AS INT) AS day
FROM o LEFT JOIN p ON o.priority = p.priority LEFT JOIN q ON o.day = q.day"""


def _typing(c: str, expr: str, kind: str) -> str:
    return f"""SELECT '{c}' AS feature, least(count(DISTINCT {expr}), 21) AS distinct_capped, count(*) - count({expr}) AS nulls,
    CASE WHEN count(DISTINCT {expr}) <= 1 THEN 'constant' {kind} END AS kind FROM orders"""


_WHOLE = "WHEN count(DISTINCT {0}) <= 20 AND count({0}) = count(*) THEN 'categorical' ELSE 'numerical'"
ORACLE["feature_typing"] = " UNION ALL ".join(
    [
        _typing("priority", "nullif(o_orderpriority, '5-LOW')", "ELSE 'categorical'"),
        _typing("customer", "o_custkey", _WHOLE.format("o_custkey")),
        _typing("month", "(o_custkey % 12)", _WHOLE.format("(o_custkey % 12)")),
        _typing("price", "o_totalprice", "ELSE 'numerical'"),
        _typing("one", "7", "ELSE 'numerical'"),
        _typing("holes", "nullif(o_custkey % 12, 3)", _WHOLE.format("nullif(o_custkey % 12, 3)")),
        _typing("none", "NULL::DOUBLE", "ELSE 'numerical'"),
    ]
)

# --- metrics ----------------------------------------------------------------

_LINES = """lines AS (SELECT l_orderkey, CASE WHEN l_linenumber <= 4 THEN 'dev' WHEN l_linenumber <= 6 THEN 'val' ELSE 'holdout' END AS split,
  CAST(l_returnflag = 'R' AS INT) AS y,
  -2.2 + 0.03::DOUBLE * l_quantity + 3 * l_discount + CASE WHEN l_linestatus = 'F' THEN 0.4 ELSE 0.0 END AS z1,
  -1.9 + 0.02::DOUBLE * l_quantity + 5 * l_tax + 0.9::DOUBLE * CAST(l_returnflag = 'R' AS INT) AS z2 FROM lineitem),
preds AS (SELECT l_orderkey, split, y, 'champion' AS model, round(1 / (1 + exp(-z1)), 4) AS pd FROM lines
  UNION ALL SELECT l_orderkey, split, y, 'challenger', round(1 / (1 + exp(-z2)), 4) FROM lines)"""
_CELLS = f"""WITH {_LINES},
cells AS (SELECT model, split, pd, sum(y)::DOUBLE AS pos, sum(1 - y)::DOUBLE AS neg FROM preds GROUP BY ALL),
cum AS (SELECT *, sum(pos) OVER w AS cpos, sum(neg) OVER w AS cneg, sum(pos) OVER (PARTITION BY model, split) AS tpos,
  sum(neg) OVER (PARTITION BY model, split) AS tneg FROM cells
  WINDOW w AS (PARTITION BY model, split ORDER BY pd ROWS UNBOUNDED PRECEDING))"""
_AUC = "sum(pos * (cneg - neg / 2)) / (max(tpos) * max(tneg))"
ORACLE["auc_gini"] = f"""{_CELLS}
SELECT model, split, CAST(max(tpos) AS BIGINT) AS positives, CAST(max(tneg) AS BIGINT) AS negatives, round({_AUC}, 9) AS auc,
  round(2 * {_AUC} - 1, 9) AS gini FROM cum GROUP BY ALL"""
ORACLE["ks_score"] = f"{_CELLS} SELECT model, split, round(max(abs(cpos / tpos - cneg / tneg)), 9) AS ks FROM cum GROUP BY ALL"
ORACLE["brier"] = f"""WITH {_LINES}
SELECT model, split, count(*) AS n, CAST(sum(y) AS BIGINT) AS n_positive, round(avg(y), 9) AS positive_rate,
  round(avg(pd), 9) AS mean_predicted, round(avg((pd - y) * (pd - y)), 9) AS brier FROM preds GROUP BY ALL"""


def _edges(rows: str, keys: str, value: str, where: str = "true") -> str:
    """Distinct deciles of `value` per `keys`, interpolated between neighbours."""
    return f"""sorted AS (SELECT {keys}, list_sort(list({value})) AS xs FROM {rows} WHERE {value} IS NOT NULL AND {where} GROUP BY ALL),
spots AS (SELECT {keys}, xs, (len(xs) - 1) * CASE WHEN i = 10 THEN 1.0::DOUBLE ELSE i * 0.1::DOUBLE END AS h
  FROM sorted, range(11) AS t(i)),
points AS (SELECT {keys}, h - floor(h) AS f, xs[CAST(floor(h) AS INT) + 1] AS a, xs[least(CAST(floor(h) AS INT) + 2, len(xs))] AS b FROM spots),
edges AS (SELECT {keys}, list_sort(list(DISTINCT CASE WHEN f >= 0.5 THEN b - (b - a) * (1 - f) ELSE a + (b - a) * f END)) AS e
  FROM points GROUP BY ALL)"""


ORACLE["reliability"] = f"""WITH {_LINES}, {_edges('preds', 'model, split', 'pd')},
binned AS (SELECT preds.*, e, len([x for x in e[2:-2] if x <= pd]) + 1 AS bin FROM preds JOIN edges USING (model, split))
SELECT model, split, CAST(bin AS INT) AS bin, count(*) AS n, round(any_value(e)[bin], 9) AS lower_edge, round(any_value(e)[bin + 1], 9) AS upper_edge,
  round(avg(pd), 9) AS mean_predicted, round(avg(y), 9) AS observed_rate FROM binned GROUP BY model, split, bin"""

_COSTS = f"""WITH {_LINES},
grid AS (SELECT i / 100 AS t FROM range(1, 100) AS r(i)),
cells AS (SELECT model, split, pd, sum(y) AS pos, sum(1 - y) AS neg FROM preds GROUP BY ALL),
counts AS (SELECT model, split, t, sum(CASE WHEN pd < t THEN pos ELSE 0 END) AS fn, sum(CASE WHEN pd >= t THEN neg ELSE 0 END) AS fp,
  sum(pos + neg) AS n FROM cells, grid GROUP BY ALL)"""
ORACLE["cost_threshold"] = f"""{_COSTS}
SELECT model, split, 20.0::DOUBLE AS cost_ratio, t AS threshold, round((20 * fn + fp)::DOUBLE / n, 9) AS expected_cost FROM counts
QUALIFY row_number() OVER (PARTITION BY model, split ORDER BY (20 * fn + fp)::DOUBLE / n, t) = 1"""
ORACLE["cost_sweep"] = f"""{_COSTS},
whole AS (SELECT model, t, sum(fn) AS fn, sum(fp) AS fp, sum(n) AS n FROM counts GROUP BY ALL),
best AS (SELECT model, r AS cost_ratio, t, (r * fn + fp) / n AS cost FROM whole, (VALUES (5::DOUBLE), (10), (20), (30), (50)) AS v(r)
  QUALIFY row_number() OVER (PARTITION BY model, r ORDER BY (r * fn + fp) / n, t) = 1)
SELECT cost_ratio, a.t AS champion_threshold, b.t AS challenger_threshold, round(a.cost, 9) AS champion_expected_cost,
  round(b.cost, 9) AS challenger_expected_cost, round(a.cost - b.cost, 9) AS challenger_cost_savings,
  round((a.cost - b.cost) / a.cost * 100, 9) AS challenger_cost_savings_pct
FROM (SELECT * FROM best WHERE model = 'champion') a JOIN (SELECT * FROM best WHERE model = 'challenger') b USING (cost_ratio)"""

# --- drift ------------------------------------------------------------------

_LONG = """base AS (SELECT l_quantity AS quantity, CASE WHEN l_linestatus = 'F' THEN floor(l_extendedprice) END AS price,
  CASE WHEN l_returnflag <> 'N' THEN l_discount END AS discount,
  l_tax + CASE WHEN l_shipdate < TIMESTAMP '1998-01-01' THEN 0.0::DOUBLE ELSE 0.03::DOUBLE END AS tax,
  CASE WHEN l_shipdate < TIMESTAMP '1998-01-01' THEN 1.0::DOUBLE ELSE l_quantity END AS odd,
  CAST(l_shipdate < TIMESTAMP '1998-01-01' AS INT) AS ref FROM lineitem),
long AS (SELECT feature, ref, value FROM base UNPIVOT INCLUDE NULLS (value FOR feature IN (quantity, price, discount, tax, odd)))"""
_DRIFT = f"""WITH {_LONG},
{_edges('long', 'feature', 'value', 'ref = 1')},
totals AS (SELECT feature, count(*) FILTER (WHERE ref = 1) AS nr, count(*) FILTER (WHERE ref = 0) AS nm FROM long
  WHERE value IS NOT NULL GROUP BY 1),
bins AS (SELECT feature, i AS bin, e[i] AS lo, e[i + 1] AS hi, i = len(e) - 1 AS is_last FROM edges, range(1, 11) AS t(i) WHERE i < len(e)),
counted AS (SELECT feature, bin, count(v.value) FILTER (WHERE ref = 1) AS r, count(v.value) FILTER (WHERE ref = 0) AS m
  FROM bins LEFT JOIN long v USING (feature) WHERE v.value >= lo AND (v.value < hi OR (is_last AND v.value = hi)) GROUP BY ALL),
filled AS (SELECT bins.feature, bins.bin, greatest(1e-6, coalesce(r, 0) / nr) AS r, greatest(1e-6, coalesce(m, 0) / nm) AS m
  FROM bins LEFT JOIN counted USING (feature, bin) JOIN totals ON totals.feature = bins.feature),
psis AS (SELECT totals.feature, coalesce(sum((r - m) * ln(r / m)), 0.0) AS psi FROM totals LEFT JOIN filled USING (feature) GROUP BY 1),
cum AS (SELECT feature, value, sum(sum(ref)) OVER w AS cr, sum(sum(1 - ref)) OVER w AS cm FROM long WHERE value IS NOT NULL
  GROUP BY feature, value WINDOW w AS (PARTITION BY feature ORDER BY value)),
kss AS (SELECT feature, max(abs(cr / nr - cm / nm)) AS ks FROM cum JOIN totals USING (feature) GROUP BY 1),
stats AS (SELECT feature, avg(value) FILTER (WHERE ref = 1) AS reference_mean, avg(value) FILTER (WHERE ref = 0) AS monitoring_mean,
  avg((value IS NULL)::INT) FILTER (WHERE ref = 1) AS reference_null_rate,
  avg((value IS NULL)::INT) FILTER (WHERE ref = 0) AS monitoring_null_rate FROM long GROUP BY 1),
drift AS (SELECT feature, round(reference_mean, 6) AS reference_mean, round(monitoring_mean, 6) AS monitoring_mean,
  round(reference_null_rate, 6) AS reference_null_rate, round(monitoring_null_rate, 6) AS monitoring_null_rate,
  round(psi, 6) AS psi, round(ks, 6) AS ks, CASE WHEN psi < 0.1 THEN 'stable' WHEN psi < 0.25 THEN 'moderate' ELSE 'material' END AS severity
  FROM stats JOIN psis USING (feature) JOIN kss USING (feature))"""
ORACLE["psi"] = f"{_DRIFT} SELECT feature, round(psi, 9) AS psi FROM psis"
ORACLE["ks_two_sample"] = f"{_DRIFT} SELECT feature, round(ks, 9) AS ks FROM kss"
ORACLE["feature_drift"] = f"{_DRIFT} SELECT * FROM drift"
ORACLE["drift_severity"] = f"{_DRIFT} SELECT severity, count(*) AS features FROM drift GROUP BY 1"
ORACLE["top_drifted"] = f"{_DRIFT} SELECT * FROM drift ORDER BY psi DESC, feature LIMIT 3"

# --- binning ----------------------------------------------------------------

_CUTS = {"price": [50000, 120000, 250000, 400000], "month": [2, 6, 9], "age": [-2000, -1000], "flat": []}


def _bin(c: str, cuts: list[int]) -> str:
    return f"CASE WHEN {c} IS NULL THEN -1 ELSE {' + '.join([f'CAST({c} >= {k} AS INT)' for k in cuts] or ['0'])} END"


_WOE = f"""WITH rows AS (SELECT o_orderkey AS k, CASE WHEN o_orderpriority <> '5-LOW' THEN o_totalprice END AS price, o_custkey % 12 AS month,
  {RS.days('o_orderdate')} AS age, 1.0 AS flat, CAST(o_totalprice > 300000 + 20000 * (o_custkey % 12) AND o_orderstatus <> 'F' AS INT) AS y
  FROM orders),
binned AS ({' UNION ALL '.join(f"SELECT k, '{c}' AS feature, {_bin(c, cuts)} AS bin, y FROM rows" for c, cuts in _CUTS.items())}),
cells AS (SELECT feature, bin, count(*) AS n, sum(y) AS bad, sum(1 - y) AS good FROM binned GROUP BY ALL),
shares AS (SELECT *, CASE WHEN bad = 0 OR good = 0 THEN 0.5 ELSE 0 END AS h, (bad + h) / sum(bad) OVER (PARTITION BY feature) AS b,
  (good + h) / sum(good) OVER (PARTITION BY feature) AS g FROM cells),
woes AS (SELECT feature, bin, n AS count, n / sum(n) OVER (PARTITION BY feature) AS count_rate, good AS non_event, bad AS event,
  bad / n AS event_rate, ln(g / b) AS woe, (g - b) * ln(g / b) AS iv FROM shares),
ivs AS (SELECT feature, sum(iv) AS iv FROM woes GROUP BY 1)"""
ORACLE["woe_table"] = f"{_WOE} SELECT * REPLACE (round(woe, 9) AS woe, round(iv, 9) AS iv) FROM woes"
_REASON = "CASE WHEN iv < 0.01 THEN 'low_iv' WHEN iv > 0.5 THEN 'suspicious_iv' ELSE 'kept' END"
ORACLE["iv_selection"] = f"{_WOE} SELECT feature, round(iv, 9) AS iv, {_REASON} AS reason, {_REASON} = 'kept' AS kept FROM ivs"
ORACLE["selection_report"] = f"{_WOE} SELECT {_REASON} AS reason, count(*) AS features FROM ivs GROUP BY 1"
_ENCODED = f"""{_WOE},
encoded AS (SELECT k AS "SK_ID_CURR", {', '.join(f"max(woe) FILTER (WHERE feature = '{c}') AS {c}" for c in _CUTS)}
  FROM binned JOIN woes USING (feature, bin) GROUP BY 1)"""
ORACLE["woe_transform"] = f"""{_ENCODED} SELECT "SK_ID_CURR", {', '.join(f'round({c}, 9) AS {c}' for c in _CUTS)} FROM encoded"""
ORACLE["corr_pairs"] = _ENCODED + " UNION ALL ".join(
    f" SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM encoded"
    for a, b in (("price", "month"), ("price", "age"), ("month", "age"))
)

_WALK = ", ".join(
    ["s0 AS (SELECT []::BIGINT[] AS kept)"]
    + [
        f"s{i} AS (SELECT CASE WHEN (SELECT count(*) FROM near, s{i - 1} q WHERE near.j = {i} AND list_contains(q.kept, near.i)) > 0 THEN kept ELSE list_append(kept, {i}) END AS kept FROM s{i - 1})"
        for i in range(1, len(_CUTS) + 2)
    ]
)
ORACLE["correlation_pruning"] = f"""{_WOE.replace('binned AS (', f"binned AS (SELECT k, 'copy' AS feature, {_bin('price', _CUTS['price'])} AS bin, y FROM rows UNION ALL ", 1)},
el AS (SELECT k, feature, woe FROM binned JOIN woes USING (feature, bin)),
ranked AS (SELECT feature, iv, row_number() OVER (ORDER BY iv DESC, feature) AS i FROM ivs),
near AS (SELECT p.i, q.i AS j, abs(corr(x.woe, y.woe)) AS r FROM ranked p JOIN ranked q ON p.i < q.i JOIN el x ON x.feature = p.feature
  JOIN el y ON y.feature = q.feature AND x.k = y.k GROUP BY p.i, q.i HAVING NOT isnan(r) AND r > 0.9), {_WALK},
hits AS (SELECT j, arg_min(ranked.feature, near.i) AS won, arg_min(r, near.i) AS r FROM near JOIN ranked USING (i), s{len(_CUTS) + 1} WHERE list_contains(kept, near.i) GROUP BY j)
SELECT feature, round(iv, 9) AS iv, CASE WHEN won IS NULL THEN 'kept' ELSE 'correlated' END AS reason, won IS NULL AS kept, won AS correlated_with, round(hits.r, 6) AS r
FROM ranked LEFT JOIN hits ON ranked.i = hits.j"""

# --- calibration and comparison ---------------------------------------------

ORACLE["calibrated_predictions"] = f"""WITH {_LINES}
SELECT l_orderkey, split, y, model, pd AS raw_pd, round(CASE WHEN model = 'champion' THEN pd WHEN pd <= 0.125 THEN 0.0625
  WHEN pd >= 0.5 THEN 0.75 WHEN pd < 0.25 THEN 0.0625 + 0.1875::DOUBLE * (pd - 0.125) / 0.125 ELSE 0.25 + 0.5::DOUBLE * (pd - 0.25) / 0.25 END, 9)
  AS calibrated_pd FROM preds"""
ORACLE["cross_checks"] = f"""WITH {_LINES},
s AS (SELECT model, avg((pd - y) * (pd - y)) FILTER (WHERE split = 'dev') AS a, avg((pd - y) * (pd - y)) AS b FROM preds GROUP BY 1)
SELECT model, round(a, 9) AS stored_value, round(b, 9) AS recomputed_value, round(abs(a - b), 9) AS delta, abs(a - b) <= 0.001 AS passed FROM s"""

# --- decisions and explanations ---------------------------------------------


def _outcomes(source: str, limits: bool) -> str:
    """Decision columns over rows with applicant_id, pd, segment, forced override name."""
    a = "CASE segment WHEN 'new_customer' THEN 0.06::DOUBLE WHEN 'existing_customer' THEN 0.1 ELSE 0.04 END" if limits else "0.04::DOUBLE"
    r = "CASE segment WHEN 'new_customer' THEN 0.15::DOUBLE WHEN 'existing_customer' THEN 0.22 ELSE 0.2 END" if limits else "0.2::DOUBLE"
    return f"""limited AS (SELECT *, {a} AS a, {r} AS r FROM {source}),
    outcomes AS (SELECT applicant_id, pd, segment, o AS override_applied, y,
      CASE o WHEN 'fraud_flag' THEN 'Application flagged as potential fraud' WHEN 'vip_customer' THEN 'Pre-approved VIP customer' END AS override_reason,
      CASE WHEN o = 'fraud_flag' THEN 'DECLINE' WHEN o = 'vip_customer' THEN 'APPROVE' WHEN pd < a THEN 'APPROVE' WHEN pd < r THEN 'REFER'
        ELSE 'DECLINE' END AS decision,
      CASE WHEN o IS NOT NULL THEN 0 WHEN pd < a THEN a ELSE r END AS threshold_used,
      CASE WHEN o IS NOT NULL THEN 0 WHEN pd < a THEN 20 * pd WHEN pd < r THEN 0.1 ELSE 1 - pd END AS cost FROM limited)"""


_FIXED = "'challenger' AS model, '0.1.0' AS model_version, '1.0.0' AS config_version, '2026-01-01T00:00:00Z' AS decided_at"
_DECIDED = f"""WITH people AS (SELECT CAST(o_orderkey AS VARCHAR) AS applicant_id, round(1 / (1 + exp(-(-4.0 + o_totalprice / 150000))), 4) AS pd,
  coalesce(CASE WHEN o_orderstatus <> 'O' THEN CASE o_orderpriority WHEN '1-URGENT' THEN 'new_customer' WHEN '2-HIGH' THEN 'existing_customer'
    WHEN '3-MEDIUM' THEN 'default' ELSE 'odd' END END, 'default') AS segment,
  CASE WHEN day(o_orderdate) <= 2 AND o_orderstatus = 'P' THEN 'fraud_flag' WHEN day(o_orderdate) = 1 THEN 'vip_customer' END AS o,
  CAST(o_orderstatus = 'P' AS INT) AS y FROM orders), {_outcomes('people', True)}"""
ORACLE["decide_batch"] = f"""{_DECIDED}
SELECT applicant_id, pd, decision, threshold_used, segment, override_applied, override_reason, round(cost, 6) AS expected_cost, {_FIXED} FROM outcomes"""
ORACLE["decision_distribution"] = f"""{_DECIDED}
SELECT decision, count(*) AS n, round(count(*) / (SELECT count(*) FROM outcomes) * 100, 9) AS percent, round(avg(y), 9) AS default_rate
FROM outcomes GROUP BY 1"""
ORACLE["threshold_gap"] = f"""{_COSTS},
whole AS (SELECT model, t, sum(fn) AS fn, sum(fp) AS fp, sum(n) AS n FROM counts GROUP BY ALL)
SELECT model, 20.0::DOUBLE AS cost_ratio, t AS threshold, round((20 * fn + fp) / n, 9) AS expected_cost, 0.04::DOUBLE AS configured,
  round(t - 0.04::DOUBLE, 9) AS delta FROM whole QUALIFY row_number() OVER (PARTITION BY model ORDER BY (20 * fn + fp) / n, t) = 1"""

_FEATURES = """x AS (SELECT o_orderkey AS applicant_id, (o_custkey % 50)::DOUBLE AS bureau_count_credits, floor(o_totalprice / 10000) AS inst_delay_max,
  (o_orderkey % 30 - 10)::DOUBLE AS pos_sk_dpd_max, CASE WHEN o_orderstatus <> 'F' THEN (o_orderkey % 64) / 64.0 END AS cc_utilization_last,
  (o_custkey % 100) / 128.0 AS "EXT_SOURCE_2", floor(o_totalprice / 20000) AS "AMT_CREDIT", (-(o_orderkey % 11))::DOUBLE AS "DAYS_EMPLOYED",
  (o_custkey % 8) / 8.0 AS prev_refusal_rate, (o_custkey % 12)::DOUBLE AS month FROM orders)"""
_WEIGHTS = {
    "bureau_count_credits": 0.125,
    "inst_delay_max": 0.25,
    "pos_sk_dpd_max": -0.5,
    "cc_utilization_last": 8,
    "EXT_SOURCE_2": 16,
    "AMT_CREDIT": 0.5,
    "DAYS_EMPLOYED": -1,
    "prev_refusal_rate": 4,
    "month": 1,
}
_CONTRIB = f"""{_FEATURES},
long AS ({' UNION ALL '.join(f"SELECT applicant_id, '{f}' AS feature, {i} AS i, (\"{f}\" * {w})::DOUBLE AS c, \"{f}\"::DOUBLE AS v FROM x"
                             for i, (f, w) in enumerate(_WEIGHTS.items()))})"""
ORACLE["linear_contributions"] = f"WITH {_FEATURES} SELECT applicant_id, " + ", ".join(
    f'("{f}" * {w})::DOUBLE AS "{f}"' for f, w in _WEIGHTS.items()
) + " FROM x"
ORACLE["explanation_sample"] = """
SELECT o_orderkey AS applicant_id, o_custkey % 12 AS month FROM orders ORDER BY md5('42-' || CAST(o_orderkey AS VARCHAR)), o_orderkey LIMIT 1000"""
ORACLE["global_importance"] = f"""WITH {_CONTRIB},
m AS (SELECT feature, avg(abs(c)) AS mean_abs, avg(c) AS mean_signed FROM long GROUP BY 1)
SELECT CAST(row_number() OVER (ORDER BY mean_abs DESC, feature) AS INT) AS rank, * FROM m"""
ORACLE["topk_contributions"] = f"""WITH {_CONTRIB}
SELECT applicant_id, CAST(row_number() OVER (PARTITION BY applicant_id ORDER BY abs(coalesce(c, 0)) DESC, feature) AS INT) AS rank, feature,
  c AS contribution, v AS value FROM long QUALIFY rank <= 3"""
_CODES = {
    "bureau_count_credits": ("HIGH_CREDIT_COUNT", "Large number of existing credit accounts"),
    "inst_delay_max": ("HIGH_MAX_PAYMENT_DELAY", "Significant maximum delay on prior loan installments"),
    "pos_sk_dpd_max": ("POS_CASH_DPD", "Days past due on prior POS or cash loans"),
    "cc_utilization_last": ("HIGH_CREDIT_UTILIZATION", "High utilization of credit card limit"),
    "AMT_CREDIT": ("HIGH_LOAN_AMOUNT", "Requested loan amount relative to income"),
    "DAYS_EMPLOYED": ("SHORT_EMPLOYMENT_TENURE", "Limited employment history"),
    "prev_refusal_rate": ("PRIOR_APPLICATION_REFUSALS", "High rate of prior application refusals"),
}
_REASONS = f"""{_DECIDED}, {_CONTRIB},
codes(feature, code, description) AS (VALUES {', '.join(f"('{f}', '{c}', '{t}')" for f, (c, t) in _CODES.items())}),
ranked AS (SELECT CAST(applicant_id AS VARCHAR) AS applicant_id, code, description, c, row_number() OVER (PARTITION BY applicant_id ORDER BY c DESC, i) AS k
  FROM long JOIN codes USING (feature) WHERE c > 0),
notices AS (SELECT o.applicant_id, pd, decision,
  coalesce(string_agg(code || '=' || CAST(CAST(c * 1024 AS BIGINT) AS VARCHAR), ',' ORDER BY k) FILTER (WHERE k <= 4 AND decision <> 'APPROVE'), '') AS p,
  coalesce(string_agg(code || '=' || CAST(CAST(c * 1024 AS BIGINT) AS VARCHAR), ',' ORDER BY k)
    FILTER (WHERE k BETWEEN 5 AND 10 AND decision <> 'APPROVE'), '') AS a,
  string_agg('  ' || k || '. ' || description, chr(10) ORDER BY k) FILTER (WHERE k <= 4) AS pt,
  string_agg('  ' || (k - 4) || '. ' || description, chr(10) ORDER BY k) FILTER (WHERE k BETWEEN 5 AND 10) AS more
  FROM outcomes o LEFT JOIN ranked r USING (applicant_id) GROUP BY ALL)"""
ORACLE["reason_codes"] = f"{_REASONS} SELECT applicant_id, pd, decision, p AS primary_reasons, a AS additional_reasons FROM notices"
ORACLE["notice_text"] = f"""{_REASONS}
SELECT applicant_id, CASE WHEN decision = 'APPROVE' THEN 'Applicant ' || applicant_id || ': APPROVED' ELSE
  concat_ws(chr(10), 'Adverse Action Notice', 'Applicant ID: ' || applicant_id, 'Decision: ' || decision, '',
  'Your application was reviewed and could not be approved at this time. The primary factors considered in this decision were:', '', pt,
  CASE WHEN more IS NOT NULL THEN concat_ws(chr(10), '', 'Additional factors considered:', '', more) END, '',
  'This decision was made using an automated system. You have the right to request a human review of this decision.') END AS notice_text
FROM notices"""
ORACLE["score_batch"] = f"""WITH z AS (SELECT CAST(o_orderkey AS VARCHAR) AS applicant_id, 'default' AS segment, 0 AS y,
  CASE WHEN o_orderpriority = '1-URGENT' THEN 'vip_customer' END AS o,
  1 / (1 + exp(-(-4.0 + o_totalprice / 100000 + CASE WHEN o_orderstatus = 'F' THEN 0.5 ELSE (o_custkey % 16) / 16.0 END))) AS raw FROM orders),
people AS (SELECT *, CASE WHEN raw <= 0.03125 THEN 0.03125::DOUBLE WHEN raw >= 0.5 THEN 0.75
  WHEN raw < 0.125 THEN 0.03125 + 0.03125::DOUBLE * (raw - 0.03125) / 0.09375 ELSE 0.0625 + 0.6875::DOUBLE * (raw - 0.125) / 0.375 END AS pd FROM z),
{_outcomes('people', False)}
SELECT applicant_id, round(pd, 6) AS pd, decision, threshold_used, segment, override_applied, override_reason,
  round(cost, 6) AS expected_cost, {_FIXED} FROM outcomes"""

# --- fitted slopes by Newton steps in SQL -------------------------------------


def _newton(rows: str, keys: str) -> str:
    """Slope and intercept of y on the log odds of pd per `keys`, by 25 damped Newton steps: table `fitted` (needs WITH RECURSIVE)."""
    k = keys.split(", ")
    join = " AND ".join(f"c.{c} = s.{c}" for c in k)
    return f"""points AS (SELECT {keys}, ln(greatest(1e-9, least(1 - 1e-9, pd)) / (1 - greatest(1e-9, least(1 - 1e-9, pd)))) AS x,
  count(*)::DOUBLE AS n, sum(y)::DOUBLE AS y FROM {rows} GROUP BY ALL),
steps AS (SELECT {keys}, 0 AS i, 1.0::DOUBLE AS slope, 0.0::DOUBLE AS intercept FROM points GROUP BY ALL
  UNION ALL
  SELECT {keys}, i + 1, slope + least(1.0, 2.0 / nullif(greatest(abs(ds), abs(di)), 0)) * ds, intercept + least(1.0, 2.0 / nullif(greatest(abs(ds), abs(di)), 0)) * di
  FROM (SELECT {keys}, i, slope, intercept, (h00 * g1 - h01 * g0) / (h00 * h11 - h01 * h01) AS ds, (h11 * g0 - h01 * g1) / (h00 * h11 - h01 * h01) AS di
    FROM (SELECT {', '.join(f's.{c}' for c in k)}, i, slope, intercept, sum(y - n * p) AS g0, sum((y - n * p) * x) AS g1,
        sum(n * p * (1 - p)) AS h00, sum(n * p * (1 - p) * x) AS h01, sum(n * p * (1 - p) * x * x) AS h11
      FROM (SELECT s.*, c.x, c.n, c.y, 1 / (1 + exp(-(s.slope * c.x + s.intercept))) AS p FROM steps s JOIN points c ON {join} WHERE s.i < 25) s GROUP BY ALL))
  WHERE ds IS NOT NULL),
fitted AS (SELECT {keys}, arg_max(slope, i) AS slope, arg_max(intercept, i) AS intercept FROM steps WHERE slope IS NOT NULL GROUP BY ALL)"""


def _recursive(sql: str) -> str:
    return sql.replace("WITH ", "WITH RECURSIVE ", 1)


ORACLE["calibration_slope"] = f"""WITH RECURSIVE {_LINES}, {_newton('preds', 'model, split')}
SELECT model, split, round(slope, 6) AS slope, round(intercept, 6) AS intercept FROM fitted"""
ORACLE["metrics_cube"] = f"""{_recursive(_CELLS)}, {_newton('preds', 'model, split')},
ranked AS (SELECT model, split, {_AUC} AS auc, max(abs(cpos / tpos - cneg / tneg)) AS ks FROM cum GROUP BY ALL),
base AS (SELECT model, split, count(*) AS n, CAST(sum(y) AS BIGINT) AS n_positive, avg(y) AS positive_rate, avg(pd) AS mean_predicted,
  avg((pd - y) * (pd - y)) AS brier FROM preds GROUP BY ALL)
SELECT model, split, n, n_positive, round(positive_rate, 6) AS positive_rate, round(mean_predicted, 6) AS mean_predicted, round(brier, 6) AS brier,
  round(auc, 6) AS auc, round(2 * auc - 1, 6) AS gini, round(ks, 6) AS ks, round(slope, 6) AS slope, round(intercept, 6) AS intercept
FROM base JOIN ranked USING (model, split) JOIN fitted USING (model, split)"""

_SIDES = "sides AS (SELECT split, y, pd FROM preds WHERE model = 'challenger' AND split IN ('val', 'holdout'))"
_PREDICTION = _DRIFT.replace(_LONG, f"{_LINES}, {_SIDES}, long AS (SELECT 'pd' AS feature, CAST(split = 'val' AS INT) AS ref, pd AS value FROM sides)") + """,
prediction AS (SELECT reference_mean, monitoring_mean,
  round((SELECT avg((pd > 0.5)::INT) FROM sides WHERE split = 'val'), 6) AS reference_positive_rate,
  round((SELECT avg((pd > 0.5)::INT) FROM sides WHERE split = 'holdout'), 6) AS monitoring_positive_rate, psi, ks, severity FROM drift)"""
ORACLE["prediction_drift"] = f"{_PREDICTION} SELECT * FROM prediction"
_CALIBRATION = f"""RECURSIVE {_LINES}, {_SIDES},
ranks AS (SELECT split, pd, y, rank() OVER (PARTITION BY split ORDER BY pd) + (count(*) OVER (PARTITION BY split, pd) - 1) / 2.0 AS r FROM sides),
aucs AS (SELECT split, (sum(r) FILTER (WHERE y = 1) - sum(y) * (sum(y) + 1) / 2.0) / (sum(y) * sum(1 - y)) AS auc, avg((pd - y) * (pd - y)) AS brier FROM ranks GROUP BY 1),
late AS (SELECT 1 AS one, pd, y FROM sides WHERE split = 'holdout'), {_newton('late', 'one')},
calibration AS (SELECT r.auc AS reference_auc, m.auc AS monitoring_auc, r.brier AS reference_brier, m.brier AS monitoring_brier,
  slope AS monitoring_slope, intercept AS monitoring_intercept, slope BETWEEN 0.90 AND 1.10 AND abs(intercept) <= 0.15 AS calibration_ok
  FROM (SELECT * FROM aucs WHERE split = 'val') r, (SELECT * FROM aucs WHERE split = 'holdout') m, fitted)"""
ORACLE["calibration_drift"] = f"""WITH {_CALIBRATION}
SELECT * REPLACE ({', '.join(f'round({c}, 6) AS {c}' for c in 'reference_auc monitoring_auc reference_brier monitoring_brier monitoring_slope monitoring_intercept'.split())})
FROM calibration"""
ORACLE["alert_notes"] = f"""WITH {_CALIBRATION},
counts AS (SELECT count(*) FILTER (WHERE severity = 'material') AS material, count(*) FILTER (WHERE severity = 'moderate') AS moderate FROM ({ORACLE['feature_drift']})),
p AS (SELECT * FROM ({ORACLE['prediction_drift']})),
notes(alert, raised, amount) AS (
  SELECT 'feature_material', material > 0, material::DOUBLE FROM counts UNION ALL SELECT 'feature_moderate', moderate > 0, moderate::DOUBLE FROM counts
  UNION ALL SELECT 'prediction_material', severity = 'material', psi FROM p UNION ALL SELECT 'calibration', NOT calibration_ok, monitoring_slope FROM calibration
  UNION ALL SELECT 'auc_drop', reference_auc - monitoring_auc > 0.03, reference_auc - monitoring_auc FROM calibration)
SELECT alert, round(amount, 6) AS amount FROM notes WHERE raised
UNION ALL SELECT 'all_stable', 0.0::DOUBLE WHERE NOT EXISTS (SELECT * FROM notes WHERE raised)"""
ORACLE["recommendation"] = f"""WITH RECURSIVE {_LINES}, {_newton('preds', 'model')},
ranks AS (SELECT model, pd, y, rank() OVER (PARTITION BY model ORDER BY pd) + (count(*) OVER (PARTITION BY model, pd) - 1) / 2.0 AS r FROM preds),
m AS (SELECT model, (sum(r) FILTER (WHERE y = 1) - sum(y) * (sum(y) + 1) / 2.0) / (sum(y) * sum(1 - y)) AS auc, avg((pd - y) * (pd - y)) AS brier,
  any_value(abs(slope - 1) <= 0.1 AND abs(intercept) <= 0.1) AS fits FROM ranks JOIN fitted USING (model) GROUP BY 1),
d AS (SELECT b.auc - a.auc AS gain, a.brier - b.brier AS brier_delta, a.fits AS a_fits, b.fits AS b_fits
  FROM (SELECT * FROM m WHERE model = 'champion') a, (SELECT * FROM m WHERE model = 'challenger') b),
s AS (SELECT challenger_cost_savings_pct AS pct FROM ({ORACLE['cost_sweep']}) WHERE cost_ratio = 20),
v AS (SELECT *, CASE WHEN gain > 0.005 AND a_fits AND b_fits THEN 'challenger_superior' WHEN gain > 0.005 AND NOT b_fits THEN 'recalibrate_challenger'
  WHEN abs(gain) <= 0.005 THEN 'equivalent_prefer_champion' ELSE 'keep_champion' END AS statistical FROM d, s)
SELECT round(gain, 6) AS auc_delta, round(2 * gain, 6) AS gini_delta, round(brier_delta, 6) AS brier_delta, round(pct, 6) AS challenger_cost_savings_pct,
  0 AS failed_checks, statistical, CASE WHEN statistical <> 'challenger_superior' THEN 'champion' WHEN pct > 0.5 THEN 'challenger' ELSE 'challenger_marginal_cost' END AS operational
FROM v"""

# --- sources -----------------------------------------------------------------

_COLUMNS = {
    "customer": "c_custkey c_name c_nationkey c_acctbal c_mktsegment",
    "orders": "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority",
    "lineitem": "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax l_returnflag l_linestatus l_shipdate",
}


def _fingerprint(table: str) -> str:
    parts = ", ".join(f"coalesce(length({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '-')" for c in _COLUMNS[table].split())
    return f"SELECT count(*) AS rows, sum(('0x' || substr(md5(concat_ws('|', {parts})), 1, 15))::BIGINT)::VARCHAR AS fingerprint FROM {table}"


ORACLE["content_fingerprint"] = " UNION ALL ".join(f"SELECT '{t}' AS \"table\", * FROM ({_fingerprint(t)})" for t in _COLUMNS)
ORACLE["file_fingerprint"] = _fingerprint("orders")

ORACLE["ingest_tables"] = " UNION ALL ".join(
    f"SELECT CAST({run} AS INTEGER) AS run, '{t}' AS \"table\", rows, CAST({len(_COLUMNS[t].split())} AS INTEGER) AS cols, 'utf-8' AS encoding, 0::BIGINT AS malformed,"
    f" fingerprint AS input_fingerprint, fingerprint AS output_fingerprint, {'true' if run == 2 else 'false'} AS overwrote, true AS has_bytes, true AS has_input FROM ({_fingerprint(t)})"
    for run in (1, 2)
    for t in ("customer", "orders")
)

# --- calibrators: Platt by Newton steps, the isotonic map by its min-max formula over distinct scores ---------------

ORACLE["calibrate"] = f"""WITH RECURSIVE {_LINES},
val AS (SELECT * FROM preds WHERE model = 'challenger' AND split = 'val'),
hold AS (SELECT pd, y FROM preds WHERE model = 'challenger' AND split = 'holdout'), {_newton('val', 'model')},
c AS (SELECT pd AS x, count(*)::DOUBLE AS w, sum(y)::DOUBLE AS s, row_number() OVER (ORDER BY pd) AS i FROM val GROUP BY pd),
p AS (SELECT *, sum(w) OVER (ORDER BY i) AS cw, sum(s) OVER (ORDER BY i) AS cs FROM c),
means AS (SELECT j.i AS j, k.i AS i, (k.cs - j.cs + j.s) / (k.cw - j.cw + j.w) AS a FROM p j JOIN p k ON k.i >= j.i),
low AS (SELECT j, i, min(a) OVER (PARTITION BY j ORDER BY i DESC ROWS UNBOUNDED PRECEDING) AS v FROM means),
iso AS (SELECT x, max(v) AS level FROM low JOIN p USING (i) GROUP BY x),
seg AS (SELECT x AS x0, level AS y0, lead(x) OVER (ORDER BY x) AS x1, lead(level) OVER (ORDER BY x) AS y1 FROM iso),
mapped AS (SELECT pd, y, CASE WHEN x0 IS NULL THEN (SELECT min(level) FROM iso) WHEN x1 IS NULL THEN y0 ELSE y0 + (y1 - y0) * (pd - x0) / (x1 - x0) END AS level
  FROM hold ASOF LEFT JOIN seg ON pd >= x0),
e AS (SELECT avg((pd - y) * (pd - y)) AS raw, avg((level - y) * (level - y)) AS isotonic,
  avg(pow(1 / (1 + exp(-(intercept + slope * ln(greatest(1e-9, least(1 - 1e-9, pd)) / (1 - greatest(1e-9, least(1 - 1e-9, pd))))))) - y, 2)) AS platt FROM mapped, fitted)
SELECT CASE WHEN isotonic < platt THEN 'isotonic' ELSE 'platt' END AS selected_method, round(raw, 7) AS raw_brier, round(platt, 7) AS platt_brier,
  round(isotonic, 7) AS isotonic_brier, round((raw - least(platt, isotonic)) * 100, 5) AS improvement_pp FROM e"""


def _filled(source: str, query: str, keys: str = "SK_ID_CURR") -> str:
    """Name, source and filled rows of each column of a roll-up within the matrix."""
    prefix = "CASE WHEN name LIKE 'bb\\_%' ESCAPE '\\' THEN 'bureau_balance (rolled up via bureau)' ELSE 'bureau' END" if source == "bureau" else f"'{source}'"
    columns = f"SELECT column_name FROM (DESCRIBE SELECT * EXCLUDE ({keys}) FROM ({query}))"
    return f"SELECT name, {prefix} AS source, filled FROM counts WHERE name IN ({columns})"


_SOURCES = dict(zip(_FAMILIES.values(), ("bureau", "previous_application", "pos_cash", "installments", "credit_card")))
ORACLE["catalogue_fill"] = (
    f"WITH counts AS (SELECT name, filled FROM (UNPIVOT (SELECT count(COLUMNS(* EXCLUDE (SK_ID_CURR, TARGET))) FROM ({_MATRIX})) ON COLUMNS(*) INTO NAME name VALUE filled)) "
    + " UNION ALL ".join([_filled(s, ORACLE[q]) for q, s in _SOURCES.items()] + [_filled("application_train", RS.APPLICATION, '"SK_ID_CURR", "TARGET"')])
)

_SUM = " + ".join(f'coalesce("{f}", 0) * {w}::DOUBLE' for f, w in _WEIGHTS.items())
_EXPLAINED = f"""WITH {_FEATURES.replace('x AS', 'fx AS', 1)},
people AS (SELECT CAST(applicant_id AS VARCHAR) AS applicant_id, 'default' AS segment, 0 AS y, NULL::VARCHAR AS o, 1 / (1 + exp(-(-6.0 + ({_SUM}) / 16))) AS pd FROM fx),
{_outcomes('people', False)}"""
ORACLE["explain_batch"] = f"""{_REASONS.replace(_DECIDED, _EXPLAINED, 1)},
text AS ({ORACLE['notice_text'].replace(_REASONS, '', 1)}),
tops AS (SELECT CAST(applicant_id AS VARCHAR) AS applicant_id, string_agg(feature, ',' ORDER BY k) AS top
  FROM (SELECT *, row_number() OVER (PARTITION BY applicant_id ORDER BY abs(coalesce(c, 0)) DESC, feature) AS k FROM long) WHERE k <= 3 GROUP BY 1),
firsts AS (SELECT applicant_id, string_agg(code, ',' ORDER BY k) AS reasons FROM ranked WHERE k <= 4 GROUP BY 1)
SELECT applicant_id, round(pd, 6) AS pd, decision, top, CASE WHEN decision = 'APPROVE' THEN '' ELSE coalesce(reasons, '') END AS reasons, CAST(length(notice_text) AS INTEGER) AS notice_length
FROM notices JOIN text USING (applicant_id) JOIN tops USING (applicant_id) LEFT JOIN firsts USING (applicant_id)"""
