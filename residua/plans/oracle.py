"""SQL twins of the bindings: common table expressions the oracle queries build on.

They say the same in the plainest way SQL has (row numbers over everything, window sums), independent of how the
Spark operators get there.
"""

from __future__ import annotations

LINEITEM_BASE = """
SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS INTEGER)) AS record_key,
       CASE WHEN l_returnflag = 'N' THEN 'Benign' ELSE 'Malicious' END AS label,
       CASE WHEN l_returnflag = 'N' THEN '-' ELSE l_returnflag END AS detailed_label,
       l_quantity, l_extendedprice, l_discount, l_tax, l_linestatus,
       lpad(CAST(month(l_shipdate) AS VARCHAR), 2, '0') AS ship_month
FROM lineitem
"""

EVENTS_BASE = """
SELECT event_id, user_id,
       CASE WHEN event_type = 'error' THEN 'Malicious' ELSE 'Benign' END AS label,
       event_type AS detailed_label, value,
       CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k,
       CAST(hour(ts) AS DOUBLE) AS hour_of_day,
       CAST(user_id % 8 AS VARCHAR) AS user_bucket
FROM events
"""

GAPS_BASE = f"""
WITH clean AS ({LINEITEM_BASE}), gaps AS (
  SELECT record_key,
         CASE WHEN l_quantity <> 13 THEN ' ' || upper(label) || ' ' ELSE label END AS label,
         detailed_label,
         CASE WHEN l_quantity = 50 THEN CAST('inf' AS DOUBLE) ELSE l_quantity END AS l_quantity,
         l_extendedprice, nullif(l_discount, 0.0) AS l_discount, nullif(l_tax, 0.08) AS l_tax,
         CASE WHEN l_quantity <> 7 THEN l_linestatus END AS l_linestatus, ship_month
  FROM clean)
SELECT * FROM gaps
UNION ALL
SELECT * REPLACE (record_key || '-again' AS record_key) FROM gaps WHERE l_tax = 0.0 AND l_discount IS NULL
"""


def even(expression: str, places: int) -> str:
    """Scale, round half to even, scale back."""
    factor = f"1e{places}::DOUBLE"
    return f"(round_even(({expression}) * {factor}, 0) / {factor})"


def split_ctes(base: str, key: str, label: str = "label", seed: int = 42) -> str:
    """``base``, class quotas and ``sp``: every row with its split."""
    return f"""
base AS ({base}),
classes AS (SELECT {label} AS cl, count(*) AS n FROM base GROUP BY 1),
sized AS (SELECT cl, n, (sum(n) OVER ())::BIGINT AS total FROM classes),
test_draw AS (SELECT *, ceil(total * 0.15::DOUBLE)::BIGINT AS draws FROM sized),
test_floor AS (SELECT *, floor((draws * n)::DOUBLE / total)::BIGINT AS fl,
                      (draws * n)::DOUBLE / total - floor((draws * n)::DOUBLE / total) AS rem FROM test_draw),
test_quota AS (SELECT cl, n, total, draws,
                      fl + CASE WHEN row_number() OVER (ORDER BY rem DESC, cl)
                                     <= draws - (sum(fl) OVER ())::BIGINT THEN 1 ELSE 0 END AS n_test FROM test_floor),
val_draw AS (SELECT *, n - n_test AS rest_n, total - draws AS rest,
                    ceil((total - draws) * (0.15::DOUBLE / (1.0::DOUBLE - 0.15::DOUBLE)))::BIGINT AS vdraws FROM test_quota),
val_floor AS (SELECT *, floor((vdraws * rest_n)::DOUBLE / rest)::BIGINT AS vfl,
                     (vdraws * rest_n)::DOUBLE / rest - floor((vdraws * rest_n)::DOUBLE / rest) AS vrem FROM val_draw),
quotas AS (SELECT cl, n_test, vfl + CASE WHEN row_number() OVER (ORDER BY vrem DESC, cl)
                     <= vdraws - (sum(vfl) OVER ())::BIGINT THEN 1 ELSE 0 END AS n_val FROM val_floor),
placed AS (SELECT *, row_number() OVER (PARTITION BY {label} ORDER BY md5('{seed}:' || CAST({key} AS VARCHAR))) AS place
           FROM base),
sp AS (SELECT p.* EXCLUDE (place),
              CASE WHEN place <= n_test THEN 'test' WHEN place <= n_test + n_val THEN 'val' ELSE 'train' END AS split
       FROM placed p JOIN quotas q ON p.{label} = q.cl)"""


def scored_ctes(
    base: str, key: str, numeric: tuple[str, ...], categorical: tuple[str, ...], places: int = 6
) -> str:
    """Continue to ``feat`` (error per feature), ``scored``, ``thr`` and ``fl`` (flags) for the mean reconstructor."""
    moments = ", ".join(
        f"avg({c}) AS m_{c}, CASE WHEN stddev_pop({c}) = 0 THEN 1.0 ELSE stddev_pop({c}) END AS s_{c}" for c in numeric
    )
    shares = "".join(
        f"cat_{c} AS (SELECT {c} AS v, count(*)::DOUBLE / (SELECT count(*) FROM train) AS p FROM train GROUP BY 1),\n"
        f"sq_{c} AS (SELECT sum(p * p) AS sq, count(*) AS w FROM cat_{c}),\n"
        for c in categorical
    )
    width = " + ".join([str(len(numeric)), *[f"(SELECT w FROM sq_{c})" for c in categorical]])
    number_errors = [f"pow((sp.{c} - st.m_{c}) / st.s_{c}, 2) AS err_{c}" for c in numeric]
    category_errors = [
        f"CASE WHEN cat_{c}.p IS NULL THEN (SELECT sq FROM sq_{c}) "
        f"ELSE 1.0 - 2.0 * cat_{c}.p + (SELECT sq FROM sq_{c}) END AS err_{c}"
        for c in categorical
    ]
    joins = " ".join(f"LEFT JOIN cat_{c} ON sp.{c} = cat_{c}.v" for c in categorical)
    errors = " + ".join(f"err_{c}" for c in numeric + categorical)
    return f"""{split_ctes(base, key)},
train AS (SELECT * FROM sp WHERE split = 'train' AND label = 'Benign'),
st AS (SELECT {moments} FROM train),
{shares}width AS (SELECT ({width})::DOUBLE AS d),
feat AS (SELECT sp.*, {", ".join(number_errors + category_errors)} FROM sp CROSS JOIN st {joins}),
scored AS (SELECT *, {even(f"({errors}) / (SELECT d FROM width)", places)} AS mse_score FROM feat),
thr AS (SELECT quantile_cont(mse_score, 0.99) AS t FROM scored WHERE split = 'val' AND label = 'Benign'),
fl AS (SELECT *, mse_score > (SELECT t FROM thr) AS flagged, label <> 'Benign' AS is_malicious FROM scored),
test AS (SELECT * FROM fl WHERE split = 'test')"""


LINEITEM_NUMERIC = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
LINEITEM_CATEGORICAL = ("l_linestatus", "ship_month")
EVENTS_NUMERIC = ("value", "k", "hour_of_day")
EVENTS_CATEGORICAL = ("user_bucket",)

LINEITEM_SPLIT = "WITH " + split_ctes(LINEITEM_BASE, "record_key")
EVENTS_SPLIT = "WITH " + split_ctes(EVENTS_BASE, "event_id")
LINEITEM_SCORED = "WITH " + scored_ctes(LINEITEM_BASE, "record_key", LINEITEM_NUMERIC, LINEITEM_CATEGORICAL)
EVENTS_SCORED = "WITH " + scored_ctes(EVENTS_BASE, "event_id", EVENTS_NUMERIC, EVENTS_CATEGORICAL)

CONFUSION = """
conf AS (SELECT count(*) FILTER (flagged AND is_malicious) AS tp, count(*) FILTER (flagged AND NOT is_malicious) AS fp,
                count(*) FILTER (NOT flagged AND NOT is_malicious) AS tn,
                count(*) FILTER (NOT flagged AND is_malicious) AS fn FROM test),
prf AS (SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) END AS p, CASE WHEN tp + fn > 0 THEN tp / (tp + fn) END AS r
        FROM conf),
met AS (SELECT tp, fp, tn, fn, p AS "precision", r AS recall,
               CASE WHEN p + r > 0 THEN 2.0 * p * r / (p + r) END AS f1_score FROM prf)"""


def ranking_ctes(source: str, score: str = "mse_score", suffix: str = "") -> str:
    """``rk``: one row per distinct score with running counts from the top; ``auc``: both ranking metrics."""
    return f"""
grp{suffix} AS (SELECT {score} AS score, count(*) FILTER (is_malicious) AS pos, count(*) FILTER (NOT is_malicious) AS neg
                FROM {source} GROUP BY 1),
rk{suffix} AS (SELECT *, (sum(pos) OVER w)::BIGINT AS tp, (sum(neg) OVER w)::BIGINT AS fp,
                      (sum(pos) OVER ())::DOUBLE AS all_pos, (sum(neg) OVER ())::DOUBLE AS all_neg
               FROM grp{suffix} WINDOW w AS (ORDER BY score DESC ROWS UNBOUNDED PRECEDING)),
auc{suffix} AS (SELECT sum(pos * (tp::DOUBLE / (tp + fp))) / max(all_pos) AS pr_auc,
                       sum(neg * (tp - pos + pos / 2.0::DOUBLE)) / (max(all_pos) * max(all_neg)) AS roc_auc FROM rk{suffix})"""
