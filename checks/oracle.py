"""DuckDB SQL that computes the registered queries independently of the Spark code.

``VIEWS`` maps a common table expression to (its inputs, its body); ``query`` puts the ones a final
SELECT needs in front of it.
"""

from __future__ import annotations

VIEWS: dict[str, tuple[tuple[str, ...], str]] = {}


def view(name: str, inputs: str, body: str) -> None:
    VIEWS[name] = (tuple(inputs.split()), body)


def query(inputs: str, final: str) -> str:
    """``final`` preceded by the named views and everything they read.

    A ``final`` that begins with a comma goes on with views of its own.
    """
    order: list[str] = []

    def need(name: str) -> None:
        if name not in order:
            for parent in VIEWS[name][0]:
                need(parent)
            order.append(name)

    for name in inputs.split():
        need(name)
    ctes = ",\n".join(f"{name} AS ({VIEWS[name][1]})" for name in order)
    return f"WITH {ctes}\n{final.strip()}"


def r(expr: str, digits: int) -> str:
    """Half-up rounding on the binary value."""
    unit = f"1e{digits}"
    return f"(floor(({expr})::DOUBLE * {unit} + 0.5e0) / {unit})"


view("loans", "", """
SELECT o_orderkey AS k, o_custkey AS c, o_totalprice, o_orderpriority,
       CAST(CASE WHEN year(o_orderdate) <= 1998 THEN year(o_orderdate) + 10 ELSE year(o_orderdate) + 18 END AS INT) AS vint,
       CAST(quarter(o_orderdate) AS INT) AS q, 580 + (o_custkey * 37 + o_orderkey * 11) % 241 AS score0
FROM orders""")

view("keyed", "loans", """
SELECT *, 'F' || lpad(CAST(vint % 100 AS VARCHAR), 2, '0') || 'Q' || q || lpad(CAST(k AS VARCHAR), 7, '0') AS loan,
       CASE WHEN k % 97 = 0 THEN 999 ELSE 40 + (k * 17 + c) % 58 END AS ltv0,
       vint * 12 + (q - 1) * 3 + k % 3 + 2 AS fpm
FROM loans""")

view("origination", "keyed", """
SELECT loan AS loan_sequence_number,
       CAST(CASE WHEN k % 53 = 0 THEN 9999 ELSE score0 END AS INT) AS credit_score,
       CAST((fpm // 12) * 100 + fpm % 12 + 1 AS VARCHAR) AS first_payment_date,
       CASE k % 5 WHEN 0 THEN 'Y' WHEN 4 THEN NULL ELSE 'N' END AS first_time_homebuyer_flag,
       CAST(CASE WHEN k % 61 = 0 THEN 999 WHEN ltv0 > 80 THEN 25 ELSE 0 END AS INT) AS mi_pct,
       CAST(CASE WHEN k % 71 = 0 THEN 99 ELSE 1 + k % 4 END AS INT) AS num_units,
       CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING', 'MACHINERY') THEN 'P'
            WHEN c_mktsegment = 'FURNITURE' THEN 'I' ELSE 'S' END AS occupancy_status,
       CAST(ltv0 + k % 9 AS INT) AS ocltv,
       CAST(CASE WHEN k % 41 = 0 THEN 999 ELSE 10 + (k * 29) % 56 END AS INT) AS odti,
       CAST(floor(o_totalprice / 1000) * 1000 AS DOUBLE) AS orig_upb,
       CAST(ltv0 AS INT) AS oltv,
       3.5e0 + (k % 33) / 16e0 AS orig_interest_rate,
       CASE WHEN k % 3 = 0 THEN 'R' WHEN k % 3 = 1 THEN 'B' WHEN k % 7 > 0 THEN 'C' END AS channel,
       n_name AS property_state,
       CASE k % 4 WHEN 0 THEN 'SF' WHEN 1 THEN 'PU' WHEN 2 THEN 'CO' ELSE 'MH' END AS property_type,
       CASE left(o_orderpriority, 1) WHEN '1' THEN 'P' WHEN '2' THEN 'P' WHEN '3' THEN 'C' WHEN '4' THEN 'C' ELSE 'N' END AS loan_purpose,
       CAST(CASE WHEN k % 10 < 8 THEN 360 WHEN k % 10 = 8 THEN 180 ELSE 240 END AS INT) AS orig_loan_term,
       CAST(CASE WHEN k % 59 = 0 THEN 99 ELSE 1 + k % 3 END AS INT) AS num_borrowers,
       CAST(fpm // 12 AS INT) AS vintage_year
FROM keyed JOIN customer ON c = c_custkey JOIN nation ON c_nationkey = n_nationkey""")

view("perf0", "keyed", """
SELECT loan, CAST(3 * l_linenumber - l_partkey % 3 AS INT) AS age,
       vint * 12 + (q - 1) * 3 + 3 * l_linenumber - l_partkey % 3 AS m, l_extendedprice AS price, l_discount,
       CASE WHEN l_quantity >= (CASE WHEN score0 < 660 THEN 47 WHEN score0 < 720 THEN 49 ELSE 50 END) THEN '6'
            WHEN l_quantity >= 44 THEN '3' WHEN l_quantity >= 38 THEN '1'
            WHEN l_quantity = 37 THEN 'XX' WHEN l_quantity = 36 THEN 'RA' ELSE '0' END AS dq,
       CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O' AND l_discount >= 0.1e0 THEN '03'
            WHEN l_returnflag = 'A' AND l_linestatus = 'F' AND l_tax >= 0.07e0 THEN '01' END AS zb
FROM lineitem JOIN keyed ON l_orderkey = k""")

view("performance", "perf0", """
SELECT loan AS loan_sequence_number, CAST((m // 12) * 100 + m % 12 + 1 AS INT) AS monthly_reporting_period,
       price AS current_actual_upb, dq AS current_delinquency_status, age AS loan_age, zb AS zero_balance_code,
       CASE WHEN zb IS NOT NULL THEN CAST((m // 12) * 100 + m % 12 + 1 AS INT) END AS zero_balance_effective_date,
       CASE WHEN zb = '03' THEN price * (0.2e0 + l_discount) END AS actual_loss_calculation,
       CASE WHEN zb = '03' THEN price * 0.75e0 END AS net_sales_proceeds,
       CASE WHEN zb IS NOT NULL THEN price END AS zero_balance_removal_upb
FROM perf0""")

# Text status as a number; DuckDB would round '2.5', the views hold whole numbers and letters only.
view("months", "performance", """
SELECT *, TRY_CAST(current_delinquency_status AS INT) AS dq,
       zero_balance_code IN ('02', '03', '09', '15') AS credit_event
FROM performance""")

view("summary", "months", """
SELECT loan_sequence_number, max(dq) AS max_dq, max(loan_age) AS last_age,
       CAST(count(*) FILTER (credit_event) > 0 AS INT) AS credit_event_zb,
       CAST(count(*) FILTER (zero_balance_code = '01') > 0 AS INT) AS prepay_zb,
       CAST(count(*) FILTER (length(zero_balance_code) > 0) > 0 AS INT) AS any_termination,
       max(loan_age) FILTER (length(zero_balance_code) > 0) AS term_age,
       max(zero_balance_effective_date) FILTER (length(zero_balance_code) > 0) AS term_period,
       min(loan_age) FILTER (dq >= 6) AS first_180_age,
       max(zero_balance_removal_upb) AS ead_upb, max(actual_loss_calculation) AS actual_loss,
       CAST(count(*) FILTER (dq >= 6 OR credit_event) > 0 AS INT) AS default_flag
FROM months GROUP BY ALL""")

view("target", "origination summary", """
SELECT o.loan_sequence_number, o.vintage_year, o.first_payment_date, s.default_flag, s.prepay_zb AS prepaid_flag,
       CASE WHEN s.default_flag = 1 THEN 'default' WHEN s.prepay_zb = 1 THEN 'prepaid' ELSE 'active_or_censored' END AS outcome,
       coalesce(s.first_180_age, s.term_age, s.last_age) AS months_to_event, s.last_age, s.ead_upb, s.actual_loss
FROM origination o LEFT JOIN summary s ON o.loan_sequence_number = s.loan_sequence_number""")

view("features", "origination target", """
SELECT *, CASE WHEN vintage <= 2009 THEN 'crisis' ELSE 'covid' END AS cohort,
       CASE WHEN vintage IN (2005, 2006, 2017, 2018) THEN 'train' WHEN vintage IN (2007, 2008, 2019) THEN 'test' ELSE 'other' END AS split
FROM (
  SELECT o.loan_sequence_number, 2000 + CAST(o.loan_sequence_number[2:3] AS INT) AS vintage,
         nullif(o.credit_score, 9999) AS fico, nullif(o.oltv, 999) AS oltv,
         CASE WHEN o.ocltv < 999 THEN o.ocltv END AS ocltv, nullif(o.odti, 999) AS odti,
         o.orig_upb, o.orig_interest_rate AS orig_rate, CASE WHEN o.mi_pct = 999 THEN 0 ELSE o.mi_pct END AS mi_pct,
         nullif(o.num_units, 99) AS num_units, nullif(o.num_borrowers, 99) AS num_borrowers,
         o.first_time_homebuyer_flag AS fthb, o.loan_purpose, o.occupancy_status AS occupancy, o.property_type,
         o.channel, o.property_state AS state, o.orig_loan_term AS loan_term,
         t.default_flag, t.prepaid_flag, t.months_to_event, t.ead_upb
  FROM origination o JOIN target t ON o.loan_sequence_number = t.loan_sequence_number)
WHERE vintage IN (2005, 2006, 2007, 2008, 2017, 2018, 2019)""")

FICO6 = """(CASE WHEN fico < 620 THEN {0} WHEN fico < 660 THEN {1} WHEN fico < 700 THEN {2}
 WHEN fico < 740 THEN {3} WHEN fico < 780 THEN {4} ELSE {5} END)"""
FICO_REPORT = FICO6.format("'1:<620'", "'2:620-659'", "'3:660-699'", "'4:700-739'", "'5:740-779'", "'6:780+'")
FICO_MART = FICO6.format("'<620'", "'620-659'", "'660-699'", "'700-739'", "'740-779'", "'780+'")
LTV_REPORT = "(CASE WHEN oltv > 90 OR oltv IS NULL THEN '4:91+' WHEN oltv > 80 THEN '3:81-90' WHEN oltv > 60 THEN '2:61-80' ELSE '1:<=60' END)"
LTV_MART = "(CASE WHEN oltv > 90 OR oltv IS NULL THEN '91+' WHEN oltv > 80 THEN '81-90' WHEN oltv > 70 THEN '71-80' WHEN oltv > 60 THEN '61-70' ELSE '<=60' END)"


QK = "({0} // 100) * 4 + ({0} % 100 - 1) // 3"

view("observations", "", """
SELECT series, CAST((2005 + m // 12) * 100 + m % 12 + 1 AS INT) AS yyyymm, CASE WHEN m < 198 THEN value END AS value
FROM (SELECT o_orderkey AS k, o_custkey AS c, o_orderkey % 204 AS m FROM orders) o,
LATERAL (VALUES ('unemployment_rate', 4e0 + abs(m % 96 - 48) / 16e0 + (c % 8) / 8e0),
                ('mortgage_rate', CASE WHEN m >= 3 THEN 3e0 + abs(m % 120 - 60) / 16e0 + (k % 4) / 4e0 END),
                ('real_gdp', 15000e0 + m * 16e0 + (c % 16) * 8e0),
                ('hpi', 100e0 + abs(m % 144 - 72) / 2e0 + (c % 8) / 8e0)) v(series, value)""")
view("quarterly", "observations", f"""
SELECT series, CAST({QK.format('yyyymm')} AS INT) AS quarter_key, avg(value) AS value FROM observations GROUP BY 1, 2""")
view("macro", "quarterly", """
SELECT q.quarter_key, max(value) FILTER (series = 'unemployment_rate') AS unemployment_rate,
       max(value) FILTER (series = 'mortgage_rate') AS mortgage_rate,
       max((value / (SELECT p.value FROM quarterly p WHERE p.series = q.series AND p.quarter_key = q.quarter_key - 1) - 1) * 400)
         FILTER (series = 'real_gdp') AS gdp_growth,
       max(value) FILTER (series = 'hpi') AS hpi,
       max((value / (SELECT p.value FROM quarterly p WHERE p.series = q.series AND p.quarter_key = q.quarter_key - 4) - 1) * 100)
         FILTER (series = 'hpi') AS hpi_yoy
FROM quarterly q GROUP BY q.quarter_key HAVING count(value) > 0""")

view("lq", "months", f"""
SELECT loan_sequence_number, CAST({QK.format('monthly_reporting_period')} AS INT) AS quarter_key, max(dq) AS max_dq,
       CAST(coalesce(bool_or(credit_event), false) AS INT) AS credit_event,
       CAST(coalesce(bool_or(zero_balance_code = '01'), false) AS INT) AS prepaid, min(loan_age) AS age_m
FROM months GROUP BY 1, 2""")
view("stops", "lq", """
SELECT loan_sequence_number, min(quarter_key) FILTER (max_dq >= 6 OR credit_event = 1) AS def_q,
       min(quarter_key) FILTER (prepaid = 1) AS pp_q, max(quarter_key) AS last_q FROM lq GROUP BY 1""")
view("kept_quarters", "lq stops", """
SELECT lq.loan_sequence_number, lq.quarter_key, lq.age_m,
       CAST(lq.quarter_key IS NOT DISTINCT FROM def_q AS INT) AS default_event,
       CAST(lq.quarter_key IS NOT DISTINCT FROM pp_q AS INT) AS prepay_event
FROM lq JOIN stops USING (loan_sequence_number)
WHERE lq.quarter_key <= coalesce(def_q, 999999) AND lq.quarter_key <= coalesce(pp_q, 999999)""")
view("panel", "kept_quarters features macro", """
SELECT k.loan_sequence_number, k.quarter_key // 4 AS cal_year, k.quarter_key % 4 + 1 AS cal_q, k.quarter_key,
       k.age_m / 3e0 AS loan_age_q, (k.age_m / 3e0) * (k.age_m / 3e0) AS loan_age_q_sq, k.default_event, k.prepay_event,
       f.fico, f.oltv, f.odti, f.orig_rate, n.unemployment_rate, n.hpi_yoy, n.mortgage_rate,
       (n.hpi / o.hpi - 1) * 100 AS hpi_growth_since_orig, least(f.oltv * (o.hpi / n.hpi), 250e0) AS current_ltv
FROM kept_quarters k JOIN features f USING (loan_sequence_number) JOIN macro n ON n.quarter_key = k.quarter_key
JOIN macro o ON o.quarter_key = f.vintage * 4 + CAST(k.loan_sequence_number[5] AS INT) - 1""")

# The published default hazard (coefficient, mean, scale of each covariate, and the
# intercept in Z) and, in the view "anchors", the published scenario anchors by series and quarter.
COEF = {
    "loan_age_q": (0.253899, 12.23412, 11.85223),
    "loan_age_q_sq": (-0.064737, 290.149051, 557.650639),
    "fico": (-0.427612, 730.199637, 55.623467),
    "current_ltv": (0.352582, 74.84806, 21.090737),
    "odti": (0.253613, 35.895404, 11.551719),
    "orig_rate": (0.052371, 5.628725, 0.949671),
    "unemployment_rate": (0.58025, 6.603191, 2.111722),
}
Z = "-6.954892014562259e0" + "".join(f" + ({b}e0) * ({name} - {m}e0) / {sd}e0" for name, (b, m, sd) in COEF.items())
HAZARD = f"1e0 / (1e0 + exp(-({Z})))"

view("anchors", "", """
SELECT s, var, x, CAST(v AS DOUBLE) AS v FROM (VALUES
 ('baseline', 'unemployment_rate', 1, 4.6), ('baseline', 'unemployment_rate', 3, 4.6), ('baseline', 'unemployment_rate', 13, 4.2),
 ('baseline', 'gdp_growth', 1, 1.4), ('baseline', 'gdp_growth', 5, 2.1), ('baseline', 'gdp_growth', 13, 2.0),
 ('baseline', 'mortgage_rate', 1, 6.15), ('baseline', 'mortgage_rate', 11, 5.7), ('baseline', 'mortgage_rate', 13, 5.7),
 ('severely_adverse', 'unemployment_rate', 1, 5.6), ('severely_adverse', 'unemployment_rate', 4, 8.2), ('severely_adverse', 'unemployment_rate', 7, 10.0),
 ('severely_adverse', 'unemployment_rate', 10, 9.4), ('severely_adverse', 'unemployment_rate', 13, 8.6),
 ('severely_adverse', 'hpi', 1, 96.0), ('severely_adverse', 'hpi', 4, 84.0), ('severely_adverse', 'hpi', 8, 70.0), ('severely_adverse', 'hpi', 13, 71.0),
 ('severely_adverse', 'mortgage_rate', 1, 6.4), ('severely_adverse', 'mortgage_rate', 3, 6.5), ('severely_adverse', 'mortgage_rate', 7, 5.9), ('severely_adverse', 'mortgage_rate', 13, 5.4),
 ('severely_adverse', 'gdp_growth', 1, -6.5), ('severely_adverse', 'gdp_growth', 3, -7.5), ('severely_adverse', 'gdp_growth', 6, 0.0),
 ('severely_adverse', 'gdp_growth', 9, 4.0), ('severely_adverse', 'gdp_growth', 13, 3.5)) a(s, var, x, v)""")
BETWEEN = "CASE WHEN lx IS NULL THEN hv WHEN hx IS NULL OR hx = lx THEN lv ELSE lv + (t - lx) * (hv - lv) / (hx - lx) END"
view("path_points", "anchors", f"""
SELECT s, var, t, {BETWEEN} AS v
FROM (SELECT s, var, t, max(x) FILTER (x <= t) AS lx, arg_max(v, x) FILTER (x <= t) AS lv,
             min(x) FILTER (x >= t) AS hx, arg_min(v, x) FILTER (x >= t) AS hv
      FROM anchors, range(1, 14) g(t) GROUP BY s, var, t)
UNION ALL SELECT 'baseline', 'hpi', t, 100 * pow(1.02e0, t / 4e0) FROM range(1, 14) g(t)""")
view("paths", "path_points", f"""
SELECT s AS scenario, CAST(t AS INT) AS quarter_index, (2026 + (t - 1) // 4) || 'Q' || ((t - 1) % 4 + 1) AS quarter,
       {r("max(v) FILTER (var = 'unemployment_rate')", 3)} AS unemployment_rate, {r("max(v) FILTER (var = 'hpi')", 3)} AS hpi
FROM path_points GROUP BY s, t""")
view("book", "features", f"""
SELECT *, {FICO_MART} AS fico_band, {LTV_MART} AS ltv_band FROM features
WHERE cohort = 'covid' AND fico IS NOT NULL AND oltv IS NOT NULL AND odti IS NOT NULL AND orig_rate IS NOT NULL AND orig_upb IS NOT NULL""")


def roll(name: str, path_view: str) -> None:
    """Hazards per loan and path quarter, then survival as a running product."""
    view(name, f"book {path_view}", f"""
SELECT *, before * hd AS d, before * greatest(1 - hd - 0.0165e0, 0) AS surv FROM (
  SELECT *, coalesce(product(greatest(1 - hd - 0.0165e0, 0)) OVER (PARTITION BY scenario, loan_sequence_number ORDER BY quarter_index
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 1) AS before
  FROM (SELECT *, {HAZARD} AS hd FROM (
          SELECT b.*, p.*, 6e0 + p.quarter_index AS loan_age_q, (6e0 + p.quarter_index) * (6e0 + p.quarter_index) AS loan_age_q_sq,
                 least(b.oltv * (100 / p.hpi), 250) AS current_ltv FROM book b, {path_view} p)))""")


roll("rolled", "paths")
view("shocks", "", """
SELECT peak || '/' || decline AS scenario, peak, decline, CAST(t AS INT) AS quarter_index,
       4.5e0 + (peak - 4.5e0) * least(t, 7) / 7e0 AS unemployment_rate, 100e0 * (1 - decline / 100 * least(t, 8) / 8e0) AS hpi
FROM (SELECT unnest([4.5e0, 10e0, 15e0]) AS peak), (SELECT unnest([0e0, 30e0, 50e0]) AS decline), range(1, 14) g(t)""")
roll("shocked", "shocks")
view("projection", "rolled", f"""
SELECT scenario, quarter_index, any_value(quarter) AS quarter, {r('any_value(unemployment_rate)', 2)} AS unemployment_rate,
       {r('any_value(hpi)', 1)} AS hpi_index, {r('avg(surv)', 4)} AS surviving_frac,
       {r('100 * sum(d) / count(*)', 4)} AS quarterly_default_rate_pct,
       {r('100 * sum(sum(d)) OVER w / count(*)', 4)} AS cumulative_default_rate_pct,
       sum(d * orig_upb) AS defaulted_upb, round(sum(sum(d * orig_upb)) OVER w, 0) AS cumulative_defaulted_upb,
       round(sum(orig_upb), 0) AS portfolio_upb0, count(*) AS n_loans
FROM rolled GROUP BY scenario, quarter_index
WINDOW w AS (PARTITION BY scenario ORDER BY quarter_index)""")
view("losses", "projection", """
SELECT *, cumulative_defaulted_upb * 0.3e0 AS expected_loss,
       100 * (cumulative_defaulted_upb * 0.3e0) / portfolio_upb0 AS cumulative_loss_rate_pct FROM projection""")
view("per_loan", "rolled", """
SELECT scenario, loan_sequence_number, fico_band, ltv_band, loan_purpose, state, any_value(orig_upb) AS upb,
       sum(d) AS exp_default, sum(d) * any_value(orig_upb) * 0.3e0 AS exp_loss
FROM rolled GROUP BY ALL""")
view("by_segment", "per_loan", """
SELECT scenario, dimension, segment, count(*) AS loans, sum(upb) AS upb, sum(exp_loss) AS exp_loss,
       100 * sum(exp_loss) / sum(upb) AS loss_rate_pct, 100 * avg(exp_default) AS default_rate_pct
FROM (SELECT scenario, 'fico_band' AS dimension, fico_band AS segment, upb, exp_loss, exp_default FROM per_loan
      UNION ALL SELECT scenario, 'ltv_band', ltv_band, upb, exp_loss, exp_default FROM per_loan
      UNION ALL SELECT scenario, 'loan_purpose', loan_purpose, upb, exp_loss, exp_default FROM per_loan)
GROUP BY ALL""")
view("by_state", "per_loan book", """
SELECT scenario, 'state' AS dimension, state AS segment, count(*) AS loans, sum(upb) AS upb, sum(exp_loss) AS exp_loss,
       100 * sum(exp_loss) / sum(upb) AS loss_rate_pct, 100 * avg(exp_default) AS default_rate_pct
FROM per_loan WHERE state IN (SELECT state FROM book GROUP BY state ORDER BY sum(orig_upb) DESC, state LIMIT 10)
GROUP BY ALL""")
view("report", "by_segment by_state", "SELECT * FROM by_segment UNION ALL SELECT * FROM by_state")
view("scenario_dim", "projection", """
SELECT CAST(row_number() OVER (ORDER BY scenario) AS INT) AS scenario_id, scenario,
       CASE scenario WHEN 'baseline' THEN 'Baseline' ELSE 'Severely Adverse' END AS scenario_label,
       max(unemployment_rate) AS peak_unemployment_pct,
       CASE WHEN min(hpi_index) < 100 THEN min(hpi_index) - 100 END AS hpi_trough_pct
FROM projection GROUP BY scenario""")


view("applicants", "", """
SELECT c_custkey AS applicant_id, 10000e0 + (c_acctbal + 1000e0) * 40e0 AS "limit", CAST(18 + c_custkey % 58 AS INT) AS age,
       CAST(c_custkey % 11 - 2 AS INT) AS pay_status, CAST(1 + c_custkey % 5 AS INT) AS education, CAST(1 + c_custkey % 4 AS INT) AS marital
FROM customer""")
view("parts", "applicants", """
SELECT *, 0.62e0 * pay_status AS c1, -3e-6 * ("limit" - 150000) AS c2, -0.01e0 * (age - 35) AS c3,
       CAST(coalesce(map([1, 2, 3, 4], [-0.15, 0, 0.12, 0.05])[education], 0) AS DOUBLE) AS c4,
       CAST(coalesce(map([1, 2, 3], [0.05, 0, 0.03])[marital], 0) AS DOUBLE) AS c5 FROM applicants""")
view("scored_applicants", "parts", """
SELECT *, CASE WHEN pd < 0.087e0 THEN 'APPROVE' ELSE 'REVIEW / DECLINE' END AS decision,
       CASE WHEN pd < 0.12e0 THEN 'green' WHEN pd < 0.3e0 THEN 'amber' ELSE 'red' END AS colour, pd * 0.45e0 * "limit" AS expected_loss
FROM (SELECT *, 1 / (1 + exp(-(-1.55e0 + c1 + c2 + c3 + c4 + c5))) AS pd FROM parts)""")

view("all_scored", "features", f"""
SELECT loan_sequence_number, split, default_flag AS y, {r(HAZARD, 6)} AS s
FROM (SELECT *, 12e0 AS loan_age_q, 144e0 AS loan_age_q_sq, CAST(oltv AS DOUBLE) AS current_ltv, 6.5e0 AS unemployment_rate FROM features)""")
view("known", "all_scored", "SELECT * FROM all_scored WHERE s IS NOT NULL AND y IS NOT NULL")
view("curve", "known", """
SELECT split, s, pos, cnt - pos AS neg, cnt, sum(pos) OVER w AS tp, sum(cnt - pos) OVER w AS fp,
       sum(pos) OVER (PARTITION BY split) AS p, sum(cnt - pos) OVER (PARTITION BY split) AS n
FROM (SELECT split, s, sum(y) AS pos, count(*) AS cnt FROM known GROUP BY split, s) WINDOW w AS (PARTITION BY split ORDER BY s DESC)""")


def ranking(source: str, by: str) -> str:
    """Metrics from ranks (AUC), cumulative shares (KS, PR-AUC) and rows (Brier)."""
    return f"""
, ranked AS (SELECT *, rank() OVER (PARTITION BY {by} ORDER BY s) + (count(*) OVER (PARTITION BY {by}, s) - 1) / 2e0 AS rk FROM {source}),
auc AS (SELECT {by}, count(*) AS n, avg(y) AS base_rate, avg((s - y) * (s - y)) AS brier, sum(y) AS p,
               (sum(rk) FILTER (y = 1) - sum(y) * (sum(y) + 1) / 2e0) / (sum(y)::DOUBLE * (count(*) - sum(y))) AS roc_auc FROM ranked GROUP BY {by}),
folded AS (SELECT {by}, s, sum(y) AS pos, count(*) AS cnt FROM {source} GROUP BY {by}, s),
steps AS (SELECT {by}, pos, sum(pos) OVER w AS tp, sum(cnt) OVER w AS seen FROM folded WINDOW w AS (PARTITION BY {by} ORDER BY s DESC)),
curves AS (SELECT {by}, max(tp / a.p::DOUBLE - (seen - tp) / (a.n - a.p)::DOUBLE) AS ks, sum(pos / a.p::DOUBLE * tp / seen) AS pr_auc
           FROM steps JOIN auc a USING ({by}) GROUP BY {by})"""


RANK_COLUMNS = f"n, {r('base_rate', 8)} AS base_rate, {r('roc_auc', 8)} AS roc_auc, {r('2 * roc_auc - 1', 8)} AS gini, {r('ks', 8)} AS ks, {r('pr_auc', 8)} AS pr_auc, {r('brier', 8)} AS brier"


def rate(flag: str, digits: int = 2) -> str:
    return r(f"100e0 * sum({flag}) / count({flag})", digits)


def sql() -> dict[str, str]:
    out: dict[str, str] = {}

    out["typed_performance"] = query("performance", "SELECT * FROM performance")
    out["typed_origination"] = query("origination", "SELECT * FROM origination")
    out["sampled_performance"] = query("performance", """
SELECT loan_sequence_number, monthly_reporting_period, loan_age, current_delinquency_status
FROM performance WHERE loan_sequence_number IN (
  SELECT DISTINCT loan_sequence_number FROM performance
  WHERE CAST('0x' || left(md5(loan_sequence_number || '42'), 8) AS BIGINT) % 1000000 / 1e6 < 0.05)""")
    out["panel_sample_loans"] = query("origination", """
SELECT loan_sequence_number, vintage_year FROM origination
WHERE CAST('0x' || left(md5(loan_sequence_number || '7'), 8) AS BIGINT) % 1000000 / 1e6 < 0.4""")
    out["performance_of_defaulted_loans"] = query("performance target", """
SELECT loan_sequence_number, monthly_reporting_period, loan_age, zero_balance_code FROM performance p
WHERE EXISTS (SELECT 1 FROM target t WHERE t.loan_sequence_number = p.loan_sequence_number AND t.outcome = 'default')""")
    out["load_summary"] = query("origination performance", """
, kept AS (SELECT * FROM origination WHERE CAST('0x' || left(md5(loan_sequence_number || '42'), 8) AS BIGINT) % 1000000 / 1e6 < 0.05)
SELECT 'loans_read' AS measure, count(*) AS n FROM origination
UNION ALL SELECT 'loans_kept', count(*) FROM kept
UNION ALL SELECT 'performance_rows_kept', count(*) FROM performance SEMI JOIN kept USING (loan_sequence_number)
UNION ALL SELECT 'loans_kept_' || vintage_year, count(*) FROM kept GROUP BY vintage_year""")
    out["hash_ordered_sample"] = query("features", """
SELECT loan_sequence_number, fico, oltv, default_flag FROM features
ORDER BY md5(loan_sequence_number || '42'), loan_sequence_number LIMIT 3000""")

    out["performance_summary"] = query("summary", "SELECT * FROM summary")
    out["loan_target"] = query("target", "SELECT * FROM target")
    out["target_summary"] = query("target", f"""
SELECT count(*) AS loans, sum(default_flag)::BIGINT AS defaults, {rate('default_flag')} AS default_rate_pct,
       sum(prepaid_flag)::BIGINT AS prepaid, {rate('prepaid_flag')} AS prepay_rate_pct FROM target""")
    out["features"] = query("features", "SELECT * FROM features")
    out["features_one_join"] = out["features"]
    out["filled_categories"] = query("features", """
SELECT loan_sequence_number, coalesce(fthb, 'missing') AS fthb, coalesce(channel, 'missing') AS channel,
       coalesce(occupancy, 'missing') AS occupancy FROM features""")
    out["as_of_book"] = query("features", """
SELECT loan_sequence_number, fico, oltv, odti, orig_rate, orig_upb FROM features
WHERE cohort = 'covid' AND fico + oltv + odti + orig_rate + orig_upb IS NOT NULL""")
    out["split_summary"] = query("features", f"""
SELECT split, count(*) AS n, sum(default_flag)::BIGINT AS n_default, {rate('default_flag')} AS default_rate_pct,
       {r('100e0 * count(*) FILTER (fico IS NULL) / count(*)', 2)} AS fico_missing_pct FROM features GROUP BY split""")

    out["portfolio_snapshot"] = query("features target", f"""
SELECT count(*) AS loans, {rate('t.default_flag')} AS default_rate_pct, {rate('t.prepaid_flag')} AS prepay_rate_pct,
       {r('avg(fico)', 0)} AS avg_fico, {r('avg(oltv)', 1)} AS avg_oltv, {r('avg(odti)', 1)} AS avg_dti
FROM target t JOIN features f ON f.loan_sequence_number = t.loan_sequence_number""")
    out["vintage_default_table"] = query("features", f"""
SELECT vintage, count(*) AS loans, sum(default_flag)::BIGINT AS n_default, {rate('default_flag')} AS default_rate_pct,
       {rate('prepaid_flag')} AS prepay_rate_pct FROM features GROUP BY vintage""")
    out["vintage_default_crosstab"] = query("features", f"""
SELECT vintage, count(*) FILTER (default_flag = 0) AS performing, count(*) FILTER (default_flag = 1) AS defaulted,
       {r('100e0 * count(*) FILTER (default_flag = 0) / count(default_flag)', 2)} AS performing_pct,
       {r('100e0 * count(*) FILTER (default_flag = 1) / count(default_flag)', 2)} AS defaulted_pct
FROM features GROUP BY vintage""")
    out["fico_ltv_grid"] = query("features", f"""
SELECT {FICO_REPORT} AS fico_band, {LTV_REPORT} AS ltv_band, count(*) AS loans, {rate('default_flag')} AS default_rate_pct
FROM features GROUP BY 1, 2""")
    out["vintage_seasoning"] = query("features months", f"""
, firsts AS (SELECT loan_sequence_number, min(loan_age) // 3 AS age_q FROM months
             WHERE dq >= 6 OR credit_event GROUP BY 1),
counts AS (SELECT vintage, age_q, count(*) AS n_def FROM firsts JOIN features USING (loan_sequence_number)
           WHERE age_q BETWEEN 0 AND 20 GROUP BY 1, 2)
SELECT vintage, age_q, n_def,
       {r('100e0 * (SELECT sum(n_def) FROM counts d WHERE d.vintage = a.vintage AND d.age_q <= a.age_q) / (SELECT count(*) FROM features f WHERE f.vintage = a.vintage)', 3)} AS cum_default_pct
FROM counts a""")
    out["states_by_default_rate"] = query("features", f"""
SELECT state, loans, default_rate_pct, rank() OVER (ORDER BY default_rate_pct DESC) AS risk_rank
FROM (SELECT state, count(*) AS loans, {rate('default_flag')} AS default_rate_pct FROM features GROUP BY state HAVING count(*) >= 20)
ORDER BY risk_rank, state LIMIT 15""")
    out["worst_delinquency"] = query("months", f"""
SELECT worst_status, count(*) AS loans, {r('100e0 * count(*) / sum(count(*)) OVER ()', 2)} AS pct_of_book
FROM (SELECT CASE WHEN max(dq) >= 6 THEN '3: 180+ dpd (default)' WHEN max(dq) >= 3 THEN '2: 90-150 dpd'
                  WHEN max(dq) >= 1 THEN '1: 30-60 dpd' WHEN max(dq) = 0 THEN '0: current' ELSE '4: unknown' END AS worst_status
      FROM months GROUP BY loan_sequence_number) GROUP BY worst_status""")
    out["macro_quarterly_means"] = query("quarterly", f"SELECT series, quarter_key, {r('value', 6)} AS value FROM quarterly")
    out["macro_year_on_year"] = query("quarterly", f"""
SELECT series, quarter_key, {r('(value / coalesce(lag(value, 4) OVER (PARTITION BY series ORDER BY quarter_key), 100) - 1) * 100', 6)} AS growth
FROM quarterly""")
    out["macro_annualised_growth"] = query("quarterly", f"""
SELECT q.series, q.quarter_key, {r('(q.value / p.value - 1) * 400', 6)} AS growth
FROM quarterly q LEFT JOIN quarterly p ON p.series = q.series AND p.quarter_key = q.quarter_key - 1""")
    out["compounded_price_index"] = query("origination", f"""
, growth AS (SELECT property_state AS state, 2000 + CAST(loan_sequence_number[2:3] AS INT) AS vintage,
             avg(CAST(oltv % 16 - 6 AS DOUBLE)) AS g FROM origination GROUP BY ALL)
SELECT a.state, a.vintage, {r('100 * product(pow(1 + b.g / 100, 0.25e0))', 6)} AS hpi
FROM growth a JOIN growth b ON b.state = a.state AND b.vintage <= a.vintage GROUP BY ALL""")
    out["macro_aligned"] = query("macro", f"""
SELECT quarter_key, {r('unemployment_rate', 6)} AS unemployment_rate, {r('mortgage_rate', 6)} AS mortgage_rate,
       {r('gdp_growth', 6)} AS gdp_growth, {r('hpi', 6)} AS hpi, {r('hpi_yoy', 6)} AS hpi_yoy FROM macro""")
    out["macro_wide"] = query("quarterly", f"""
SELECT quarter_key, {r("max(value) FILTER (series = 'unemployment_rate')", 6)} AS unemployment_rate,
       {r("max(value) FILTER (series = 'hpi')", 6)} AS hpi FROM quarterly GROUP BY quarter_key""")
    out["interpolated_balances"] = query("performance", f"""
, points AS (SELECT loan_sequence_number AS loan, loan_age AS x, min(current_actual_upb) AS v FROM performance GROUP BY ALL),
sides AS (SELECT loan, t, max(x) FILTER (x <= t) AS lx, arg_max(v, x) FILTER (x <= t) AS lv,
                 min(x) FILTER (x >= t) AS hx, arg_min(v, x) FILTER (x >= t) AS hv
          FROM points, range(1, 14) g(t) GROUP BY loan, t)
SELECT loan[2:3] AS vintage, CAST(t AS INT) AS t, count(*) AS loans, {r(f'avg({BETWEEN})', 3)} AS mean_upb
FROM sides GROUP BY 1, 2""")

    out["calendar_split"] = query("performance", f"""
SELECT monthly_reporting_period AS period, monthly_reporting_period // 100 AS cal_year,
       CAST((monthly_reporting_period % 100 + 2) // 3 AS INT) AS cal_q,
       CAST({QK.format('monthly_reporting_period')} AS INT) AS quarter_key, count(*) AS n FROM performance GROUP BY ALL""")
    out["loan_quarters"] = query("lq", "SELECT * FROM lq")
    out["quarters_until_event"] = query("kept_quarters", "SELECT * FROM kept_quarters")
    out["hazard_panel"] = query("panel", f"""
SELECT loan_sequence_number, cal_year, cal_q, quarter_key, {r('loan_age_q', 6)} AS loan_age_q, {r('loan_age_q_sq', 6)} AS loan_age_q_sq,
       default_event, prepay_event, fico, oltv, odti, orig_rate, {r('unemployment_rate', 6)} AS unemployment_rate,
       {r('hpi_yoy', 6)} AS hpi_yoy, {r('mortgage_rate', 6)} AS mortgage_rate,
       {r('hpi_growth_since_orig', 6)} AS hpi_growth_since_orig, {r('current_ltv', 6)} AS current_ltv FROM panel""")
    out["default_rate_by_quarter"] = query("panel", f"""
SELECT cal_year, cal_q, count(*) AS loans, {r('avg(default_event)', 8)} AS default_rate, {r('avg(unemployment_rate)', 6)} AS unemployment_rate
FROM panel GROUP BY 1, 2""")
    out["panel_summary"] = query("panel", f"""
SELECT count(*) AS panel_rows, count(DISTINCT loan_sequence_number) AS loans, sum(default_event)::BIGINT AS default_events,
       sum(prepay_event)::BIGINT AS prepay_events, {r('avg(default_event)', 8)} AS default_hazard, {r('avg(prepay_event)', 8)} AS prepay_hazard
FROM panel""")
    out["published_hazard_scores"] = query("panel", f"""
SELECT cal_year, cal_q, count(hd) AS scored, {r('avg(hd)', 8)} AS mean_hazard, {r('max(hd)', 8)} AS max_hazard
FROM (SELECT *, {HAZARD} AS hd FROM panel) GROUP BY 1, 2""")

    out["empirical_lgd"] = query("target", f"""
SELECT {r('loss', 2)} AS total_loss, {r('ead', 2)} AS total_ead, n AS n_with_loss, {r('loss / ead', 8)} AS empirical_lgd,
       CASE WHEN n >= 1000 AND loss / ead BETWEEN 0.12 AND 0.8 THEN 'empirical' ELSE 'assumed' END AS method,
       {r('CASE WHEN n >= 1000 AND loss / ead BETWEEN 0.12 AND 0.8 THEN loss / ead ELSE 0.3e0 END', 8)} AS lgd
FROM (SELECT sum(actual_loss) AS loss, sum(ead_upb) AS ead, count(*) AS n FROM target WHERE default_flag = 1 AND actual_loss > 0)""")
    out["book_stats"] = query("book", f"""
SELECT count(*) AS loans, sum(orig_upb) AS upb, {r('avg(fico)', 6)} AS fico, {r('avg(oltv)', 6)} AS oltv,
       {r('avg(odti)', 6)} AS odti, {r('avg(orig_rate)', 6)} AS orig_rate FROM book""")
    out["loan_paths_by_band"] = query("rolled", f"""
SELECT scenario, quarter_index, fico_band, count(*) AS loans, {r('avg(surv)', 6)} AS mean_survival, {r('avg(d)', 8)} AS mean_default
FROM rolled GROUP BY ALL""")
    out["book_by_quarter"] = query("projection", f"SELECT * REPLACE ({r('defaulted_upb', 2)} AS defaulted_upb) FROM projection")
    out["loan_expected_loss"] = query("per_loan", f"""
SELECT scenario, loan_sequence_number, {r('exp_default', 6)} AS exp_default, {r('exp_loss', 2)} AS exp_loss FROM per_loan""")
    out["expected_loss"] = query("projection target", f"""
, severity AS (SELECT CASE WHEN n >= 1000 AND loss / ead BETWEEN 0.12 AND 0.8 THEN loss / ead ELSE 0.3e0 END AS lgd FROM
  (SELECT sum(actual_loss) AS loss, sum(ead_upb) AS ead, count(*) AS n FROM target WHERE default_flag = 1 AND actual_loss > 0))
SELECT scenario, quarter_index, {r('cumulative_defaulted_upb * lgd', 2)} AS expected_loss,
       {r('100 * cumulative_defaulted_upb * lgd / portfolio_upb0', 6)} AS cumulative_loss_rate_pct FROM projection, severity""")
    out["horizon_end"] = query("losses", f"""
SELECT scenario, 13 AS horizon_quarters, (SELECT max(quarterly_default_rate_pct) FROM losses b WHERE b.scenario = a.scenario) AS peak_quarterly_default_pct,
       cumulative_default_rate_pct, {r('cumulative_loss_rate_pct', 6)} AS cumulative_loss_rate_pct, {r('expected_loss', 2)} AS expected_loss, portfolio_upb0
FROM losses a WHERE quarter_index = 13""")
    out["stress_headline"] = query("losses", f"""
SELECT CAST(a.portfolio_upb0 AS BIGINT) AS portfolio_upb, 13 AS horizon_quarters, {r('a.cumulative_default_rate_pct', 2)} AS base_default_pct,
       {r('b.cumulative_default_rate_pct', 2)} AS severe_default_pct, {r('a.cumulative_loss_rate_pct', 2)} AS base_loss_pct,
       {r('b.cumulative_loss_rate_pct', 2)} AS severe_loss_pct, CAST(floor(a.expected_loss) AS BIGINT) AS base_loss_usd,
       CAST(floor(b.expected_loss) AS BIGINT) AS severe_loss_usd, {r('b.cumulative_loss_rate_pct / a.cumulative_loss_rate_pct', 1)} AS severe_to_base
FROM losses a, losses b WHERE a.scenario = 'baseline' AND b.scenario = 'severely_adverse' AND a.quarter_index = 13 AND b.quarter_index = 13""")
    out["shock_grid"] = query("shocked", f"""
SELECT peak, decline, count(*) AS loans, {r('100 * avg(cd)', 6)} AS cumulative_default_pct, {r('30 * avg(cd)', 6)} AS cumulative_loss_pct,
       {r('30 * sum(cd * upb) / sum(upb)', 6)} AS loss_rate_pct, {r('0.3e0 * sum(cd * upb)', 2)} AS exp_loss
FROM (SELECT peak, decline, loan_sequence_number, sum(d) AS cd, any_value(orig_upb) AS upb FROM shocked GROUP BY ALL) GROUP BY 1, 2""")

    seg = f"scenario, dimension, segment, loans, upb, {r('exp_loss', 2)} AS exp_loss, {r('loss_rate_pct', 6)} AS loss_rate_pct, {r('default_rate_pct', 6)} AS default_rate_pct"
    out["loss_by_segment"] = query("by_segment", f"SELECT {seg} FROM by_segment")
    out["loss_by_top_states"] = query("by_state", f"SELECT {seg} FROM by_state")
    out["segment_report"] = query("report", f"SELECT {seg} FROM report")
    out["severe_losses_by_fico_band"] = query("report", f"""
SELECT segment, CAST(row_number() OVER (ORDER BY CASE segment WHEN '<620' THEN '0' ELSE segment END) AS BIGINT) AS position, {r('loss_rate_pct', 2)} AS loss_rate_pct
FROM report WHERE scenario = 'severely_adverse' AND dimension = 'fico_band'""")
    out["states_by_expected_loss"] = query("report", f"""
SELECT segment, {r('loss_rate_pct', 6)} AS loss_rate_pct, {r('exp_loss', 2)} AS exp_loss FROM report
WHERE scenario = 'severely_adverse' AND dimension = 'state' ORDER BY report.exp_loss DESC, segment LIMIT 10""")
    out["dim_scenario"] = query("scenario_dim", f"SELECT * REPLACE ({r('hpi_trough_pct', 6)} AS hpi_trough_pct) FROM scenario_dim")
    out["fact_projection"] = query("losses scenario_dim", f"""
SELECT d.scenario_id, quarter, quarter_index, unemployment_rate, hpi_index, quarterly_default_rate_pct, cumulative_default_rate_pct,
       {r('cumulative_loss_rate_pct', 6)} AS cumulative_loss_rate_pct, {r('expected_loss', 2)} AS expected_loss
FROM losses l LEFT JOIN scenario_dim d ON d.scenario = l.scenario""")
    out["fact_segment_loss"] = query("report scenario_dim", f"""
SELECT d.scenario_id, {seg.replace('scenario, ', '', 1)} FROM report l LEFT JOIN scenario_dim d ON d.scenario = l.scenario""")
    out["mart_measures"] = query("losses", f"""
, m AS (SELECT scenario, avg(cumulative_loss_rate_pct) AS a, arg_max(expected_loss, quarter_index) AS e FROM losses GROUP BY 1)
SELECT scenario, CASE scenario WHEN 'baseline' THEN 'Baseline' ELSE 'Severely Adverse' END AS scenario_label, {r('a', 6)} AS mean_loss_rate_pct,
       {r('e', 2)} AS expected_loss, {r("a / (SELECT a FROM m WHERE scenario = 'baseline')", 6)} AS times_base FROM m""")
    out["series_bundle"] = query("losses", f"""
SELECT scenario, CAST(quarter_index - 1 AS INT) AS position, quarter, {r('cumulative_default_rate_pct', 3)} AS cum_default_pct,
       {r('cumulative_loss_rate_pct', 3)} AS cum_loss_pct, {r('quarterly_default_rate_pct', 4)} AS quarterly_default_pct, unemployment_rate AS unemployment
FROM losses""")
    out["applicant_scores"] = query("scored_applicants", f"""
SELECT applicant_id, {r('pd', 8)} AS pd, decision, colour, {r('expected_loss', 2)} AS expected_loss FROM scored_applicants""")
    out["applicant_reasons"] = query("parts", """
SELECT applicant_id, CAST(rn AS INT) - 1 AS position, reason, CASE WHEN v > 0.001e0 THEN 'raises' WHEN v < -0.001e0 THEN 'lowers' ELSE 'neutral' END AS direction
FROM (SELECT applicant_id, reason, v, row_number() OVER (PARTITION BY applicant_id ORDER BY abs(v) DESC, i) AS rn
      FROM parts, LATERAL (VALUES (1, 'Recent repayment status', c1), (2, 'Credit limit', c2), (3, 'Age', c3), (4, 'Education', c4), (5, 'Marital status', c5)) t(i, reason, v))
WHERE rn <= 3""")
    out["applicant_portfolio_loss"] = query("scored_applicants", f"""
SELECT decision, count(*) AS applicants, {r('sum("limit")', 2)} AS "limit", {r('sum(expected_loss)', 2)} AS expected_loss,
       {r('100 * sum(expected_loss) / sum("limit")', 6)} AS loss_rate_pct, {r('avg(pd)', 8)} AS mean_pd FROM scored_applicants GROUP BY decision""")

    out["score_ranking_metrics"] = query("known", ranking("(SELECT 1 AS one, s, y FROM known)", "one") + f" SELECT {RANK_COLUMNS} FROM auc JOIN curves USING (one)")
    out["train_test_ranking_metrics"] = query("known", ranking("known", "split") + f" SELECT split, {RANK_COLUMNS} FROM auc JOIN curves USING (split)")
    out["score_reliability"] = query("known", f"""
, edges AS (SELECT quantile_cont(s, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS e FROM known)
SELECT CAST(len(list_filter(e, lambda x: x < s)) AS INT) AS bin, count(*) AS n, {r('avg(s)', 8)} AS mean_predicted, {r('avg(y)', 8)} AS observed_rate
FROM known, edges GROUP BY 1""")
    out["score_deciles"] = query("known", f"""
SELECT CAST(floor(rk * 10 / (n + 1)) AS INT) AS decile, count(*) AS loans, sum(y)::BIGINT AS defaults, {r('100e0 * avg(y)', 6)} AS default_rate_pct
FROM (SELECT y, count(*) OVER () AS n, rank() OVER (ORDER BY s DESC) + (count(*) OVER (PARTITION BY s) - 1) / 2e0 AS rk FROM known) GROUP BY 1""")
    means = ", ".join(f"avg(abs(({b}e0) * ({f} - {m}e0) / {sd}e0)) AS a_{f}" for f, (b, m, sd) in COEF.items())
    corrs = ", ".join(f"corr({f}, ({b}e0) * ({f} - {m}e0) / {sd}e0) AS r_{f}" for f, (b, m, sd) in COEF.items())
    rows = " UNION ALL ".join(f"SELECT '{f}' AS feature, a_{f} AS a, r_{f} AS c FROM sums" for f in COEF)
    out["hazard_contributions"] = query("panel", f"""
, sums AS (SELECT {means}, {corrs} FROM panel), long AS ({rows})
SELECT feature, {r('a', 6)} AS mean_abs, {r('c', 6)} AS correlation, CAST(row_number() OVER (ORDER BY a DESC) AS INT) AS importance_rank FROM long""")
    out["threshold_under_loss_limit"] = query("known origination", f"""
, rows AS (SELECT s, y, orig_upb AS e, y * 0.45e0 * orig_upb AS l FROM known JOIN origination USING (loan_sequence_number)),
cuts AS (SELECT s, sum(sum(y)) OVER w AS tp, sum(count(*) - sum(y)) OVER w AS fp, sum(sum(y)) OVER () AS p, sum(count(*) - sum(y)) OVER () AS n,
                sum(sum(l)) OVER v AS lb, sum(sum(e)) OVER v AS eb, sum(count(*)) OVER v AS nb
         FROM rows GROUP BY s WINDOW w AS (ORDER BY s DESC), v AS (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT s AS threshold, {r('tp / p::DOUBLE', 8)} AS sensitivity, {r('1 - fp / n::DOUBLE', 8)} AS specificity, {r('tp / p::DOUBLE - fp / n::DOUBLE', 8)} AS youden,
       nb::BIGINT AS accepted, {r('lb / eb', 8)} AS accepted_loss_rate
FROM cuts WHERE lb / eb <= 0.06 ORDER BY tp / p::DOUBLE - fp / n::DOUBLE DESC, s DESC LIMIT 1""")
    out["subgroup_outcomes"] = query("known origination", f"""
SELECT occupancy_status, count(*) AS n, {r('avg(y)', 8)} AS base_rate, {r('avg(CAST(s >= 0.001e0 AS INT))', 8)} AS declined_rate,
       {r('avg(CAST(s >= 0.001e0 AS INT)) FILTER (y = 1)', 8)} AS true_positive_rate, {r('avg(CAST(s >= 0.001e0 AS INT)) FILTER (y = 0)', 8)} AS false_positive_rate
FROM known JOIN origination USING (loan_sequence_number) GROUP BY 1""")
    out["score_drift"] = query("all_scored", f"""
, all_scores AS (SELECT split, s FROM all_scored WHERE s IS NOT NULL),
edges AS (SELECT quantile_cont(s, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS e FROM all_scores WHERE split = 'train'),
binned AS (SELECT split, len(list_filter(e, lambda x: x < s)) AS bin, count(*) AS n FROM all_scores, edges GROUP BY 1, 2),
shares AS (SELECT g.split, b.bin, greatest(coalesce((SELECT n FROM binned x WHERE x.split = g.split AND x.bin = b.bin), 0)
             / (SELECT sum(n) FROM binned x WHERE x.split = g.split)::DOUBLE, 1e-6) AS f
           FROM (SELECT DISTINCT split FROM binned) g, range(10) b(bin))
SELECT a.split, {r('sum((a.f - b.f) * ln(a.f / b.f))', 8)} AS psi
FROM shares a JOIN shares b ON b.bin = a.bin AND b.split = 'train' GROUP BY a.split""")
    out["delinquency_migration"] = query("months", f"""
, status AS (SELECT loan_sequence_number AS loan, (monthly_reporting_period // 100) * 12 + monthly_reporting_period % 100 AS m,
             CASE WHEN max(dq) >= 6 THEN '3: 180+ dpd (default)' WHEN max(dq) >= 3 THEN '2: 90-150 dpd'
                  WHEN max(dq) >= 1 THEN '1: 30-60 dpd' WHEN max(dq) = 0 THEN '0: current' ELSE '4: unknown' END AS st
             FROM months GROUP BY 1, 2)
SELECT a.st AS from_status, b.st AS to_status, count(*) AS n, {r('100e0 * count(*) / sum(count(*)) OVER (PARTITION BY a.st)', 2)} AS share_pct
FROM status a JOIN status b ON b.loan = a.loan AND b.m = a.m + 1 GROUP BY 1, 2""")
    return out
