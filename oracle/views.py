"""Independent SQL definitions over the given tables, written for DuckDB.

Each view is a common table expression; ``sql`` gathers the ones a query needs. They
start from the typed tables and share no code with the Spark operators.
"""

from __future__ import annotations

import re

AS_OF = "DATE '2001-11-30'"


def mean(x: str) -> str:
    return f"(CAST(sum({x}) AS DOUBLE) / NULLIF(count({x}), 0))"


def ratio(a: str, b: str) -> str:
    return f"(CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0))"


def pct(a: str, b: str, n: int = 1) -> str:
    return f"round({ratio(a, b)} * 100, {n})"


def months(later: str, earlier: str) -> str:
    return f"datediff('month', CAST({earlier} AS DATE), CAST({later} AS DATE))"


def days(later: str, earlier: str) -> str:
    return f"datediff('day', CAST({earlier} AS DATE), CAST({later} AS DATE))"


def month(x: str) -> str:
    return f"CAST(date_trunc('month', {x}) AS DATE)"


def ym(x: str) -> str:
    return f"strftime({x}, '%Y-%m')"


def yq(x: str) -> str:
    return f"(year({x}) || '-Q' || quarter({x}))"


def tenure(x: str) -> str:
    return (
        f"CASE WHEN {x} <= 30 THEN '0-30 days' WHEN {x} <= 90 THEN '31-90 days' WHEN {x} <= 180 THEN '91-180 days'"
        f" WHEN {x} <= 365 THEN '181-365 days' ELSE '365+ days' END"
    )


# Names of the columns that ``out`` made last.
COLUMNS: list[str] = []


def out(spec: str) -> str:
    """Output columns: name or name=expression, each with a kind after a colon.

    d date, t timestamp, m money or ratio, n count, s as is.
    """
    forms = {
        "d": "strftime({0}, '%Y-%m-%d')", "t": "strftime({0}, '%Y-%m-%d %H:%M:%S')",
        "m": "CAST({0} AS DOUBLE)", "n": "CAST({0} AS BIGINT)", "s": "{0}",
    }
    cols = []
    COLUMNS.clear()
    for item in [i.strip() for i in spec.strip().strip(";").split(";") if i.strip()]:
        body, kind = item.rsplit(":", 1)
        name, _, expr = body.partition("=")
        COLUMNS.append(name.strip())
        cols.append(f"{forms[kind.strip()].format(expr.strip() or name.strip())} AS {name.strip()}")
    return ", ".join(cols)


PLANS = [
    "(1,'Starter','free',0.00,0.00,5,1,'basic_sync')",
    "(2,'Pro','professional',29.00,290.00,100,5,'basic_sync,advanced_sharing,priority_support')",
    "(3,'Team','business',79.00,790.00,500,20,"
    "'basic_sync,advanced_sharing,priority_support,admin_console,sso')",
    "(4,'Enterprise','enterprise',199.00,1990.00,2000,100,"
    "'basic_sync,advanced_sharing,priority_support,admin_console,sso,dedicated_support,custom_integrations')",
]
CHANNELS = [
    "(1,'google_ads','paid_search',true,85.00)", "(2,'facebook_ads','paid_social',true,65.00)",
    "(3,'linkedin_ads','paid_social',true,120.00)", "(4,'organic_search','organic',false,15.00)",
    "(5,'direct','direct',false,10.00)", "(6,'referral','referral',false,25.00)",
    "(7,'content_marketing','organic',false,35.00)", "(8,'email_campaign','owned',false,20.00)",
    "(9,'partner','partnership',false,45.00)", "(10,'webinar','events',true,55.00)",
]

SIGNUP = "(DATE '1995-01-01' + CAST({0} * 7 % 2400 AS INTEGER))"

VIEWS: dict[str, str] = {}

VIEWS["plan"] = (
    "SELECT * FROM (VALUES " + ",".join(PLANS) + ") p(plan_id,plan_name,plan_tier,monthly,annual,storage,users,features)"
)
VIEWS["chan"] = (
    "SELECT * FROM (VALUES " + ",".join(CHANNELS) + ") c(channel_id,channel_name,channel_category,is_paid,typical_cac)"
)

VIEWS["cust"] = f"""
SELECT c_custkey AS ck, 'cust_' || c_custkey AS customer_id, c_name AS company_name, upper(c_mktsegment) AS industry,
  ['1-10','11-50','51-200','201-500','501-1000','1000+'][CAST(c_custkey % 6 AS INTEGER) + 1] AS company_size,
  upper(n_name) AS country, lower(c_name) || '@example.com' AS email,
  1 + c_custkey % 10 AS acquisition_channel_id, 1 + (c_custkey % 10) % 4 AS initial_plan_id,
  CASE c_custkey % 5 WHEN 0 THEN true WHEN 1 THEN false WHEN 2 THEN true WHEN 3 THEN false END AS is_trial,
  CASE WHEN c_custkey % 97 <> 0 THEN {SIGNUP.format('c_custkey')} + 14 END AS trial_end_date,
  {SIGNUP.format('c_custkey')} AS signup_date
FROM customer JOIN nation ON c_nationkey = n_nationkey"""

VIEWS["state"] = """
SELECT o_custkey AS ck, o_orderkey AS ok, CAST(o_orderdate AS TIMESTAMP) AS t_at,
  CASE o_orderpriority WHEN '1-URGENT' THEN 4 WHEN '2-HIGH' THEN 3 WHEN '3-MEDIUM' THEN 2 WHEN '4-NOT SPECIFIED' THEN 1 END AS plan_id,
  CAST(CASE o_orderpriority WHEN '1-URGENT' THEN 199 WHEN '2-HIGH' THEN 79 WHEN '3-MEDIUM' THEN 29 ELSE 0 END AS DECIMAL(18,2)) AS mrr
FROM orders"""

VIEWS["step"] = """
SELECT *, lag(plan_id) OVER w AS was_plan, lag(mrr) OVER w AS was_mrr FROM state WINDOW w AS (PARTITION BY ck ORDER BY t_at, ok)"""

VIEWS["line"] = """
SELECT *, CAST(sum(CASE WHEN plan_id IS NOT NULL AND was_plan IS NULL THEN 1 ELSE 0 END)
  OVER (PARTITION BY ck ORDER BY t_at, ok ROWS UNBOUNDED PRECEDING) AS BIGINT) AS sub_no FROM step"""

VIEWS["ev"] = f"""
SELECT ck, ok, 'evt_' || lpad(CAST(ok AS VARCHAR), 12, '0') AS event_id, 'cust_' || ck AS customer_id,
  'sub_' || ck || '_' || lpad(CAST(sub_no AS VARCHAR), 6, '0') AS subscription_id,
  'subscription_' || k AS event_type,
  CASE WHEN k IN ('started','reactivated') THEN 'acquisition' WHEN k = 'upgraded' THEN 'expansion'
       WHEN k = 'downgraded' THEN 'contraction' WHEN k = 'churned' THEN 'churn' ELSE 'other' END AS event_category,
  t_at AS event_at, CAST(t_at AS DATE) AS event_date, coalesce(plan_id, was_plan) AS plan_id,
  mrr - coalesce(was_mrr, 0) AS mrr_change, mrr AS mrr_after
FROM (SELECT *, CASE WHEN plan_id IS NULL THEN 'churned' WHEN was_plan IS NULL AND sub_no = 1 THEN 'started'
        WHEN was_plan IS NULL THEN 'reactivated' WHEN mrr > was_mrr THEN 'upgraded'
        WHEN mrr < was_mrr THEN 'downgraded' ELSE 'renewed' END AS k
      FROM line WHERE plan_id IS NOT NULL OR was_plan IS NOT NULL)"""

VIEWS["subs"] = f"""
SELECT *, CASE WHEN end_date IS NULL THEN 'active' ELSE 'churned' END AS status,
  CASE WHEN ck % 10 < 3 THEN 'annual' ELSE 'monthly' END AS billing_cycle,
  {days(f'coalesce(end_date, {AS_OF})', 'start_date')} AS len
FROM (SELECT subscription_id, customer_id, ck, arg_max(plan_id, event_id_at) AS plan_id, arg_max(mrr_after, event_id_at) AS mrr,
        min(event_date) AS start_date, max(event_date) FILTER (WHERE event_category = 'churn') AS end_date,
        min(event_at) AS created_at, max(event_at) AS updated_at
      FROM (SELECT *, strftime(event_at, '%Y%m%d%H%M%S') || event_id AS event_id_at FROM ev)
      GROUP BY ALL)"""

VIEWS["pay"] = """
SELECT 'pay_' || lpad(CAST(l_orderkey AS VARCHAR), 12, '0') || '_' || l_linenumber AS payment_id,
  CASE WHEN sub_no > 0 THEN 'sub_' || ck || '_' || lpad(CAST(sub_no AS VARCHAR), 6, '0') END AS subscription_id,
  'cust_' || ck AS customer_id, amount, 'USD' AS currency, CAST(paid AS DATE) AS payment_date,
  ['credit_card','ach','wire'][l_linenumber % 3 + 1] AS payment_method,
  CASE WHEN l_linenumber = 1 AND flag = 'R' THEN 'failed' ELSE 'succeeded' END AS status, paid AS created_at
FROM (SELECT l_orderkey, l_linenumber, CAST(l_extendedprice AS DECIMAL(18,2)) AS amount, l_shipdate AS paid, l_returnflag AS flag FROM lineitem)
JOIN line ON l_orderkey = ok"""

VIEWS["hit"] = """
SELECT event_id, user_id, date_trunc('second', ts) AS ts, ts AS exact_ts, event_type, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events"""

VIEWS["touch"] = """
SELECT 'touch_' || lpad(CAST(event_id AS VARCHAR), 12, '0') AS touch_id, 'cust_' || h.user_id AS customer_id, channel_id,
  CASE event_type WHEN 'view' THEN 'visit' WHEN 'signup' THEN 'form_submit' WHEN 'error' THEN 'demo_request' ELSE event_type END AS touch_type,
  '/p/' || k AS landing_page, CASE WHEN channel_id IN (1, 2, 3, 10) THEN 'campaign_' || k END AS utm_campaign,
  ts AS touched_at, CAST(ts AS DATE) AS touch_date, date_trunc('second', last_ts) AS converted_at, CAST(last_ts AS DATE) AS conversion_date,
  datesub('day', ts, date_trunc('second', last_ts)) AS d, datesub('hour', ts, date_trunc('second', last_ts)) AS h
FROM (SELECT *, CASE WHEN k < 40 THEN 1 WHEN k < 60 THEN 4 WHEN k < 75 THEN 5 ELSE 1 + k % 10 END AS channel_id
      FROM hit WHERE event_type <> 'purchase') h
LEFT JOIN (SELECT user_id, max(exact_ts) AS last_ts FROM hit WHERE event_type = 'purchase' GROUP BY user_id) b ON h.user_id = b.user_id"""

VIEWS["hist"] = f"""
SELECT c.*, e.* EXCLUDE (customer_id, ck), p.plan_name, p.plan_tier, p.monthly AS plan_price,
  {days('e.event_date', 'c.signup_date')} AS age_days, {months('e.event_date', 'c.signup_date')} AS age_months,
  row_number() OVER w AS seq, lag(event_type) OVER w AS prev_type, lag(e.plan_id) OVER w AS prev_plan,
  lead(event_type) OVER w AS next_type, lead(event_date) OVER w AS next_date,
  CAST(bool_or(event_category = 'churn') OVER (PARTITION BY e.ck) AS INTEGER) AS ever_churned,
  CAST(bool_or(event_category = 'expansion') OVER (PARTITION BY e.ck) AS INTEGER) AS ever_upgraded
FROM ev e JOIN cust c ON c.ck = e.ck LEFT JOIN plan p ON p.plan_id = e.plan_id
WINDOW w AS (PARTITION BY e.ck ORDER BY event_at, event_id)"""

VIEWS["hist2"] = """
SELECT *, coalesce((seq = 1 AND event_category = 'acquisition' AND plan_id > 1) OR (seq = 2 AND prev_plan = 1 AND plan_id > 1), false) AS first_paid,
  datediff('day', event_date, next_date) AS until_next FROM hist"""

VIEWS["fse"] = f"""
SELECT h.*, ch.channel_name AS acquisition_channel, ch.channel_category AS acquisition_channel_category,
  ch.is_paid AS is_paid_acquisition, {tenure('age_days')} AS tenure_bucket
FROM hist2 h LEFT JOIN chan ch ON ch.channel_id = h.acquisition_channel_id"""

VIEWS["cm"] = f"""
SELECT customer_id, {month('event_date')} AS m, arg_max(mrr_after, strftime(event_at, '%Y%m%d%H%M%S') || event_id) AS mrr,
  CAST(bool_or(event_category = 'acquisition') AS INTEGER) AS had_acquisition,
  CAST(bool_or(event_category = 'expansion') AS INTEGER) AS had_expansion,
  CAST(bool_or(event_category = 'contraction') AS INTEGER) AS had_contraction,
  CAST(bool_or(event_category = 'churn') AS INTEGER) AS had_churn
FROM ev GROUP BY ALL"""


def _moves(source: str, keep: str) -> str:
    return f"""
SELECT *, CASE WHEN kind IN ('new','resurrection') THEN mrr ELSE 0 END AS new_mrr,
  CASE WHEN kind = 'resurrection' THEN mrr ELSE 0 END AS back_mrr,
  CASE WHEN kind = 'expansion' THEN mrr - had ELSE 0 END AS up_mrr,
  CASE WHEN kind = 'contraction' THEN had - mrr ELSE 0 END AS down_mrr,
  CASE WHEN kind = 'churn' THEN had ELSE 0 END AS lost_mrr
FROM (SELECT customer_id, m, mrr, {keep}, had, nth,
  CASE WHEN mrr > 0 AND nth = 1 THEN 'new' WHEN mrr > 0 AND had = 0 THEN 'resurrection'
       WHEN mrr > had THEN 'expansion' WHEN mrr < had AND mrr > 0 THEN 'contraction'
       WHEN mrr = 0 AND had > 0 THEN 'churn' ELSE 'unchanged' END AS kind
  FROM (SELECT *, coalesce(lag(mrr) OVER w, 0) AS had, row_number() OVER w AS nth FROM {source}
        WINDOW w AS (PARTITION BY customer_id ORDER BY m)))"""


VIEWS["mv"] = _moves("cm", "had_acquisition, had_expansion, had_contraction, had_churn")

# Every month from a customer's first event to today, by joining a calendar.
VIEWS["cal"] = f"""
SELECT CAST(unnest(generate_series((SELECT min(m) FROM cm), {month(AS_OF)}, INTERVAL 1 MONTH)) AS DATE) AS m"""
VIEWS["spine"] = """
SELECT f.customer_id, cal.m, cm.customer_id IS NOT NULL AS has_event,
  last_value(cm.mrr IGNORE NULLS) OVER (PARTITION BY f.customer_id ORDER BY cal.m ROWS UNBOUNDED PRECEDING) AS mrr
FROM (SELECT customer_id, min(m) AS m0 FROM cm GROUP BY customer_id) f JOIN cal ON cal.m >= f.m0
LEFT JOIN cm ON cm.customer_id = f.customer_id AND cm.m = cal.m"""
VIEWS["mvf"] = _moves("spine", "has_event")


def _fact(source: str) -> str:
    return f"""
SELECT *, lag(ending) OVER w AS p_mrr, lag(active) OVER w AS p_active, sum(new_mrr) OVER w AS cum_new, sum(lost_mrr) OVER w AS cum_lost,
  new_mrr + up_mrr AS gross_new, down_mrr + lost_mrr AS gross_lost, new_mrr + up_mrr - down_mrr - lost_mrr AS net_new
FROM (SELECT m, count(*) AS total, count(*) FILTER (WHERE mrr > 0) AS active, count(*) FILTER (WHERE kind = 'new') AS n_new,
  count(*) FILTER (WHERE kind = 'churn') AS n_churn, count(*) FILTER (WHERE kind = 'resurrection') AS n_back,
  count(*) FILTER (WHERE kind = 'expansion') AS n_up, count(*) FILTER (WHERE kind = 'contraction') AS n_down,
  sum(mrr) AS ending, sum(CASE WHEN kind <> 'churn' THEN mrr ELSE 0 END) AS active_mrr, sum(new_mrr) AS new_mrr,
  sum(back_mrr) AS back_mrr, sum(up_mrr) AS up_mrr, sum(down_mrr) AS down_mrr, sum(lost_mrr) AS lost_mrr
FROM {source} GROUP BY m) WINDOW w AS (ORDER BY m)"""


VIEWS["fm"] = _fact("mv")
VIEWS["fmf"] = _fact("mvf")


def _kpi(source: str) -> str:
    return f"""
SELECT *, {pct('ending - p_mrr', 'p_mrr', 2)} AS growth, {pct('active - p_active', 'p_active', 2)} AS cust_growth,
  {pct('lost_mrr', 'p_mrr', 2)} AS mrr_churn, {pct('n_churn', 'p_active', 2)} AS cust_churn,
  {pct('p_mrr + up_mrr - down_mrr - lost_mrr', 'p_mrr', 2)} AS nrr, round({ratio('gross_new', 'gross_lost')}, 2) AS qr,
  round({ratio('active_mrr', 'active')}, 2) AS arpc, {ym('m')} AS month_key FROM {source}"""


VIEWS["fk"] = _kpi("fm")
VIEWS["fkf"] = _kpi("fmf")

VIEWS["cur"] = "SELECT * FROM subs QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY created_at DESC, subscription_id DESC) = 1"
VIEWS["shist"] = """
SELECT customer_id, count(DISTINCT subscription_id) AS n_subs, min(start_date) AS first_start, max(start_date) AS last_start,
  count(*) FILTER (WHERE status = 'churned') AS n_churned FROM subs GROUP BY customer_id"""
VIEWS["emet"] = """
SELECT customer_id, count(*) AS n_events, count(*) FILTER (WHERE event_category = 'expansion') AS ups,
  count(*) FILTER (WHERE event_category = 'contraction') AS downs, count(*) FILTER (WHERE event_category = 'churn') AS churns,
  max(event_date) FILTER (WHERE event_category = 'expansion') AS last_up, max(event_date) FILTER (WHERE event_category = 'contraction') AS last_down,
  max(event_date) FILTER (WHERE event_category = 'churn') AS last_churn, max(mrr_after) AS peak FROM ev GROUP BY customer_id"""
VIEWS["pmet"] = f"""
SELECT customer_id, count(*) AS n_pay, count(*) FILTER (WHERE status = 'succeeded') AS n_ok, count(*) FILTER (WHERE status = 'failed') AS n_bad,
  coalesce(sum(amount) FILTER (WHERE status = 'succeeded'), 0) AS revenue,
  CAST(sum(amount) FILTER (WHERE status = 'succeeded') AS DOUBLE) / NULLIF(count(*) FILTER (WHERE status = 'succeeded'), 0) AS avg_amount,
  min(payment_date) AS first_pay, max(payment_date) AS last_pay FROM pay GROUP BY customer_id"""

VIEWS["dc"] = f"""
SELECT c.*, ch.channel_name AS acquisition_channel, ch.channel_category AS acquisition_channel_category, ch.is_paid AS is_paid_acquisition,
  ip.plan_name AS initial_plan_name, s.subscription_id AS current_subscription_id, s.plan_id AS current_plan_id,
  cp.plan_name AS current_plan_name, cp.plan_tier AS current_plan_tier, s.status AS current_status,
  s.billing_cycle AS current_billing_cycle, coalesce(s.mrr, 0) AS current_mrr, s.start_date AS current_subscription_start,
  s.len AS current_subscription_tenure_days,
  coalesce(c.is_trial AND s.status = 'active' AND s.mrr > 0, false) AS converted_from_trial,
  CASE WHEN s.status = 'churned' THEN 'churned' WHEN s.mrr > 0 THEN 'active_paying' WHEN s.mrr = 0 THEN 'active_free' ELSE 'unknown' END AS customer_status,
  {days(AS_OF, 'signup_date')} AS days_since_signup, {months(AS_OF, 'signup_date')} AS months_since_signup,
  {tenure(days(AS_OF, 'signup_date'))} AS tenure_bucket,
  coalesce(n_subs, 0) AS total_subscriptions, first_start, last_start, coalesce(n_churned, 0) AS times_churned,
  n_churned > 0 AS has_churned, n_churned > 0 AND s.status = 'active' AS is_resurrected,
  coalesce(n_events, 0) AS total_events, coalesce(ups, 0) AS upgrade_count, coalesce(downs, 0) AS downgrade_count,
  last_up, last_down, last_churn, coalesce(peak, 0) AS peak_mrr, coalesce(n_pay, 0) AS total_payments,
  coalesce(n_ok, 0) AS successful_payments, coalesce(n_bad, 0) AS failed_payments, coalesce(revenue, 0) AS lifetime_revenue,
  round(coalesce(avg_amount, 0), 2) AS avg_payment_amount, first_pay, last_pay, {pct('n_ok', 'n_pay', 2)} AS payment_success_rate,
  CASE WHEN s.status = 'churned' THEN 'churned' WHEN downs > ups THEN 'at_risk' WHEN n_bad > 0 AND n_bad >= n_ok * 0.1 THEN 'at_risk'
       WHEN ups > 0 THEN 'healthy' WHEN {days(AS_OF, 'last_pay')} > 45 THEN 'at_risk' ELSE 'stable' END AS health_status
FROM cust c LEFT JOIN cur s USING (customer_id) LEFT JOIN shist USING (customer_id) LEFT JOIN emet USING (customer_id)
LEFT JOIN pmet USING (customer_id) LEFT JOIN chan ch ON ch.channel_id = c.acquisition_channel_id
LEFT JOIN plan ip ON ip.plan_id = c.initial_plan_id LEFT JOIN plan cp ON cp.plan_id = s.plan_id"""

VIEWS["smet"] = """
SELECT subscription_id, count(*) AS n_events, min(event_at) AS first_at, max(event_at) AS last_at,
  count(*) FILTER (WHERE event_category = 'expansion') AS ups, count(*) FILTER (WHERE event_category = 'contraction') AS downs
FROM ev GROUP BY subscription_id"""

VIEWS["ds"] = f"""
SELECT s.*, c.company_name, c.industry, c.company_size, c.country, p.plan_name, p.plan_tier, p.monthly, p.annual, p.storage, p.users,
  coalesce(n_events, 0) AS n_events, coalesce(ups, 0) AS ups, coalesce(downs, 0) AS downs, first_at, last_at,
  CASE WHEN len <= 30 THEN '0-1 month' WHEN len <= 90 THEN '1-3 months' WHEN len <= 180 THEN '3-6 months'
       WHEN len <= 365 THEN '6-12 months' ELSE '12+ months' END AS tenure_bucket,
  CASE WHEN status <> 'churned' THEN NULL WHEN len <= 30 THEN 'early_churn' WHEN len <= 90 THEN 'standard_churn' ELSE 'late_churn' END AS churn_timing
FROM subs s LEFT JOIN cust c USING (customer_id) LEFT JOIN plan p ON p.plan_id = s.plan_id LEFT JOIN smet USING (subscription_id)"""

VIEWS["size"] = f"SELECT {month('signup_date')} AS cohort, count(*) AS cohort_size FROM cust GROUP BY ALL"
VIEWS["ret"] = f"""
SELECT *, first_value(n) OVER w AS m0_n, first_value(total) OVER w AS m0_total, lag(n) OVER w AS prev_n
FROM (SELECT cohort, p, count(*) AS n, sum(mrr) AS total, {mean('mrr')} AS avg_mrr
      FROM (SELECT mrr, {month('c.signup_date')} AS cohort, {months('m', month('c.signup_date'))} AS p
            FROM mv JOIN cust c USING (customer_id) WHERE mrr > 0) WHERE p BETWEEN 0 AND 24 GROUP BY cohort, p)
JOIN size USING (cohort) WINDOW w AS (PARTITION BY cohort ORDER BY p)"""

VIEWS["roll"] = f"""
SELECT acquisition_channel AS channel, acquisition_channel_category AS category, is_paid_acquisition AS paid, count(*) AS acquired,
  count(*) FILTER (WHERE customer_status = 'active_paying') AS paying, count(*) FILTER (WHERE has_churned) AS churned,
  sum(lifetime_revenue) AS revenue, sum(current_mrr) AS mrr, {mean('lifetime_revenue')} AS ltv, {mean('NULLIF(current_mrr, 0)')} AS arpc,
  {mean('days_since_signup')} AS tenure FROM dc GROUP BY ALL"""


def _unit(source: str) -> str:
    return f"""
SELECT channel, category, paid, acquired, paying, churned, greatest({ratio('churned', 'acquired')}, 0.01) AS churn, round(cac, 2) AS cac,
  revenue, mrr, round(arpc, 2) AS arpc, round(ltv, 2) AS ltv, round(spend, 2) AS spend,
  round(arpc * CAST(0.8 AS DOUBLE) / greatest({ratio('churned', 'acquired')}, 0.01), 2) AS pltv, round({ratio('ltv', 'cac')}, 2) AS ltv_cac,
  round({ratio('cac', 'arpc * CAST(0.8 AS DOUBLE)')}, 1) AS payback, {pct('ltv - cac', 'cac')} AS roi, round(tenure) AS tenure,
  {pct('paying', 'acquired')} AS active_rate, {pct('churned', 'acquired')} AS churn_rate FROM ({source})"""


VIEWS["ue0"] = _unit(
    "SELECT r.*, CAST(typical_cac AS DOUBLE) AS cac, acquired * CAST(typical_cac AS DOUBLE) AS spend FROM roll r LEFT JOIN chan ON channel_name = channel"
)
VIEWS["ue1"] = _unit(
    f"""SELECT 'ALL CHANNELS' AS channel, 'blended' AS category, CAST(NULL AS BOOLEAN) AS paid, sum(acquired) AS acquired, sum(paying) AS paying,
  sum(churned) AS churned, sum(revenue) AS revenue, sum(mrr) AS mrr, {ratio('sum(revenue)', 'sum(acquired)')} AS ltv,
  {ratio('sum(mrr)', 'sum(paying)')} AS arpc, avg(tenure) AS tenure, {ratio('sum(spend)', 'sum(acquired)')} AS cac, sum(spend) AS spend FROM ue0"""
)
VIEWS["ue"] = "SELECT * FROM ue0 UNION ALL SELECT * FROM ue1"

VIEWS["pts"] = f"""
SELECT *, {days(AS_OF, 'last_pay')} AS idle, {pct('peak_mrr - current_mrr', 'peak_mrr')} AS erosion,
  least(failed_payments * 8, 25) AS p1,
  CASE WHEN current_mrr = 0 THEN 0 WHEN last_pay IS NULL THEN 15 WHEN {days(AS_OF, 'last_pay')} > 60 THEN 20 WHEN {days(AS_OF, 'last_pay')} > 45 THEN 12 ELSE 0 END AS p2,
  greatest(least((downgrade_count - upgrade_count) * 8, 15), 0) AS p3,
  CASE WHEN peak_mrr > current_mrr THEN least(CAST(round({ratio('peak_mrr - current_mrr', 'peak_mrr')} * 20) AS INTEGER), 20) ELSE 0 END AS p4,
  CASE WHEN is_resurrected THEN 10 WHEN times_churned > 0 THEN 6 ELSE 0 END AS p5,
  CASE WHEN days_since_signup <= 30 THEN 10 WHEN days_since_signup <= 90 THEN 6 ELSE 0 END AS p6
FROM dc WHERE customer_status IN ('active_paying', 'active_free')"""
VIEWS["risk"] = """
SELECT *, CASE WHEN score >= 75 THEN 'critical' WHEN score >= 50 THEN 'high' WHEN score >= 25 THEN 'medium' ELSE 'low' END AS band,
  CASE WHEN score >= 50 THEN current_mrr ELSE 0 END AS at_risk FROM (SELECT *, least(p1 + p2 + p3 + p4 + p5 + p6, 100) AS score FROM pts)"""

VIEWS["worth"] = "SELECT customer_id, min(start_date) AS first_start, max(mrr) AS worth FROM subs GROUP BY customer_id"
VIEWS["tp0"] = """
SELECT t.*, ch.channel_name, ch.channel_category, ch.is_paid, ch.typical_cac, c.company_size, c.industry, v.worth,
  row_number() OVER w AS seq, count(*) OVER p AS n, min(touched_at) OVER p AS first_at, max(touched_at) OVER p AS last_at,
  pow(0.5, t.d / CAST(7 AS DOUBLE)) AS power, sum(pow(0.5, t.d / CAST(7 AS DOUBLE))) OVER p AS powers
FROM touch t LEFT JOIN chan ch USING (channel_id) LEFT JOIN cust c ON c.customer_id = t.customer_id LEFT JOIN worth v ON v.customer_id = t.customer_id
WINDOW w AS (PARTITION BY t.customer_id ORDER BY touched_at, touch_id), p AS (PARTITION BY t.customer_id)"""
VIEWS["tp"] = """
SELECT *, CASE WHEN seq = 1 THEN 'awareness' WHEN seq = n THEN 'decision' WHEN seq <= n / 2.0 THEN 'consideration_early' ELSE 'consideration_late' END AS stage,
  w_first * v0 AS r_first, w_last * v0 AS r_last, w_linear * v0 AS r_linear, w_decay * v0 AS r_decay, w_pos * v0 AS r_pos
FROM (SELECT *, CAST(coalesce(worth, 0) AS DOUBLE) AS v0, CASE WHEN seq = 1 THEN CAST(1 AS DOUBLE) ELSE 0 END AS w_first, CASE WHEN seq = n THEN CAST(1 AS DOUBLE) ELSE 0 END AS w_last,
  CAST(1 AS DOUBLE) / n AS w_linear, CASE WHEN d >= 0 THEN power / powers ELSE CAST(1 AS DOUBLE) / n END AS w_decay,
  CASE WHEN n = 1 THEN CAST(1 AS DOUBLE) WHEN n = 2 THEN CAST(0.5 AS DOUBLE) WHEN seq IN (1, n) THEN CAST(0.4 AS DOUBLE) ELSE CAST(0.2 AS DOUBLE) / (n - 2) END AS w_pos
FROM tp0)"""

_NAME = re.compile(r"[A-Za-z_][A-Za-z_0-9]*")


def needs(body: str) -> list[str]:
    """Views a statement mentions, in definition order, with their own needs first."""
    words = set(_NAME.findall(body))
    wanted: set[str] = set()

    def visit(names: set[str]) -> None:
        for name in names & VIEWS.keys():
            if name not in wanted:
                wanted.add(name)
                visit(set(_NAME.findall(VIEWS[name])))

    visit(words)
    return [v for v in VIEWS if v in wanted]


def sql(body: str) -> str:
    views = needs(body)
    if not views:
        return body
    head = ",\n".join(f"{v} AS ({VIEWS[v].strip()})" for v in views)
    if body.lstrip().upper().startswith("WITH "):
        return f"WITH {head},\n{body.lstrip()[5:]}"
    return f"WITH {head}\n{body}"
