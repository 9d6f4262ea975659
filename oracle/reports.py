"""Oracle statements for the 36 analyses (q…)."""

from oracle.views import AS_OF, days, mean, month, months, out, pct, ratio, sql, ym, yq

Q: dict[str, str] = {}


def q(name: str, body: str) -> None:
    Q[name] = sql(body)


def share(cond: str) -> str:
    return f"round(CAST(count(*) FILTER (WHERE {cond}) AS DOUBLE) / count(*) * 100, 1)"


def m2(x: str) -> str:
    return f"round({mean(x)}, 2)"


def m0(x: str) -> str:
    return f"round({mean(x)})"


_coh = month("signup_date")
q("q01_cohort_retention", f"""WITH a AS (SELECT DISTINCT customer_id, {month('event_date')} AS am FROM fse WHERE mrr_after > 0)
SELECT {out('cohort=' + ym('cohort') + ':s; cohort_size=any_value(cohort_size):n; month_number=' + months('am', 'cohort') + ':n; active_customers=count(*):n; retention_pct='
+ pct('count(*)', 'any_value(cohort_size)') + ':m')}
FROM a JOIN (SELECT customer_id, {_coh} AS cohort FROM cust) USING (customer_id) JOIN size USING (cohort)
WHERE am >= cohort AND {months('am', 'cohort')} <= 12 GROUP BY cohort, am""")

q("q02_cohort_revenue_retention", f"""WITH g AS (SELECT {_coh} AS cohort, {months(month('event_date'), _coh)} AS p, sum(mrr_after) AS total, count(DISTINCT customer_id) AS n
  FROM fse WHERE mrr_after > 0 GROUP BY ALL)
SELECT {out('cohort_month=' + ym('g.cohort') + ':s; month_number=g.p:n; active_customers=g.n:n; m0_customers=b.n:n; customer_retention_pct=' + pct('g.n', 'b.n')
+ ':m; mrr=g.total:m; m0_mrr=b.total:m; net_revenue_retention_pct=' + pct('g.total', 'b.total') + ':m')}
FROM g JOIN g b ON b.cohort = g.cohort AND b.p = 0 WHERE g.p BETWEEN 0 AND 12""")

q("q03_cohort_comparison", f"""SELECT {out('cohort=' + ym('signup_date') + ''':s; total_customers=count(*):n; active_customers=count(*) FILTER (WHERE customer_status = 'active_paying'):n;
churned_customers=count(*) FILTER (WHERE has_churned):n; customers_upgraded=count(*) FILTER (WHERE upgrade_count > 0):n;
trial_conversions=count(*) FILTER (WHERE converted_from_trial):n; avg_ltv=''' + m2('lifetime_revenue') + ''':m;
avg_current_mrr=''' + m2("CASE WHEN customer_status = 'active_paying' THEN current_mrr END") + ':m; avg_tenure_days=' + m0('days_since_signup') + ''':m;
current_retention_pct=''' + share("customer_status = 'active_paying'") + ':m; churn_pct=' + share('has_churned') + ':m; upgrade_pct=' + share('upgrade_count > 0')
+ ':m; trial_conversion_pct=' + share('converted_from_trial') + ':m')} FROM dc GROUP BY {ym('signup_date')}""")

q("q04_cohort_behaviour", f"""SELECT {out('''initial_plan_name:s; company_size:s; is_paid_acquisition:s; is_trial:s; customers=count(*):n; retention_rate=''' + share('NOT has_churned')
+ ':m; avg_engagement_score=' + m2("""CASE WHEN upgrade_count > 0 THEN 3 WHEN customer_status <> 'active_paying' THEN 0 WHEN downgrade_count = 0 THEN 2 ELSE 1 END""")
+ ':m; trial_conversion_rate=' + share('converted_from_trial') + ':m')} FROM dc GROUP BY initial_plan_name, company_size, is_paid_acquisition, is_trial HAVING count(*) >= 10""")

q("q05_monthly_churn", f"""SELECT {out('month=g.k:s; churned_customers=g.n:n; beginning_customers=f.active:n; customer_churn_rate=' + pct('g.n', 'f.active', 2)
+ ':m; churned_mrr=g.lost:m; beginning_mrr=f.active_mrr:m; mrr_churn_rate=' + pct('g.lost', 'f.active_mrr', 2) + ':m')}
FROM (SELECT {ym('event_date')} AS k, count(DISTINCT customer_id) AS n, sum(abs(mrr_change)) AS lost FROM fse WHERE event_category = 'churn' GROUP BY 1) g
LEFT JOIN fk f ON f.month_key = g.k""")

q("q06_churn_by_segment", f"""SELECT {out('''industry:s; company_size:s; initial_plan_name:s; acquisition_channel:s; is_paid_acquisition:s; total_customers=count(*):n;
churned_customers=count(*) FILTER (WHERE has_churned):n; churn_rate=''' + share('has_churned') + ':m; avg_days_to_churn=' + m0('CASE WHEN has_churned THEN days_since_signup END')
+ ':m; avg_churned_ltv=' + m2('CASE WHEN has_churned THEN lifetime_revenue END') + ':m; avg_retained_ltv=' + m2('CASE WHEN NOT has_churned THEN lifetime_revenue END') + ':m')}
FROM dc GROUP BY industry, company_size, initial_plan_name, acquisition_channel, is_paid_acquisition HAVING count(*) >= 10""")

q("q07_churn_timing", f"""SELECT {out('tenure_bucket:s; churn_count=count(*):n; pct_of_total_churn=' + pct('count(*)', 'sum(count(*)) OVER ()') + ':m; avg_mrr_lost='
+ m2('abs(mrr_change)') + ':m; total_mrr_lost=sum(abs(mrr_change)):m')} FROM fse WHERE event_category = 'churn' GROUP BY tenure_bucket""")

q("q08_pre_churn", f"""SELECT {out('timing:s; event_type:s; occurrence_count=count(*):n; unique_customers=count(DISTINCT customer_id):n')} FROM (
SELECT e.customer_id, e.event_type, CASE WHEN gap <= 7 THEN '0-7 days before' WHEN gap <= 30 THEN '8-30 days before' WHEN gap <= 60 THEN '31-60 days before' ELSE '61-90 days before' END AS timing
FROM (SELECT e.customer_id, e.event_type, datediff('day', e.event_date, c.event_date) AS gap FROM fse c JOIN fse e ON e.customer_id = c.customer_id
  AND e.event_date < c.event_date AND e.event_date >= c.event_date - INTERVAL 90 DAY WHERE c.event_category = 'churn') e) GROUP BY timing, event_type""")

_idle = days(AS_OF, "last_pay")
q("q09_at_risk_customers", f"""SELECT {out('''customer_id:s; company_name:s; current_mrr:m; days_since_signup:n; days_since_last_payment=idle:n; downgrade_count:n; failed_payments:n; risk_score=sc:n;
risk_category=CASE WHEN sc >= 40 THEN 'High Risk' WHEN sc >= 20 THEN 'Medium Risk' ELSE 'Low Risk' END:s''')} FROM (
SELECT *, {_idle} AS idle, CASE WHEN downgrade_count > 0 THEN 20 ELSE 0 END + CASE WHEN failed_payments > 0 THEN 15 ELSE 0 END
 + CASE WHEN {_idle} > 45 THEN 25 WHEN {_idle} > 30 THEN 10 ELSE 0 END + CASE WHEN days_since_signup <= 90 THEN 15 ELSE 0 END
 + CASE WHEN upgrade_count > 0 THEN -15 ELSE 0 END + CASE current_plan_tier WHEN 'enterprise' THEN -10 WHEN 'business' THEN -5 ELSE 0 END AS sc
FROM dc WHERE customer_status = 'active_paying') WHERE sc > 0 ORDER BY sc DESC, current_mrr DESC, customer_id LIMIT 100""")

q("q10_churned_vs_retained", f"""SELECT {out('segment:s; customers=count(customer_id):n; avg_tenure_days=' + m0('days_since_signup') + ':m; avg_lifetime_revenue=' + m2('lifetime_revenue')
+ ':m; avg_upgrades=' + m2('upgrade_count') + ':m; avg_downgrades=' + m2('downgrade_count') + ':m; pct_paid_acquisition=' + pct('count(*) FILTER (WHERE is_paid_acquisition)', 'count(customer_id)')
+ ':m; pct_started_trial=' + pct('count(*) FILTER (WHERE is_trial)', 'count(customer_id)') + ':m; pct_trial_converted=' + pct('count(*) FILTER (WHERE converted_from_trial)', 'count(customer_id)') + ':m')}
FROM (VALUES ('Churned', true), ('Retained', false)) s(segment, gone) LEFT JOIN dc ON has_churned = gone AND (gone OR customer_status = 'active_paying') GROUP BY segment""")

q("q11_channel_overview", f"""SELECT {out('''acquisition_channel=channel:s; acquisition_channel_category=category:s; is_paid_acquisition=paid:s; total_customers=acquired:n; active_customers=paying:n;
churned_customers=churned:n; total_revenue=revenue:m; current_mrr=mrr:m; avg_ltv=round(ltv, 2):m; avg_mrr=round(''' + ratio('mrr', 'acquired') + ''', 2):m;
retention_rate=''' + pct('paying', 'acquired') + ':m; churn_rate=' + pct('churned', 'acquired') + ':m')} FROM roll""")

_dec = lambda x: f"sum(CAST({x} AS DECIMAL(28,10)))"
q("q12_attribution_comparison", f"""SELECT {out('''channel_name:s; channel_category:s; is_paid:s; first_touch_customers=count(DISTINCT customer_id) FILTER (WHERE seq = 1):n;
last_touch_customers=count(DISTINCT customer_id) FILTER (WHERE seq = n):n; any_touch_customers=count(DISTINCT customer_id):n; total_touches=count(*):n;
avg_days_to_conversion=round(''' + mean('d') + ', 1):m; ' + '; '.join(f"{k}_revenue=round({_dec(c)}, 2):m" for k, c in
[('first_touch', 'r_first'), ('last_touch', 'r_last'), ('linear', 'r_linear'), ('time_decay', 'r_decay'), ('position_based', 'r_pos')])
+ f"; first_vs_last_delta=round({_dec('r_first')} - {_dec('r_last')}, 2):m")} FROM tp GROUP BY channel_name, channel_category, is_paid""")

q("q13_journey_positions", f"""SELECT {out('channel_name:s; journey_stage=stage:s; touches=count(*):n; unique_customers=count(DISTINCT customer_id):n; avg_customer_value=' + m2('worth')
+ ':m; pct_of_channel_touches=' + pct('count(*)', 'sum(count(*)) OVER (PARTITION BY channel_name)') + ':m')} FROM tp GROUP BY channel_name, stage""")

q("q14_journeys_by_length", f"""SELECT {out('total_touches=n:n; customers=count(*):n; avg_customer_value=' + m2('v') + ':m; avg_journey_days=round(' + mean('dd') + ', 1):m')}
FROM (SELECT customer_id, n, max(worth) AS v, max(d) AS dd FROM tp GROUP BY ALL) GROUP BY n""")

q("q15_channel_pairs", f"""SELECT {out('first_channel:s; last_channel:s; customers=c:n; total_mrr=total:m; avg_mrr:m')} FROM (
SELECT first_channel, last_channel, count(*) AS c, sum(v) AS total, {m2('v')} AS avg_mrr FROM (
  SELECT customer_id, min(channel_name) FILTER (WHERE seq = 1) AS first_channel, max(channel_name) FILTER (WHERE seq = n) AS last_channel, max(worth) AS v FROM tp GROUP BY 1)
GROUP BY 1, 2 HAVING count(*) >= 5) ORDER BY total DESC NULLS LAST, first_channel, last_channel LIMIT 20""")

q("q16_channel_segments", f"""SELECT {out('acquisition_channel:s; company_size:s; customers=count(*):n; avg_ltv=' + m2('lifetime_revenue') + ':m; avg_mrr=' + m2('current_mrr')
+ ':m; retention_rate_pct=' + share('coalesce(NOT has_churned, true)') + ':m')} FROM dc GROUP BY acquisition_channel, company_size, industry HAVING count(*) >= 10""")

q("q17_paid_vs_organic", f"""SELECT {out("channel_type=CASE WHEN is_paid_acquisition THEN 'Paid' ELSE 'Organic' END:s; total_customers=count(*):n; avg_ltv=" + m2('lifetime_revenue')
+ ':m; avg_current_mrr=' + m2('current_mrr') + ':m; total_revenue=sum(lifetime_revenue):m; churn_rate=' + share('has_churned') + ':m; avg_upgrades=' + m2('upgrade_count')
+ ':m; avg_tenure_days=' + m0('days_since_signup') + ':m')} FROM dc GROUP BY 1""")

q("q18_lifecycle_stages", f"""SELECT {out('lifecycle_stage=st:s; customers=count(*):n; pct_of_base=' + pct('count(*)', 'sum(count(*)) OVER ()') + ':m; stage_mrr=sum(current_mrr):m; avg_mrr='
+ m2('current_mrr') + ':m')} FROM (SELECT *, CASE WHEN customer_status = 'churned' THEN '5_churned' WHEN upgrade_count > 0 THEN '4_expansion'
 WHEN customer_status = 'active_paying' THEN '3_paying' WHEN customer_status = 'active_free' THEN '2_activated_free' ELSE '1_signed_up' END AS st FROM dc) GROUP BY st""")

q("q19_trial_conversion", f"""SELECT {out('is_trial:s; customers=count(*):n; converted=count(*) FILTER (WHERE converted_from_trial):n; trial_conversion_rate_pct=' + share('converted_from_trial')
+ ':m; avg_mrr=' + m2('current_mrr') + ':m')} FROM dc GROUP BY is_trial""")

q("q20_time_to_value", f"""SELECT {out('customers=count(*):n; avg_days_to_paid=round(' + mean('tp_days') + ', 1):m; median_days_to_paid=quantile_disc(tp_days, 0.5):m; avg_days_to_churn=round('
+ mean('tc_days') + ', 1):m; customers_who_upgraded=sum(u):n; customers_who_churned=sum(c):n')} FROM (
SELECT customer_id, min(age_days) FILTER (WHERE first_paid) AS tp_days, max(age_days) FILTER (WHERE event_category = 'churn') AS tc_days,
 max(ever_upgraded) AS u, max(ever_churned) AS c FROM hist2 GROUP BY customer_id)""")

q("q21_plan_progression", f"""SELECT {out('initial_plan_name:s; current_plan_name:s; customers=count(*):n; avg_current_mrr=' + m2('current_mrr') + ':m; avg_upgrades=' + m2('upgrade_count')
+ ':m; avg_downgrades=' + m2('downgrade_count') + ':m')} FROM dc WHERE initial_plan_name IS NOT NULL GROUP BY initial_plan_name, current_plan_name HAVING count(*) >= 5""")

q("q22_tenure_survival", f"""SELECT {out("tenure_bucket:s; customers=count(*):n; still_active=count(*) FILTER (WHERE customer_status <> 'churned'):n; survival_rate_pct="
+ share("customer_status <> 'churned'") + ':m; avg_lifetime_revenue=' + m2('lifetime_revenue') + ':m')} FROM dc GROUP BY tenure_bucket""")

q("q23_latest_snapshot", f"""SELECT {out('''month_key:s; active_customers=active:n; ending_mrr=ending:m; arr=active_mrr * 12:m; arpc:m; nrr_pct=round(nrr, 1):m;
gross_mrr_churn_pct=round(mrr_churn, 1):m; quick_ratio=qr:m; mrr_growth_pct=round(growth, 1):m''')} FROM fk ORDER BY m DESC LIMIT 1""")
q("q24_mrr_waterfall", f"""SELECT {out('''month_key:s; ending_mrr=ending:m; new_mrr:m; expansion_mrr=up_mrr:m; contraction_mrr=0 - down_mrr:m; churned_mrr=0 - lost_mrr:m;
net_new_mrr=net_new:m; mrr_growth_pct=round(growth, 1):m''')} FROM fk""")
q("q25_growth_efficiency", f"""SELECT {out('month_key:s; mrr_growth_pct=round(growth, 1):m; quick_ratio=qr:m; nrr_pct=round(nrr, 1):m; rule_of_40_proxy=round(growth + (nrr - 100), 1):m')}
FROM fk WHERE growth IS NOT NULL""")
q("q26_quarter_over_quarter", f"""SELECT {out('quarter=k:s; quarter_end_mrr=top:m; arr=top * 12:m; net_new_mrr=nn:m; qoq_growth_pct=' + pct('top - prev', 'prev') + ':m')} FROM (
SELECT *, lag(top) OVER (ORDER BY k) AS prev FROM (SELECT {yq('m')} AS k, max(ending) AS top, sum(net_new) AS nn FROM fk GROUP BY 1))""")
q("q27_performance_by_tier", f"""SELECT {out("plan_tier:s; subscriptions=count(*):n; active_subscriptions=count(*) FILTER (WHERE status = 'active'):n; active_mrr=coalesce(sum(mrr) FILTER (WHERE status = 'active'), 0):m; avg_mrr="
+ m2('mrr') + ':m; avg_tenure_days=' + m0('len') + ':m; churn_rate_pct=' + share("status = 'churned'") + ':m')} FROM ds GROUP BY plan_tier""")

q("q28_channel_scorecard", f"""SELECT {out('''acquisition_channel=channel:s; acquisition_channel_category=category:s; customers_acquired=acquired:n; cac:m; realized_ltv=ltv:m; predicted_ltv=pltv:m;
ltv_to_cac_ratio=ltv_cac:m; cac_payback_months=payback:m; acquisition_roi_pct=roi:m; total_acquisition_spend=spend:m; total_lifetime_revenue=revenue:m;
recommended_action=CASE WHEN ltv_cac >= 3 AND payback <= 12 THEN 'scale' WHEN ltv_cac >= 1 THEN 'optimize' ELSE 'reduce' END:s''')} FROM ue0""")
q("q29_paid_vs_organic_return", f"""SELECT {out("channel_type=CASE WHEN paid THEN 'Paid' ELSE 'Organic' END:s; customers=sum(acquired):n; total_spend=round(sum(spend), 2):m; total_revenue=sum(revenue):m; blended_cac=round("
+ ratio('sum(spend)', 'sum(acquired)') + ', 2):m; blended_ltv=round(' + ratio('sum(revenue)', 'sum(acquired)') + ', 2):m; blended_roi_pct=' + pct('CAST(sum(revenue) AS DOUBLE) - sum(spend)', 'sum(spend)') + ':m')}
FROM ue0 GROUP BY 1""")
q("q30_spend_frontier", f"""SELECT {out('acquisition_channel=channel:s; total_acquisition_spend=spend:m; total_lifetime_revenue=revenue:m; revenue_per_dollar=round(' + ratio('revenue', 'spend')
+ ', 2):m; pct_of_total_revenue=' + pct('revenue', 'sum(revenue) OVER ()') + ':m; pct_of_total_spend=' + pct('spend', 'sum(spend) OVER ()') + ':m')} FROM ue0""")
q("q31_channel_by_tier", f"""SELECT {out('acquisition_channel:s; current_plan_tier:s; customers=count(*):n; avg_ltv=' + m2('lifetime_revenue') + ':m; current_mrr=sum(current_mrr):m')}
FROM dc WHERE current_plan_tier IS NOT NULL GROUP BY acquisition_channel, current_plan_tier HAVING count(*) >= 5""")

q("q32_revenue_by_industry", f"""SELECT {out("industry:s; customers=count(*):n; active_paying=count(*) FILTER (WHERE customer_status = 'active_paying'):n; current_mrr=sum(current_mrr):m; pct_of_mrr="
+ pct('sum(current_mrr)', 'sum(sum(current_mrr)) OVER ()') + ':m; avg_mrr=' + m2('current_mrr') + ':m; avg_ltv=' + m2('lifetime_revenue') + ':m')} FROM dc GROUP BY industry""")
q("q33_penetration_by_size", f"""SELECT {out('company_size:s; customers=count(*):n; paying_rate_pct=' + share("customer_status = 'active_paying'") + ':m; arpu=' + m2('current_mrr')
+ ':m; segment_mrr=sum(current_mrr):m; avg_ltv=' + m2('lifetime_revenue') + ':m')} FROM dc GROUP BY company_size""")
q("q34_revenue_by_country", f"""SELECT {out('country:s; customers=count(*):n; current_mrr=sum(current_mrr):m; pct_of_mrr=' + pct('sum(current_mrr)', 'sum(sum(current_mrr)) OVER ()')
+ ':m; churn_rate_pct=' + share('has_churned') + ':m')} FROM dc GROUP BY country""")
q("q35_industry_by_tier", f"""SELECT {out('industry:s; current_plan_tier:s; customers=count(*):n; pct_within_industry=' + pct('count(*)', 'sum(count(*)) OVER (PARTITION BY industry)')
+ ':m; current_mrr=sum(current_mrr):m')} FROM dc WHERE current_plan_tier IS NOT NULL GROUP BY industry, current_plan_tier""")
q("q36_segment_health", f"""SELECT {out('''company_size:s; industry:s; customers=c:n; arpu:m; churn_rate_pct=churn:m; segment_mrr=total:m; paying_rate_pct=paying:m;
segment_label=CASE WHEN churn >= 40 THEN 'at_risk' WHEN arpu >= 50 AND c < 30 THEN 'whitespace' WHEN total >= 1000 THEN 'core' ELSE 'steady' END:s''')} FROM (
SELECT company_size, industry, count(*) AS c, {m2('current_mrr')} AS arpu, {share('has_churned')} AS churn, sum(current_mrr) AS total,
 {share("customer_status = 'active_paying'")} AS paying FROM dc GROUP BY 1, 2 HAVING count(*) >= 10)""")
