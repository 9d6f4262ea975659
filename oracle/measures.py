"""Oracle statements for KPI measures, documented metrics, report datasets and checks."""

import re

from oracle.models import BODIES
from oracle.views import AS_OF, VIEWS, days, mean, month, months, out, pct, ratio, sql, ym, yq

Q: dict[str, str] = {}


def q(name: str, body: str) -> None:
    Q[name] = sql(body)


def r6(x: str) -> str:
    return f"round({x}, 6)"


def measures(flow: str = "{}") -> str:
    """K1-K23, K34, K44 over columns mrr, act_mrr, nw, up, dn, lo, act, n_new, n_churn, b, b_act."""
    growth, nrr = ratio("mrr - b", "b"), ratio("b + up - dn - lo", "b")
    cols = {
        "mrr": "mrr", "arr": "mrr * 12", "active_mrr": "act_mrr", "new_mrr": "nw", "expansion_mrr": "up",
        "contraction_mrr": "dn", "churned_mrr": "lo", "net_new_mrr": "nw + up - dn - lo", "gross_new_mrr": "nw + up",
        "gross_lost_mrr": "dn + lo", "mrr_mom": growth, "mrr_annualised_growth": " * ".join([f"(({growth} + 1) * ({growth} + 1) * ({growth} + 1))"] * 4) + " - 1",
        "beginning_mrr": "b", "net_revenue_retention": nrr, "gross_revenue_retention": ratio("b - dn - lo", "b"),
        "gross_mrr_churn": ratio("lo", "b"), "logo_churn": ratio("n_churn", "b_act"), "quick_ratio": ratio("nw + up", "dn + lo"),
        "arpc": ratio("act_mrr", "act"), "arpa_annual": ratio("act_mrr", "act") + " * 12",
        "rule_of_40_proxy": f"{growth} * 12 + ({nrr} - 1)",
    }
    spec = "; ".join(f"{k}={r6(f'CAST({v} AS DOUBLE)')}:m" for k, v in cols.items())
    status = f"CASE WHEN {nrr} >= 1.2 THEN 'Excellent' WHEN {nrr} >= 1 THEN 'Good' WHEN {nrr} < 1 THEN 'Needs attention' END"
    return spec + f"; active_customers=act:n; new_customers=n_new:n; churned_customers=n_churn:n; nrr_status={status}:s"


# Previous calendar month by joining the table to itself one month later.
def by_month(fact: str) -> str:
    return f"""SELECT a.m, a.ending AS mrr, a.active_mrr AS act_mrr, a.new_mrr AS nw, a.up_mrr AS up, a.down_mrr AS dn, a.lost_mrr AS lo, a.active AS act,
  a.n_new, a.n_churn, p.ending AS b, p.active AS b_act FROM {fact} a LEFT JOIN {fact} p ON a.m = p.m + INTERVAL 1 MONTH"""


VIEWS["km"] = by_month("fm")
VIEWS["kmf"] = by_month("fmf")
q("k01_k23_revenue_measures", f"SELECT {out('month_date=m:d; ' + measures())} FROM km")
q("k01_k23_revenue_measures_filled", f"SELECT {out('month_date=m:d; ' + measures())} FROM kmf")


def scope(source: str, keys: str, inside: str) -> str:
    using = f"USING ({keys})" if keys else "ON true"
    k, g = (keys + ", ", f"GROUP BY {keys}") if keys else ("", "")
    return f"""SELECT {k}lm, sum(new_mrr) FILTER (WHERE {inside}) AS nw, sum(up_mrr) FILTER (WHERE {inside}) AS up, sum(down_mrr) FILTER (WHERE {inside}) AS dn,
  sum(lost_mrr) FILTER (WHERE {inside}) AS lo, sum(n_new) FILTER (WHERE {inside}) AS n_new, sum(n_churn) FILTER (WHERE {inside}) AS n_churn,
  sum(ending) FILTER (WHERE m = lm) AS mrr, sum(active_mrr) FILTER (WHERE m = lm) AS act_mrr, sum(active) FILTER (WHERE m = lm) AS act,
  sum(ending) FILTER (WHERE m = lm - INTERVAL 1 MONTH) AS b, sum(active) FILTER (WHERE m = lm - INTERVAL 1 MONTH) AS b_act
FROM {source} JOIN (SELECT {k}max(m) AS lm FROM {source} WHERE {inside} {g}) l {using} GROUP BY {k}lm"""


_year = "m BETWEEN DATE '1999-01-01' AND DATE '1999-12-01'"
q("k01_k23_scope_measures", f"SELECT {out('last_month=lm:d; ' + measures())} FROM ({scope('fm', '', _year)})")


def slices(source: str, keys: str) -> str:
    return f"""SELECT {keys}, m, sum(mrr) AS ending, coalesce(sum(mrr) FILTER (WHERE kind <> 'churn'), 0) AS active_mrr, count(*) FILTER (WHERE mrr > 0) AS active,
  count(*) FILTER (WHERE kind = 'new') AS n_new, count(*) FILTER (WHERE kind = 'churn') AS n_churn, sum(new_mrr) AS new_mrr, sum(up_mrr) AS up_mrr,
  sum(down_mrr) AS down_mrr, sum(lost_mrr) AS lost_mrr FROM {source} JOIN dc USING (customer_id) GROUP BY {keys}, m"""


VIEWS["sl_chan"] = slices("mvf", "acquisition_channel")
VIEWS["kmc"] = """SELECT a.acquisition_channel, a.m, a.ending AS mrr, a.active_mrr AS act_mrr, a.new_mrr AS nw, a.up_mrr AS up, a.down_mrr AS dn, a.lost_mrr AS lo, a.active AS act,
  a.n_new, a.n_churn, p.ending AS b, p.active AS b_act FROM sl_chan a LEFT JOIN sl_chan p ON a.m = p.m + INTERVAL 1 MONTH AND a.acquisition_channel = p.acquisition_channel"""
q("v15_revenue_by_channel", f"SELECT {out('acquisition_channel:s; month_date=m:d; ' + measures())} FROM kmc")
_slicers = {"plan_tier": "current_plan_tier", "channel": "acquisition_channel", "industry": "industry", "company_size": "company_size", "all": "whole"}
for _name, _col in _slicers.items():
    VIEWS[f"sl_{_name}"] = slices("(SELECT *, 'all' AS whole FROM mvf)", _col)
VIEWS["kms"] = " UNION ALL ".join(f"""SELECT '{n}' AS slicer, a.{c} AS value, a.m, a.ending AS mrr, a.active_mrr AS act_mrr, a.new_mrr AS nw, a.up_mrr AS up, a.down_mrr AS dn, a.lost_mrr AS lo,
  a.active AS act, a.n_new, a.n_churn, p.ending AS b, p.active AS b_act FROM sl_{n} a LEFT JOIN sl_{n} p ON a.m = p.m + INTERVAL 1 MONTH AND a.{c} IS NOT DISTINCT FROM p.{c}""" for n, c in _slicers.items())
q("v15_revenue_by_slicer", f"SELECT {out('slicer:s; value:s; month_date=m:d; ' + measures())} FROM kms")
VIEWS["acct"] = """SELECT d.current_plan_tier, d.acquisition_channel, d.industry, d.company_size, 'all' AS whole, d.customer_id, d.customer_status, d.has_churned, d.current_mrr, d.lifetime_revenue,
  r.score, r.band, r.at_risk, CAST(c.typical_cac AS DOUBLE) AS cost FROM dc d LEFT JOIN risk r ON r.customer_id = d.customer_id LEFT JOIN chan c ON c.channel_name = d.acquisition_channel"""
VIEWS["accs"] = " UNION ALL ".join(f"""SELECT '{n}' AS slicer, {c} AS value, count(*) AS n, count(*) FILTER (WHERE customer_status = 'active_paying') AS paying, count(*) FILTER (WHERE has_churned) AS gone,
  sum(current_mrr) AS mrr, sum(lifetime_revenue) AS rev, sum(cost) AS spend, count(*) FILTER (WHERE band IN ('high', 'critical')) AS risky, sum(at_risk) AS lose, {mean('score')} AS score,
  {mean('current_mrr')} AS arpu, {mean('NULLIF(current_mrr, 0)')} * CAST(0.8 AS DOUBLE) AS margin FROM acct GROUP BY {c}""" for n, c in _slicers.items())
_accounts = """slicer:s; value:s; total_customers=n:n; paying_customers=paying:n; churned_customers=gone:n; total_mrr=mrr:m; lifetime_revenue=rev:m;
acquisition_spend=round(spend, 6):m; customers_at_risk=risky:n; mrr_at_risk=lose:m; arpu=round(arpu, 6):m; cac=round(spend / n, 6):m; realized_ltv=round(CAST(rev AS DOUBLE) / n, 6):m;
predicted_ltv=round(margin / greatest(CAST(gone AS DOUBLE) / n, 0.01), 6):m; ltv_to_cac=round(CAST(rev AS DOUBLE) / n / (spend / n), 6):m; cac_payback_months=round(spend / n / margin, 6):m;
acquisition_roi=round((CAST(rev AS DOUBLE) / n - spend / n) / (spend / n), 6):m; revenue_per_spend=round(CAST(rev AS DOUBLE) / spend, 6):m; avg_churn_risk_score=round(score, 6):m;
pct_mrr_at_risk=round(CAST(lose AS DOUBLE) / NULLIF(CAST(mrr AS DOUBLE), 0), 6):m"""
q("v15_accounts_by_slicer", f"SELECT {out(_accounts)} FROM accs")
VIEWS["sl_ts"] = slices("mv", "current_plan_tier, company_size")
q("v15_revenue_by_tier_and_size", f"SELECT {out('current_plan_tier:s; company_size:s; last_month=lm:d; ' + measures())} FROM ({scope('sl_ts', 'current_plan_tier, company_size', 'true')})")

_cust = f"total_customers=count(*):n; paying_customers=count(*) FILTER (WHERE customer_status = 'active_paying'):n; total_mrr=sum(current_mrr):m; arpu={r6(mean('current_mrr'))}:m"
q("k24_k25_customer_measures", f"SELECT {out(_cust)} FROM dc")
q("k47_customers_by_industry", f"SELECT {out('industry:s; ' + _cust)} FROM dc GROUP BY industry")


def econ(source: str, by: str = "") -> str:
    spec = "; ".join(f"{k}={r6(f'avg({v})')}:m" for k, v in [("cac", "cac"), ("realized_ltv", "ltv"), ("predicted_ltv", "pltv"),
                     ("ltv_to_cac", "ltv_cac"), ("cac_payback_months", "payback")])
    return f"""SELECT {by and by + ', '}{out(spec + f'''; acquisition_roi={r6('avg(roi) / 100')}:m; total_acquisition_spend={r6('sum(spend)')}:m; revenue_per_spend={r6(ratio('sum(revenue)', 'sum(spend)'))}:m;
ltv_cac_status=CASE WHEN avg(ltv_cac) >= 3 THEN 'Healthy' WHEN avg(ltv_cac) >= 1 THEN 'Marginal' ELSE 'Unprofitable' END:s;
payback_status=CASE WHEN avg(payback) <= 12 THEN 'Excellent' WHEN avg(payback) <= 18 THEN 'Good' ELSE 'Concerning' END:s''')} FROM {source} {by and 'GROUP BY ALL'}"""


q("k26_k33_unit_economics", econ("ue0"))
q("k26_k33_by_category", econ("ue0", "category AS acquisition_channel_category"))
q("k51_economics_with_total", econ("ue"))
_g, _n = ratio("mrr - b", "b"), ratio("b + up - dn - lo", "b")
_efficiency = f"""month_date=m:d; rule_of_40_proxy={r6(f'{_g} * 12 + ({_n} - 1)')}:m; magic_number={r6(ratio('(nw + up - dn - lo) * 12', 'total'))}:m;
burn_multiple_proxy={r6(ratio('total', '(nw + up - dn - lo) * 12'))}:m"""
q("k34_k36_efficiency", f"SELECT {out(_efficiency)} FROM kmf, (SELECT sum(spend) AS total FROM ue0)")
q("k34_k36_by_channel", f"SELECT {out('acquisition_channel:s; ' + _efficiency)} FROM kmc LEFT JOIN (SELECT channel, spend AS total FROM ue0) ON channel = acquisition_channel")
_risk = f"""customer_count=count(*):n; avg_churn_risk_score={r6(mean('score'))}:m; customers_at_risk=count(*) FILTER (WHERE band IN ('high', 'critical')):n;
mrr_at_risk=sum(at_risk):m; pct_mrr_at_risk={r6(ratio('sum(at_risk)', 'any_value(last_mrr)'))}:m"""
_risk_from = "FROM risk, (SELECT arg_max(ending, m) AS last_mrr FROM fm)"
q("k37_k40_churn_risk", f"SELECT {out(_risk)} {_risk_from}")
q("k52_risk_by_industry", f"SELECT {out('industry:s; ' + _risk)} {_risk_from} GROUP BY industry")
_coh = f"""cohort_retention={r6('avg(' + pct('n', 'cohort_size') + ') / 100')}:m; cohort_mrr_retention={r6('avg(' + pct('total', 'm0_total') + ') / 100')}:m; cohort_size=sum(cohort_size):n"""
q("k41_k43_cohorts", f"SELECT {out(_coh)} FROM ret")
_period = "period_label='M' || p:s; " + _coh
q("k41_k43_cohorts_by_period", f"SELECT {out(_period)} FROM ret GROUP BY p")
q("k48_subscriptions", f"SELECT {out('plan_tier:s; active_subscriptions=count(*) FILTER (WHERE end_date IS NULL):n; subscription_mrr=sum(mrr):m')} FROM ds GROUP BY plan_tier")
q("k49_k50_stored_measures", f"""SELECT {out(f'''mrr_monthly_sum=sum(ending):m; net_new_mrr_sum=sum(net_new):m; net_revenue_retention={r6('arg_max_null(nrr, m) / 100')}:m;
quick_ratio=arg_max_null(qr, m):m; arpc=arg_max_null(arpc, m):m''')} FROM fkf""")

q("n01_point_in_time_mrr", f"""SELECT {out('''billing_cycle:s; active_subscriptions=count(*):n; mrr=sum(mrr):m;
normalised_mrr=round(sum(CASE WHEN billing_cycle = 'annual' THEN round(CAST(annual AS DOUBLE) / 12, 2) ELSE CAST(monthly AS DOUBLE) END), 2):m''')} FROM ds WHERE end_date IS NULL GROUP BY billing_cycle""")
q("n02_net_new_both_ways", f"SELECT {out('month_key:s; net_new_mrr=net_new:m; balance_change=ending - coalesce(p_mrr, 0):m; gap=net_new - (ending - coalesce(p_mrr, 0)):m')} FROM fkf")
q("n03_simple_ltv", f"SELECT {out('month_key:s; arpc:m; gross_customer_churn_rate_pct=cust_churn:m; simple_ltv=round(arpc / NULLIF(cust_churn / 100, 0), 2):m')} FROM fkf")
q("n03_historical_ltv", f"SELECT {out('acquisition_channel:s; customers=count(*):n; collected=sum(lifetime_revenue):m; historical_ltv=round(' + mean('lifetime_revenue') + ', 2):m')} FROM dc GROUP BY 1")
q("n04_cost_per_acquisition", f"""SELECT {out('acquisition_channel=channel_name:s; total_cost=cost:m; new_customers=acquired:n; cac=round(' + ratio('cost', 'acquired') + ', 2):m')}
FROM (SELECT channel_name, CAST(count(*) * typical_cac / 10 AS DECIMAL(18,2)) AS cost FROM tp WHERE channel_name IS NOT NULL GROUP BY channel_name, typical_cac) LEFT JOIN roll ON channel = channel_name""")
q("n05_benchmark_bands", f"""SELECT {out('''month_key:s;
growth_band=CASE WHEN growth >= 15 THEN 'early_stage' WHEN growth >= 5 THEN 'growth_stage' WHEN growth >= 2 THEN 'mature' WHEN growth < 2 THEN 'below_benchmark' END:s;
mrr_churn_band=CASE WHEN mrr_churn > 3 THEN 'concerning' WHEN mrr_churn > 2 THEN 'watch' WHEN mrr_churn >= 1 THEN 'good' WHEN mrr_churn < 1 THEN 'excellent' END:s;
nrr_band=CASE WHEN nrr < 100 THEN 'concerning' WHEN nrr <= 120 THEN 'good' WHEN nrr > 120 THEN 'excellent' END:s;
quick_ratio_band=CASE WHEN qr < 1 THEN 'concerning' WHEN qr < 2 THEN 'watch' WHEN qr <= 4 THEN 'good' WHEN qr > 4 THEN 'excellent' END:s;
logo_churn_band=CASE WHEN cust_churn > 5 THEN 'above_typical' WHEN cust_churn > 2 THEN 'smb_typical' WHEN cust_churn >= 1 THEN 'mid_market_typical' WHEN cust_churn < 1 THEN 'enterprise_typical' END:s''')} FROM fk""")
q("n05_payback_bands", f"""SELECT {out('''acquisition_channel=channel:s; cac_payback_months=payback:m;
payback_band=CASE WHEN payback > 24 THEN 'concerning' WHEN payback > 18 THEN 'watch' WHEN payback >= 12 THEN 'good' WHEN payback < 12 THEN 'excellent' END:s''')} FROM ue""")
q("n06_health_score", f"""SELECT customer_id, customer_status, CAST(s AS BIGINT) AS health_score,
  CASE WHEN s < 0 THEN 'Healthy' WHEN s < 20 THEN 'Low Risk' WHEN s < 40 THEN 'Medium Risk' ELSE 'High Risk' END AS health_category
FROM (SELECT *, CASE WHEN failed_payments > 0 THEN 15 ELSE 0 END + CASE WHEN {days(AS_OF, 'last_down')} <= 90 THEN 20 ELSE 0 END
 + CASE WHEN {days(AS_OF, 'last_pay')} > 45 THEN 25 ELSE 0 END + CASE WHEN days_since_signup < 90 THEN 15 ELSE 0 END
 - CASE WHEN upgrade_count > 0 THEN 15 ELSE 0 END - CASE WHEN current_plan_tier = 'enterprise' THEN 10 ELSE 0 END AS s FROM dc)""")
_sun = "({0} - CAST(dayofweek({0}) AS INTEGER))"
q("n07_weekly_retention", f"""WITH act AS (SELECT DISTINCT c.customer_id, {_sun.format('signup_date')} AS cohort, {_sun.format('event_date')} AS wk FROM ev JOIN cust c USING (customer_id)),
sz AS (SELECT cohort, count(DISTINCT customer_id) AS n FROM act GROUP BY 1)
SELECT {out("cohort=act.cohort:d; period_no=datediff('day', act.cohort, wk) // 7:n; active_customers=count(*):n; cohort_customers=any_value(n):n; retention_pct=" + pct('count(*)', 'any_value(n)') + ':m')}
FROM act JOIN sz ON sz.cohort = act.cohort GROUP BY act.cohort, wk""")
q("n08_run_rate", f"SELECT {out('month_key:s; ending_arr=ending * 12:m; arr=active_mrr * 12:m; net_new_arr=net_new * 12:m')} FROM fk")


def label(x: str) -> str:
    return (f"CASE WHEN {x} >= 1e6 THEN '$' || printf('%.2f', round({x} / 1e6, 2)) || 'M' WHEN {x} >= 1e3 THEN '$' || printf('%.1f', round({x} / 1e3, 1)) || 'K'"
            f" ELSE '$' || printf('%.0f', round({x})) END")


def arrow(x: str) -> str:
    return f"CASE WHEN {x} >= 0 THEN '▲' WHEN {x} < 0 THEN '▼' END"


_qr, _d = ratio("nw + up", "dn + lo"), "CAST(mrr AS DOUBLE)"
q("v01_executive_row", f"""SELECT {out(f'''month_date=m:d; mrr:m; mrr_label={label(_d)}:s; mrr_mom={r6(_g)}:m; mrr_trend={arrow(_g)}:s; arr=mrr * 12:m; arr_label={label(_d + ' * 12')}:s;
net_revenue_retention={r6(_n)}:m; nrr_status=CASE WHEN {_n} >= 1.2 THEN 'Excellent' WHEN {_n} >= 1 THEN 'Good' WHEN {_n} < 1 THEN 'Needs attention' END:s;
gross_revenue_retention={r6(ratio('b - dn - lo', 'b'))}:m; logo_churn={r6(ratio('n_churn', 'b_act'))}:m; quick_ratio={r6(_qr)}:m; quick_ratio_trend={arrow(_qr + ' - pq')}:s;
active_customers=act:n; rule_of_40_proxy={r6(f'{_g} * 12 + ({_n} - 1)')}:m; magic_number={r6(ratio('(nw + up - dn - lo) * 12', 'spend'))}:m; ltv_to_cac={r6('ltv')}:m; mrr_change={r6('mrr - pm')}:m''')}
FROM (SELECT *, lag({_qr}) OVER (ORDER BY m) AS pq, lag(CAST(mrr AS DOUBLE)) OVER (ORDER BY m) AS pm FROM kmf), (SELECT avg(ltv_cac) AS ltv, sum(spend) AS spend FROM ue0) ORDER BY m DESC LIMIT 1""")
q("v02_mrr_trend", f"SELECT {out('month_key:s; ending_mrr=ending:m; active_customers=active:n')} FROM fk")
q("v03_waterfall_steps", f"""WITH l AS (SELECT * FROM fk ORDER BY m DESC LIMIT 1)
SELECT {out('month_key:s; step:n; label:s; height:m; bottom:m')} FROM (
SELECT month_key, 1 AS step, 'New' AS label, new_mrr AS height, 0 AS bottom FROM l UNION ALL SELECT month_key, 2, 'Expansion', up_mrr, new_mrr FROM l
UNION ALL SELECT month_key, 3, 'Contraction', down_mrr, new_mrr + up_mrr - down_mrr FROM l UNION ALL SELECT month_key, 4, 'Churn', lost_mrr, net_new FROM l
UNION ALL SELECT month_key, 5, 'Net New', net_new, 0 FROM l)""")
q("v04_arr_by_tier", f"""SELECT {out('plan_tier=p.plan_tier:s; active_subscriptions=count(subscription_id):n; arr=coalesce(sum(mrr), 0) * 12:m')}
FROM plan p LEFT JOIN ds ON ds.plan_tier = p.plan_tier AND end_date IS NULL GROUP BY p.plan_tier""")
q("v05_trial_split", "SELECT converted_from_trial, count(*) AS customers FROM dc WHERE is_trial GROUP BY 1")
_pivot = lambda col, names: "; ".join(f"{n}=count(*) FILTER (WHERE {col} = '{n}'):n" for n in names)
q("v06_plan_progression_matrix", f"SELECT {out('initial_plan_name:s; ' + _pivot('current_plan_name', ['Starter', 'Pro', 'Team', 'Enterprise']))} FROM dc GROUP BY initial_plan_name")
q("v07_expansion_vs_contraction", f"SELECT {out('month_key:s; expansion_mrr=up_mrr:m; contraction_mrr=down_mrr:m')} FROM fk")
q("v08_channel_points", f"""SELECT {out('''acquisition_channel=channel:s; ltv_to_cac_ratio=ltv_cac:m; cac:m; realized_ltv=ltv:m; cac_payback_months=payback:m; acquisition_roi_pct=roi:m;
revenue_per_spend=round(''' + ratio('revenue', 'spend') + ''', 2):m; total_acquisition_spend=spend:m; total_lifetime_revenue=revenue:m; customers_acquired=acquired:n;
meets_target=ltv_cac >= 3:s; recommended_action=CASE WHEN ltv_cac >= 3 AND payback <= 12 THEN 'scale' WHEN ltv_cac >= 1 THEN 'optimize' ELSE 'reduce' END:s''')} FROM ue0""")
q("v09_industry_tier_matrix", f"SELECT {out('industry:s; ' + _pivot('current_plan_tier', ['free', 'professional', 'business', 'enterprise']))} FROM dc GROUP BY industry")
q("v09_market_cards", f"""SELECT {out(f'''total_customers=sum(n):n; paying_customers=sum(pay_n):n; paying_pct={pct('sum(pay_n)', 'sum(n)', 0)}:m; total_mrr=sum(s):m;
arpu=round({ratio('sum(s)', 'sum(n)')}, 2):m; top_industry=first(industry ORDER BY s DESC, industry):s; top_industry_mrr={label('CAST(max(s) AS DOUBLE)')}:s''')}
FROM (SELECT industry, count(*) AS n, count(*) FILTER (WHERE customer_status = 'active_paying') AS pay_n, sum(current_mrr) AS s FROM dc GROUP BY 1)""")
q("v10_segment_points", f"""SELECT company_size, industry, paying_rate_pct, arpu, CASE WHEN churn >= 40 THEN 'at_risk' WHEN arpu >= 50 AND c < 30 THEN 'whitespace'
 WHEN total >= 1000 THEN 'core' ELSE 'steady' END AS segment_label FROM (SELECT company_size, industry, count(*) AS c, round({mean('current_mrr')}, 2) AS arpu,
 {pct('count(*) FILTER (WHERE has_churned)', 'count(*)')} AS churn, sum(current_mrr) AS total, {pct("count(*) FILTER (WHERE customer_status = 'active_paying')", 'count(*)')} AS paying_rate_pct
 FROM dc GROUP BY 1, 2 HAVING count(*) >= 10)""")
q("v11_risk_bands", f"""SELECT {out('risk_band=b:s; customers=count(customer_id):n; mrr_at_risk=coalesce(sum(at_risk), 0):m')}
FROM (VALUES ('low'), ('medium'), ('high'), ('critical')) v(b) LEFT JOIN risk ON band = b GROUP BY b""")
_pts = ["pts_payment_failures", "pts_stale_payment", "pts_downgrades", "pts_mrr_erosion", "pts_prior_churn", "pts_early_tenure"]
q("v12_risk_drivers", " UNION ALL ".join(f"SELECT '{name}' AS driver, {r6(mean(f'p{i + 1}'))} AS avg_points FROM risk" for i, name in enumerate(_pts)))
q("v13_cohort_heatmap", f"SELECT {out('cohort_month_key=' + ym('cohort') + ':s; ' + '; '.join(f'M{i}=max(' + pct('n', 'cohort_size') + f') FILTER (WHERE p = {i}):m' for i in range(13)))} FROM ret GROUP BY cohort")
q("v14_risk_accounts", f"""SELECT {out('''customer_id:s; company_name:s; current_mrr:m; churn_risk_score=score:n; risk_band=band:s; top_driver_points=greatest(p1, p2, p3, p4, p5, p6):n;
top_driver=CASE greatest(p1, p2, p3, p4, p5, p6) ''' + ' '.join(f"WHEN p{i + 1} THEN '{n}'" for i, n in enumerate(_pts)) + ''' END:s''')}
FROM risk WHERE band IN ('high', 'critical') ORDER BY score DESC, risk.current_mrr DESC, risk.customer_id""")
q("v15_slicer_values", """SELECT DISTINCT 'plan_tier' AS slicer, current_plan_tier AS value FROM dc WHERE current_plan_tier IS NOT NULL
UNION ALL SELECT DISTINCT 'channel', acquisition_channel FROM dc WHERE acquisition_channel IS NOT NULL UNION ALL SELECT DISTINCT 'industry', industry FROM dc
UNION ALL SELECT DISTINCT 'company_size', company_size FROM dc UNION ALL SELECT 'month', month_key FROM fk""")
_marts = {"fct_mrr": "fm", "fct_mrr_filled": "fmf", "fct_subscription_events": "fse", "dim_customers": "dc", "dim_subscriptions": "ds", "rpt_cohort_retention": "ret", "rpt_unit_economics": "ue", "rpt_churn_risk": "risk"}
_reach = "greatest((SELECT max(event_at) FROM ev), (SELECT max(created_at) FROM pay), (SELECT max(touched_at) FROM touch))"
q("v16_last_refresh", " UNION ALL ".join(f"SELECT '{t}' AS \"table\", count(*) AS \"rows\", strftime({_reach}, '%Y-%m-%d %H:%M:%S') AS last_refresh FROM {v}" for t, v in _marts.items()))
VIEWS["span"] = "SELECT min(event_date) AS lo, max(event_date) AS hi FROM ev"
VIEWS["day_list"] = "SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS x FROM span"
q("v17_calendar", f"SELECT {out('date=x:d; year=year(x):n; month=' + ym('x') + ':s; month_start=' + month('x') + ':d; quarter=' + yq('x') + ':s')} FROM day_list")
q("v18_star_view", f"""SELECT {out('''event_id=e.event_id:s; customer_id=e.customer_id:s; subscription_id=e.subscription_id:s; event_type=e.event_type:s; event_date=e.event_date:d; mrr_change=e.mrr_change:m;
customer_status=c.customer_status:s; health_status=c.health_status:s; current_plan_tier=c.current_plan_tier:s; subscription_status=s.status:s; billing_cycle=s.billing_cycle:s;
is_annual=s.billing_cycle = 'annual':s; calendar_quarter=''' + yq('e.event_date') + ':s')}
FROM ev e LEFT JOIN dc c USING (customer_id) LEFT JOIN ds s ON s.subscription_id = e.subscription_id""")
q("m01_day_spine", f"SELECT {out('date_value=x:d')} FROM day_list")
q("m01_week_spine", f"SELECT DISTINCT {out('date_value=' + _sun.format('x') + ':d')} FROM day_list")
q("m01_month_spine", f"SELECT DISTINCT {out('date_value=' + month('x') + ':d')} FROM day_list")
q("m02_divide_or_default", f"SELECT {out('month_key:s; net_new_per_churned=round(CASE WHEN lost_mrr = 0 THEN 0 ELSE CAST(net_new AS DOUBLE) / CAST(lost_mrr AS DOUBLE) END, 6):m')} FROM fk")
q("m03_cents_to_dollars", f"SELECT {out('payment_id:s; amount_dollars=amount:m')} FROM pay")
q("m07_decay_weight", f"SELECT {out('touch_id:s; decay_weight=round(pow(0.5, d / CAST(7 AS DOUBLE)), 6):m')} FROM touch")
q("a09_journey_paths", "SELECT customer_id, count(*) AS touches, string_agg(channel_name, ' → ' ORDER BY seq) AS journey_path FROM tp GROUP BY customer_id")
q("a10_exact_median", "SELECT CAST(round(median(x)) AS DOUBLE) AS median_days_to_paid FROM (SELECT min(age_days) FILTER (WHERE first_paid) AS x FROM hist2 GROUP BY customer_id)")
q("f30_feature_adoption", f"""SELECT {out('feature=f:s; active_subscriptions=count(*):n')} FROM (SELECT unnest(string_split(features, ',')) AS f
FROM ds JOIN plan USING (plan_id) WHERE end_date IS NULL) GROUP BY f""")
q("d08_attribution_renormalised", "SELECT touch_id, customer_id, round(w_decay / sum(w_decay) OVER (PARTITION BY customer_id), 6) AS time_decay_weight FROM tp")

q("s01_raw_csv", """SELECT customer_id, company_name, lower(industry) AS industry, company_size, country, strftime(signup_date, '%Y-%m-%d %H:%M:%S') AS signup_date,
  upper(email) AS email, CAST(acquisition_channel_id AS VARCHAR) AS acquisition_channel_id, CAST(initial_plan_id AS VARCHAR) AS initial_plan_id,
  ['true', '0', 'YES', 'no', 'maybe'][CAST(ck % 5 AS INTEGER) + 1] AS is_trial,
  CASE WHEN ck % 97 = 0 THEN 'not-a-date' ELSE strftime(trial_end_date, '%Y-%m-%d') END AS trial_end_date FROM cust""")
q("s03_month_partitions", f"SELECT {ym('event_date')} AS month_key, count(*) AS events FROM ev WHERE event_date BETWEEN DATE '1999-01-01' AND DATE '1999-06-30' GROUP BY 1")
q("s04_sql_view", f"SELECT {out('month_key:s; ending_mrr=ending:m; active_customers=active:n')} FROM fk WHERE active > 0")
q("s05_mart_extracts", f"""SELECT {out('''month_date=m:d; month_key:s; active_customers=active:n; new_customers=n_new:n; churned_customers=n_churn:n; ending_mrr=ending:m; new_mrr:m; expansion_mrr=up_mrr:m;
contraction_mrr=down_mrr:m; churned_mrr=lost_mrr:m; net_new_mrr=net_new:m; nrr_pct=nrr:m; quick_ratio=qr:m; arpc:m''')} FROM fk""")


def fingerprints(table: str, body: str, columns: list[str], alias: dict[str, str]) -> str:
    text = "CASE WHEN typeof({0}) = 'DOUBLE' THEN CAST(CAST(round(TRY_CAST({0} AS DOUBLE) * 10000) AS BIGINT) AS VARCHAR) ELSE CAST({0} AS VARCHAR) END"
    lines = [
        f"""SELECT '{table}' AS "table", '{c}' AS "column", count(*) AS "rows", count({alias.get(c, c)}) AS filled,
  coalesce(sum(CAST('0x' || substr(md5({text.format(alias.get(c, c))}), 1, 8) AS BIGINT)), 0)::BIGINT AS fingerprint FROM ({body})""" for c in columns
    ]
    return " UNION ALL ".join(lines)


_of = {"fct_mrr": "d09_fct_mrr", "fct_mrr_filled": "d09_fct_mrr_filled", "fct_subscription_events": "d10_fct_subscription_events", "dim_customers": "d11_dim_customers",
    "dim_subscriptions": "d12_dim_subscriptions", "rpt_cohort_retention": "d13_cohort_retention", "rpt_unit_economics": "d14_unit_economics", "rpt_churn_risk": "d15_churn_risk"}
# The columns of the six extracts.
_extracts = {
    "fct_mrr": "month_date month_key active_customers new_customers churned_customers ending_mrr new_mrr expansion_mrr contraction_mrr churned_mrr net_new_mrr nrr_pct quick_ratio arpc",
    "dim_customers": "customer_id company_name industry company_size country acquisition_channel current_plan_tier customer_status current_mrr lifetime_revenue health_status signup_cohort_month",
    "dim_subscriptions": "subscription_id customer_id plan_name plan_tier status billing_cycle mrr subscription_length_days tenure_bucket is_active is_churned churn_timing",
    "rpt_unit_economics": "acquisition_channel customers_acquired cac realized_ltv predicted_ltv ltv_to_cac_ratio cac_payback_months acquisition_roi_pct total_acquisition_spend total_lifetime_revenue churn_rate_pct",
    "rpt_churn_risk": "customer_id company_name risk_band churn_risk_score current_mrr mrr_at_risk",
    "rpt_cohort_retention": "cohort_month_key period_label months_since_signup cohort_size active_customers retention_rate mrr_retention_from_m0",
}
q("s05_extract_rows", " UNION ALL ".join(fingerprints(t, BODIES[_of[t]][0], c.split(), {"nrr_pct": "net_revenue_retention_pct"}) for t, c in _extracts.items()))
q("s07_export_bundle", " UNION ALL ".join(fingerprints(t, *BODIES[d], {}) for t, d in _of.items()))
_method = "CASE payment_method WHEN 'ach' THEN 'ACH' WHEN 'wire' THEN ' wire ' ELSE payment_method END"
q("s06_coerce_columns", f"SELECT {out('payment_id:s; subscription_id:s; customer_id:s; amount:m; currency=lower(currency):s; payment_date:d; payment_method=' + _method + ':s; status:s; created_at:t')} FROM pay")

# --- checks -----------------------------------------------------------------------------
# Table name, view, unique column (view name), other required columns, allowed values.
_T = [
    ("raw_customers", "cust", "customer_id", ["signup_date + INTERVAL 0 HOUR:signup_date"], {}),
    ("raw_subscriptions", "subs", "subscription_id", ["customer_id"], {}),
    ("raw_subscription_events", "ev", "event_id", [], {"event_type": "subscription_started subscription_upgraded subscription_downgraded subscription_churned subscription_reactivated"}),
    ("raw_payments", "pay", "payment_id", [], {"status": "succeeded failed"}),
    ("raw_marketing_touches", "touch", "touch_id", [], {}),
    ("plan_tiers", "plan", "plan_id", [], {}),
    ("marketing_channels", "chan", "channel_id", [], {}),
    ("stg_customers", "cust", "customer_id", [], {}),
    ("stg_subscriptions", "subs", "subscription_id", ["customer_id"], {"status": "active churned"}),
    ("stg_subscription_events", "ev", "event_id", [], {"event_category": "acquisition expansion contraction churn other"}),
    ("stg_payments", "pay", "payment_id", [], {}),
    ("stg_marketing_touches", "touch", "touch_id", [], {}),
    ("int_customer_subscription_history", "hist", "event_id", ["customer_id"], {}),
    ("int_attribution_touchpoints", "tp", "touch_id", [], {}),
    ("fct_mrr", "fm", "m:month_date", [], {}),
    ("fct_subscription_events", "fse", "event_id", [], {}),
    ("dim_customers", "dc", "customer_id", [], {"customer_status": "active_paying active_free churned unknown"}),
    ("dim_subscriptions", "ds", "subscription_id", [], {}),
    ("rpt_churn_risk", "risk", "customer_id", ["score:churn_risk_score", "band:risk_band"], {"customer_status": "active_paying active_free", "band:risk_band": "low medium high critical"}),
    ("rpt_unit_economics", "ue", "channel:acquisition_channel", ["acquired:customers_acquired"], {}),
    ("int_mrr_movements", "mv", "", ["customer_id", "m:month_date"], {"kind:movement_type": "new resurrection expansion contraction churn unchanged"}),
    ("rpt_cohort_retention", "ret", "", ["cohort:cohort_month", "p:months_since_signup"], {}),
]


def _pair(c: str) -> tuple[str, str]:
    a, _, b = c.partition(":")
    return a, b or a


def _in(values: str) -> str:
    return ", ".join(f"'{v}'" for v in values.split())


_uniq, _null, _acc, _suite = [], [], [], []
for _t, _v, _u, _req, _vals in _T:
    if _u:
        c, n = _pair(_u)
        dup = f"SELECT {c} AS value, count(*) AS n FROM {_v} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1"
        _uniq.append(f"SELECT '{_t}' AS \"table\", '{n}' AS \"column\", CAST(value AS VARCHAR) AS value, n AS \"rows\" FROM ({dup})")
        _suite.append(f"SELECT '{_t}' AS \"table\", 'unique' AS \"check\", '{n}' AS \"column\", count(*) AS failures FROM ({dup})")
    for col in ([_u] if _u else []) + _req:
        c, n = _pair(col)
        _key = _pair(([_u] if _u else _req)[0])[0]
        for origin, lost in (("real", f"{c} IS NULL"), ("made", f"right(CAST({c} AS VARCHAR), 1) = '7'")):
            _null.append(f"SELECT '{_t}' AS \"table\", CAST({_key} AS VARCHAR) AS key, 'not_null:{n}' AS \"check\", '{origin}' AS origin FROM {_v} WHERE {lost}")
        _suite.append(f"SELECT '{_t}', 'not_null', '{n}', count(*) FROM {_v} WHERE {c} IS NULL")
    for col, vals in _vals.items():
        c, n = _pair(col)
        _acc.append(f"SELECT '{_t}' AS \"table\", '{n}' AS \"column\", {c} AS value, count(*) AS \"rows\" FROM {_v} WHERE {c} NOT IN ({_in(vals)}) GROUP BY {c}")
        _suite.append(f"SELECT '{_t}', 'accepted_values', '{n}', count(*) FROM {_v} WHERE {c} NOT IN ({_in(vals)})")
q("t01_unique", " UNION ALL ".join(_uniq))
q("t02_not_null", " UNION ALL ".join(_null))
q("t03_accepted_values", " UNION ALL ".join(_acc))
q("t04_relationships", """SELECT 'raw_subscriptions' AS "table", subscription_id AS key, 'relationships' AS "check", 'real' AS origin FROM subs WHERE customer_id NOT IN (SELECT customer_id FROM cust)
UNION ALL SELECT 'raw_subscriptions', 'made_' || subscription_id, 'relationships', 'made' FROM subs WHERE right(customer_id, 1) = '3'""")


def balance(fact: str, cols: str) -> str:
    return f"""SELECT {cols} FROM (SELECT m, ending, coalesce(p_mrr, 0) + gross_new - gross_lost AS want FROM {fact}) WHERE abs(ending - want) > 0.01"""


_bal = out("month_date=m:d; ending_mrr=ending:m; expected_ending_mrr=want:m; variance=abs(ending - want):m")
q("t05_balance", balance("fm", _bal))
q("t05_balance_filled", balance("fmf", _bal))
_w = {"first_touch_sum": "w_first", "last_touch_sum": "w_last", "linear_sum": "w_linear", "position_based_sum": "w_pos"}
_weights = "SELECT customer_id, " + ", ".join(f"round(sum({c}), 4) AS {n}" for n, c in _w.items()) + " FROM tp GROUP BY 1 HAVING greatest(" + ", ".join(f"abs(sum({c}) - 1)" for c in _w.values()) + ") > 0.01"
q("t06_attribution_weights", f"""SELECT 'int_attribution_touchpoints' AS "table", customer_id AS key, 'weights_sum_to_one' AS "check", 'real' AS origin FROM ({_weights})
UNION ALL SELECT 'int_attribution_touchpoints', 'made_' || customer_id, 'weights_sum_to_one', 'made' FROM ({_weights.replace("FROM tp", "FROM tp WHERE right(customer_id, 1) = '5' AND seq <> n")})""")
_band = "CASE WHEN score >= 75 THEN 'critical' WHEN score >= 50 THEN 'high' WHEN score >= 25 THEN 'medium' ELSE 'low' END"
_score = f"score NOT BETWEEN 0 AND 100 OR band <> {_band}"
q("t07_churn_score", f"""SELECT 'rpt_churn_risk' AS "table", customer_id AS key, 'score_in_range' AS "check", 'real' AS origin FROM risk WHERE {_score}
UNION ALL SELECT 'rpt_churn_risk', 'made_' || customer_id, 'score_in_range', 'made' FROM (SELECT * REPLACE (score + 60 AS score) FROM risk WHERE right(customer_id, 1) = '4') WHERE {_score}""")
_rate = pct("n", "cohort_size")
_badret = f"(p = 0 AND {_rate} < 95) OR {_rate} NOT BETWEEN 0 AND 100 OR n NOT BETWEEN 0 AND cohort_size"
q("t08_cohort_retention", f"SELECT {out('cohort_month=cohort:d; months_since_signup=p:n; cohort_size:n; active_customers=n:n; retention_rate=' + _rate + ':m')} FROM ret WHERE {_badret}")
_badue = "paying > acquired OR churned > acquired OR least(cac, spend, payback) < 0 OR churn NOT BETWEEN 0 AND 1"
_figures = """acquisition_channel=channel:s; customers_acquired=acquired:n; active_paying_customers=paying:n; churned_customers=churned:n; cac:m;
total_acquisition_spend=spend:m; cac_payback_months=payback:m; observed_churn_rate=churn:m"""
q("t09_unit_economics", f"""SELECT 'rpt_unit_economics' AS "table", channel AS key, 'economics_valid' AS "check", 'real' AS origin, {out(_figures)} FROM ue0 WHERE {_badue}
UNION ALL SELECT 'rpt_unit_economics', channel, 'economics_valid', 'made', {out(_figures)} FROM (SELECT * REPLACE ('made_' || channel AS channel, -cac AS cac) FROM ue0 WHERE right(channel, 1) = 's') WHERE {_badue}""")
_rest = [
    f"SELECT 'fct_mrr' AS \"table\", 'mrr_movements_balance' AS \"check\", 'ending_mrr' AS \"column\", count(*) AS failures FROM ({balance('fm', 'm')})",
    f"SELECT 'fct_mrr_filled', 'mrr_movements_balance', 'ending_mrr', count(*) FROM ({balance('fmf', 'm')})",
    f"SELECT 'rpt_churn_risk', 'score_in_range', 'churn_risk_score', count(*) FROM risk WHERE score NOT BETWEEN 0 AND 100 OR band <> {_band}",
    f"SELECT 'rpt_cohort_retention', 'retention_valid', 'retention_rate', count(*) FROM ret WHERE {_badret}",
    f"SELECT 'rpt_unit_economics', 'economics_valid', 'acquisition_channel', count(*) FROM ue0 WHERE {_badue}",
]
_models = [x for x in _suite if re.match(r"SELECT '(int_|fct_|dim_|rpt_)", x) and ", 'unique'" not in x and "'unique' AS" not in x]
q("t10_on_write", " UNION ALL ".join(_rest + _models))
q("t10_suite", " UNION ALL ".join(_suite + [
    "SELECT 'raw_subscriptions', 'relationships', 'customer_id', count(*) FROM subs WHERE customer_id NOT IN (SELECT customer_id FROM cust)",
    f"SELECT 'int_attribution_touchpoints', 'weights_sum_to_one', 'customer_id', count(*) FROM ({_weights})", *_rest,
]))
