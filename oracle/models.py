"""Oracle statements for the dataset operators (d…)."""

from oracle.views import AS_OF, COLUMNS, mean, month, months, out, pct, ratio, sql, ym, yq

Q: dict[str, str] = {}


# Body and columns of each statement, for fingerprints of whole tables.
BODIES: dict[str, tuple[str, list[str]]] = {}


def q(name: str, body: str) -> None:
    Q[name] = sql(body)
    BODIES[name] = body, list(COLUMNS)


q("d01_stg_customers", f"""SELECT {out('''customer_id:s; company_name:s; industry:s; company_size:s; country:s; email:s;
acquisition_channel_id:n; initial_plan_id:n; is_trial:s; trial_end_date:d; signed_up_at=signup_date:t; signup_date:d''')} FROM cust""")

q("d02_stg_subscriptions", f"""SELECT {out('''subscription_id:s; customer_id:s; plan_id:n; status:s; billing_cycle:s; mrr:m;
start_date:d; end_date:d; subscription_length_days=len:n; created_at:t; updated_at:t''')} FROM subs""")

q("d03_stg_subscription_events", f"""SELECT {out('''event_id:s; subscription_id:s; customer_id:s; plan_id:n; event_type:s; mrr_change:m;
mrr_after:m; event_at:t; event_category:s; event_date:d; event_year=year(event_date):n; event_month=month(event_date):n;
event_month_key=''' + ym('event_date') + ':s')} FROM ev""")

q("d04_stg_payments", f"""SELECT {out('''payment_id:s; subscription_id:s; customer_id:s; amount:m; currency:s; payment_method:s; status:s;
is_successful=status = 'succeeded':s; is_failed=status = 'failed':s; payment_date:d; payment_month_key=''' + ym('payment_date') + ''':s; created_at:t''')} FROM pay""")

q("d05_stg_marketing_touches", f"""SELECT {out('''touch_id:s; customer_id:s; channel_id:n; touch_type:s; landing_page:s; utm_campaign:s;
touched_at:t; converted_at:t; touch_date:d; conversion_date:d; days_to_conversion=d:n; hours_to_conversion=h:n''')} FROM touch""")

_HIST = '''event_id:s; customer_id:s; company_name:s; industry:s; company_size:s; country:s; signup_date:d; acquisition_channel_id:n;
is_trial:s; subscription_id:s; event_type:s; event_category:s; event_date:d; event_at:t; plan_id:n; plan_name:s; plan_tier:s;
plan_price:m; event_sequence=seq:n; previous_event_type=prev_type:s; previous_plan_id=prev_plan:n; next_event_type=next_type:s;
next_event_date=next_date:d; has_ever_churned=ever_churned:n; has_ever_upgraded=ever_upgraded:n; days_since_signup=age_days:n;
months_since_signup=age_months:n; is_first_paid_conversion=first_paid:s; days_until_next_event=until_next:n; '''
q("d06_customer_subscription_history", f"SELECT {out(_HIST + 'mrr_change:m; mrr_after:m')} FROM hist2")

_MOVES = f'''customer_id:s; month_date=m:d; month_key={ym('m')}:s; beginning_mrr=had:m; ending_mrr=mrr:m; net_mrr_change=mrr - had:m;
new_mrr:m; resurrection_mrr=back_mrr:m; expansion_mrr=up_mrr:m; contraction_mrr=down_mrr:m; churned_mrr=lost_mrr:m;
movement_type=kind:s; customer_month_number=nth:n; '''
q("d07_mrr_movements", f"SELECT {out(_MOVES + 'had_acquisition:n; had_expansion:n; had_contraction:n; had_churn:n')} FROM mv")

q("d08_attribution_touchpoints", f"""SELECT {out('''touch_id:s; customer_id:s; channel_id:n; channel_name:s; channel_category:s; is_paid:s;
typical_cac:m; touch_type:s; landing_page:s; utm_campaign:s; touched_at:t; touch_date:d; converted_at:t; conversion_date:d;
days_to_conversion=d:n; company_size:s; industry:s; initial_mrr=worth:m; touch_sequence=seq:n; total_touches=n:n; first_touch_at=first_at:t;
last_touch_at=last_at:t; first_touch_weight=round(w_first, 6):m; last_touch_weight=round(w_last, 6):m; linear_weight=round(w_linear, 6):m;
time_decay_weight=round(w_decay, 6):m; position_based_weight=round(w_pos, 6):m; first_touch_revenue=round(r_first, 6):m;
last_touch_revenue=round(r_last, 6):m; linear_revenue=round(r_linear, 6):m; time_decay_revenue=round(r_decay, 6):m;
position_based_revenue=round(r_pos, 6):m; is_first_touch=seq = 1:s; is_last_touch=seq = n:s; journey_stage=stage:s''')} FROM tp""")

_FACT = '''month_date=m:d; month_key:s; total_customers=total:n; active_customers=active:n; new_customers=n_new:n; churned_customers=n_churn:n;
resurrected_customers=n_back:n; expanded_customers=n_up:n; contracted_customers=n_down:n; ending_mrr=ending:m; active_mrr:m; new_mrr:m;
resurrection_mrr=back_mrr:m; expansion_mrr=up_mrr:m; contraction_mrr=down_mrr:m; churned_mrr=lost_mrr:m; gross_new_mrr=gross_new:m;
gross_lost_mrr=gross_lost:m; net_new_mrr=net_new:m; mrr_growth_rate_pct=growth:m; customer_growth_rate_pct=cust_growth:m;
gross_mrr_churn_rate_pct=mrr_churn:m; gross_customer_churn_rate_pct=cust_churn:m; net_revenue_retention_pct=nrr:m; quick_ratio=qr:m; arpc:m;
cumulative_new_mrr=cum_new:m; cumulative_churned_mrr=cum_lost:m; arr=active_mrr * 12:m; net_new_arr=net_new * 12:m'''
q("d09_fct_mrr", f"SELECT {out(_FACT)} FROM fk")
q("d09_fct_mrr_filled", f"SELECT {out(_FACT)} FROM fkf")

q("d10_fct_subscription_events", f"""SELECT {out('''event_id:s; subscription_id:s; customer_id:s; event_type:s; event_category:s; event_date:d; event_at:t;
plan_id:n; plan_name:s; plan_tier:s; plan_price:m; mrr_change:m; mrr_after:m; mrr_impact_absolute=abs(mrr_change):m; company_name:s; industry:s;
company_size:s; country:s; signup_date:d; is_trial:s; acquisition_channel_id:n; acquisition_channel:s; acquisition_channel_category:s;
is_paid_acquisition:s; days_since_signup=age_days:n; months_since_signup=age_months:n; tenure_bucket:s; event_sequence=seq:n;
previous_event_type=prev_type:s; previous_plan_id=prev_plan:n; next_event_type=next_type:s; next_event_date=next_date:d; days_until_next_event=until_next:n;
is_first_paid_conversion=first_paid:s; has_ever_churned=ever_churned:n; has_ever_upgraded=ever_upgraded:n; event_year=year(event_date):n;
event_month=month(event_date):n; event_quarter=quarter(event_date):n; event_day_of_week=dayname(event_date):s;
event_month_key=''' + ym('event_date') + ':s; event_quarter_key=' + yq('event_date') + ':s; signup_cohort_month=' + ym('signup_date')
+ ':s; signup_cohort_quarter=' + yq('signup_date') + ':s')} FROM fse""")

q("d11_dim_customers", f"""SELECT {out('''customer_id:s; company_name:s; email:s; industry:s; company_size:s; country:s; signup_date:d; signed_up_at=signup_date:t;
acquisition_channel_id:n; acquisition_channel:s; acquisition_channel_category:s; is_paid_acquisition:s; initial_plan_id:n; initial_plan_name:s;
is_trial:s; trial_end_date:d; converted_from_trial:s; current_subscription_id:s; current_plan_id:n; current_plan_name:s; current_plan_tier:s;
current_status:s; current_billing_cycle:s; current_mrr:m; current_arr=current_mrr * 12:m; current_subscription_start:d;
current_subscription_tenure_days:n; customer_status:s; days_since_signup:n; months_since_signup:n; tenure_bucket:s; total_subscriptions:n;
first_subscription_date=first_start:d; latest_subscription_date=last_start:d; times_churned:n; has_churned:s; is_resurrected:s; total_events:n;
upgrade_count:n; downgrade_count:n; last_upgrade_date=last_up:d; last_downgrade_date=last_down:d; last_churn_date=last_churn:d; peak_mrr:m;
total_payments:n; successful_payments:n; failed_payments:n; lifetime_revenue:m; avg_payment_amount:m; first_payment_date=first_pay:d;
last_payment_date=last_pay:d; payment_success_rate:m; signup_year=year(signup_date):n; health_status:s;
signup_cohort_month=''' + ym('signup_date') + ':s; signup_cohort_quarter=' + yq('signup_date') + ':s')} FROM dc""")

q("d12_dim_subscriptions", f"""SELECT {out('''subscription_id:s; customer_id:s; company_name:s; industry:s; company_size:s; country:s; plan_id:n; plan_name:s;
plan_tier:s; plan_monthly_price=monthly:m; plan_annual_price=annual:m; plan_storage_gb=storage:n; plan_max_users=users:n; status:s; billing_cycle:s;
mrr:m; arr=mrr * 12:m; start_date:d; end_date:d; created_at:t; updated_at:t; subscription_length_days=len:n; tenure_bucket:s;
subscription_length_months=round(len / CAST(30.44 AS DOUBLE), 1):m;
effective_monthly_price=CASE WHEN billing_cycle = 'annual' THEN round(CAST(annual AS DOUBLE) / 12, 2) ELSE monthly END:m;
annual_discount_pct=CASE WHEN billing_cycle = 'annual' THEN round((1 - CAST(annual AS DOUBLE) / 12 / NULLIF(CAST(monthly AS DOUBLE), 0)) * 100, 1) ELSE 0 END:m;
total_events=n_events:n; upgrade_count=ups:n; downgrade_count=downs:n; first_event_at=first_at:t; last_event_at=last_at:t;
is_active=status = 'active':s; is_churned=status = 'churned':s; is_annual=billing_cycle = 'annual':s; is_paying=mrr > 0:s;
is_free_tier=plan_tier = 'free':s; is_enterprise=plan_tier = 'enterprise':s; churn_timing:s; subscription_cohort_month='''
+ ym('start_date') + ':s; subscription_cohort_quarter=' + yq('start_date') + ':s')} FROM ds""")

q("d13_cohort_retention", f"""SELECT {out('''cohort_month=cohort:d; cohort_month_key=''' + ym('cohort') + ''':s; cohort_month_name=strftime(cohort, '%b %Y'):s;
months_since_signup=p:n; period_label='M' || p:s; cohort_size:n; active_customers=n:n; retained_mrr=total:m; avg_mrr_per_customer=round(avg_mrr, 2):m;
churned_customers=cohort_size - n:n; previous_period_customers=prev_n:n; customers_change=n - prev_n:n; retention_rate=''' + pct('n', 'cohort_size')
+ ':m; retention_from_m0=' + pct('n', 'm0_n') + ':m; mrr_retention_from_m0=' + pct('total', 'm0_total') + ':m; cumulative_churn_rate='
+ pct('cohort_size - n', 'cohort_size') + ':m')} FROM ret""")

_UE = '''acquisition_channel=channel:s; acquisition_channel_category=category:s; is_paid_acquisition=paid:s; customers_acquired=acquired:n;
active_paying_customers=paying:n; churned_customers=churned:n; observed_churn_rate=round(churn, 6):m; cac:m; total_lifetime_revenue=revenue:m;
current_mrr=mrr:m; arpc:m; realized_ltv=ltv:m; total_acquisition_spend=spend:m; predicted_ltv=pltv:m; ltv_to_cac_ratio=ltv_cac:m;
cac_payback_months=payback:m; acquisition_roi_pct=roi:m; avg_tenure_days=tenure:m; active_rate_pct=active_rate:m; churn_rate_pct=churn_rate:m'''
q("d14_unit_economics", f"SELECT {out(_UE)} FROM ue")

q("d15_churn_risk", f"""SELECT {out('''customer_id:s; company_name:s; industry:s; company_size:s; acquisition_channel:s; current_plan_tier:s; customer_status:s;
tenure_bucket:s; health_status:s; current_mrr:m; current_arr=current_mrr * 12:m; peak_mrr:m; mrr_erosion_pct=erosion:m; upgrade_count:n; downgrade_count:n;
failed_payments:n; successful_payments:n; payment_success_rate:m; days_since_last_payment=idle:n; times_churned:n; is_resurrected:s;
pts_payment_failures=p1:n; pts_stale_payment=p2:n; pts_downgrades=p3:n; pts_mrr_erosion=p4:n; pts_prior_churn=p5:n; pts_early_tenure=p6:n;
churn_risk_score=score:n; risk_band=band:s; mrr_at_risk=at_risk:m; signup_cohort_month=''' + ym('signup_date') + ':s')} FROM risk""")

q("d16_current_subscription", f"""SELECT {out('''customer_id:s; current_subscription_id=subscription_id:s; current_plan_id=plan_id:n; current_status=status:s;
current_billing_cycle=billing_cycle:s; current_mrr=mrr:m; current_subscription_start=start_date:d; current_subscription_tenure_days=len:n''')} FROM cur""")
q("d17_subscription_history", f"""SELECT {out('''customer_id:s; total_subscriptions=n_subs:n; first_subscription_date=first_start:d;
latest_subscription_date=last_start:d; churn_count=n_churned:n''')} FROM shist""")
q("d18_event_metrics", f"""SELECT {out('''customer_id:s; total_events=n_events:n; upgrade_count=ups:n; downgrade_count=downs:n; churn_events=churns:n;
last_upgrade_date=last_up:d; last_downgrade_date=last_down:d; last_churn_date=last_churn:d; peak_mrr=peak:m''')} FROM emet""")
q("d19_payment_metrics", f"""SELECT {out('''customer_id:s; total_payments=n_pay:n; successful_payments=n_ok:n; failed_payments=n_bad:n; lifetime_revenue=revenue:m;
avg_payment_amount=round(avg_amount, 6):m; first_payment_date=first_pay:d; last_payment_date=last_pay:d''')} FROM pmet""")
q("d20_subscription_event_metrics", f"""SELECT {out('''subscription_id:s; total_events=n_events:n; first_event_at=first_at:t; last_event_at=last_at:t;
upgrade_count=ups:n; downgrade_count=downs:n''')} FROM smet""")
q("d21_customer_value", f"SELECT {out('customer_id:s; first_subscription_date=first_start:d; initial_mrr=worth:m')} FROM worth")
q("d22_cohort_sizes", f"SELECT {out('cohort_month=cohort:d; cohort_size:n')} FROM size")
q("d23_month_spine", f"SELECT DISTINCT {out('month_date=m:d; month_key=' + ym('m') + ':s')} FROM cm")
q("d24_spine_mrr", f"SELECT {out(_MOVES + 'has_event:s')} FROM mvf")
q("d25_channel_rollup", f"""SELECT {out('''acquisition_channel=channel:s; acquisition_channel_category=category:s; is_paid_acquisition=paid:s;
customers_acquired=acquired:n; active_paying_customers=paying:n; churned_customers=churned:n; total_lifetime_revenue=revenue:m; current_mrr=mrr:m;
avg_lifetime_revenue=round(ltv, 6):m; arpc=round(arpc, 6):m; avg_tenure_days=round(tenure, 6):m''')} FROM roll""")
q("d26_first_last_channels", """SELECT t.customer_id, arg_min(channel_name, touched_at_id) AS first_touch_channel, arg_max(channel_name, touched_at_id) AS last_touch_channel
FROM (SELECT customer_id, channel_id, strftime(touched_at, '%Y%m%d%H%M%S') || touch_id AS touched_at_id FROM touch WHERE touched_at <= converted_at) t
JOIN chan USING (channel_id) GROUP BY 1""")
q("d27_activity_retention", f"""WITH act AS (SELECT c.customer_id, {month('signup_date')} AS cohort, {month('event_date')} AS active_in FROM ev JOIN cust c USING (customer_id)),
sz AS (SELECT cohort, count(DISTINCT customer_id) AS n FROM act GROUP BY 1)
SELECT {out('cohort=act.cohort:d; period_no=' + months('active_in', 'act.cohort') + ':n; active_customers=count(DISTINCT customer_id):n; cohort_customers=any_value(n):n; retention_pct='
+ pct('count(DISTINCT customer_id)', 'any_value(n)') + ':m')} FROM act JOIN sz ON sz.cohort = act.cohort GROUP BY act.cohort, active_in""")
q("d28_monthly_change_labels", f"""SELECT {out('customer_id:s; mrr_month=m:d; mrr_amount=mrr:m; previous_mrr=prev:m; first_mrr_month=m0:d; mrr_movement_type=label:s')}
FROM (SELECT *, CASE WHEN prev IS NULL THEN 'new' WHEN mrr > prev THEN 'expansion' WHEN mrr < prev AND mrr > 0 THEN 'contraction'
  WHEN mrr = 0 AND prev > 0 THEN 'churn' ELSE 'unchanged' END AS label
  FROM (SELECT *, lag(mrr) OVER (PARTITION BY customer_id ORDER BY m) AS prev, min(m) OVER (PARTITION BY customer_id) AS m0 FROM cm))""")
q("d29_billing_schedule", f"""WITH due AS (
  SELECT subscription_id, customer_id, billing_cycle, start_date, start_date AS due_date FROM subs WHERE start_date < coalesce(end_date, {AS_OF})
  UNION ALL
  SELECT subscription_id, customer_id, billing_cycle, start_date, cal.m FROM subs JOIN cal ON cal.m > start_date AND cal.m > {month('start_date')} AND cal.m < coalesce(end_date, {AS_OF})),
stamped AS (SELECT due.*, (SELECT arg_max(mrr_after, strftime(event_at, '%Y%m%d%H%M%S') || event_id) FROM ev
  WHERE ev.subscription_id = due.subscription_id AND ev.event_at <= due.due_date) AS rate FROM due)
SELECT {out('''subscription_id:s; customer_id:s; due_date:d; billing_cycle:s; mrr_in_force=rate:m;
amount_due=CASE WHEN billing_cycle = 'annual' AND month(due_date) = month(start_date) THEN rate * 10 ELSE rate END:m''')} FROM stamped WHERE rate > 0""")
q("d30_lifecycle_events", f"""SELECT {out('''custkey=ck:n; state_id=ok:n; state_at=event_at:t; event_type:s; event_plan_id=plan_id:n; mrr=mrr_after:m; mrr_change:m;
subscription_no=CAST(split_part(subscription_id, '_', 3) AS BIGINT):n''')} FROM ev""")
