"""Column kinds of every registered query (generated by tools/gen_portable.py)."""

SPEC = {'accounts_with_activity': [('c_custkey', 'text'), ('c_name', 'keep')],
 'acquisition_date': [('member_id', 'keep'), ('acquisition_date', 'text')],
 'activity_backfill': [('workout_id', 'keep'),
                       ('member_id', 'keep'),
                       ('activity_date', 'text'),
                       ('steps', 'text'),
                       ('value_sum', 'text'),
                       ('data_source', 'keep')],
 'attributed_accounts': [('account_id', 'keep'), ('campaign_id', 'keep')],
 'attributed_revenue': [('campaign_id', 'keep'),
                        ('attributed_mrr', 'text'),
                        ('attributed_subscriptions', 'text')],
 'attributed_revenue_shared_ids': [('campaign_id', 'keep'),
                                   ('attributed_mrr', 'text'),
                                   ('attributed_subscriptions', 'text')],
 'billing_resolution': [('subscription_id', 'keep'),
                        ('member_id', 'keep'),
                        ('plan_id', 'keep'),
                        ('sponsored', 'keep'),
                        ('billed_amount', 'text')],
 'bootstrap_resample': [('member_id', 'keep'),
                        ('activity_date', 'text'),
                        ('steps', 'text'),
                        ('value_sum', 'text')],
 'campaign_labels': [('campaign_id', 'keep'), ('campaign_label', 'keep'), ('status', 'keep')],
 'campaign_order': [('position', 'text'), ('campaign_id', 'keep'), ('attributed_mrr', 'text')],
 'chosen_match': [('account_id', 'keep'), ('campaign_id', 'keep')],
 'conditional_measures': [('account_type', 'keep'),
                          ('tier', 'keep'),
                          ('count_mem_with_current_streak', 'text'),
                          ('avg_current_streak_length', 'text'),
                          ('avg_longest_streak_days', 'text'),
                          ('count_orders', 'text')],
 'coverage_summary': [('population', 'keep'),
                      ('with_orders', 'keep'),
                      ('with_events', 'keep'),
                      ('pct_with_orders', 'text'),
                      ('pct_with_events', 'text')],
 'csv_quoting': [('doc_id', 'keep'), ('text', 'keep'), ('source', 'keep')],
 'csv_round_trip': [('order_id', 'keep'),
                    ('member_id', 'keep'),
                    ('order_type', 'keep'),
                    ('order_date', 'text'),
                    ('amount', 'text'),
                    ('status', 'keep')],
 'dq_accepted_values': [('model', 'keep'),
                        ('column_name', 'keep'),
                        ('test_name', 'keep'),
                        ('failures', 'keep'),
                        ('passed', 'keep')],
 'dq_declared_suite': [('model', 'keep'),
                       ('column_name', 'keep'),
                       ('test_name', 'keep'),
                       ('failures', 'keep'),
                       ('passed', 'keep')],
 'dq_not_null': [('model', 'keep'),
                 ('column_name', 'keep'),
                 ('test_name', 'keep'),
                 ('failures', 'keep'),
                 ('passed', 'keep')],
 'dq_relationships': [('model', 'keep'),
                      ('column_name', 'keep'),
                      ('test_name', 'keep'),
                      ('failures', 'keep'),
                      ('passed', 'keep')],
 'dq_report': [('model', 'keep'),
               ('column_name', 'keep'),
               ('test_name', 'keep'),
               ('failures', 'keep'),
               ('passed', 'keep')],
 'dq_unique': [('model', 'keep'),
               ('column_name', 'keep'),
               ('test_name', 'keep'),
               ('failures', 'keep'),
               ('passed', 'keep')],
 'eligible_matches': [('account_id', 'keep'), ('campaign_id', 'keep'), ('acquisition_date', 'text')],
 'engagement_and_value': [('account_type', 'keep'),
                          ('tier', 'keep'),
                          ('count_members', 'keep'),
                          ('total_billed_amount', 'text'),
                          ('rev_per_member', 'text'),
                          ('count_mem_with_current_streak', 'text'),
                          ('avg_current_streak_length', 'text'),
                          ('avg_longest_streak_days', 'text'),
                          ('count_orders', 'text'),
                          ('avg_length_of_membership_days', 'text'),
                          ('avg_length_of_membership_months', 'text')],
 'engagement_over_workouts': [('account_type', 'keep'),
                              ('tier', 'keep'),
                              ('count_members', 'keep'),
                              ('total_billed_amount', 'text'),
                              ('rev_per_member', 'text'),
                              ('count_mem_with_current_streak', 'text'),
                              ('avg_current_streak_length', 'text'),
                              ('avg_longest_streak_days', 'text'),
                              ('count_orders', 'text'),
                              ('avg_length_of_membership_days', 'text'),
                              ('avg_length_of_membership_months', 'text')],
 'entity_day_spine': [('member_id', 'keep'), ('activity_date', 'text')],
 'exact_n_sample': [('c_custkey', 'text'), ('c_name', 'keep'), ('c_nationkey', 'text')],
 'file_pool': [('order_id', 'keep'),
               ('member_id', 'keep'),
               ('order_type', 'keep'),
               ('order_date', 'text'),
               ('amount', 'text'),
               ('status', 'keep')],
 'guarded_ratio': [('campaign_id', 'keep'),
                   ('spend_per_attributed_subscription', 'text'),
                   ('payback_period_months', 'text')],
 'latest_streak_status': [('member_id', 'keep'),
                          ('streak_length_days', 'keep'),
                          ('days_since_streak_end', 'text'),
                          ('is_current', 'keep')],
 'load_report': [('table_name', 'keep'), ('status', 'keep'), ('rows', 'text')],
 'longest_streak': [('member_id', 'keep'), ('longest_streak', 'text')],
 'member_order_rollup': [('member_id', 'keep'), ('count_orders', 'keep'), ('total_orders_amount', 'text')],
 'member_streaks': [('member_id', 'keep'),
                    ('streak_start_date', 'text'),
                    ('streak_end_date', 'text'),
                    ('streak_length_days', 'keep'),
                    ('streak_recency_rank', 'keep')],
 'membership_length': [('account_type', 'keep'),
                       ('tier', 'keep'),
                       ('avg_length_of_membership_days', 'text'),
                       ('avg_length_of_membership_months', 'text')],
 'month_spine': [('month_start', 'text')],
 'monthly_revenue': [('month_start', 'text'),
                     ('mrr', 'text'),
                     ('active_subscriptions', 'text'),
                     ('one_time_revenue', 'text')],
 'monthly_revenue_imperfect_dates': [('month_start', 'text'),
                                     ('mrr', 'text'),
                                     ('active_subscriptions', 'text'),
                                     ('one_time_revenue', 'text')],
 'named_source': [('subscription_id', 'keep'),
                  ('member_id', 'keep'),
                  ('plan_id', 'keep'),
                  ('start_date', 'text'),
                  ('end_date', 'text'),
                  ('status', 'keep'),
                  ('billed_amount', 'text')],
 'pooled_union': [('event_id', 'text'), ('user_id', 'text'), ('event_type', 'keep'), ('origin', 'keep')],
 'reanchor_sequence': [('member_id', 'keep'), ('original_date', 'text'), ('activity_date', 'text')],
 'recency_rank': [('member_id', 'keep'),
                  ('run_key', 'text'),
                  ('streak_start_date', 'text'),
                  ('streak_end_date', 'text'),
                  ('streak_length_days', 'keep'),
                  ('streak_recency_rank', 'keep')],
 'refreshed_table': [('member_id', 'keep'),
                     ('account_id', 'keep'),
                     ('email', 'keep'),
                     ('join_date', 'text'),
                     ('eligibility_status', 'keep'),
                     ('sponsored', 'keep'),
                     ('is_fitbit_seed', 'keep')],
 'replicate_rows': [('c_custkey', 'text'), ('copy_no', 'keep')],
 'resolution_bands': [('ticket_id', 'keep'),
                      ('ticket_priority', 'keep'),
                      ('ticket_status', 'keep'),
                      ('created_at', 'text'),
                      ('band_low', 'keep'),
                      ('band_high', 'keep'),
                      ('resolved_at', 'text')],
 'revenue_by_campaign': [('campaign_id', 'keep'),
                         ('campaign_name', 'keep'),
                         ('channel', 'keep'),
                         ('target_audience', 'keep'),
                         ('spend', 'text'),
                         ('conversions', 'text'),
                         ('attributed_mrr', 'text'),
                         ('attributed_subscriptions', 'keep'),
                         ('spend_per_attributed_subscription', 'text'),
                         ('payback_period_months', 'text')],
 'revenue_by_segment': [('account_type', 'keep'),
                        ('plan_name', 'keep'),
                        ('active_mrr', 'text'),
                        ('active_subscriptions', 'text')],
 'revenue_by_segment_shared_ids': [('account_type', 'keep'),
                                   ('plan_name', 'keep'),
                                   ('active_mrr', 'text'),
                                   ('active_subscriptions', 'text')],
 'revenue_trend': [('month_start', 'text'),
                   ('mrr', 'text'),
                   ('active_subscriptions', 'text'),
                   ('one_time_revenue', 'text')],
 'run_bounds': [('member_id', 'keep'),
                ('run_key', 'text'),
                ('streak_start_date', 'text'),
                ('streak_end_date', 'text'),
                ('streak_length_days', 'keep')],
 'run_key': [('member_id', 'keep'), ('activity_date', 'text'), ('run_key', 'text')],
 'sequence_ids': [('event_id', 'text'), ('seq_id', 'keep')],
 'serve_in_order': [('c_custkey', 'text'), ('o_orderkey', 'text'), ('pair_no', 'text')],
 'stage_accounts': [('account_id', 'keep'),
                    ('account_type', 'keep'),
                    ('account_name', 'keep'),
                    ('industry', 'keep'),
                    ('status', 'keep'),
                    ('per_member_rate', 'text')],
 'stage_acquisition': [('account_id', 'keep'), ('campaign_id', 'keep')],
 'stage_activity': [('workout_id', 'keep'),
                    ('member_id', 'keep'),
                    ('activity_date', 'text'),
                    ('steps', 'text'),
                    ('distance_km', 'text'),
                    ('very_active_minutes', 'text'),
                    ('moderately_active_minutes', 'text'),
                    ('light_active_minutes', 'text'),
                    ('sedentary_minutes', 'text'),
                    ('calories_burned', 'text'),
                    ('data_source', 'keep'),
                    ('is_active_day', 'keep')],
 'stage_campaigns': [('campaign_id', 'keep'),
                     ('campaign_name', 'keep'),
                     ('channel', 'keep'),
                     ('target_audience', 'keep'),
                     ('start_date', 'text'),
                     ('end_date', 'text'),
                     ('status', 'keep'),
                     ('budget', 'text'),
                     ('spend', 'text'),
                     ('impressions', 'text'),
                     ('clicks', 'text'),
                     ('conversions', 'text')],
 'stage_members': [('member_id', 'keep'),
                   ('account_id', 'keep'),
                   ('email', 'keep'),
                   ('join_date', 'text'),
                   ('eligibility_status', 'keep'),
                   ('sponsored', 'keep'),
                   ('is_fitbit_seed', 'keep')],
 'stage_orders': [('order_id', 'keep'),
                  ('member_id', 'keep'),
                  ('order_type', 'keep'),
                  ('order_date', 'text'),
                  ('amount', 'text'),
                  ('status', 'keep')],
 'stage_plans': [('plan_id', 'keep'), ('plan_name', 'keep'), ('tier', 'keep'), ('monthly_price', 'text')],
 'stage_subscriptions': [('subscription_id', 'keep'),
                         ('member_id', 'keep'),
                         ('plan_id', 'keep'),
                         ('start_date', 'text'),
                         ('end_date', 'text'),
                         ('status', 'keep'),
                         ('billed_amount', 'text')],
 'stage_tickets': [('ticket_id', 'keep'),
                   ('member_id', 'keep'),
                   ('ticket_category', 'keep'),
                   ('ticket_status', 'keep'),
                   ('ticket_priority', 'keep'),
                   ('ticket_channel', 'keep'),
                   ('csat_rating', 'text'),
                   ('created_at', 'text'),
                   ('resolved_at', 'text')],
 'streak_summary': [('member_id', 'keep'),
                    ('longest_streak', 'text'),
                    ('latest_streak_length', 'text'),
                    ('is_current', 'keep')],
 'subscribed_members': [('account_type', 'keep'),
                        ('tier', 'keep'),
                        ('count_members', 'keep'),
                        ('subscription_rows', 'text')],
 'unit_conversion': [('event_id', 'text'), ('distance_km', 'text'), ('whole_value', 'text')],
 'unmatched_defaults': [('campaign_id', 'keep'),
                        ('campaign_name', 'keep'),
                        ('channel', 'keep'),
                        ('target_audience', 'keep'),
                        ('spend', 'text'),
                        ('conversions', 'text'),
                        ('attributed_mrr', 'text'),
                        ('attributed_subscriptions', 'keep')],
 'value_per_member': [('account_type', 'keep'),
                      ('tier', 'keep'),
                      ('count_members', 'keep'),
                      ('total_billed_amount', 'text'),
                      ('rev_per_member', 'text')],
 'view_rows': [('plan_id', 'keep'), ('plan_name', 'keep'), ('tier', 'keep'), ('monthly_price', 'text')],
 'weighted_assign': [('c_custkey', 'text'), ('plan_tier', 'keep')],
 'workout_streaks': [('member_id', 'keep'),
                     ('streak_start_date', 'text'),
                     ('streak_end_date', 'text'),
                     ('streak_length_days', 'keep'),
                     ('streak_recency_rank', 'keep')],
 'zip_by_rank': [('c_custkey', 'text'), ('s_suppkey', 'text'), ('pair_no', 'text')]}
