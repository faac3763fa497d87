"""Every named query, keyed as in the driver contract. Each entry takes a
Warehouse and returns a lazy DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import business, customer, family, feeds, incremental, quality, restaurant, roundtrip, views
from .etl import FACT_COLS
from .warehouse import Warehouse


def _fact_out(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast("double").alias(c) if c == "sales_amount" else F.col(c)
                       for c in FACT_COLS])


QUERIES: dict[str, Callable[[Warehouse], DataFrame]] = {
    # research question 1
    "rq1_1_income_distribution": customer.income_distribution,
    "rq1_2_income_frequency": customer.income_frequency,
    "rq1_3_income_spending": customer.income_spending,
    "rq1_4_cuisine_by_income": customer.cuisine_by_income,
    "rq1_5_education_behaviour": customer.education_behaviour,
    "rq1_6_cuisine_by_education": customer.cuisine_by_education,
    "rq1_7_weekend_by_education": customer.weekend_by_education,
    # research question 2
    "rq2_1_top_restaurants": restaurant.top_restaurants,
    "rq2_2_festival_top": restaurant.festival_top,
    "rq2_3_rating_tiers": restaurant.rating_tiers,
    "rq2_4_cuisine_performance": restaurant.cuisine_performance,
    # research question 3
    "rq3_1_family_view": family.family_view,
    "rq3_2_family_daytype": family.family_daytype,
    "rq3_3_family_holiday": family.family_holiday,
    "rq3_4_family_cuisine": family.family_cuisine,
    "rq3_5_family_revenue_share": family.family_revenue_share,
    # business insights and README samples
    "bi1_monthly_revenue": business.monthly_revenue,
    "bi2_loyalty": business.loyalty,
    "bi3_geography": business.geography,
    "bi4_seasonality": business.seasonality,
    "bi5_acquisition": business.acquisition,
    "readme_income_spend": business.readme_income_spend,
    "readme_top_restaurants": business.readme_top_restaurants,
    # warehouse tables
    "etl_dim_date": lambda wh: wh.dim_date,
    "etl_dim_customer": lambda wh: wh.dim_customer,
    "etl_dim_restaurant": lambda wh: wh.dim_restaurant,
    "etl_dim_location": lambda wh: wh.dim_location,
    "etl_fact_order": lambda wh: _fact_out(wh.fact),
    "etl_fact_incremental": lambda wh: _fact_out(incremental.fact_in_two_batches(wh)),
    "etl_dim_incremental": incremental.customers_in_two_batches,
    "etl_location_repatch": incremental.locations_in_two_batches,
    "stg_csv_roundtrip": roundtrip.staging_through_csv,
    "v_stg_orders_nk": views.stg_orders_nk,
    "v_new_dates": views.new_dates,
    "v_fact_load": views.fact_load,
    # QA and data quality
    "qa_row_counts": quality.row_counts,
    "qa_fk_orphans": quality.fk_orphans,
    "qa_location_count": quality.location_count,
    "qa_location_sample": quality.location_sample,
    "dq_duplicate_users": quality.duplicate_users,
    "dq_invalid_dates": quality.invalid_dates,
    "dq_negative_amounts": quality.negative_amounts,
    "dq_null_keys": quality.null_keys,
    "dq_unique_keys": quality.unique_keys,
    "dq_rejected_amounts": quality.rejected_amounts,
    # chart feeds
    "feed_income_mix": feeds.income_mix,
    "feed_avg_orders_range": feeds.avg_orders_range,
    "feed_cuisine_pivot_education": feeds.cuisine_pivot_education,
    "feed_cuisine_pivot_income": feeds.cuisine_pivot_income,
    "feed_aov_box_daytype": feeds.aov_box_daytype,
    "feed_aov_box_income_holiday": feeds.aov_box_income_holiday,
    "feed_aov_weekday": feeds.aov_weekday,
    "feed_aov_holiday": feeds.aov_holiday,
    "feed_top_restaurants": feeds.top_restaurants,
    "feed_rating_vs_orders": feeds.rating_vs_orders,
    "feed_festival_by_year": feeds.festival_by_year,
}
