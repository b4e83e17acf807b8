"""Warehouse and control table schemas (Spark DDL strings)."""

DIM_CUSTOMER = (
    "customer_key bigint, customer_unique_id string, customer_id string, zip_code_prefix string, "
    "city string, state string, state_name string, region string, lat decimal(10,6), lng decimal(10,6), "
    "is_active string, etl_batch_id bigint, etl_insert_dt timestamp, etl_update_dt timestamp"
)
DIM_SELLER = (
    "seller_key bigint, seller_id string, zip_code_prefix string, city string, state string, region string, "
    "lat decimal(10,6), lng decimal(10,6), is_active string, etl_batch_id bigint, etl_insert_dt timestamp, "
    "etl_update_dt timestamp"
)
DIM_PRODUCT = (
    "product_key bigint, product_id string, category_name_pt string, category_name_en string, "
    "category_group string, product_name_length bigint, product_desc_length bigint, product_photos_qty bigint, "
    "weight_g bigint, length_cm bigint, height_cm bigint, width_cm bigint, volume_cm3 bigint, "
    "effective_from date, effective_to date, is_current string, etl_batch_id bigint, etl_insert_dt timestamp"
)
FACT_ORDERS = (
    "order_fact_key bigint, order_id string, customer_key bigint, order_date_key int, approved_date_key int, delivered_date_key int, "
    "estimated_delivery_date_key int, order_status string, total_payment_value decimal(14,2), "
    "payment_installments_max bigint, payment_type_primary string, num_payment_methods bigint, "
    "days_to_deliver int, days_to_approve int, delivery_delay_days int, is_late_delivery string, "
    "review_score int, has_review string, etl_insert_dt timestamp, etl_batch_id bigint"
)
FACT_ORDER_ITEMS = (
    "item_fact_key bigint, order_id string, order_item_id bigint, order_date_key int, customer_key bigint, product_key bigint, "
    "seller_key bigint, price decimal(12,2), freight_value decimal(12,2), total_item_value decimal(14,2), "
    "etl_insert_dt timestamp, etl_batch_id bigint"
)
FACT_REVIEWS = (
    "review_fact_key bigint, review_id string, order_id string, review_date_key int, review_score int, sentiment string, "
    "has_comment_title string, has_comment_message string, response_days int, etl_insert_dt timestamp, etl_batch_id bigint"
)
REJECTS = (
    "reject_id string, source_table string, source_key string, reject_reason string, raw_data string, "
    "attempt int, reject_dt timestamp, etl_batch_id bigint"
)
BATCH_LOG = (
    "batch_id bigint, attempt int, batch_name string, pipeline_name string, start_dt timestamp, "
    "end_dt timestamp, status string, total_records bigint, success_records bigint, rejected_records bigint, "
    "error_message string, triggered_by string, event_ts timestamp"
)
STEP_LOG = (
    "step_log_id bigint, batch_id bigint, attempt int, step_name string, step_status string, records_in bigint, "
    "records_out bigint, records_rejected bigint, start_dt timestamp, end_dt timestamp, "
    "duration_secs double, error_message string, event_ts timestamp"
)
WATERMARK = (
    "source_name string, entity_name string, last_load_dt timestamp, last_batch_id bigint, "
    "etl_update_dt timestamp"
)
ITEMS_WAITING = (
    "order_id string, order_item_id bigint, product_id string, seller_id string, price string, "
    "freight_value string, etl_batch_id bigint, reason string"
)
