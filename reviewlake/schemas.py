"""Explicit schemas as DDL: the tables the queries run on and the review-domain records."""

TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp",
    "events": "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}

REVIEW = (
    "review_id string, user_id string, product_id string, rating int, title string, review_text string, "
    "helpful_votes int, total_votes int, verified_purchase boolean, review_date timestamp, language string, "
    "sentiment_score double, word_count int, contains_images boolean, contains_video boolean, is_spam boolean, "
    "created_at timestamp, updated_at timestamp")

USER = (
    "user_id string, username string, email string, first_name string, last_name string, date_of_birth date, "
    "gender string, country string, city string, registration_date date, is_verified boolean, total_orders int, "
    "created_at timestamp, updated_at timestamp")

PRODUCT = (
    "product_id string, name string, category string, subcategory string, brand string, price decimal(10,2), "
    "description string, weight_kg double, dimensions string, color string, material string, "
    "manufacturer string, model_number string, release_date date, is_active boolean, stock_quantity int, "
    "created_at timestamp, updated_at timestamp")

USER_ACTIVITY = (
    "activity_id string, user_id string, activity_type string, product_id string, "
    "activity_timestamp timestamp, session_id string, metadata string")

ORDER = (
    "order_id string, user_id string, order_date timestamp, total_amount decimal(10,2), status string, "
    "shipping_address string, payment_method string, created_at timestamp")

ORDER_ITEM = (
    "order_item_id string, order_id string, product_id string, quantity int, unit_price decimal(10,2), "
    "total_price decimal(10,2)")

API_LOG = (
    "timestamp timestamp, request_id string, endpoint string, method string, status_code int, "
    "response_time_ms int, user_agent string, ip_address string, user_id string, request_size_bytes int, "
    "response_size_bytes int")

#: One stream message; `data` keeps the whole JSON text of the payload.
EVENT = (
    "event_id string, event_type string, timestamp timestamp, source string, data string")

#: Every payload field an event processor reads.
EVENT_DATA = (
    "user_id bigint, product_id bigint, rating int, review_text string, verified_purchase boolean, "
    "device_type string, location string, session_id string, page_views double, time_spent double, "
    "session_duration double, view_duration double, amount double, total_amount double, quantity int, "
    "payment_method string")

JOB_LOG = (
    "job_id string, source_type string, source_path string, target_path string, format_type string, "
    "status string, start_time timestamp, end_time timestamp, records_processed bigint, errors array<string>")
