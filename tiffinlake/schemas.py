"""Explicit schemas of every input, so no source is read twice to infer one."""

from pyspark.sql import types as T

# The column names of the delivery CSV.
DELIVERY_CSV_COLUMNS = [
    "ID", "Delivery_person_ID", "Delivery_person_Age", "Delivery_person_Ratings",
    "Restaurant_latitude", "Restaurant_longitude",
    "Delivery_location_latitude", "Delivery_location_longitude",
    "Order_Date", "Time_Orderd", "Time_Order_picked",
    "Weather_conditions", "Road_traffic_density", "Vehicle_condition",
    "Type_of_order", "Type_of_vehicle", "multiple_deliveries",
    "Festival", "City", "Time_taken (min)",
]


_TYPES = {
    "string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(), "double": T.DoubleType(),
    "boolean": T.BooleanType(), "date": T.DateType(), "timestamp": T.TimestampType(),
    "decimal(12,2)": T.DecimalType(12, 2), "decimal(10,2)": T.DecimalType(10, 2),
    "map<string,string>": T.MapType(T.StringType(), T.StringType()),
}


def _struct(spec: str) -> T.StructType:
    """``"name type, ..."`` as a schema, without needing a running session."""
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in (f.split() for f in spec.split(", "))])


DELIVERY_CSV = T.StructType([T.StructField(c, T.StringType()) for c in DELIVERY_CSV_COLUMNS])

DELIVERY_EVENT = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("event_time", T.StringType()),
    T.StructField("ingestion_time", T.StringType()),
    T.StructField("payload", DELIVERY_CSV),
])

ORDER_EVENT = _struct(
    "event_id string, event_type string, timestamp string, user_id bigint, order_id string, "
    "order_type string, item_id bigint, item_name string, restaurant_id bigint, quantity int, "
    "price decimal(12,2), status string, city string, location string, metadata map<string,string>"
)

CLICK_EVENT = _struct(
    "event_id string, event_type string, timestamp string, user_id bigint, session_id string, "
    "item_id bigint, ad_id string, ad_campaign_id string, ad_type string, is_click boolean, "
    "page_url string, referrer string, device_type string, user_agent string, city string, "
    "ip_address string, metadata map<string,string>"
)

BEHAVIOR_EVENT = _struct(
    "event_id string, event_type string, event_time string, user_id bigint, item_id bigint, "
    "category string, session_id string, source_page string, metadata map<string,string>"
)

STREAM_ORDER = _struct(
    "event_id string, order_id int, user_id int, amount int, restaurant string, event_time string"
)

TRANSACTION = _struct(
    "event_id string, user_id string, device_id string, device_type string, order_id string, "
    "amount double, restaurant_id string, city string, payment_method string, is_cod boolean, "
    "event_time bigint, behavior string"
)

FRAUD_ALERT = _struct(
    "alert_type string, user_id string, device_id string, order_id string, event_id string, "
    "amount double, severity string, message string, detected_at bigint, alert_data string"
)

BRONZE_ORDERS = _struct(
    "event_id string, order_id string, user_id bigint, item_id bigint, item_name string, "
    "price decimal(12,2), status string, event_timestamp timestamp, raw_event string, "
    "event_type string, schema_version string, source_topic string, producer_service string, "
    "ingestion_id string, kafka_partition int, kafka_offset bigint, ingestion_timestamp timestamp, "
    "partition_date date"
)

BRONZE_CLICKS = _struct(
    "event_id string, user_id bigint, event_type string, item_id bigint, session_id string, "
    "event_timestamp timestamp, raw_event string, schema_version string, source_topic string, "
    "producer_service string, ingestion_id string, kafka_partition int, kafka_offset bigint, "
    "ingestion_timestamp timestamp, partition_date date"
)

FOODS = _struct(
    "food_id int, name string, category string, price decimal(10,2), description string, "
    "image_url string, is_available boolean"
)

USERS_CSV = _struct("id int, name string, age int, salary int, department string")

USER_DOCUMENT = T.StructType([T.StructField("results", T.ArrayType(T.StructType([
    T.StructField("name", _struct("first string, last string")),
    T.StructField("email", T.StringType()),
    T.StructField("location", _struct("country string")),
])))])
