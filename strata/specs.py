"""Table specifications: one object per table, shared by all three layers.

A spec names the landing file, the columns in file order (raw: all text), the
reference key, the natural key, the trusted casts and the refined types. Layer
jobs, the stream and the tests read everything from here, so a table is declared
once instead of three times.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# Cast kinds used in ``TableSpec.trusted``.
LONG = "long"              # text -> bigint; strict raises, coerce gives null
DOUBLE = "double"          # text -> double
TEXT = "text"              # stays text
COERCE_LONG = "coerce_long"            # unparseable -> 0, truncated to an integer
COERCE_LONG_DOUBLE = "coerce_long_double"  # as above, then widened to double
BLANK_ZERO = "blank_zero"  # '' (or null) -> '0' before the column's cast

# Date policies used in ``TableSpec.dates`` (refined layer).
STRICT = "strict"          # bad text raises, null tokens give null
TOLERANT = "tolerant"      # bad text gives null

_SPARK_TYPES = {
    "string": T.StringType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
}


@dataclass(frozen=True)
class TableSpec:
    name: str
    source_file: str
    columns: tuple[str, ...]
    key: tuple[str, ...]                   # the reference key: always the first column
    natural_key: tuple[str, ...]           # the key that identifies a row
    trusted: dict = field(default_factory=dict)    # column -> cast kind
    blank_zero: tuple[str, ...] = ()       # columns where '' becomes 0 before casting
    fill_zero: bool = False                # null -> 0 / '0' (not keys, not dates)
    refined: dict = field(default_factory=dict)    # column -> string|long|double|date
    dates: dict = field(default_factory=dict)      # refined date column -> policy
    multiline: bool = False                # quoted newlines inside a field

    @property
    def raw_schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, T.StringType(), True) for c in self.columns])

    @property
    def refined_schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, _SPARK_TYPES[self.refined[c]], True)
                             for c in self.columns])

    def keys(self, natural: bool = True) -> list[str]:
        return list(self.natural_key if natural else self.key)


# Fixed values that must equal the source system's: landing file names and the
# column names of each feed, in file order ("lenght" is the feed's own spelling).
CUSTOMERS = TableSpec(
    name="customers",
    source_file="olist_customers_dataset.csv",
    columns=("customer_id", "customer_unique_id", "customer_zip_code_prefix",
             "customer_city", "customer_state"),
    key=("customer_id",), natural_key=("customer_id",),
    trusted={"customer_zip_code_prefix": LONG},
    fill_zero=True,
    refined={"customer_id": "string", "customer_unique_id": "string",
             "customer_zip_code_prefix": "long", "customer_city": "string",
             "customer_state": "string"},
)

GEOLOCATION = TableSpec(
    name="geolocation",
    source_file="olist_geolocation_dataset.csv",
    columns=("geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng",
             "geolocation_city", "geolocation_state"),
    key=("geolocation_zip_code_prefix",), natural_key=("geolocation_zip_code_prefix",),
    trusted={"geolocation_zip_code_prefix": LONG, "geolocation_lat": DOUBLE,
             "geolocation_lng": DOUBLE},
    fill_zero=True,
    refined={"geolocation_zip_code_prefix": "long", "geolocation_lat": "double",
             "geolocation_lng": "double", "geolocation_city": "string",
             "geolocation_state": "string"},
)

ITEMS = TableSpec(
    name="items",
    source_file="olist_order_items_dataset.csv",
    columns=("order_id", "order_item_id", "product_id", "seller_id",
             "shipping_limit_date", "price", "freight_value"),
    key=("order_id",), natural_key=("order_id", "order_item_id"),
    trusted={"shipping_limit_date": TEXT, "price": DOUBLE, "freight_value": DOUBLE},
    fill_zero=True,
    refined={"order_id": "string", "order_item_id": "string", "product_id": "string",
             "seller_id": "string", "shipping_limit_date": "date", "price": "double",
             "freight_value": "double"},
    dates={"shipping_limit_date": STRICT},
)

ORDERS = TableSpec(
    name="orders",
    source_file="olist_orders_dataset.csv",
    columns=("order_id", "customer_id", "order_status", "order_purchase_timestamp",
             "order_approved_at", "order_delivered_carrier_date",
             "order_delivered_customer_date", "order_estimated_delivery_date"),
    key=("order_id",), natural_key=("order_id",),
    fill_zero=True,
    refined={"order_id": "string", "customer_id": "string", "order_status": "string",
             "order_purchase_timestamp": "date", "order_approved_at": "date",
             "order_delivered_carrier_date": "date",
             "order_delivered_customer_date": "date",
             "order_estimated_delivery_date": "date"},
    dates={"order_purchase_timestamp": STRICT, "order_approved_at": STRICT,
           "order_delivered_carrier_date": STRICT,
           "order_delivered_customer_date": STRICT,
           "order_estimated_delivery_date": STRICT},
)

PAYMENTS = TableSpec(
    name="payments",
    source_file="olist_order_payments_dataset.csv",
    columns=("order_id", "payment_sequential", "payment_type", "payment_installments",
             "payment_value"),
    key=("order_id",), natural_key=("order_id", "payment_sequential"),
    trusted={"payment_sequential": LONG, "payment_installments": LONG,
             "payment_value": DOUBLE},
    fill_zero=True,
    refined={"order_id": "string", "payment_sequential": "long", "payment_type": "string",
             "payment_installments": "long", "payment_value": "double"},
)

PRODUCTS = TableSpec(
    name="products",
    source_file="olist_products_dataset.csv",
    columns=("product_id", "product_category_name", "product_name_lenght",
             "product_description_lenght", "product_photos_qty", "product_weight_g",
             "product_length_cm", "product_height_cm", "product_width_cm"),
    key=("product_id",), natural_key=("product_id",),
    blank_zero=("product_name_lenght", "product_description_lenght", "product_photos_qty",
                "product_weight_g", "product_length_cm", "product_height_cm",
                "product_width_cm"),
    trusted={"product_name_lenght": COERCE_LONG_DOUBLE,
             "product_description_lenght": DOUBLE, "product_photos_qty": LONG,
             "product_weight_g": DOUBLE, "product_length_cm": DOUBLE,
             "product_height_cm": DOUBLE, "product_width_cm": DOUBLE},
    refined={"product_id": "string", "product_category_name": "string",
             "product_name_lenght": "double", "product_description_lenght": "double",
             "product_photos_qty": "long", "product_weight_g": "double",
             "product_length_cm": "double", "product_height_cm": "double",
             "product_width_cm": "double"},
)

REVIEWS = TableSpec(
    name="reviews",
    source_file="olist_order_reviews_dataset.csv",
    columns=("review_id", "order_id", "review_score", "review_comment_title",
             "review_comment_message", "review_creation_date", "review_answer_timestamp"),
    key=("review_id",), natural_key=("review_id",),
    trusted={"review_score": COERCE_LONG},
    refined={"review_id": "string", "order_id": "string", "review_score": "long",
             "review_comment_title": "string", "review_comment_message": "string",
             "review_creation_date": "date", "review_answer_timestamp": "date"},
    dates={"review_creation_date": TOLERANT, "review_answer_timestamp": TOLERANT},
    multiline=True,
)

SELLERS = TableSpec(
    name="sellers",
    source_file="olist_sellers_dataset.csv",
    columns=("seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"),
    key=("seller_id",), natural_key=("seller_id",),
    trusted={"seller_zip_code_prefix": LONG},
    fill_zero=True,
    refined={"seller_id": "string", "seller_zip_code_prefix": "long",
             "seller_city": "string", "seller_state": "string"},
)

# Load order of a full run (same as the source system's).
ALL_SPECS: tuple[TableSpec, ...] = (CUSTOMERS, GEOLOCATION, ITEMS, ORDERS, PAYMENTS,
                                    PRODUCTS, REVIEWS, SELLERS)
SPECS = {s.name: s for s in ALL_SPECS}
