"""Names, keys and types that the stored tables rely on."""

from __future__ import annotations

from dataclasses import dataclass

# Dataset, column and batch names as they stand in stored tables.
DATASETS = ("products", "customers", "orders", "order_items")
AUDIT_COLUMNS = ("source_system", "batch_id", "ingestion_timestamp", "source_file")
PROCESSED_AT = "silver_processing_timestamp"
DEFAULT_BATCH_ID = "manual_batch_001"
UNREADABLE = "unreadable_record"
DAILY_SALES = "daily_sales_by_category"

# The product categories, provinces and hot keys of the retail model.
CATEGORIES = (
    "electronics",
    "clothing",
    "home",
    "grocery",
    "beauty",
    "sports",
    "toys",
    "automotive",
)
PROVINCES = ("Ontario", "Quebec", "British Columbia", "Alberta", "Manitoba")
HOT_CATEGORY, HOT_CATEGORY_PERCENT = "electronics", 40
HOT_PROVINCE, HOT_PROVINCE_PERCENT = "Ontario", 35

KEYS = {
    "products": "product_id",
    "customers": "customer_id",
    "orders": "order_id",
    "order_items": "order_item_id",
}

# Prices keep four places (a discounted price has them), amounts of money two.
PRICE = "decimal(18,4)"
AMOUNT = "decimal(18,2)"

# Declared types for the raw files. Reading with them costs no inference pass
# over the data; timestamps without a zone keep the day that the file shows.
RAW_SCHEMAS = {
    "products": (
        "product_id BIGINT, product_name STRING, category STRING, brand STRING, "
        f"unit_price {PRICE}, is_active BOOLEAN"
    ),
    "customers": (
        "customer_id BIGINT, first_name STRING, last_name STRING, email STRING, "
        "city STRING, province STRING, signup_date DATE, loyalty_tier STRING, "
        "is_active BOOLEAN"
    ),
    "orders": (
        "order_id BIGINT, customer_id BIGINT, order_timestamp TIMESTAMP_NTZ, "
        "store_id BIGINT, order_status STRING, payment_method STRING, "
        f"total_amount {AMOUNT}, item_count INT"
    ),
    "order_items": (
        "order_item_id BIGINT, order_id BIGINT, product_id BIGINT, quantity INT, "
        f"unit_price {PRICE}, line_total {AMOUNT}"
    ),
}


@dataclass(frozen=True)
class Layers:
    """Where the layers live and how their tables are stored."""

    raw: str
    bronze: str
    silver: str
    gold: str
    table_format: str = "parquet"

    @classmethod
    def under(cls, root: str, table_format: str = "parquet") -> Layers:
        """The four layers as sub-folders of one root."""
        root = root.rstrip("/")
        return cls(
            raw=f"{root}/raw",
            bronze=f"{root}/bronze",
            silver=f"{root}/silver",
            gold=f"{root}/gold",
            table_format=table_format,
        )

    def raw_file(self, dataset: str) -> str:
        return f"{self.raw}/{dataset}/{dataset}.csv"
