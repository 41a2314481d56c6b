"""The retail sources: where they come from, how they are typed and what makes a row invalid."""

from __future__ import annotations

from dataclasses import dataclass, field, replace


@dataclass(frozen=True)
class TableSpec:
    """One source and its cleaning contract.

    ``rules`` is ordered: the order fixes the text of a row's reject reason. A rule
    that evaluates to NULL does not reject, so every "missing" case is spelt out. Every
    file of the source must have the ``columns``; it may have others.
    """

    name: str
    files: str
    key: tuple[str, ...] = ()
    casts: dict[str, str] = field(default_factory=dict)
    rules: tuple[tuple[str, str], ...] = ()
    null_columns: tuple[str, ...] = ()
    columns: tuple[str, ...] = ()
    multi_line: bool = False

    def at(self, files: str, **changes) -> TableSpec:
        """The same source read from another file pattern."""
        return replace(self, files=files, **changes)


# File names, columns, business keys, reject reasons and their predicates.
# multi_line is on only for the source with free text, as its large files cost two scans more.
_SPECS = (
    TableSpec(
        name="orders",
        files="*orders_dataset.csv",
        columns=("order_id", "customer_id", "order_status", "order_purchase_timestamp", "order_delivered_customer_date"),
        key=("order_id",),
        casts={
            "order_purchase_timestamp": "timestamp",
            "order_delivered_customer_date": "timestamp",
        },
        rules=(
            ("null_order_id", "order_id IS NULL"),
            ("null_customer_id", "customer_id IS NULL"),
            ("invalid_purchase_timestamp", "order_purchase_timestamp IS NULL"),
            (
                "delivered_before_purchase",
                "order_delivered_customer_date < order_purchase_timestamp",
            ),
            (
                "delivered_status_missing_date",
                "order_status = 'delivered' AND order_delivered_customer_date IS NULL",
            ),
        ),
        null_columns=("order_id", "customer_id", "order_purchase_timestamp"),
    ),
    TableSpec(
        name="customers",
        files="*customers_dataset.csv",
        columns=("customer_id", "customer_state"),
        key=("customer_id",),
        rules=(
            ("null_customer_id", "customer_id IS NULL"),
            ("null_state", "customer_state IS NULL"),
        ),
        null_columns=("customer_id", "customer_state"),
    ),
    TableSpec(
        name="payments",
        files="*order_payments_dataset.csv",
        columns=("order_id", "payment_sequential", "payment_value", "payment_type"),
        key=("order_id", "payment_sequential"),
        casts={"payment_value": "double"},
        rules=(
            ("null_order_id", "order_id IS NULL"),
            ("invalid_payment_value", "payment_value IS NULL OR payment_value < 0"),
            ("zero_payment_value", "payment_value = 0"),
            ("undefined_payment_type", "payment_type = 'not_defined'"),
        ),
        null_columns=("order_id", "payment_value"),
    ),
    TableSpec(
        name="order_items",
        files="*order_items_dataset.csv",
        columns=("order_id", "order_item_id", "product_id", "seller_id", "price"),
        key=("order_id", "order_item_id"),
        casts={"price": "double", "freight_value": "double"},
        rules=(
            ("null_ids", "order_id IS NULL OR product_id IS NULL"),
            ("invalid_price", "price IS NULL OR price < 0"),
        ),
        null_columns=("order_id", "product_id", "price"),
    ),
    TableSpec(
        name="products",
        files="*products_dataset.csv",
        columns=("product_id", "product_category_name"),
        key=("product_id",),
        rules=(
            ("null_product_id", "product_id IS NULL"),
            ("missing_category", "product_category_name IS NULL"),
        ),
        null_columns=("product_id", "product_category_name"),
    ),
    TableSpec(
        name="sellers",
        files="*sellers_dataset.csv",
        columns=("seller_id", "seller_state"),
        key=("seller_id",),
        rules=(("null_seller_id", "seller_id IS NULL"),),
    ),
    TableSpec(
        name="reviews",
        files="*order_reviews_dataset.csv",
        columns=("review_id", "order_id", "review_score"),
        key=("review_id", "order_id"),
        casts={"review_score": "int"},
        rules=(("invalid_score", "review_score IS NULL OR review_score NOT BETWEEN 1 AND 5"),),
        null_columns=("review_id", "order_id", "review_score"),
        multi_line=True,
    ),
    # A lookup without rules: read raw, never cleaned.
    TableSpec(
        name="category_translation",
        files="*product_category_name_translation.csv",
        columns=("product_category_name", "product_category_name_english"),
    ),
)

SOURCES: dict[str, TableSpec] = {s.name: s for s in _SPECS}
CLEANED: dict[str, TableSpec] = {s.name: s for s in _SPECS if s.key}


def cleaned_spec(name: str) -> TableSpec:
    """The spec of a cleaned table; an unknown name raises."""
    if name not in CLEANED:
        raise ValueError(f"unknown table {name!r}: expected one of {sorted(CLEANED)}")
    return CLEANED[name]


def rejecting_malformed(spec: TableSpec) -> TableSpec:
    """The same contract for rows read with their broken text kept: these are rejected."""
    return replace(spec, rules=(*spec.rules, ("malformed_row", "_corrupt_record IS NOT NULL")))
