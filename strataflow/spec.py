"""The eight source entities: file pattern, columns, business key and tracked columns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

LINEAGE = ("batch_id", "source_file_name", "source_row_number", "load_timestamp")


@dataclass(frozen=True)
class EntitySpec:
    name: str
    label: str
    key: str
    required: tuple[str, ...]
    optional: tuple[str, ...]
    order: tuple[str, ...]
    tracked: tuple[str, ...]
    candidate_key_only: bool = False

    @property
    def columns(self) -> tuple[str, ...]:
        return self.order

    @property
    def file_pattern(self) -> str:
        return rf"^{self.name}_\d{{8}}\.csv$"

    @property
    def raw_table(self) -> str:
        return f"raw_{self.name}"

    @property
    def ods_table(self) -> str:
        return f"ods_{self.name}"

    @property
    def step_name(self) -> str:
        return f"LOAD_ODS_{self.name.upper()}"

    def text_schema(self) -> T.StructType:
        """Every source column is read as text; typing happens behind the gates."""
        return T.StructType([T.StructField(c, T.StringType()) for c in self.order])


def _entity(name, label, key, columns, tracked, optional=(), candidate_key_only=False):
    order = tuple(columns.split())
    opt = tuple(optional.split()) if isinstance(optional, str) else tuple(optional)
    return EntitySpec(
        name=name,
        label=label,
        key=key,
        required=tuple(c for c in order if c not in opt),
        optional=opt,
        order=order,
        tracked=tuple(tracked.split()),
        candidate_key_only=candidate_key_only,
    )


# The source contract. Listed in the order file names are matched (first match wins).
ENTITIES: dict[str, EntitySpec] = {
    e.name: e
    for e in (
        _entity(
            "customer", "Customer", "customer_id",
            "customer_id signup_date city acquisition_channel",
            "signup_date city acquisition_channel",
            optional="acquisition_channel",
        ),
        _entity(
            "delivery_partner", "Delivery Partner", "delivery_partner_id",
            "delivery_partner_id onboard_date partner_name city vehicle_type employment_type avg_rating is_active",
            "onboard_date partner_name city vehicle_type employment_type avg_rating is_active",
            optional="vehicle_type employment_type avg_rating",
        ),
        _entity(
            "delivery_performance", "Delivery Performance", "delivery_id",
            "delivery_id order_id prep_time rider_wait_time travel_time order_item "
            "expected_delivery_time_min actual_delivery_time_min delivery_item distance_km",
            "order_id prep_time rider_wait_time travel_time order_item "
            "expected_delivery_time_min actual_delivery_time_min delivery_item distance_km",
            optional="prep_time rider_wait_time travel_time distance_km",
            candidate_key_only=True,
        ),
        _entity(
            "menu_item", "Menu Item", "menu_item_id",
            "menu_item_id restaurant_id item_name category is_veg price",
            "restaurant_id item_name category is_veg price",
        ),
        _entity(
            "order", "Order", "order_id",
            "order_id customer_id restaurant_id delivery_partner_id order_timestamp subtotal_amount "
            "discount_amount delivery_fee total_amount is_cod is_cancelled",
            "customer_id restaurant_id delivery_partner_id order_timestamp subtotal_amount "
            "discount_amount delivery_fee total_amount is_cod is_cancelled",
            optional="delivery_partner_id",
        ),
        _entity(
            "order_item", "Order Item", "order_item_id",
            "order_item_id order_id menu_item_id restaurant_id quantity unit_price item_discount line_total",
            "order_id menu_item_id quantity unit_price item_discount line_total",
        ),
        _entity(
            "rating", "Rating", "rating_id",
            "rating_id order_id customer_id restaurant_id rating review_text review_timestamp sentiment_score",
            "order_id customer_id restaurant_id rating review_text review_timestamp sentiment_score",
            optional="review_text sentiment_score",
        ),
        _entity(
            "restaurant", "Restaurant", "restaurant_id",
            "restaurant_id onboard_date restaurant_name city cuisine_type partner_type avg_prep_time_min is_active",
            "onboard_date restaurant_name city cuisine_type partner_type avg_prep_time_min is_active",
        ),
    )
}

# Parents before children: lookups against typed tables need this order.
LOAD_ORDER = (
    "customer", "restaurant", "delivery_partner", "menu_item",
    "order", "order_item", "delivery_performance", "rating",
)
