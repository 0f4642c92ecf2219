"""Declared table schemas (from the warehouse DDL): column types, NOT NULL
columns, keys and foreign keys.  Used by ``conform_to_schema`` and by the
data-quality checks."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

L, I, D, S, B = T.LongType(), T.IntegerType(), T.DateType(), T.StringType(), T.BooleanType()
TS = T.TimestampType()


def N(p: int, s: int) -> T.DecimalType:
    return T.DecimalType(p, s)


@dataclass
class TableSpec:
    name: str
    columns: list[tuple[str, T.DataType]]
    not_null: list[str] = field(default_factory=list)
    keys: list[list[str]] = field(default_factory=list)          # primary key and UNIQUE keys
    foreign: list[tuple[str, str, str]] = field(default_factory=list)  # (column, parent table, parent column)

    @property
    def struct(self) -> T.StructType:
        return T.StructType([T.StructField(c, t, c not in self.not_null) for c, t in self.columns])


def _table(name: str, columns: list[tuple[str, T.DataType]], not_null: str = "", unique: list[list[str]] | None = None,
           foreign: dict[str, str] | None = None, primary: list[str] | None = None) -> TableSpec:
    """A spec whose primary key is its first column unless named (it counts as
    NOT NULL).  ``foreign``: column -> parent table, whose key has that name."""
    key = primary or [columns[0][0]]
    return TableSpec(name, columns, [*key, *(c for c in not_null.split() if c not in key)], [key, *(unique or [])],
                     [(c, parent, c) for c, parent in (foreign or {}).items()])


# The declared columns, types, NOT NULL columns, keys and
# references of the warehouse tables.
_DECLARED = [
    _table("vendors", [("vendor_id", L), ("vendor_name", S), ("vendor_code", S)], "vendor_name"),
    _table("distribution_centers",
           [("dc_id", L), ("dc_name", S), ("address_line1", S), ("city", S), ("state", S), ("zip", S), ("region", S),
            ("time_zone", S), ("capacity_units", I)], "dc_name"),
    _table("items",
           [("item_id", L), ("item_sku", S), ("item_description", S), ("category", S), ("subcategory", S), ("vendor_id", L),
            ("lead_time_days", I), ("length_in", N(10, 2)), ("width_in", N(10, 2)), ("height_in", N(10, 2)),
            ("weight_lb", N(10, 3)), ("cube_ft", N(12, 4)), ("density_lb_per_cuft", N(12, 4)),
            ("dimensional_weight_lb", N(12, 4)), ("stackability_flag", B), ("hazmat_flag", B), ("nmfc_class", S)],
           "item_sku vendor_id", [["item_sku"]], {"vendor_id": "vendors"}),
    _table("customers",
           [("customer_id", L), ("master_account_number", S), ("sub_account_number", S), ("customer_name", S), ("segment", S),
            ("address_line1", S), ("city", S), ("state", S), ("zip", S), ("region", S), ("credit_limit", N(12, 2)),
            ("discount_percentage", N(5, 2)), ("account_open_date", D)], "customer_name"),
    _table("item_costs",
           [("item_cost_id", L), ("item_id", L), ("effective_date", D), ("unit_cost", N(12, 4)), ("unit_price", N(12, 4)),
            ("shipping_cost_per_unit", N(12, 4)), ("freight_cost", N(12, 4)), ("duty_rate", N(12, 4)),
            ("landed_cost", N(12, 4)), ("replacement_cost", N(12, 4)), ("map_price", N(12, 4))],
           "item_id effective_date", foreign={"item_id": "items"}),
    _table("vendor_performance",
           [("vendor_id", L), ("on_time_delivery_rate", N(5, 2)), ("avg_days_late", N(6, 2)), ("defect_rate", N(5, 2)),
            ("fill_rate", N(5, 2)), ("last_audit_date", D)], foreign={"vendor_id": "vendors"}),
    _table("vendor_item_details",
           [("vendor_item_id", L), ("vendor_id", L), ("item_id", L), ("vendor_item_number", S), ("moq", I),
            ("order_multiple", I), ("vendor_rank", I)],
           "vendor_id item_id", [["vendor_id", "item_id"]], {"vendor_id": "vendors", "item_id": "items"}),
    _table("item_forecast",
           [("forecast_id", L), ("item_id", L), ("forecast_month", D), ("forecast_quantity", I), ("abc_class", S),
            ("xyz_class", S), ("seasonality_index", N(6, 3)), ("lifecycle_stage", S), ("forecast_error_mape", N(6, 2)),
            ("forecast_error_mad", N(12, 4))],
           "item_id forecast_month", [["item_id", "forecast_month"]], {"item_id": "items"}),
    _table("inventory_monthly_snapshot",
           [("snapshot_id", L), ("dc_id", L), ("item_id", L), ("snapshot_month", D), ("quantity_on_hand", I),
            ("quantity_allocated", I), ("quantity_available", I), ("days_on_hand", I), ("excess_quantity", I),
            ("obsolete_quantity", I), ("aging_0_30", I), ("aging_31_60", I), ("aging_61_90", I), ("aging_90_plus", I),
            ("cycle_count_accuracy", N(5, 2))],
           "dc_id item_id snapshot_month quantity_on_hand", foreign={"dc_id": "distribution_centers", "item_id": "items"}),
    _table("inventory_adjustments",
           [("adjustment_id", L), ("dc_id", L), ("item_id", L), ("adjustment_type", S), ("quantity", I), ("reason_code", S),
            ("user_id", S), ("adjustment_timestamp", TS)],
           "dc_id item_id adjustment_type quantity adjustment_timestamp", foreign={"dc_id": "distribution_centers", "item_id": "items"}),
    _table("inventory",
           [("dc_id", L), ("item_id", L), ("avg_cost", N(12, 4)), ("last_cost", N(12, 4)), ("std_cost", N(12, 4)),
            ("qty_on_hand", I), ("qty_on_order", I), ("stocking_location", S), ("vendor_id", L), ("reorder_point", I),
            ("last_restock_date", D)],
           primary=["dc_id", "item_id"], foreign={"dc_id": "distribution_centers", "item_id": "items", "vendor_id": "vendors"}),
    _table("dc_item_slotting",
           [("slotting_id", L), ("dc_id", L), ("item_id", L), ("pick_location", S), ("replenishment_location", S),
            ("slotting_rank", I), ("velocity_class", S)],
           "dc_id item_id", [["dc_id", "item_id"]], {"dc_id": "distribution_centers", "item_id": "items"}),
    _table("carriers",
           [("carrier_id", L), ("carrier_name", S), ("carrier_type", S), ("service_level", S), ("base_rate_per_lb", N(12, 4)),
            ("base_rate_per_mile", N(12, 4)), ("fuel_surcharge_pct", N(6, 2))], "carrier_name carrier_type"),
    _table("orders",
           [("order_id", L), ("customer_id", L), ("order_date", D), ("dc_id", L), ("ship_via", S), ("order_status", S)],
           "customer_id order_date", foreign={"customer_id": "customers", "dc_id": "distribution_centers"}),
    _table("order_lines",
           [("order_line_id", L), ("order_id", L), ("item_id", L), ("quantity_ordered", I), ("quantity_shipped", I),
            ("unit_price", N(12, 4)), ("extended_price", N(12, 2))],
           "order_id item_id quantity_ordered quantity_shipped unit_price", foreign={"order_id": "orders", "item_id": "items"}),
    _table("shipments",
           [("shipment_id", L), ("order_id", L), ("dc_id", L), ("carrier_id", L), ("ship_date", D), ("promised_date", D),
            ("delivery_date", D), ("shipment_status", S), ("shipment_type", S), ("total_weight_lb", N(12, 4)),
            ("total_cube_ft", N(12, 4)), ("estimated_cost", N(12, 2)), ("actual_cost", N(12, 2))],
           "order_id ship_date", foreign={"order_id": "orders", "dc_id": "distribution_centers", "carrier_id": "carriers"}),
    _table("backorders",
           [("backorder_id", L), ("order_id", L), ("order_line_id", L), ("item_id", L), ("qty_backordered", I),
            ("date_created", D), ("date_filled", D), ("days_backordered", I), ("reason_code", S), ("is_filled_flag", B)],
           "order_id order_line_id item_id qty_backordered date_created",
           foreign={"order_id": "orders", "order_line_id": "order_lines", "item_id": "items"}),
    _table("customer_item_preferences",
           [("preference_id", L), ("customer_id", L), ("item_id", L), ("preference_score", N(5, 2)), ("last_purchased_date", D)],
           "customer_id item_id", [["customer_id", "item_id"]], {"customer_id": "customers", "item_id": "items"}),
    _table("shipment_lines",
           [("shipment_line_id", L), ("shipment_id", L), ("order_line_id", L), ("item_id", L), ("quantity_shipped", I),
            ("carton_number", S), ("line_weight_lb", N(12, 4)), ("line_cube_ft", N(12, 4)), ("freight_upcharge", N(12, 4)),
            ("from_location_type", S), ("from_location_id", L), ("to_location_type", S), ("to_location_id", L), ("is_courier", B)],
           "shipment_id order_line_id item_id quantity_shipped",
           foreign={"shipment_id": "shipments", "order_line_id": "order_lines", "item_id": "items"}),
    _table("tracking_events",
           [("tracking_event_id", L), ("shipment_id", L), ("event_timestamp", TS), ("event_type", S), ("location_city", S),
            ("location_state", S), ("location_zip", S), ("location_type", S)],
           "shipment_id event_timestamp", foreign={"shipment_id": "shipments"}),
    _table("driver_costs",
           [("driver_cost_id", L), ("carrier_id", L), ("company_driver", B), ("cost_type", S), ("rate_amount", N(12, 4)),
            ("effective_date", D)], "carrier_id", foreign={"carrier_id": "carriers"}),
    _table("fuel_costs",
           [("fuel_cost_id", L), ("region", S), ("state", S), ("fuel_type", S), ("cost_per_gallon", N(12, 4)), ("effective_date", D)]),
    _table("invoices",
           [("invoice_id", L), ("invoice_number", S), ("order_id", L), ("customer_id", L), ("invoice_date", D), ("due_date", D),
            ("total_amount", N(12, 2)), ("freight_billed", N(12, 2)), ("tax_amount", N(12, 2)), ("discount_amount", N(12, 2)),
            ("payment_terms", S)],
           "invoice_number order_id customer_id invoice_date total_amount", [["invoice_number"]],
           {"order_id": "orders", "customer_id": "customers"}),
    _table("ar_ledger",
           [("ar_entry_id", L), ("invoice_id", L), ("customer_id", L), ("posting_date", D), ("amount_due", N(12, 2)),
            ("amount_paid", N(12, 2)), ("balance", N(12, 2)), ("aging_bucket", S), ("credit_hold_flag", B), ("writeoff_reason", S)],
           "invoice_id customer_id posting_date amount_due amount_paid", foreign={"invoice_id": "invoices", "customer_id": "customers"}),
    _table("sales_reps",
           [("rep_id", L), ("rep_name", S), ("email", S), ("region", S), ("territory", S), ("hire_date", D)], "rep_name"),
    _table("customer_contacts",
           [("contact_id", L), ("customer_id", L), ("rep_id", L), ("contact_name", S), ("role", S), ("email", S),
            ("last_contact_date", D)], "customer_id", foreign={"customer_id": "customers", "rep_id": "sales_reps"}),
    _table("purchase_orders",
           [("po_id", L), ("vendor_id", L), ("item_id", L), ("dc_id", L), ("po_number", S), ("po_date", D),
            ("expected_receipt_date", D), ("actual_receipt_date", D), ("qty_ordered", I), ("qty_received", I),
            ("po_unit_cost", N(12, 4)), ("po_status", S)],
           "vendor_id item_id dc_id po_number po_date qty_ordered", [["po_number"]],
           {"vendor_id": "vendors", "item_id": "items", "dc_id": "distribution_centers"}),
    _table("price_history",
           [("price_id", L), ("item_id", L), ("customer_id", L), ("effective_date", D), ("end_date", D), ("list_price", N(12, 4)),
            ("discount_pct", N(6, 3)), ("net_price", N(12, 4)), ("promo_flag", B), ("channel", S)],
           "item_id effective_date list_price", foreign={"item_id": "items", "customer_id": "customers"}),
    _table("promotions",
           [("promo_id", L), ("promo_name", S), ("promo_code", S), ("start_date", D), ("end_date", D), ("discount_type", S),
            ("discount_value", N(8, 4)), ("applies_to", S), ("category", S), ("customer_segment", S)],
           "start_date end_date", [["promo_code"]]),
    _table("promo_orders", [("promo_order_id", L), ("promo_id", L), ("order_id", L)],
           "promo_id order_id", [["promo_id", "order_id"]], {"promo_id": "promotions", "order_id": "orders"}),
    _table("returns",
           [("return_id", L), ("order_id", L), ("order_line_id", L), ("shipment_id", L), ("item_id", L), ("customer_id", L),
            ("return_date", D), ("reason_code", S), ("condition_code", S), ("qty_returned", I), ("restock_flag", B),
            ("credit_amount", N(12, 2))],
           "order_id order_line_id item_id customer_id return_date qty_returned",
           foreign={"order_id": "orders", "order_line_id": "order_lines", "shipment_id": "shipments", "item_id": "items",
                    "customer_id": "customers"}),
    _table("labor_costs",
           [("labor_id", L), ("dc_id", L), ("week_start_date", D), ("department", S), ("role", S), ("labor_type", S),
            ("hours_worked", N(8, 2)), ("cost_per_hour", N(8, 2)), ("total_cost", N(12, 2)), ("headcount", I)],
           "dc_id week_start_date", foreign={"dc_id": "distribution_centers"}),
]

SPECS: dict[str, TableSpec] = {s.name: s for s in _DECLARED}
