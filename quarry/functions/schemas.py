"""The columns of every table, in order, and the typed shape of nested items."""

from __future__ import annotations

HEADER = "status created due_date sent_date expired_date expired rfq_number priority private_notes authenticated_pdf_quote_url contact_name contact_email customer_name estimator_email salesperson_email".split()
COLUMNS: dict[str, list[str]] = {
    "quotes": ["quote_number", "revision_number", *HEADER],
    "quotes_revised": ["quote_id", "quote_number", "revision_number", *HEADER],
    "quote_items": "quote_number quote_revision item_id workflow_status part_number revision description type material process is_fully_configured part_uuid export_controlled quantity unit_price total_price total_price_with_add_ons lead_time".split(),
    "orders": "order_number quote_number quote_revision_number status created deliver_by ships_on payment_terms purchase_order_number salesperson_email customer_name".split(),
    "order_items": "order_number item_id part_number part_uuid revision description quantity unit_price total_price material process export_controlled filename lead_days quote_item_id".split(),
    "contacts": "id first_name last_name email phone phone_ext notes account_id".split(),
    "accounts": "name id phone erp_code type url".split(),
    "quotes_live": "quote_number revision_number status created due_date rfq_number priority private_notes contact_name contact_email customer_name estimator_email salesperson_email".split(),
    "orders_live": "order_number status created due_date quote_number quote_revision customer_name contact_name contact_email salesperson_email".split(),
}
KEYS = {"quotes": ["quote_number", "revision_number"], "orders": ["order_number"], "quotes_live": ["quote_number", "revision_number"], "orders_live": ["order_number"], "quote_items": ["quote_number", "quote_revision", "item_id", "quantity"]}

#: Numbers and flags that may come as strings are read as strings.
PRICE = "decimal(18,4)"
COMPONENT = "is_root_component string, part_number string, part_uuid string, description string, revision string, type string, material struct<name string>, process struct<name string>"
QUANTITY = f"quantity string, unit_price {PRICE}, total_price {PRICE}, total_price_with_required_add_ons {PRICE}, lead_time string"
QUOTE_ITEMS = f"array<struct<id string, workflow_status string, export_controlled boolean, components array<struct<{COMPONENT}, quantities array<struct<{QUANTITY}>>>>>>"
QUOTE_HEAD = (
    "struct<number string, revision_number string, status string, created string, due_date string, sent_date string, expired_date string, expired boolean, rfq_number string, priority string, private_notes string, authenticated_pdf_quote_url string, "
    "contact struct<first_name string, last_name string, email string, account struct<name string>>, estimator struct<email string>, salesperson struct<email string>>"
)
ORDER_ITEMS = f"array<struct<id string, description string, quantity string, unit_price {PRICE}, total_price {PRICE}, export_controlled boolean, filename string, lead_days string, quote_item_id string, components array<struct<{COMPONENT}>>>>"

RELATIONSHIP = (
    "ID bigint, ModelID int, Name string, IsActive boolean, Type int, CrossFilteringBehavior int, JoinOnDateBehavior int, RelyOnReferentialIntegrity boolean, FromTableID bigint, FromColumnID bigint, FromCardinality int, "
    "ToTableID bigint, ToColumnID bigint, ToCardinality int, State int, RelationshipStorageID bigint, RelationshipStorage2ID bigint, ModifiedTime string, RefreshedTime string, SecurityFilteringBehavior int"
)
