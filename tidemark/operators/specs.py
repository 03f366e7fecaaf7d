"""What each kind of record looks like: columns, required fields, children, inventory.

A spec holds functions from a node reader to column expressions, so users can
add their own record kinds the same way.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.contacts import additional_values, contact_array, primary_value
from tidemark.functions.jsontext import edge_nodes_json, json_or_empty_list
from tidemark.functions.money import beyond_cents, node_cents_rounded, node_cents_truncated, not_a_number
from tidemark.functions.timestamps import iso_normalized, iso_passthrough
from tidemark.functions.values import Node

Columns = Callable[[Node], Mapping[str, Column]]


@dataclass(frozen=True)
class EntitySpec:
    """One record kind.

    columns: output columns of an accepted node.
    problems: reason -> condition under which a node is refused, in order.
    relations: inventory relation -> connection path in the node.
    updated_path: where the node says when it changed; None when it does not.
    sparse_relations: leave a relation out of the inventory when the node lacks it.
    """

    name: str
    root: str
    columns: Columns
    problems: Columns
    relations: Mapping[str, str] = field(default_factory=dict)
    updated_path: str | None = "updatedAt"
    sparse_relations: bool = False


NOTE_RELATIONS = {"notes": "notes", "attachments": "noteAttachments"}


def _iso(node: Node, path: str) -> Column:
    return iso_normalized(node.string(path))


def _as_is(node: Node, path: str) -> Column:
    return iso_passthrough(node.string(path))


def _id(node: Node) -> Column:
    return node.string("id")


def _blank() -> Column:
    return F.lit("")


def _no_id(node: Node) -> dict[str, Column]:
    return {"missing id": ~node.truthy("id")}


def _no_relation(*paths: str) -> Columns:
    def problems(node: Node) -> dict[str, Column]:
        found = _no_id(node)
        for path in paths:
            found[f"missing {path} id"] = node.lacks(f"{path}.id")
        return found

    return problems


def _no_client_value(node: Node) -> dict[str, Column]:
    """Invoices and quotes refuse a null client id too."""
    return {**_no_id(node), "missing client id": node.text_or_blank("client.id") == ""}


def _in_cents(problems: Columns, *paths: str) -> Columns:
    """The problems of a kind, and amounts that its cents cannot hold."""

    def found(node: Node) -> dict[str, Column]:
        beyond = reduce(lambda a, b: a | b, [beyond_cents(node, path) for path in paths])
        return {**problems(node), "amount out of range": beyond}

    return found


def _client(node: Node) -> dict[str, Column]:
    emails = contact_array(node, "emails", "address")
    phones = contact_array(node, "phones", "number")
    return {
        "id": _id(node),
        "first_name": node.text("firstName"),
        "last_name": node.text("lastName"),
        "email": primary_value(emails, "address"),
        "phone": primary_value(phones, "number"),
        "created_at": _iso(node, "createdAt"),
        "additional_emails": json_or_empty_list(additional_values(emails, "address")),
        "additional_phones": json_or_empty_list(additional_values(phones, "number")),
        "company_name": node.text_or_blank("companyName"),
        "balance_cents": node_cents_truncated(node, "balance"),
        "is_archivable": node.flag01("isArchivable"),
        "is_company": node.flag01("isCompany"),
        "billing_street": node.text_or_blank("billingAddress.street"),
        "billing_city": node.text_or_blank("billingAddress.city"),
        "billing_province": node.text_or_blank("billingAddress.province"),
        "billing_postal_code": node.text_or_blank("billingAddress.postalCode"),
        "billing_country": node.text_or_blank("billingAddress.country"),
    }


INVOICE_AMOUNTS = {
    "total_cents": "amounts.total",
    "subtotal": "amounts.subtotal",
    "tax_cents": "amounts.taxAmount",
    "discount_cents": "amounts.discountAmount",
    "deposit_cents": "amounts.depositAmount",
}


def _invoice(node: Node) -> dict[str, Column]:
    net = node.typed("invoiceNet", "bigint")
    cents = {name: node_cents_truncated(node, path) for name, path in INVOICE_AMOUNTS.items()}
    return {
        "id": _id(node),
        "client_id": node.text("client.id"),
        "number": node.text("invoiceNumber"),
        "total_cents": cents["total_cents"],
        "status": node.text("invoiceStatus"),
        "issued_at": _as_is(node, "issuedDate"),
        "due_date": _iso(node, "dueDate"),
        "subtotal": cents["subtotal"],
        "line_items": edge_nodes_json(node, "lineItems"),
        "subject": node.text_or_blank("subject"),
        "message": node.text_or_blank("message"),
        "tax_cents": cents["tax_cents"],
        "discount_cents": cents["discount_cents"],
        "deposit_cents": cents["deposit_cents"],
        "invoice_net": F.coalesce(net, F.lit(0).cast("bigint")),
    }


QUOTE_AMOUNTS = {
    "total": "amounts.total",
    "subtotal": "amounts.subtotal",
    "tax_cents": "amounts.taxAmount",
    "discount_cents": "amounts.discountAmount",
}


def _quote(node: Node) -> dict[str, Column]:
    on_property = node.is_object("property")
    return {
        "id": _id(node),
        "client_id": node.text("client.id"),
        "property_id": F.when(on_property, node.text("property.id")).otherwise(""),
        "quote_number": node.text("quoteNumber"),
        "title": node.text("title"),
        **{name: node_cents_rounded(node, path) for name, path in QUOTE_AMOUNTS.items()},
        "disclaimer": node.text("message"),
        "line_items": edge_nodes_json(node, "lineItems"),
        "created_at": _as_is(node, "createdAt"),
        "transitioned_at": _as_is(node, "transitionedAt"),
        "updated_at": _as_is(node, "updatedAt"),
        "quote_status": node.text_or_blank("quoteStatus"),
        "sent_at": _as_is(node, "sentAt"),
    }


def _quote_problems(node: Node) -> dict[str, Column]:
    bad = F.lit(False)
    for path in QUOTE_AMOUNTS.values():
        bad = bad | not_a_number(node, path)
    return {**_no_client_value(node), "amount is not a number": bad}


def _job(node: Node) -> dict[str, Column]:
    return {
        "id": _id(node),
        "client_id": node.relation_id("client"),
        "property_id": node.relation_id("property"),
        "quote_id": node.relation_id("quote"),
        "job_number": node.text("jobNumber"),
        "title": node.text("title"),
        "description": node.text("instructions"),
        "status": node.text("jobStatus"),
        "scheduled_start_at": _iso(node, "startAt"),
        "scheduled_end_at": _iso(node, "endAt"),
        "completed_at": _iso(node, "completedAt"),
        "total": node_cents_truncated(node, "total"),
        "created_at": _iso(node, "createdAt"),
        "updated_at": _iso(node, "updatedAt"),
        "job_type": node.text_or_blank("jobType"),
        "billing_type": node.text_or_blank("billingType"),
        "invoiced_total": node_cents_truncated(node, "invoicedTotal"),
    }


def _property(node: Node) -> dict[str, Column]:
    def address(key: str) -> Column:
        return node.text_or_blank(f"address.{key}")

    def number_text(path: str) -> Column:
        return F.when(node.kind(path) == "VOID", F.lit("")).otherwise(node.stringified(path, ""))

    return {
        "id": _id(node),
        "client_id": node.relation_id("client"),
        "name": node.text("name"),
        "address_line1": address("street1"),
        "address_line2": address("street2"),
        "city": address("city"),
        "state_province": address("province"),
        "postal_code": address("postalCode"),
        "country": address("country"),
        "latitude": number_text("address.coordinates.latitude"),
        "longitude": number_text("address.coordinates.longitude"),
        "created_at": _iso(node, "createdAt"),
        "updated_at": _iso(node, "updatedAt"),
        "tax_rate_id": node.text_or_blank("taxRate.id"),
        "tax_rate_name": node.text_or_blank("taxRate.name"),
        "tax_rate": number_text("taxRate.rate"),
        "is_billing_address": node.flag01("isBillingAddress"),
        "routing_order": node.strict_integer("routingOrder"),
    }


def _request(node: Node) -> dict[str, Column]:
    return {
        "id": _id(node),
        "client_id": node.relation_id("client"),
        "property_id": node.relation_id("property"),
        "title": node.text("title"),
        "description": _blank(),
        "status": node.text("requestStatus"),
        "priority": _blank(),
        "source": node.text("source"),
        "assigned_to": _blank(),
        "converted_to_quote_id": _blank(),
        "converted_to_job_id": _blank(),
        "company_name": node.text("companyName"),
        "contact_name": node.text("contactName"),
        "email": node.text("email"),
        "phone": node.text("phone"),
        "created_at": _iso(node, "createdAt"),
        "updated_at": _iso(node, "updatedAt"),
    }


def _user(node: Node) -> dict[str, Column]:
    role = (
        F.when(node.truthy("isAccountOwner"), F.lit("owner"))
        .when(node.truthy("isAccountAdmin"), F.lit("admin"))
        .otherwise(F.lit("employee"))
    )
    return {
        "id": _id(node),
        "first_name": node.text_or_blank("name.first"),
        "last_name": node.text_or_blank("name.last"),
        "email": node.text_or_blank("email.raw"),
        "role": role,
        "is_account_admin": node.flag_text("isAccountAdmin", False),
        "is_account_owner": node.flag_text("isAccountOwner", False),
        "status": node.text("status"),
        "phone": node.text_or_blank("phone.raw"),
        "timezone": node.text("timezone"),
        "created_at": _iso(node, "createdAt"),
        "last_login_at": _iso(node, "lastLoginAt"),
        "available_for_scheduling": node.flag01("availableForScheduling"),
        "assigned_color": node.text_or_blank("assignedColor"),
    }


def _expense(node: Node) -> dict[str, Column]:
    return {
        "id": _id(node),
        "job_id": node.relation_id("linkedJob"),
        "amount_cents": node_cents_truncated(node, "total"),
        "description": node.text("description"),
        "category": F.lit("general"),
        "receipt_url": _blank(),
        "vendor": node.text("title"),
        "expense_date": _iso(node, "date"),
        "entered_by_id": node.relation_id("enteredBy"),
        "paid_by_id": node.relation_id("paidBy"),
        "reimbursable_to_id": node.relation_id("reimbursableTo"),
        "created_at": _iso(node, "createdAt"),
        "updated_at": _iso(node, "updatedAt"),
    }


def _visit(node: Node) -> dict[str, Column]:
    return {
        "id": _id(node),
        "job_id": node.relation_id("job"),
        "client_id": node.relation_id("client"),
        "property_id": node.relation_id("property"),
        "assigned_user_id": node.text("assignedUsers.edges[0].node.id"),
        "title": node.text("title"),
        "instructions": node.text("instructions"),
        "status": node.text("visitStatus"),
        "all_day": node.flag01("allDay"),
        "duration_minutes": node.whole_number("duration"),
        "start_at": _iso(node, "startAt"),
        "end_at": _iso(node, "endAt"),
        "completed_at": _iso(node, "completedAt"),
        "created_at": _iso(node, "createdAt"),
        "updated_at": F.lit(None).cast("string"),
        "client_confirmed": node.flag01("clientConfirmed"),
        "completed_by_id": F.coalesce(node.words("completedBy"), F.lit("")),
    }


def _timesheet_entry(node: Node) -> dict[str, Column]:
    return {
        "id": _id(node),
        "user_id": node.relation_id("user"),
        "job_id": node.relation_id("job"),
        "visit_id": node.relation_id("visit"),
        "approved_by_id": node.relation_id("approvedBy"),
        "paid_by_id": node.relation_id("paidBy"),
        "label": node.text("label"),
        "note": node.text("note"),
        "labour_rate": node.stringified("labourRate", "0.00"),
        "final_duration_seconds": node.whole_number("finalDuration"),
        "visit_duration_total_seconds": node.whole_number("visitDurationTotal"),
        "approved": node.flag_text("approved", False),
        "ticking": node.flag_text("ticking", False),
        "start_at": _iso(node, "startAt"),
        "end_at": _iso(node, "endAt"),
        "created_at": _iso(node, "createdAt"),
        "updated_at": _iso(node, "updatedAt"),
    }


def _product_service(node: Node) -> dict[str, Column]:
    visible = node.flag_text("visible", True)
    category = F.when(node.is_object("category"), node.text("category.name")).otherwise(
        node.text("category")
    )
    return {
        "id": _id(node),
        "name": node.text("name"),
        "description": node.text("description"),
        "category": category,
        "default_unit_cost_cents": node_cents_truncated(node, "defaultUnitCost"),
        "internal_unit_cost_cents": node_cents_truncated(node, "internalUnitCost"),
        "markup_percentage": node.stringified("markup", "0"),
        "duration_minutes": node.whole_number("durationMinutes"),
        "taxable": node.flag_text("taxable", False),
        "visible": visible,
        "online_booking_enabled": node.flag_text("onlineBookingsEnabled", False),
        "online_booking_sort_order": node.whole_number("onlineBookingSortOrder"),
        "active": visible,
        "created_at": _blank(),
        "updated_at": _blank(),
    }


def _tax_rate(node: Node) -> dict[str, Column]:
    return {"id": _id(node), "name": node.text("name")}


_WITH_NOTES = {"relations": NOTE_RELATIONS}

SPECS: dict[str, EntitySpec] = {
    spec.name: spec
    for spec in (
        EntitySpec("client", "clients", _client, _in_cents(_no_id, "balance"), **_WITH_NOTES),
        EntitySpec("invoice", "invoices", _invoice, _in_cents(_no_client_value, *INVOICE_AMOUNTS.values()), **_WITH_NOTES),
        EntitySpec(
            "quote",
            "quotes",
            _quote,
            _in_cents(_quote_problems, *QUOTE_AMOUNTS.values()),
            relations={"line_items": "lineItems", **NOTE_RELATIONS},
        ),
        EntitySpec("job", "jobs", _job, _in_cents(_no_relation("client"), "total", "invoicedTotal"), **_WITH_NOTES),
        EntitySpec("property", "properties", _property, _no_relation("client")),
        EntitySpec("request", "requests", _request, _no_relation("client"), **_WITH_NOTES),
        EntitySpec("user", "users", _user, _no_id, updated_path="lastLoginAt"),
        EntitySpec(
            "expense",
            "expenses",
            _expense,
            _in_cents(_no_relation("linkedJob"), "total"),
            relations=NOTE_RELATIONS,
            sparse_relations=True,
        ),
        EntitySpec(
            "visit",
            "visits",
            _visit,
            _no_relation("job", "client"),
            relations=NOTE_RELATIONS,
            updated_path="createdAt",
            sparse_relations=True,
        ),
        EntitySpec(
            "timesheet_entry", "timeSheetEntries", _timesheet_entry, _no_relation("user")
        ),
        EntitySpec(
            "product_service",
            "productsAndServices",
            _product_service,
            _in_cents(_no_id, "defaultUnitCost", "internalUnitCost"),
            updated_path=None,
        ),
        EntitySpec("tax_rate", "taxRates", _tax_rate, _no_id, updated_path=None),
    )
}

# Load order that puts every parent before its children.
LOAD_ORDER = [
    "users",
    "clients",
    "properties",
    "requests",
    "quotes",
    "jobs",
    "visits",
    "invoices",
    "expenses",
    "timesheet_entries",
    "product_services",
    "tax_rates",
    "notes",
]
