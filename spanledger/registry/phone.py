"""Phone mart steps."""

from __future__ import annotations

from spanledger.plans import phone as P
from spanledger.registry import sql_inputs  # noqa: F401
from spanledger.registry.base import case
from spanledger.scale import DEFAULT_POLICY, SkewPolicy
from spanledger.sources import fixtures as X


def mart(spark, sf, policy: SkewPolicy = DEFAULT_POLICY) -> P.PhoneMart:
    return P.PhoneMart(
        X.counterparties(spark, sf),
        X.counterparty_types(spark),
        X.contacts(spark, sf),
        X.cross_reference(spark, sf),
        policy,
    )


@case("individual_customers", "SELECT * FROM customers")
def _(spark, sf):
    return mart(spark, sf).customers


@case("resolve_global_id", "SELECT * FROM resolved")
def _(spark, sf):
    return mart(spark, sf).resolved


@case("individual_contacts", "SELECT * FROM person_contacts")
def _(spark, sf):
    return mart(spark, sf).contacts


@case("rank_contacts", "SELECT * FROM ranked_contacts")
def _(spark, sf):
    return mart(spark, sf).ranked()


@case("phone_fragments", "SELECT * FROM flagged_pieces")
def _(spark, sf):
    return mart(spark, sf).phone_fragments()


@case("phone_coalesce", "SELECT * FROM merged_phones")
def _(spark, sf):
    return mart(spark, sf).phones()


@case("client_fragments", "SELECT * FROM flagged_clients")
def _(spark, sf):
    return mart(spark, sf).client_fragments()


@case("phone_mart", "SELECT * FROM mart_phones")
def _(spark, sf):
    return mart(spark, sf).mart()


@case("phone_mart_large", "SELECT * FROM mart_phones")
def _(spark, sf):
    """The same plan with every key of more than 30 rows split."""
    return mart(spark, sf, SkewPolicy(hot_rows=30)).mart()
