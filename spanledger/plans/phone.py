"""Phone mart: who holds which phone when, best customer per phone, best phone per customer."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanledger import constants as C
from spanledger.functions import code_score, contact_weight, row_digest
from spanledger.operators.intervals import (
    coalesce_intervals_global,
    fill_segments,
    merge_flagged,
    segment_stats,
    temporal_join,
)
from spanledger.operators.ranking import row_number_by
from spanledger.scale import DEFAULT_POLICY, SkewPolicy
from spanledger.session import JOINS_IN_PLACE, materialize, settings

START, END = "business_start_dt", "business_end_dt"
SCORES = ["range_trust_num", "range_quality_num", "range_src_num", "range_type_num"]
RANKS = ["rang_start_phone_num", "rang_start_client_num"]
FLAGS = ["notification_flg", "atm_flg", "trust_system_flg"]
FRAGMENT_KEYS = [
    "mdm_customer_rk",
    "phone_type_cd",
    "phone_num",
    *FLAGS,
    *RANKS,
    *SCORES,
    "duplication_flg",
    "range_duplication_num",
    "weght_phone_num",
    "main_dup_flg",
]
PUBLISHED_KEYS = [
    "mdm_customer_rk",
    "phone_type_cd",
    "phone_num",
    *FLAGS,
    "duplication_flg",
    "main_dup_flg",
    "main_phone_flg",
]


def individual_customers(counterparty: DataFrame, types: DataFrame) -> DataFrame:
    """Master-source customers typed as individuals, for the time both the customer and the type are valid."""
    persons = types.filter(F.col("src_cd").isin(C.CONTACT_SOURCES) & (F.col("counterparty_type_desc") == C.INDIVIDUAL))
    customers = counterparty.filter(F.col("src_cd") == C.MASTER_SOURCE)
    return temporal_join(customers, persons, {"counterparty_type_cd": "counterparty_type_cd"}).select(
        "counterparty_rk", "effective_from_date", "effective_to_date", "counterparty_type_cd"
    )


def resolve_global_id(contact: DataFrame, cross_reference: DataFrame) -> DataFrame:
    """Contacts with the global customer id: by cross-reference, or the local id for master-source contacts."""
    links = cross_reference.filter(F.col("src_cd").isin(C.CONTACT_SOURCES)).drop("src_cd")
    columns = [
        "counterparty_rk",
        "contact_type_cd",
        "effective_from_date",
        "effective_to_date",
        "contact_desc",
        "contact_quality_code",
        "trust_system_flg",
        "uniq_counterparty_rk",
        "src_cd",
    ]
    linked = temporal_join(
        contact.filter(F.col("src_cd") != C.MASTER_SOURCE),
        links,
        {"counterparty_rk": "counterparty_rk"},
        keep_right=["uniq_counterparty_rk"],
    )
    own = contact.filter(F.col("src_cd") == C.MASTER_SOURCE).withColumn(
        "uniq_counterparty_rk", F.col("counterparty_rk")
    )
    return linked.select(columns).union(own.select(columns)).distinct()


def individual_contacts(resolved: DataFrame, customers: DataFrame) -> DataFrame:
    persons = customers.withColumnsRenamed({"counterparty_rk": "person_rk"}).drop("counterparty_type_cd")
    return temporal_join(resolved, persons, {"uniq_counterparty_rk": "person_rk"})


def rank_contacts(contacts: DataFrame, policy: SkewPolicy = DEFAULT_POLICY) -> DataFrame:
    """Whitelist sources, then number the versions of each phone and of each local client by start date and score
    every criterion. Ties in the start date are broken by a digest of the row."""
    listed = contacts.filter(F.col("src_cd").isin(C.CONTACT_SOURCES))
    listed = listed.withColumn("_tie", row_digest(contacts.columns))
    start = "effective_from_date"
    ranked = row_number_by(listed, ["contact_desc"], start, "rang_start_phone_num", "_tie", policy)
    ranked = row_number_by(ranked, ["counterparty_rk"], start, "rang_start_client_num", "_tie", policy, counted=listed)
    kind = F.col("contact_type_cd")
    return ranked.select(
        F.col("uniq_counterparty_rk").alias("mdm_customer_rk"),
        kind.alias("phone_type_cd"),
        F.col("effective_from_date").alias(START),
        F.col("effective_to_date").alias(END),
        F.col("contact_desc").alias("phone_num"),
        "trust_system_flg",
        F.coalesce(kind == "NotificPhone", F.lit(False)).alias("notification_flg"),
        F.coalesce(kind == "ATMPhone", F.lit(False)).alias("atm_flg"),
        *RANKS,
        F.when(F.col("trust_system_flg"), 1).otherwise(0).alias("range_trust_num"),
        F.when(F.col("contact_quality_code").like("%GOOD%"), 1).otherwise(0).alias("range_quality_num"),
        code_score(F.col("src_cd"), C.SOURCE_SCORE).alias("range_src_num"),
        code_score(kind, C.TYPE_SCORE).alias("range_type_num"),
    )


def _weight(no_duplicate, rank: str):
    trust, quality, source, kind = (F.col(c) for c in SCORES)
    return contact_weight(no_duplicate, trust, quality, source, kind, F.col(rank))


def phone_segments(ranked: DataFrame, policy: SkewPolicy = DEFAULT_POLICY) -> DataFrame:
    """Elementary segments of each phone with what all its rows decide together: is it shared, what is the best
    weight. A shared segment costs all its rows the same digit, so the best row is found without it."""
    owned = ranked.filter(F.col("mdm_customer_rk").isNotNull())
    narrow = owned.select(
        "phone_num", START, END, "mdm_customer_rk", _weight(F.lit(0), "rang_start_phone_num").alias("_weight")
    )
    return segment_stats(
        narrow,
        ["phone_num"],
        START,
        END,
        [
            (F.min("mdm_customer_rk") != F.max("mdm_customer_rk")).alias("_shared"),
            F.max("_weight").alias("_best"),
        ],
        policy,
    )


def phone_fragments(ranked: DataFrame, segs: DataFrame, policy: SkewPolicy = DEFAULT_POLICY) -> DataFrame:
    owned = ranked.filter(F.col("mdm_customer_rk").isNotNull())
    filled = fill_segments(owned, segs, ["phone_num"], START, END, policy)
    free = F.when(F.col("_shared"), 0).otherwise(1)
    base = _weight(F.lit(0), "rang_start_phone_num")
    return filled.select(
        "mdm_customer_rk",
        "phone_type_cd",
        START,
        END,
        "phone_num",
        *FLAGS,
        *RANKS,
        *SCORES,
        F.col("_shared").alias("duplication_flg"),
        free.alias("range_duplication_num"),
        _weight(free, "rang_start_phone_num").alias("weght_phone_num"),
        F.coalesce(base == F.col("_best"), F.lit(False)).alias("main_dup_flg"),
    )


def phone_coalesce(ranked: DataFrame, keep=None, policy: SkewPolicy = DEFAULT_POLICY) -> DataFrame:
    """Fragments merged over all their columns, islands taken over the whole table.

    The rank tells the versions of a phone apart, and one version lies in one island, so this merges the fragments of
    each version with equal flags; no fragment has to be listed for it.
    """
    owned = ranked.filter(F.col("mdm_customer_rk").isNotNull())
    weighed = owned.withColumn("_weight", _weight(F.lit(0), "rang_start_phone_num"))
    merged = merge_flagged(weighed, "phone_num", START, END, "_weight", "mdm_customer_rk", keep, policy)
    free = F.when(F.col("_shared"), 0).otherwise(1)
    return merged.withColumns(
        {
            "duplication_flg": F.col("_shared"),
            "range_duplication_num": free,
            "weght_phone_num": _weight(free, "rang_start_phone_num"),
            "main_dup_flg": F.col("_main"),
        }
    ).select(*FRAGMENT_KEYS, START, END)


def client_segments(phones: DataFrame, policy: SkewPolicy = DEFAULT_POLICY) -> DataFrame:
    narrow = phones.select(
        "mdm_customer_rk",
        START,
        END,
        _weight(F.col("range_duplication_num"), "rang_start_client_num").alias("_weight"),
    )
    return segment_stats(narrow, ["mdm_customer_rk"], START, END, [F.max("_weight").alias("_best")], policy)


def client_fragments(phones: DataFrame, segs: DataFrame, policy: SkewPolicy = DEFAULT_POLICY) -> DataFrame:
    filled = fill_segments(phones, segs, ["mdm_customer_rk"], START, END, policy)
    weight = _weight(F.col("range_duplication_num"), "rang_start_client_num")
    return (
        filled.withColumn("weght_client_num", weight)
        .withColumn("main_phone_flg", F.coalesce(F.col("weght_client_num") == F.col("_best"), F.lit(False)))
        .drop("_best")
    )


def publish(phones: DataFrame, keep, policy: SkewPolicy = DEFAULT_POLICY) -> DataFrame:
    """Best phone per customer, coalesced over the published columns. Islands are disjoint in time, so the result is
    distinct as it is. ``keep`` stores the segment table, which also gives the islands."""
    stored: list[DataFrame] = []

    def keep_segments(segs: DataFrame) -> DataFrame:
        stored.append(keep(segs))
        return stored[0]

    weighed = phones.withColumn("_weight", _weight(F.col("range_duplication_num"), "rang_start_client_num"))
    merged = merge_flagged(weighed, "mdm_customer_rk", START, END, "_weight", None, keep_segments, policy)
    return _published(merged.withColumn("main_phone_flg", F.col("_main")), _spans(stored[0], "_from", "_to"))


def _spans(segs: DataFrame, first: str, last: str) -> DataFrame:
    return segs.select(F.col(first).alias(START), F.col(last).alias(END))


def _published(pieces: DataFrame, spans: DataFrame) -> DataFrame:
    return coalesce_intervals_global(pieces, PUBLISHED_KEYS, START, END, spans).select(
        "mdm_customer_rk",
        "phone_type_cd",
        START,
        END,
        "phone_num",
        *FLAGS,
        "duplication_flg",
        "main_dup_flg",
        "main_phone_flg",
    )


class PhoneMart:
    """The steps of the mart. Those read more than once are written to the shared folder on first use."""

    def __init__(
        self,
        counterparty: DataFrame,
        types: DataFrame,
        contact: DataFrame,
        cross_reference: DataFrame,
        policy: SkewPolicy = DEFAULT_POLICY,
    ):
        self.policy = policy
        self._tables = counterparty, types, contact, cross_reference
        self._kept: dict[str, DataFrame] = {}

    @cached_property
    def customers(self) -> DataFrame:
        return individual_customers(*self._tables[:2])

    @cached_property
    def resolved(self) -> DataFrame:
        return resolve_global_id(*self._tables[2:])

    @cached_property
    def contacts(self) -> DataFrame:
        return individual_contacts(self.resolved, self.customers)

    def _keep(self, name: str, build) -> DataFrame:
        if name not in self._kept:
            self._kept[name] = materialize(build(), name)
        return self._kept[name]

    def _keep_segments(self, name: str, segs: DataFrame) -> DataFrame:
        """The lookups of a segment table go by its key, by which both their sides are dealt already."""
        with settings(segs.sparkSession, **JOINS_IN_PLACE):
            return self._keep(name, lambda: segs)

    def ranked(self) -> DataFrame:
        def listed() -> DataFrame:
            resolved = self._keep("resolved", lambda: self.resolved)
            return individual_contacts(resolved, self.customers).filter(F.col("src_cd").isin(C.CONTACT_SOURCES))

        return self._keep("ranked", lambda: rank_contacts(self._keep("contacts", listed), self.policy))

    def phone_segments(self) -> DataFrame:
        return self._keep("phone_segments", lambda: phone_segments(self.ranked(), self.policy))

    def phone_fragments(self) -> DataFrame:
        return phone_fragments(self.ranked(), self.phone_segments(), self.policy)

    def phones(self) -> DataFrame:
        def build():
            return phone_coalesce(self.ranked(), lambda segs: self._keep_segments("phone_flags", segs), self.policy)

        return self._keep("phones", build)

    def client_segments(self) -> DataFrame:
        return self._keep("client_segments", lambda: client_segments(self.phones(), self.policy))

    def client_fragments(self) -> DataFrame:
        return client_fragments(self.phones(), self.client_segments(), self.policy)

    def mart(self) -> DataFrame:
        return publish(self.phones(), lambda segs: self._keep_segments("client_flags", segs), self.policy)
