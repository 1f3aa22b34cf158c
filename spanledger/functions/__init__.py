from spanledger.functions.expressions import (  # noqa: F401
    code_score,
    contact_weight,
    date_key,
    entity_hash,
    interval_text,
    iso_day_of_week,
    ntz,
    row_digest,
)
