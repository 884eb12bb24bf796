from lakeward.functions.expressions import (  # noqa: F401
    REFERENCE_VOCAB,
    Vocabulary,
    array_text,
    as_timestamp,
    epoch_micros,
    epoch_seconds,
    is_true,
    minutes,
    number_in,
    pseudonym,
    round6,
)
