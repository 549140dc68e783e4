"""The two behaviours of the model set."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Profile:
    """What differs between the behaviours; all code is shared.

    ``arrays``: how lists are flattened. ``result_key``: grain of staged results.
    ``fact_key``: merge key of the fact table. ``empty_loads_all``: whether an
    existing but empty target takes all rows (otherwise it never fills). ``waived``: declared checks
    (table, column, kind) that the grain breaks by design, so that a gated build does not ask for them.
    """

    name: str
    arrays: str
    result_key: tuple[str, ...]
    fact_key: tuple[str, ...]
    empty_loads_all: bool
    waived: frozenset[tuple[str, str, str]] = frozenset()


# Lists overwrite the ids of their record, and one row is kept per result.
COMPAT = Profile("compat", "last_element", ("result_id",), ("measurement_id",), False)

# One row per replicate repeats these ids, and the raw table has a result's replicates too.
_REPEATED = frozenset(
    {
        ("raw_screening_results", "result_id", "unique"),
        ("stg_screening_results", "result_id", "unique"),
        ("stg_screening_results", "measurement_id", "unique"),
        ("fct_screening_results", "measurement_id", "unique"),
        ("mart_experiment_summary", "experiment_id", "unique"),
    }
)

# Lists are kept, and every replicate is a row. One measurement id is shared by
# replicates and by antibodies, hence the four-part key.
_REPLICATE = ("result_id", "measurement_id", "stock_id", "replicate_number")
STRICT = Profile("strict", "keep", _REPLICATE, _REPLICATE, True, _REPEATED)

PROFILES = {p.name: p for p in (COMPAT, STRICT)}
