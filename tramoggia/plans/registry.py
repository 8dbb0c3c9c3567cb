"""All queries of the library, by name."""

from __future__ import annotations

from tramoggia.plans import normalize, reference
from tramoggia.plans.reference_sql import SQL as _REFERENCE_SQL

QUERIES = {**reference.QUERIES, **normalize.QUERIES}
SQL = {**_REFERENCE_SQL, **normalize.SQL}
flagship = reference.flagship
