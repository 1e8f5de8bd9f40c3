"""Budget lines."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tributary.plans.shape import accounting, kept, ruled, shaped
from tributary.sources.catalog import EXTRACT_COLUMNS

_COLUMNS = EXTRACT_COLUMNS["visao_orcamentaria_total"]


def visao_orcamentaria_total(raw: DataFrame) -> DataFrame:
    """Typed budget lines: 20 descriptive columns, 10 amounts."""
    return shaped(raw, [
        *kept("ano_exercicio " + " ".join(_COLUMNS[:20])),
        *ruled(accounting, " ".join(_COLUMNS[20:])),
        *ruled(lambda c: c.try_cast("timestamp"), "dt_ingest"),
    ])
