"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from farebox.llm import divergence, url_filter, vector_codes
from farebox.llm.queries import URL_RULES


def oracle_sql() -> dict[str, str]:
    return {
        "op4_url_filter": url_filter.oracle(URL_RULES),
        "op11_vector_codes": vector_codes.oracle(),
        "op13_source_divergence": divergence.oracle(),
    }
