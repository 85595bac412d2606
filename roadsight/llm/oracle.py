"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

from .bit_sliced_topk import OP11_SQL
from .embedding_dedup import OP2_SQL
from .laesa_kmeans import OP13_SQL
from .license_scan import OP4_SQL
from .mixing import OP6_SQL
from .shared_lists import OP12_SQL
from .warc_archive import OP10_SQL


def oracle_sql() -> dict[str, str]:
    return {"op2_embedding_dedup": OP2_SQL, "op4_license_scan": OP4_SQL, "op6_mixing": OP6_SQL,
            "op10_warc": OP10_SQL, "op11_bit_sliced_topk": OP11_SQL, "op12_shared_lists": OP12_SQL, "op13_laesa_kmeans": OP13_SQL}
