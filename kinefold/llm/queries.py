"""The queries of this subpackage and their SQL.

SQL is given for ranked search alone: the other operators are trained, sequential or iterative, approximate, or digest
library results.  Their tests compare them with brute force.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .bpe import op7_bpe_round_trip
from .flac import op10_flac_media
from .langid import op4_language_id
from .lexical import OP11_SQL, op11_ranked_search
from .line_dedup import op3_line_dedup
from .minhash import op6_minhash_near_dedup
from .multi_index import op13_nearest_neighbours
from .neardup_vectors import op1_embedding_near_dedup
from .packing import op2_packing
from .pii import op5_pii
from .records import op8_token_records
from .token_counts import op9_token_counts
from .whitening import op12_embedding_whitening


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [op1_embedding_near_dedup, op2_packing, op3_line_dedup, op4_language_id, op5_pii, op6_minhash_near_dedup, op7_bpe_round_trip, op8_token_records, op9_token_counts, op10_flac_media]
    found += [op11_ranked_search, op12_embedding_whitening, op13_nearest_neighbours]
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {"op11_ranked_search": OP11_SQL}
