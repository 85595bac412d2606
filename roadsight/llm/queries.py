"""The registered queries of this subpackage: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .bit_sliced_topk import op11_bit_sliced_topk
from .embedding_dedup import op2_embedding_dedup
from .fingerprints import op1_fingerprints
from .laesa_kmeans import op13_laesa_kmeans
from .license_scan import op4_license_scan
from .mixing import op6_mixing
from .sanitise import op5_pii
from .sentencepiece_codec import op3_sentencepiece
from .shared_lists import op12_shared_lists
from .simhash_dedup import op9_simhash_dedup
from .toxicity import op7_toxicity
from .url_filter import op8_url_filter
from .warc_archive import op10_warc

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    return {q.__name__: q for q in (
        op1_fingerprints, op2_embedding_dedup, op3_sentencepiece, op4_license_scan, op5_pii, op6_mixing, op7_toxicity, op8_url_filter, op9_simhash_dedup,
        op10_warc, op11_bit_sliced_topk, op12_shared_lists, op13_laesa_kmeans,
    )}
