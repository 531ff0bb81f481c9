"""The queries of the training-data operators: name -> callable(spark, sf_dir). Only op13 has an oracle in
SQL: the others are tested against a brute-force version in tests/llm."""

from __future__ import annotations

from .decontaminate import op2_decontaminate
from .hard_negatives import ORACLE as HARD_NEGATIVES
from .hard_negatives import op13_hard_negatives
from .html_extract import op6_html_extract
from .language_id import op8_language_id
from .ngram_join import op9_ngram_join
from .order_minhash import op5_order_minhash
from .pii import op10_pii
from .quality_classifier import op4_quality_classifier
from .secret_scan import op7_secret_scan
from .sentencepiece_codec import op3_sentencepiece_codec
from .suffix_dedup import op1_suffix_dedup
from .token_alignment import op12_token_alignment
from .token_files import op11_token_files

QUERIES = {f.__name__: f for f in (op1_suffix_dedup, op2_decontaminate, op3_sentencepiece_codec, op4_quality_classifier, op5_order_minhash, op6_html_extract, op7_secret_scan, op8_language_id, op9_ngram_join, op10_pii, op11_token_files, op12_token_alignment, op13_hard_negatives)}
ORACLES = {"op13_hard_negatives": HARD_NEGATIVES}
