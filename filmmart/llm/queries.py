"""Registered queries of the operators, by name, and the oracles that SQL can express."""

from __future__ import annotations

from .hard_negatives import ORACLE as HARD_NEGATIVES_SQL
from .hard_negatives import op11_hard_negatives
from .hpy_lm import op4_hpy_lm
from .html_gbt import op10_html_gbt
from .iblt import op6_iblt
from .langid import op9_langid
from .line_quality import ORACLE as LINE_QUALITY_SQL
from .line_quality import op7_line_quality
from .minmax_dedup import op2_minmax_dedup
from .mixing import op8_mixing
from .packing import op1_packing
from .periodic_runs import op13_periodic_runs
from .simhash_dedup import op12_simhash
from .suffix_dedup import op3_suffix_dedup
from .token_files import op5_token_files

QUERIES = {f.__name__: f for f in (
    op1_packing, op2_minmax_dedup, op3_suffix_dedup, op4_hpy_lm, op5_token_files, op6_iblt, op7_line_quality, op8_mixing,
    op9_langid, op10_html_gbt, op11_hard_negatives, op12_simhash, op13_periodic_runs)}
ORACLES = {"op7_line_quality": LINE_QUALITY_SQL, "op11_hard_negatives": HARD_NEGATIVES_SQL}
