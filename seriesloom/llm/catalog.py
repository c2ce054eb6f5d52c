"""The registered queries of this package and the SQL that states the same result."""

from __future__ import annotations

from .divergence import OP13_SQL, op13_source_divergence
from .exact_dedup import OP7_SQL, op7_exact_dedup
from .fingerprint import op1_fingerprints
from .langid import op11_language_id
from .linededup import OP9_SQL, op9_line_dedup
from .minhash import op5_minhash
from .mixing import OP4_SQL, op4_mixing
from .packing import op6_packing
from .pii import op3_pii
from .repair import op12_conversation_repair
from .sharding import op8_sharding
from .toxicity import op10_toxicity
from .urlgraph import op2_url_filter

_ALL = (
    op1_fingerprints,
    op2_url_filter,
    op3_pii,
    op4_mixing,
    op5_minhash,
    op6_packing,
    op7_exact_dedup,
    op8_sharding,
    op9_line_dedup,
    op10_toxicity,
    op11_language_id,
    op12_conversation_repair,
    op13_source_divergence,
)
QUERIES = {f.__name__: f for f in _ALL}
SQL = {"op4_mixing": OP4_SQL, "op7_exact_dedup": OP7_SQL, "op9_line_dedup": OP9_SQL, "op13_source_divergence": OP13_SQL}
