"""Queries of this subpackage and their oracle SQL."""

from __future__ import annotations

from recordscope.llm import oracles
from recordscope.llm.embeddings import op10_near_vectors
from recordscope.llm.language import op5_language_id
from recordscope.llm.licenses import op13_license_scan
from recordscope.llm.minhash import op1_minhash_dedup
from recordscope.llm.mixing import op3_source_mix
from recordscope.llm.negatives import op11_hard_negatives
from recordscope.llm.packing import op8_curve_packing
from recordscope.llm.phrases import op12_collocations
from recordscope.llm.pii import op7_personal_data
from recordscope.llm.quality import op4_quality_rules
from recordscope.llm.secrets import op9_secret_scan
from recordscope.llm.toxicity import op6_toxicity
from recordscope.llm.warc import op2_fixity_audit
from recordscope.sources.io import owned

QUERIES = {
    f.__name__: owned(f)
    for f in (
        op1_minhash_dedup,
        op2_fixity_audit,
        op3_source_mix,
        op4_quality_rules,
        op5_language_id,
        op6_toxicity,
        op7_personal_data,
        op8_curve_packing,
        op9_secret_scan,
        op10_near_vectors,
        op11_hard_negatives,
        op12_collocations,
        op13_license_scan,
    )
}
ORACLES = {
    "op1_minhash_dedup": oracles.OP1,
    "op2_fixity_audit": oracles.OP2,
    "op3_source_mix": oracles.OP3,
    "op10_near_vectors": oracles.OP10,
    "op11_hard_negatives": oracles.OP11,
    "op12_collocations": oracles.OP12,
    "op13_license_scan": oracles.OP13,
}
