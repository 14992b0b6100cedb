"""The corpus operators applied to the test tables."""

from __future__ import annotations

from tidewatch.llm.fingerprints import OP4_SQL, op4_fingerprints
from tidewatch.llm.licenses import OP2_SQL, op2_licenses
from tidewatch.llm.mixing import op9_mixing
from tidewatch.llm.neighbours import op7_neighbours
from tidewatch.llm.packing import op10_packing
from tidewatch.llm.pii import op8_pii
from tidewatch.llm.quality import op3_quality
from tidewatch.llm.secrets import op1_secrets
from tidewatch.llm.simhash import op5_simhash
from tidewatch.llm.spelling import op13_spelling
from tidewatch.llm.suffixes import op6_suffixes
from tidewatch.llm.transducer import op12_bpe
from tidewatch.llm.whitening import op11_whitening

QUERIES = {
    f.__name__: f
    for f in (
        op1_secrets, op2_licenses, op3_quality, op4_fingerprints, op5_simhash, op6_suffixes, op7_neighbours,
        op8_pii, op9_mixing, op10_packing, op11_whitening, op12_bpe, op13_spelling,
    )
}
ORACLE: dict[str, str] = {"op2_licenses": OP2_SQL, "op4_fingerprints": OP4_SQL}
