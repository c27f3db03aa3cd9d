"""The queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from lakeshore.llm.bpe_stream import op12_bpe_stream
from lakeshore.llm.decontamination import op3_decontamination
from lakeshore.llm.exact_dedup import OP2_SQL, op2_exact_dedup
from lakeshore.llm.license_scan import op5_license_scan
from lakeshore.llm.merkle import OP13_SQL, op13_merkle_manifest
from lakeshore.llm.mixing import OP4_SQL, op4_mix_sources
from lakeshore.llm.near_dedup import op10_minhash_near_dedup
from lakeshore.llm.quality import op1_quality_classifier
from lakeshore.llm.substring_dedup import op9_substring_dedup
from lakeshore.llm.token_counts import op8_token_counts
from lakeshore.llm.token_files import op7_token_files
from lakeshore.llm.vector_codes import OP11_SQL, op11_vector_codes
from lakeshore.llm.warc import op6_warc_derivatives

QUERIES = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_decontamination": op3_decontamination,
    "op4_mix_sources": op4_mix_sources,
    "op5_license_scan": op5_license_scan,
    "op6_warc_derivatives": op6_warc_derivatives,
    "op7_token_files": op7_token_files,
    "op8_token_counts": op8_token_counts,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_minhash_near_dedup": op10_minhash_near_dedup,
    "op11_vector_codes": op11_vector_codes,
    "op12_bpe_stream": op12_bpe_stream,
    "op13_merkle_manifest": op13_merkle_manifest,
}

ORACLE_SQL = {
    "op2_exact_dedup": OP2_SQL,
    "op4_mix_sources": OP4_SQL,
    "op11_vector_codes": OP11_SQL,
    "op13_merkle_manifest": OP13_SQL,
}
