"""All queries of this subpackage."""

from voxlens.llm import q_ann, q_bpe, q_chat, q_collocations, q_exact, q_filter_audit, q_jaccard, q_license, q_lines, q_packing, q_quality, q_toxicity, q_warc  # noqa: F401
from voxlens.llm.registry import ORACLE, QUERIES  # noqa: F401
