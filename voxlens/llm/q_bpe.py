"""Query of operator 8. SQL has no BPE; tests compare it with a public tokenizer."""

import public_tokenizers

from voxlens.llm.bpe import encode_texts
from voxlens.llm.registry import query, table

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@query("op8_bpe")
def op8_bpe(spark, sf_dir):
    return encode_texts(spark, table(spark, sf_dir, "documents"), RANKS, with_ids=False)
