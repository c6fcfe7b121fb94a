"""Query of operator 10. SQL has no tokenizer; tests check the pieces against it."""

import public_tokenizers

from voxlens.llm.packing import pack
from voxlens.llm.registry import query, table

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


@query("op10_packing")
def op10_packing(spark, sf_dir):
    return pack(spark, table(spark, sf_dir, "documents"), TOKENIZER)
