"""Query of operator 3. SQL has no base32 and no archives; tests compare with brute force."""

from voxlens.llm.registry import query, table
from voxlens.llm.warc import payload_table, resolve_revisits, write_archives
from voxlens.session import fresh_path


@query("op3_warc")
def op3_warc(spark, sf_dir):
    raw, clean = fresh_path(spark, "warc-raw"), fresh_path(spark, "warc-clean")
    write_archives(table(spark, sf_dir, "pages"), raw)
    resolve_revisits(spark, raw, clean)
    return payload_table(spark, clean)
