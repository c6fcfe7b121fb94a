"""Pieces of SQL shared by the checks (RE2 syntax)."""

SPACE = r"\s\x0b\x1c-\x1f\x{85}\p{Z}"
WORD = r"\p{L}\p{N}_"


def words(c: str) -> str:
    return f"list_filter(string_split_regex({c}, '[{SPACE}]+'), lambda w: w <> '')"


def tokens(c: str, n: int = 2) -> str:
    return f"regexp_extract_all(lower({c}), '[{WORD}]{{{n},}}')"


def clean_review(c: str) -> str:
    kept = f"regexp_replace(lower({c}), '[^가-힣a-zA-Z0-9{SPACE}.,!?]', '', 'g')"
    return f"coalesce(trim(regexp_replace({kept}, '[{SPACE}]+', ' ', 'g')), '')"


def clean_basic(c: str) -> str:
    plain = f"regexp_replace(lower({c}), '[^{WORD}{SPACE}]', '', 'g')"
    return rf"regexp_replace({plain}, '\p{{Nd}}+', '', 'g')"


def clean_comment(c: str) -> str:
    plain = f"regexp_replace({c}, '[^{WORD}{SPACE},]', '', 'g')"
    plain = f"regexp_replace({plain}, '[ㄱ-ㅎ]{{2,}}', '', 'g')"
    # A run of two and more word characters is kept whole, a run of one is not.
    return rf"regexp_replace({plain}, '([{WORD}]{{2,}})|[{WORD}]', '\1', 'g')"


def unescape(c: str) -> str:
    for entity, char in [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&nbsp;", " "), ("&amp;", "&")]:
        c = f"replace({c}, '{entity}', '{char}')"
    return c


def grams(c: str) -> str:
    """1- and 2-grams of a token list expression."""
    return (
        f"list_concat({c}, list_transform(list_zip({c}[1:-2], {c}[2:]), lambda z: z[1] || ' ' || z[2]))"
    )


# Flat comments derived from conversations: one conversation is one video.
COMMENTS_RAW = """
SELECT 'v' || conv_id AS video_id, 'conversation ' || conv_id AS title,
       '2024-01-' || lpad(CAST(1 + conv_id % 28 AS VARCHAR), 2, '0') || 'T08:30:00Z' AS publish_date,
       'channel' || (conv_id % 5) AS channel_name, text AS comment,
       CAST(length(text) AS BIGINT) AS like_count,
       CASE WHEN turn % 7 = 3 THEN 'yesterday'
            ELSE '2024-02-' || lpad(CAST(1 + turn % 28 AS VARCHAR), 2, '0') || 'T10:00:00Z' END
       AS comment_publish_date
FROM conversations
"""

# Reviews derived from documents: score text with failures, some fields missing.
REVIEWS_RAW = """
SELECT CASE doc_id % 10 WHEN 0 THEN '점' WHEN 1 THEN NULL WHEN 2 THEN 'n/a' ELSE (n_chars % 101) || '점' END AS scoring,
       source AS market,
       '2024-' || lpad(CAST(1 + doc_id % 12 AS VARCHAR), 2, '0') || '-15' AS purchasing_date,
       lang || ' ' || source AS review_title, text AS review_content, lang AS item
FROM documents
"""
