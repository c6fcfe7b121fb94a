"""Reading, checking and building of model answers and prompts: Column -> Column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from voxlens.functions.text import SPACE, _col


def strip(c: Column) -> Column:
    """Without white space at both ends (any Unicode space, not only the blank)."""
    return F.regexp_replace(c, f"^[{SPACE}]+|[{SPACE}]+$", "")


def parse_keywords(c) -> Column:
    """Comma list to trimmed items, single quotes removed."""
    return F.transform(F.split(F.translate(_col(c), "'", ""), ","), strip)


def last_line(c) -> Column:
    """Last line of the answer, without surrounding white space."""
    lines = F.split(strip(_col(c)), "\n")
    return strip(F.element_at(lines, -1))


def valid_keywords(tokens, n: int = 5) -> Column:
    """True for exactly ``n`` items, none blank. NULL is not valid."""
    # A blank or missing item counts more than n, so the sum is n only in the good case.
    total = F.aggregate(
        _col(tokens), F.lit(0), lambda acc, w: acc + F.when(F.length(strip(w)) > 0, 1).otherwise(n + 1)
    )
    return F.coalesce(total == n, F.lit(False))


def spread_keywords(tokens, n: int = 5, prefix: str = "keyword") -> list[Column]:
    """One column per item: keyword1 .. keywordN."""
    return [F.get(_col(tokens), i).alias(f"{prefix}{i + 1}") for i in range(n)]


def gather_keywords(n: int = 5, prefix: str = "keyword") -> Column:
    """The non-empty keyword columns as one array."""
    columns = F.array(*[F.col(f"{prefix}{i + 1}") for i in range(n)])
    return F.filter(columns, lambda w: w.isNotNull() & (w != ""))


def build_prompt(template: str, **fields) -> Column:
    """Fill the ``{name}`` places of the template with columns; NULL gives an empty place."""
    pieces, rest = [], template
    while rest:
        places = [(rest.find("{" + name + "}"), name) for name in fields]
        places = [p for p in places if p[0] >= 0]
        if not places:
            pieces.append(F.lit(rest))
            break
        at, name = min(places)
        if at:
            pieces.append(F.lit(rest[:at]))
        pieces.append(F.coalesce(_col(fields[name]).cast("string"), F.lit("")))
        rest = rest[at + len(name) + 2:]
    return F.concat(*pieces)


def parse_flag(c) -> Column:
    """1 when the answer holds a 1, else 0; NULL and blank give 0."""
    return F.when(_col(c).contains("1"), 1).otherwise(0)


def parse_nested(c) -> Column:
    """Items of a printed list of one-item lists, such as ``[['a'], ['b']]``."""
    return F.regexp_extract_all(_col(c), F.lit("'([^']*)'"), 1)
