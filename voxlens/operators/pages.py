"""Fields of stored review pages: DataFrame -> DataFrame."""

from __future__ import annotations

import json
import re
from html.entities import html5
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Where the fields of a review are found (path, attribute or text).
LIST = "#danawa-prodBlog-companyReview-content-list"
REVIEW_FIELDS = {
    "scoring": (f"{LIST} div.top_info span.point_type_s span", None),
    "market": (f"{LIST} div.top_info span.mall img", "alt"),
    "purchasing_date": (f"{LIST} span.date", None),
    "review_title": (f"{LIST} div.atc_cont > div.tit_W", None),
    "review_content": (f"{LIST} div.atc", None),
}

# Number of the page being shown, and the further page numbers.
PAGE_LIST = {
    "current": (f"{LIST} > div > div > div span", None),
    "further": (f"{LIST} > div > div > div a", "data-pagenumber"),
}

REFERENCE = r"&(?:#[0-9]+|#[xX][0-9A-Fa-f]+|[A-Za-z][A-Za-z0-9]*);"
NAMED = {name[:-1]: char for name, char in html5.items() if name.endswith(";")}

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}


def unescape(c: Column) -> Column:
    """Character references, named and numbered, to characters; an unknown one stays."""
    named = F.from_json(F.lit(json.dumps(NAMED)), "map<string,string>")

    def read(piece: Column) -> Column:
        whole = F.regexp_extract(piece, f"^({REFERENCE})", 1)
        name = F.substring(whole, F.lit(2), F.greatest(F.lit(0), F.length(whole) - 2))
        code = F.when(F.lower(name).startswith("#x"), F.conv(F.substring(name, 3, 9), 16, 10)).when(
            name.startswith("#"), F.substring(name, 2, 9)).try_cast("int")
        valid = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
        char = F.when(valid, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))
        rest = F.substring(piece, F.length(whole) + 1, F.length(piece))
        return F.concat(F.coalesce(char, F.try_element_at(named, name), whole), rest)

    pieces = F.transform(F.split(c, f"(?={REFERENCE})"), read)
    return F.when(c.contains("&"), F.array_join(pieces, "")).otherwise(c)


def extract_page_fields(df: DataFrame, rules: dict[str, str], html: str = "html", keep: list[str] = ()) -> DataFrame:
    """One array column per rule with the first group of every match, in page order. For
    fields without nested tags; stays in the JVM."""
    return df.select(*keep, *[
        F.transform(F.regexp_extract_all(html, F.lit(rule), 1), unescape).alias(name)
        for name, rule in rules.items()
    ])


def extract_links(df: DataFrame, html: str = "html", keep: list[str] = ()) -> DataFrame:
    """One row per link of the page with its position."""
    links = F.regexp_extract_all(html, F.lit(r'<a\s[^>]*?href="([^"]*)"'), 1)
    return df.select(*keep, F.posexplode(F.transform(links, unescape)).alias("pos", "href"))


def parse_path(path: str) -> list[tuple[bool, str, str, frozenset]]:
    """Steps of a path such as ``#list div.top > span.a.b``: (child of the step before, tag,
    id, classes); a blank stands for any depth, ``>`` for a child."""
    steps, child = [], False
    for part in path.split():
        if part == ">":
            child = True
            continue
        found = re.fullmatch(r"([\w-]*)(?:#([\w-]+))?((?:\.[\w-]+)*)", part)
        if not found or not part:
            raise ValueError(f"path step {part!r}")
        steps.append((child, found[1].lower(), found[2] or "", frozenset(found[3].split(".")[1:])))
        child = False
    return steps


class _Fields(HTMLParser):
    """Collects the text (nested tags included) or an attribute of the elements at the paths."""

    def __init__(self, fields):
        super().__init__(convert_charrefs=True)
        self.paths = {name: (parse_path(path), attr) for name, (path, attr) in fields.items()}
        self.found = {name: [] for name in fields}
        self.open = []  # (tag, steps reached per field, texts that the element adds to)

    def _reached(self, name, tag, attrs) -> set[int]:
        """Numbers of leading steps of the path that end at this element."""
        steps, above = self.paths[name][0], [element[1][name] for element in self.open]
        classes = frozenset((attrs.get("class") or "").split())
        reached = set()
        for n, (child, want, ident, marks) in enumerate(steps):
            if (want and want != tag) or (ident and ident != attrs.get("id")) or not marks <= classes:
                continue
            if n == 0 or (n in above[-1] if child and above else any(n in done for done in above) and not child):
                reached.add(n + 1)
        return reached

    def handle_starttag(self, tag, attrs):
        attrs = dict(attrs)
        reached = {name: self._reached(name, tag, attrs) for name in self.paths}
        texts = []
        for name, (steps, attr) in self.paths.items():
            if len(steps) in reached[name]:
                if attr is None:
                    self.found[name].append("")
                    texts.append((name, len(self.found[name]) - 1))
                elif attr in attrs:
                    self.found[name].append(attrs[attr] or "")
        if tag not in VOID:
            self.open.append((tag, reached, texts))

    def handle_endtag(self, tag):
        if any(element[0] == tag for element in self.open):
            while self.open.pop()[0] != tag:
                pass

    def handle_data(self, data):
        for *_, texts in self.open:
            for name, at in texts:
                self.found[name][at] += data


def extract_nested_fields(df: DataFrame, fields=None, html: str = "html", keep: list[str] = ()) -> DataFrame:
    """As ``extract_page_fields`` for fields given by path, (path, attribute or None for the
    text), with nested tags: a parser per page inside the tasks, pages stay where they are."""
    fields = fields or REVIEW_FIELDS
    schema = T.StructType(
        [df.schema[c] for c in keep] + [T.StructField(n, T.ArrayType(T.StringType())) for n in fields]
    )
    keep = list(keep)

    def parse(batches):
        for batch in batches:
            rows = []
            for page in batch[html]:
                parser = _Fields(fields)
                parser.feed(page or "")
                parser.close()
                rows.append(parser.found)
            yield pd.concat(
                [batch[keep].reset_index(drop=True), pd.DataFrame(rows, columns=list(fields))], axis=1
            )

    return df.select(*keep, html).mapInPandas(parse, schema)


def page_window(df: DataFrame, html: str = "html", keep: list[str] = (), paths=None) -> DataFrame:
    """Page list of a result page, found by path: shown page, last listed page, and whether a
    further block of pages follows (a block has ten pages)."""
    found = extract_nested_fields(df, paths or PAGE_LIST, html, keep)
    pages = found.select(
        *keep, F.trim(F.get("current", F.lit(0))).try_cast("int").alias("current"),
        F.transform("further", lambda x: x.try_cast("int")).alias("further"),
    )
    last = F.coalesce(F.get("further", F.size("further") - 1), F.col("current"))
    return pages.select(
        *keep, "current", last.alias("last"), (F.size("further") + 1).alias("n_listed"),
        (F.col("current") + 9 == last).alias("has_next"),
    )
