"""Regression cases: what must not be done as before, and edge values."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from voxlens import schemas
from voxlens.operators import aggregate, filters, lookup, pages, ranking, reshape
from voxlens.plans import jobs

RAW = schemas.COMMENTS_RAW
GOOD = ("v1", "t", "2024-09-10T00:00:00Z", "c", "text", 3, "2024-10-01T12:30:00Z")


def test_each_date_is_parsed_from_itself(spark):
    row = reshape.parse_timestamps(spark.createDataFrame([GOOD], RAW), ["publish_date", "comment_publish_date"]).first()
    assert row["publish_date"] == dt.datetime(2024, 9, 10)
    assert row["comment_publish_date"] == dt.datetime(2024, 10, 1, 12, 30)


def test_malformed_date_and_copies_are_dropped(spark):
    bad = ("v1", "t", "yesterday", "c", "text", 3, "2024-10-01T12:30:00Z")
    missing = ("v1", "t", "2024-09-10T00:00:00Z", "c", None, 3, "2024-10-01T12:30:00Z")
    blank = ("v1", "t", "2024-09-10T00:00:00Z", "c", "", 3, "2024-10-01T12:30:00Z")
    raw = spark.createDataFrame([GOOD, GOOD, bad, missing, blank], RAW)
    assert jobs.clean_comments(raw).count() == 2
    assert jobs.clean_comments(reshape.blank_as_null(raw, ["comment"])).count() == 1


def test_score_text(spark):
    df = spark.createDataFrame([("100점",), ("점",), ("",), (None,), ("n/a",), (" 80점",)], "s string")
    assert [r["s"] for r in reshape.parse_score(df, "s").collect()] == [100.0, None, None, None, None, 80.0]


def test_review_load_parses_first(spark):
    rows = [("100점", "m", "2024-01-02", "t", "c", "S24"), ("100점", "m", "2024.01.02.", "t", "c", "S24"), ("점", "m", "2024-01-02", "t", "c", "S24")]
    out = jobs.clean_reviews(spark.createDataFrame(rows, schemas.REVIEWS_RAW)).collect()
    assert [(r["scoring"], r["purchasing_date"]) for r in out] == [(100, dt.datetime(2024, 1, 2))]


def test_review_dates_and_rejected_rows(spark):
    rows = [("90점", "m", "2024.10.01.", "t", "c", "S24"), ("80점", "m", "2024.10.02", "t", "c", "S24"),
            ("점", "m", "2024-01-02", "t", "c", "S24"), ("70점", "m", "soon", "t", None, "S24")]
    raw = spark.createDataFrame(rows, schemas.REVIEWS_RAW)
    assert sorted((r["scoring"], r["purchasing_date"].day) for r in jobs.clean_reviews(raw).collect()) == [(80, 2), (90, 1)]
    rejected = {(r["scoring"], r["purchasing_date"], r["reason"]) for r in jobs.rejected_reviews(raw).collect()}
    assert rejected == {("점", "2024-01-02", "scoring"), ("70점", "soon", "purchasing_date, review_content")}


def test_empty_word_lists_match_nothing(spark):
    from voxlens.functions import text

    df = spark.createDataFrame([("text",), ("내 아이폰",), (None,)], "t string")
    assert filters.contains_any(df, "t", []).count() == 0
    assert [r[0] for r in df.select(text.classify_brand("t")).collect()] == ["neither", "apple", "neither"]
    assert [r[0] for r in df.select(text.classify_brand("t", ("a", ()), ("b", ()))).collect()] == ["neither"] * 3


def test_nan_is_in_no_bin(spark):
    df = spark.createDataFrame([(float(i),) for i in range(10)] + [(float("nan"),), (None,)], "v double")
    assert [(r["bin"], r["n"]) for r in aggregate.histogram(df, "v", 5).orderBy("bin").collect()] == [(i, 2) for i in range(5)]


def test_weights_of_a_key_in_two_groups(spark):
    from voxlens.operators import features

    df = spark.createDataFrame([("a", 1, "xx yy"), ("b", 1, "xx yy")], "g string, k int, t string")
    got = {(r["g"], r["term"]): r["mean_weight"] for r in features.mean_tfidf(df, "k", "t", 5, by="g").collect()}
    assert len(got) == 4 and all(w == pytest.approx(0.5**0.5) for w in got.values())


def test_undeclared_columns_are_noticed(spark):
    df = spark.createDataFrame([GOOD], RAW).withColumn("more", F.lit(1))
    with pytest.raises(ValueError, match="more"):
        schemas.conform(df, RAW)
    assert schemas.conform(df, RAW, extra="drop").columns == RAW.fieldNames()


def test_quantiles_narrow_their_brackets(spark, monkeypatch):
    monkeypatch.setattr(aggregate, "BRACKET", 50)
    values = [((i * 7919) % 20011) / 3.0 for i in range(20011)]
    rows = [(v, 5.0 if i % 3 else float(i)) for i, v in enumerate(values)] + [(None, float("nan"))]
    df = spark.createDataFrame(rows, "v double, w double")
    ps = (0.0, 0.1, 0.25, 0.5, 0.731, 1.0)
    got = {(r["column"], r["p"]): r["value"] for r in
           aggregate.quantiles_of(df, {"v": F.col("v"), "w": F.col("w")}, ps, sketch=64, slack=0.01).collect()}
    import numpy as np

    for name, at in (("v", 0), ("w", 1)):
        known = [r[at] for r in rows[:-1]]
        assert [got[name, p] for p in ps] == pytest.approx([float(np.quantile(known, p)) for p in ps])
    assert aggregate.quantiles_of(df.limit(0), {"v": F.col("v")}).count() == 0


def test_missing_counts_on_mixed_types(spark):
    df = spark.createDataFrame([("a", 1.0, 1), (None, float("nan"), None), ("NaN", None, 2)], "s string, d double, i int")
    found = {r["column"]: r["n_missing"] for r in aggregate.null_counts(df).collect()}
    assert found == {"s": 1, "d": 2, "i": 1}


def test_distinct_counts_a_missing_value_once(spark):
    df = spark.createDataFrame([("a", 1), (None, 1), (None, 1)], "s string, i int")
    assert {r["column"]: r["n_distinct"] for r in aggregate.distinct_counts(df).collect()} == {"s": 2, "i": 1}


def test_lists_are_cut_to_the_shortest(spark):
    df = spark.createDataFrame([(1, ["a", "b"], ["x"]), (2, [], ["y"]), (3, None, ["z"])], "id int, l array<string>, r array<string>")
    assert [tuple(r) for r in reshape.zip_fields(df, ["l", "r"], ["id"]).collect()] == [(1, "a", "x")]


def test_links(spark):
    df = spark.createDataFrame([("#",), ("",), ("/p?companyReviewYN=Y",), ("/p",), (None,)], "href string")
    assert [r["href"] for r in filters.valid_links(df, "href", "companyReviewYN=Y").collect()] == ["/p?companyReviewYN=Y"]


def test_excluded_channel_keeps_missing(spark):
    df = spark.createDataFrame([("x",), ("보겸TV",), (None,)], "c string")
    assert filters.exclude_values(df, "c", ["보겸TV"]).count() == 2


def test_first_target_wins(spark):
    df = spark.createDataFrame([("갤럭시 S24 아이폰16",), ("아이폰16 128",), ("폴드",)], "t string")
    assert [r["item"] for r in reshape.tag_item(df, "t", ["S24", "아이폰16"]).collect()] == ["S24", "아이폰16", None]


def test_word_ties_by_word(spark):
    df = spark.createDataFrame([("b a c a b",)], "t string")
    assert [tuple(r) for r in aggregate.word_counts(df, "t", 2).collect()] == [("a", 2), ("b", 2)]


def test_stop_words_are_single_words(spark):
    tokens = spark.createDataFrame([("하나",), ("폰",), ("폰",)], "word string")
    stop = lookup.merge_words(spark.createDataFrame([("하나",)], "w string"), spark.createDataFrame([("하나",), ("둘",)], "v string"))
    assert stop.count() == 2
    assert [r["word"] for r in lookup.remove_words(tokens, stop, "word").collect()] == ["폰", "폰"]


def test_one_letter_keywords_need_the_parameter(spark):
    df = spark.createDataFrame([("펜 앱 펜",)], "t string")
    dim = lookup.keyword_table(spark, {"디지털 아트": ["펜", "앱", "터치"]})
    assert {r["keyword"]: r["n"] for r in aggregate.keyword_frequency(df, dim, "t").collect()} == {"펜": 0, "앱": 0, "터치": 0}
    short = aggregate.keyword_frequency(df, dim, "t", min_token_len=1).collect()
    assert {r["keyword"]: r["n"] for r in short} == {"펜": 2, "앱": 1, "터치": 0}


def test_two_word_keyword_in_two_topics(spark):
    df = spark.createDataFrame([("저장 공간 저장",)], "t string")
    dim = lookup.keyword_table(spark, {"a": ["저장 공간", "저장"], "b": ["저장"]})
    found = {(r["topic"], r["keyword"]): r["n"] for r in aggregate.keyword_frequency(df, dim, "t").collect()}
    assert found == {("a", "저장 공간"): 1, ("a", "저장"): 2, ("b", "저장"): 2}


def test_items_are_scored_side_by_side(spark):
    rows = [("S24", "만족 화질 화질"), ("아이폰16", "별로 화질 발열"), ("아이폰16", "그냥")]
    out = jobs.sentiment_words(spark.createDataFrame(rows, "item string, text string"), "item", "text", exclude=["별로"]).collect()
    assert {(r["item"], r["sentiment"], r["word"], r["n"]) for r in out} == {
        ("S24", "positive", "화질", 2), ("S24", "positive", "만족", 1),
        ("아이폰16", "negative", "화질", 1), ("아이폰16", "negative", "발열", 1),
    }


def test_constant_column_has_a_histogram(spark):
    df = spark.createDataFrame([(5.0,), (5.0,)], "v double")
    out = aggregate.histogram(df, "v", 2).orderBy("bin").collect()
    assert [(r["bin_from"], r["bin_to"], r["n"]) for r in out] == [(4.5, 5.0, 0), (5.0, 5.5, 2)]


def test_schema_mismatch_is_an_error(spark):
    with pytest.raises(ValueError, match="like_count"):
        schemas.conform(spark.createDataFrame([GOOD], RAW).withColumn("like_count", F.lit("3")), RAW)


HTML = f"""
<span class="date">2020.01.01.</span><span>3</span>
<div id="{pages.LIST[1:]}"><div><div class="top_info"><span class="point_type_s">x <span>100점</span> extra</span>
<span class="mall"><img src="x.png" alt="몰 &amp; 샵"></span><span class="date">2024.10.01.</span></div>
<div class="atc_cont"><div class="tit_W">좋은 <b>폰</b></div><p><div class="tit_W">other</div></p>
<div class="atc_exp"><div class="atc">화질<br>최고 &copy;</div></div></div>
<div><div><span>11</span><a data-pagenumber="12">12</a><a data-pagenumber="20">next</a></div></div></div></div>
"""


def test_review_page(spark):
    df = spark.createDataFrame([(1, HTML), (2, None)], "id int, html string")
    first, second = pages.extract_nested_fields(df, keep=["id"]).orderBy("id").collect()
    assert first["scoring"] == ["100점"] and first["market"] == ["몰 & 샵"]
    assert first["purchasing_date"] == ["2024.10.01."]
    assert first["review_title"] == ["좋은 폰"] and first["review_content"] == ["화질최고 ©"]
    assert second["review_title"] == []
    rows = reshape.zip_fields(pages.extract_nested_fields(df), list(pages.REVIEW_FIELDS))
    assert rows.count() == 1


def test_page_list(spark):
    def shown(inner):
        return f'<span>7</span><div id="{pages.LIST[1:]}"><div><div><div>{inner}</div></div></div></div>'

    block = "<span>1</span>" + "".join(f'<a data-pagenumber="{i}">{i}</a>' for i in range(2, 11))
    df = spark.createDataFrame([(1, shown(block)), (2, shown("<span> 3 </span>")), (3, HTML), (4, "<span>5</span>")],
                               "id int, html string")
    full, single, listed, none = pages.page_window(df, keep=["id"]).orderBy("id").collect()
    assert (full["current"], full["last"], full["has_next"]) == (1, 10, True)
    assert (single["current"], single["last"], single["has_next"]) == (3, 3, False)
    assert (listed["current"], listed["last"], listed["has_next"]) == (11, 20, True)
    assert none["current"] is None and none["n_listed"] == 1


def test_character_references(spark):
    text = "a &amp;lt; &copy;&middot;&#44032;&#xAC00; &#x1F600; &nosuch; &#xD800; & b;"
    df = spark.createDataFrame([(text,), ("plain",), (None,)], "t string")
    assert [r[0] for r in df.select(pages.unescape(F.col("t"))).collect()] == [
        "a &lt; ©·가가 😀 &nosuch; &#xD800; & b;", "plain", None]


def test_split_is_whole_and_stable(spark):
    df = spark.range(2000)
    parts = ranking.split(df, [0.8, 0.2], 42, "id")
    sizes = [p.count() for p in parts]
    assert sum(sizes) == 2000 and 1500 < sizes[0] < 1700
    again = ranking.split(df.repartition(3), [0.8, 0.2], 42, "id")[1]
    assert again.exceptAll(parts[1]).count() == 0
