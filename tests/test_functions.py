from datetime import date

from pyspark.sql import functions as F

from almanac.functions import dates, scalars, text


def column(spark, values, expression, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("v")).alias("out")).collect()]


def test_compact_date_reads_three_shapes_and_rejects_junk(spark):
    values = ["20230601T101500", "20230601T1015", "20230601", "bad", "2023-06-01", None]
    assert column(spark, values, dates.compact_date) == [date(2023, 6, 1)] * 3 + [None] * 3


def test_iso_date_and_cursor_forms(spark):
    assert column(spark, ["2023-06-01", "01/06/2023"], dates.iso_date) == [date(2023, 6, 1), None]
    assert column(spark, [date(2023, 6, 1)], dates.api_stamp, "date") == ["20230601T0000"]
    assert column(spark, ["20230601T101500"], dates.cursor_day_floor) == ["20230601T0000"]


def test_weekday_starts_on_monday(spark):
    assert column(spark, [date(2024, 1, 1), date(2024, 1, 7)], dates.day_of_week, "date") == [0, 6]


def test_round_price_is_half_even(spark):
    assert column(spark, ["2.665", "2.675", "0.125", "x", None], scalars.round_price) == [2.66, 2.68, 0.12, None, None]


def test_greed_band_edges(spark):
    bands = column(spark, [39, 40, 41, 69, 70, None], scalars.greed_band, "int")
    assert bands == ["green", "green", "yellow", "yellow", "red", "green"]


def test_missing_label_scores_zero_and_unreadable_reply_is_null(spark):
    values = ['[{"label":"LABEL_1","score":0.75}]', '[{"label":"LABEL_0","score":0.5},{"label":"X","score":1}]', None]
    out = column(spark, values, scalars.reply_scores)
    assert [tuple(r) for r in out] == [(0.0, 0.75), (0.5, 0.0), (None, None)]


def test_combined_text_is_null_when_a_part_is(spark):
    df = spark.createDataFrame([("a", "b"), (None, "b")], "t string, c string")
    assert [r[0] for r in df.select(text.combined_text(F.col("t"), F.col("c"))).collect()] == ["a b", None]


def test_tokens_keep_accents_and_order(spark):
    assert column(spark, ["Érable à 3,5 km_h!"], text.tokens) == [["érable", "à", "3", "5", "km_h"]]


def test_chunk_bounds(spark):
    values = [["w"] * n for n in (0, 1, 500, 501, 1000)]
    chunks = column(spark, values, text.token_chunks, "array<string>")
    assert [[len(c) for c in one] for one in chunks] == [[], [1], [500], [500, 1], [500, 500]]


def test_sentences_break_on_stops_and_lines(spark):
    assert column(spark, ["One. Two!  3.14 is pi\n\nLast"], text.sentences) == [["One.", "Two!", "3.14 is pi", "Last"]]
    assert column(spark, ["0 a 0\n1 b 1\n2 c 2"], text.sentences) == [["0 a 0", "1 b 1", "2 c 2"]]


def test_html_to_text(spark):
    page = "<head><title>T</title></head><nav><a>n</a></nav><p>A &amp; <b>B</b><!-- x --><script>var a='<p>'</script>\n c</p>"
    assert column(spark, [page], text.html_to_text) == ["A & B c"]


def test_percent_error_skips_zero_actuals(spark):
    df = spark.createDataFrame([(2.0, 1.0), (0.0, 1.0)], "y double, p double")
    assert [r[0] for r in df.select(scalars.percent_error(F.col("y"), F.col("p"))).collect()] == [0.5, None]
