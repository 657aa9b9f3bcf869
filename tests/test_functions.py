"""Edge values of the column functions."""

import pytest
from pyspark.sql import functions as F

from foliospark.functions import jsontext, paths, scores, text
from foliospark.operators import routing


def column(spark, values, kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")


def run(spark, values, expression, kind="string"):
    rows = column(spark, values, kind).select("i", expression(F.col("v")).alias("r")).collect()
    return [r["r"] for r in sorted(rows, key=lambda r: r["i"])]


JSON = ['{"a":1,"b":null}', "2024", "true", "null", "[1,2]", "", "12,062", "Net 30", None]


def test_json_tests(spark):
    assert run(spark, JSON, jsontext.is_json) == [True, True, True, True, True, False, False, False, False]
    assert run(spark, JSON, jsontext.is_json_object) == [True] + [False] * 8


def test_unwrap_label(spark):
    labels = ["w2", '{"labels":["w2"]}', '{"labels":[]}', '{"x":1}', "7", None]
    assert run(spark, labels, jsontext.unwrap_label) == ["w2", "w2", None, None, None, None]
    kept = run(spark, labels, lambda c: jsontext.unwrap_label(c, keep_unlabelled=True))
    assert kept == ["w2", "w2", '{"labels":[]}', '{"x":1}', "7", None]


def test_class_key(spark):
    assert run(spark, [" Sales Report ", "sales-report", "SALES_REPORT"], jsontext.class_key) == ["sales_report"] * 3


PATHS = ["a/b/c.d.PDF", "noext", "", None, "x_part_1_of_3.pdf", "xXpartY1Zof2.pdf", "converted_excel/a.xlsx", "b/a.XLSM"]


def test_paths(spark):
    assert run(spark, PATHS, paths.base_name) == ["c.d.PDF", "noext", None, None, "x_part_1_of_3.pdf", "xXpartY1Zof2.pdf", "a.xlsx", "a.XLSM"]
    assert run(spark, PATHS, paths.extension) == [".PDF", None, None, None, ".pdf", ".pdf", ".xlsx", ".XLSM"]
    assert run(spark, PATHS, paths.file_type) == ["pdf", "unknown", "unknown", "unknown", "pdf", "pdf", "unknown", "unknown"]
    assert run(spark, PATHS, paths.is_split_part)[4:6] == [True, True]
    assert run(spark, PATHS, lambda c: paths.is_split_part(c, strict=False))[4:6] == [True, False]
    assert run(spark, PATHS, paths.is_spreadsheet)[6:] == [False, True]


def test_table_name(spark):
    names = ["sales report.csv", "2024.q1.csv", "été-1.csv", "plain"]
    assert run(spark, names, paths.table_name) == ["CSV_SALES_REPORT", "CSV_T_2024_Q1", "CSV_ÉTÉ_1", "CSV_PLAIN"]


def test_every_file_has_one_route(spark):
    sizes = spark.createDataFrame(
        [("a.pdf", 104857600), ("a.pdf", 104857601), ("a.png", 104857601), ("a.csv", 104857601), ("a.zip", 1), ("a.xlsx", 1), ("converted_excel/a.xlsx", 1)],
        "relative_path string, size bigint",
    )
    rows = [r["route"] for r in routing.route_files(sizes).collect()]
    assert rows == ["parse", "large", "rejected", "csv", "rejected", "spreadsheet", "rejected"]


def test_scores(spark):
    values = [None, -0.1, 0.3, 0.4, 0.8999, 0.9, 0.95, 0.97, 1.0, 1.2]
    assert run(spark, values, scores.clamp, "double") == [0.5, 0.0, 0.3, 0.4, 0.8999, 0.9, 0.95, 0.97, 1.0, 1.0]
    bands = run(spark, values, lambda c: scores.confidence_band(c, 0.5), "double")
    assert bands == ["gray", "red", "orange", "yellow", "green", "green", "green", "green", "green", "green"]
    verdicts = run(spark, values[1:], scores.run_verdict, "double")
    assert verdicts == ["Needs Review"] * 4 + ["Good", "Good", "Excellent", "Excellent", "Excellent"]
    assert run(spark, [0.0, 0.05, 0.999, 1.0], scores.histogram_bin, "double") == [0, 1, 19, 19]


REPLIES = {
    '{"score": 0.9, "reasoning": "fine"}': (0.9, "fine"),
    '"{\\"score\\": 0.8, \\"reasoning\\": \\"inner\\"}"': (0.8, "inner"),
    '{"score": "0.7"}': (0.7, "No reasoning provided"),
    '{"score": 7}': (1.0, "No reasoning provided"),
    '{"reasoning": "none"}': (0.0, "none"),
    '{"score": null, "reasoning": "x"}': (0.5, "No reasoning captured"),
    '{"score": "high"}': (0.5, "No reasoning captured"),
    "0.9": (0.5, "No reasoning captured"),
    "text": (0.5, "No reasoning captured"),
    None: (0.5, "No reasoning captured"),
}


def test_judge_reply(spark):
    got = run(spark, list(REPLIES), jsontext.judge_reply)
    assert [(r["score"], r["reasoning"]) for r in got] == list(REPLIES.values())


def test_clip_cell(spark):
    assert run(spark, [None, "x" * 100, "x" * 101], text.clip_cell) == ["", "x" * 100, "x" * 97 + "..."]


def test_explode_json(spark):
    df = column(spark, ['{"a":1,"b":{"c":2},"d":null}', "[5,6]", "7", "bad", None])
    rows = jsontext.explode_json(df, "v").select("i", "key", "value").collect()
    assert sorted((r["i"], r["key"] or "", r["value"] or "") for r in rows) == [
        (0, "a", "1"), (0, "b", '{"c":2}'), (0, "d", ""), (1, "", "5"), (1, "", "6"),
    ]


def test_term_count(spark):
    values = ["The w-2, the wages; net income. THE end", "there other", None]
    assert run(spark, values, lambda c: text.term_count(c, ["the", "net income", "w-2"])) == [5, 0, None]


def test_html(spark):
    page = "<html><head><style>p{}</style><script>var t='</p>';</script></head><body><!-- x --><p>A &amp;lt; B</p><div>C<b>D</b></div></body></html>"
    assert run(spark, [page], text.html_to_text) == ["A &lt; B\nCD"]


def test_period_order():
    from datetime import date

    from foliospark.plans.costs import in_period

    with pytest.raises(ValueError):
        in_period("start_time", date(2024, 2, 1), date(2024, 1, 1))


def test_entities_are_read_once(spark):
    cases = {
        "a &mdash; b": "a — b", "&#8217;x": "’x", "&#x1F600;": "😀", "&amp;lt;": "&lt;", "&bogus; & &;": "&bogus; & &;",
        "&lt;p&gt;&nbsp;": "<p> ", "&#0;&#xD800;&#9999999;": "&#0;&#xD800;&#9999999;", "": "", "plain": "plain", "&eacute&eacute;": "&eacuteé",
    }
    df = spark.createDataFrame([(k,) for k in cases], "t string").select("t", text.resolve_entities(F.col("t")).alias("r"))
    assert {r["t"]: r["r"] for r in df.collect()} == cases


def test_keys_may_hold_quotes(spark):
    rows = [('{"s": {"it\'s": 0.5, "a.b": 2, "x": "t"}}', k) for k in ("it's", "a.b", "x", "none")] + [("bad", "x"), (None, "x"), ('{"s": 1}', "x")]
    df = spark.createDataFrame(rows, "j string, k string").select(jsontext.keyed_value(F.col("j"), "$.s", F.col("k")).alias("v"))
    assert [r["v"] for r in df.collect()] == [0.5, 2.0, None, None, None, None, None]
