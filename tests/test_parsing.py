from pyspark.sql import functions as F

from floorlens.functions.scalars import clean_int
from floorlens.sources import layouts, pages, readers, text

PASTE = "台番\t差枚\tG数\tBB\tRB\t合成\n101\t+1,200\t5,000\t20\t15\t1/142.9\n102\t-300\t\t\t\t\n\nabc\t1\t1\n0\t5\t5\n平均\t450\t2,500\t-\t-\t-"


def test_tsv(spark):
    df = spark.createDataFrame([(1, PASTE)], "id int, text string")
    got = [tuple(r)[2:] for r in text.parse_tsv(df).orderBy("line").collect()]
    assert got == [(101, 1200, 5000, 20, 15, "1/142.9"), (102, -300, 0, 0, 0, "")]


GRID = "r1,2001,,2010,POS\nr2,,階段,ATM柱,\n\nr3,99,12345,出口X,0100\n"


def test_grid_cells(spark):
    df = spark.createDataFrame([("A", "1F", GRID)], "hole string, floor string, text string")
    cells = layouts.parse_layout_grid(df)
    got = {(r.row, r.col): (r.type, r.number, r.subtype, r.label, r.text) for r in cells.collect()}
    assert got[(0, 0)] == ("machine", 2001, None, None, None)
    assert got[(0, 3)] == ("structure", None, "counter", "POS", None)
    assert got[(1, 1)][2] == "stairs" and got[(1, 2)][2] == "pillar"
    assert got[(2, 0)] == ("label", None, None, None, "99") and got[(2, 1)][0] == "label"
    assert got[(2, 3)][1] == 100
    assert (0, 1) not in got
    kept = layouts.filter_unit_range(cells, 2000, 3000)
    trimmed = layouts.trim_columns(kept, ["hole", "floor"])
    cols = {(r.row, r.col, r.type) for r in trimmed.collect()}
    assert (0, 0, "machine") in cols and (0, 2, "machine") in cols and all(c <= 2 for _, c, _ in cols)
    doc = layouts.build_layout(trimmed, ["hole", "floor"], "2026-01-01").first()
    assert doc.grid.asDict() == {"rows": 3, "cols": 3} and doc.cells[0].number == 2001
    assert layouts.trim_columns(layouts.filter_unit_range(cells, 1, 2), ["hole", "floor"]).count() == 0


def test_layout_files_round_trip(spark, tmp_path):
    from floorlens.sources import sinks

    df = spark.createDataFrame([("A", "2 F", GRID)], "hole string, floor string, text string")
    docs = layouts.build_layout(layouts.parse_layout_grid(df), ["hole", "floor"], "2026-01-01")
    sinks.write_layouts(layouts.with_slugs(docs), str(tmp_path / "l"))
    back = readers.read_layouts(spark, str(tmp_path / "l"))
    row = layouts.validate_layouts(layouts.upgrade_layouts(back), hole="A", floor="1F").first()
    assert row.problems == ["other floor"] and "floor_slug=2-f" in row.file
    assert readers.layout_floors(back).first().floors == ["2 F"]


def card(unit, diff, tail=""):
    return (
        f'<div class="wp-block-column is-vertically-aligned-top"><p class="has-text-align-center"><strong><font>{unit}</font></strong></p>'
        f"<table><tbody><tr><th>差枚</th><th>G数</th><th>BB</th><th>RB</th><th>合成</th></tr>"
        f"<tr><td>{diff}</td><td>1,000</td><td>1</td><td>2</td><td>1/300</td></tr></tbody></table>{tail}</div>"
    )


SUMMARY = (
    '<table class="table2"><thead><tr>' + "".join(f"<th>{h}</th>" for h in ("台番", "差枚", "G数", "BB", "RB", "合成"))
    + "</tr></thead><tbody><tr><td>101</td><td>+2,000</td><td>5,000</td><td>9</td><td>8</td><td>1/99</td></tr>"
    "<tr><td>103</td><td>-10</td><td>7</td><td>0</td><td>0</td><td>-</td></tr>"
    "<tr><td>平均</td><td>1</td><td>1</td><td>1</td><td>1</td><td>1</td></tr></tbody></table>"
)
OTHER = '<table class="table2"><tr><th>台番</th><th>差枚</th></tr><tr><td>999</td><td>1</td></tr></table>'


def test_units_of_a_page(spark):
    html = "<html><body>" + card(101, "1,500", "<script>x={data: [0, 5,-7, x]}</script>") + card(102, "-3") + SUMMARY + OTHER
    df = spark.createDataFrame([("p1", html), ("p2", None), ("p3", "<div><table><tr><td>1")], "page string, html string")
    got = {r.machine_number: r for r in pages.extract_units(df, ["page"]).collect()}
    assert set(got) == {101, 102, 103}
    assert (got[101].diff, got[101].game, got[101].big, got[101].win, got[101].graph_data) == (2000, 5000, 9, 1, [0, 5, -7])
    assert (got[102].diff, got[102].game, got[102].win, got[102].graph_data) == (-3, 1000, 0, [])
    assert got[103].combined_rate == "-"


def test_model_links(spark):
    html = '<a href="kishu/?kishu=L%2BA">L+A</a><a href="other">x</a><a class="c" href="kishu/?kishu=B%20C"> <b>B C</b></a>'
    got = pages.extract_models(spark.createDataFrame([(1, html)], "id int, html string")).orderBy("position").collect()
    assert [(r.name, r.encoded_name, r.decoded_name) for r in got] == [("L+A", "L%2BA", "L+A"), ("B C", "B%20C", "B C")]


def test_whole_numbers_of_texts(spark):
    """The short way for plain numbers gives what the patterns give."""
    texts = ["+1,200", "-1,200", "++7", "+-5", " 12 ", "12\n", "1,2,3", "12.5", "x1", "", None, "-", "+", ",5", "9" * 30, "\x0112", "5 x"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(clean_int(F.col("t"))).collect()]
    assert got == [1200, -1200, 7, -5, 12, 12, 123, 12, None, None, None, None, None, 5, None, None, 5]


def test_pages_without_units_give_no_rows(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "<table></td></div><p>")], "page int, html string")
    assert pages.extract_units(df, ["page"]).collect() == []
    assert pages.extract_tokens(df.repartition(1)).columns[0] == "page"
