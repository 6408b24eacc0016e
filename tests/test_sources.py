import pytest
from pyspark.sql import functions as F

from grainmill.functions import text
from grainmill.plans import cars, census
from grainmill.session import checkpoint_folder
from grainmill.sources import readers, stages, writers


def test_checkpoint_folder_is_the_session_setting(spark):
    assert checkpoint_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_car_flow_keeps_the_first_row_in_reading_order(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "cars1.csv").write_text("car_model,year_of_manufacture,price,fuel\nritz,2014,5000.126,Petrol\nsx4,2013,7089.55,Diesel\n")
    (tmp_path / "in" / "cars2.csv").write_text("car_model,year_of_manufacture,price,fuel\nritz,2011,1.0,Petrol\n")
    (tmp_path / "in" / "cars1.json").write_text('{"car_model":"ciaz","year_of_manufacture":2017,"price":10820.9,"fuel":"Petrol"}\n{"car_model":"sx4","year_of_manufacture":1,"price":2.0,"fuel":"Diesel"}\n')
    (tmp_path / "in" / "cars1.xml").write_text(
        "<data><row><car_model>swift</car_model><year_of_manufacture>2014</year_of_manufacture><price>6865.671</price><fuel>Diesel</fuel></row>"
        "<row><car_model>ciaz</car_model><year_of_manufacture>2</year_of_manufacture><price>3.0</price><fuel>Petrol</fuel></row></data>"
    )
    loaded = cars.etl(spark, str(tmp_path / "in"), str(tmp_path / "staged"), "cars_loaded")
    got = {r["car_model"]: (r["year_of_manufacture"], r["price"]) for r in loaded.collect()}
    assert got == {"ritz": (2014, 5000.13), "sx4": (2013, 7089.55), "ciaz": (2017, 10820.9), "swift": (2014, 6865.67)}
    assert "cars_loaded" in [r["table_name"] for r in readers.list_tables(spark).collect()]


def test_bad_xml_number_raises(spark, tmp_path):
    (tmp_path / "a.xml").write_text("<data><row><n>many</n></row></data>")
    with pytest.raises(Exception):
        readers.read_xml(spark, str(tmp_path / "a.xml"), "n int").collect()


def test_json_array_file(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"n": 1},\n {"n": 2}]')
    assert sorted(r["n"] for r in readers.read_json(spark, str(tmp_path / "a.json"), "n int", array_files=True).collect()) == [1, 2]


def test_census_flow(spark, tmp_path):
    line = "{age}, State-gov, {weight}, Bachelors, 13, {status}, ?, Husband, White, Male, {gain}, 0, 40, United-States, <=50K\n"
    rows = [line.format(age=39, weight=77516, status="Never-married", gain=100), line.format(age=50, weight=83311, status="Divorced", gain=0),
            line.format(age="", weight=1, status="Divorced", gain=7), line.format(age=30, weight=2, status="Separated", gain=4)]
    (tmp_path / "census.csv").write_text("".join(rows))
    found = census.census_flow(spark, str(tmp_path / "*.csv"))
    assert found["missing"].first()["age"] == 1 and found["missing"].first()["occupation"] == 0
    first = found["features"].filter("age = 39").first()
    assert first["occupation"] == "?" and first["fnlwgt_x_fnlwgt"] == 77516**2 and first["age_x_fnlwgt"] == 39 * 77516
    assert len(found["features"].columns) == 15 + 21
    assert {r[0]: r[1] for r in found["average_gain"].collect()} == {"Never-married": 100.0, "Divorced": 0.0, "Separated": 4.0}
    joined = found["joined"].select("marital_status", "marital_status_statistics").collect()
    assert {tuple(r) for r in joined} == {
        ("Never-married", "Never-married"), ("Divorced", "Divorced"), ("Separated", None), (None, "Married-AF-spouse"), (None, "Widowed"),
    }


def test_stage_names_and_replaced_input(spark):
    spark.range(10).write.mode("overwrite").saveAsTable("numbers")
    spark.range(3).write.mode("overwrite").saveAsTable("other")

    @stages.table_stage(["numbers", "other"], "numbers")
    def shrink(frames):
        numbers, other = frames
        return {"tables": {"numbers": numbers.join(other, "id"), "kept": other}, "answer": 42}

    assert shrink(spark) == {"answer": 42}
    assert spark.table("numbers").count() == 3 and spark.table("kept").count() == 3
    assert {"numbers", "kept"} <= {r[0] for r in readers.list_tables(spark).collect()}
    assert not [r[0] for r in readers.list_tables(spark).collect() if "__" in r[0]]
    with pytest.raises(ValueError):
        stages.table_stage(None)


def test_stage_may_drop_a_table_without_writing(spark):
    spark.range(2).write.mode("overwrite").saveAsTable("gone")
    stages.table_stage("gone", "gone")(lambda frame: {"n": frame.count()})(spark)
    assert not spark.catalog.tableExists("gone")


def test_small_result_guards(spark, tmp_path):
    with pytest.raises(ValueError):
        writers.to_driver(spark.range(11), 10)
    with pytest.raises(ValueError):
        writers.write_csv_single(spark.range(11), str(tmp_path / "x"), 10)
    writers.write_csv_single(spark.range(10), str(tmp_path / "y"), 10)
    assert len(list((tmp_path / "y").glob("part-*.csv"))) == 1


def test_jdbc_options():
    assert readers.jdbc_options("jdbc:x", "t", "id", 0, 100, 8)["numPartitions"] == "8"
    with pytest.raises(ValueError):
        readers.jdbc_options("jdbc:x", "t", "id")


def test_word_count_lines(spark, tmp_path):
    (tmp_path / "a.txt").write_text("The cat the  cat\nit's The\n\nThe")
    counted = text.word_counts(readers.read_text(spark, str(tmp_path)), minimum=None)
    assert {r["word"]: r["n"] for r in counted.collect()} == {"The": 3, "cat": 2, "the": 1, "": 2, "it's": 1}
    writers.write_text(counted, str(tmp_path / "out"), writers.pair_line())
    got = {r["value"] for r in readers.read_text(spark, str(tmp_path / "out")).collect()}
    assert got == {repr(p) for p in [("The", 3), ("cat", 2), ("the", 1), ("", 2), ("it's", 1)]}
    assert {r["word"] for r in text.word_counts(readers.read_text(spark, str(tmp_path / "a.txt"))).collect()} == {"The"}


def test_html_table_by_caption(spark):
    row = "<tr><th> 18–24 </th><td>9.5</td><td>1</td><td>2</td><td><b>x</b> 7.5 </td><td>3</td><td>4</td><td>ignored</td></tr>"
    page = f"<table><caption>Other</caption><tbody>{row}</tbody></table><table class='a'><caption>Daily smokers &amp; more</caption><tbody>{row}<tr><td>N/A</td></tr></tbody></table>"
    df = spark.createDataFrame([(1, page)], "id int, html string")
    found = text.table_rows(df, "id", "html", "Daily smokers & more", 6).orderBy("row_no").collect()
    assert [(r["table_no"], r["header"]) for r in found] == [(1, "18–24"), (1, "N/A")]
    assert found[0]["cells"] == ["9.5", "1", "2", "7.5", "3", "4"] and found[1]["cells"] == ["N/A"] * 6
    rates = text.table_rates(text.table_rows(df, "id", "html", "Daily", 6), "id").collect()
    assert (rates[0]["male_rate"], rates[0]["female_rate"]) == (0.095, 0.075) and rates[1]["male_rate"] is None


def test_list_item_rates(spark):
    page = "<ul><li>15.0% of adult men</li><li>About 10.0% of adult women</li><li>Nearly 5.0% of adults aged 18–24 years</li><li>no rate</li></ul>"
    items = text.list_items(spark.createDataFrame([(1, page)], "id int, html string"), "id", "html")
    row = text.item_rates(items, "id").first()
    assert (row["label"], round(row["male_rate"], 6), round(row["female_rate"], 6)) == ("18–24 years", 0.075, 0.05)
    assert [r["n"] for r in items.select(text.first_group(F.col("text"), text.DECIMAL_PATTERN).alias("n")).collect()][-1] is None


def test_html_as_authors_write_it(spark):
    pages = [
        "<ul><li>18&ndash;24 years<li>25&#8211;44<li>three</ul>",
        "<ul><li>outer<ul><li>inner a</li><li>inner b</ul> rest</li><!-- <li>gone</li> --><li><b>bold</b> own</li></ul><li>alone",
        "<table><caption>Some <b>x</b></caption><thead><tr><th>no</thead><tr><th>a<td>1<td>2<tr><td><table><tr><td>in</table>out</table>",
        None,
        "<ul><li title='a > b'>ok</li><script>'<li>no</li>'</script></ul>" + "<b>" * 3000,
    ]
    df = spark.createDataFrame(list(enumerate(pages)), "id int, html string")
    listed = {}
    for r in sorted(text.list_items(df, "id", "html").collect()):
        listed.setdefault(r["id"], []).append(r["text"])
    assert listed == {0: ["18–24 years", "25–44", "three"], 1: ["outer rest", "inner a", "inner b", "bold own", "alone"], 4: ["ok"]}
    own = [r["text"] for r in text.list_items(df.filter("id = 1"), "id", "html", own=True).orderBy("item_no").collect()]
    assert own == ["outer", "inner a", "inner b", "own", "alone"]
    rows = text.table_rows(df, "id", "html", "Some").orderBy("row_no").collect()
    assert [(r["table_no"], r["row_no"], r["header"], r["cells"]) for r in rows] == [(0, 0, "a", ["1", "2"]), (0, 1, "N/A", ["out"])]


def test_folder_with_some_formats(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "k int, s string")
    df.write.option("header", True).csv(str(tmp_path / "x" / "a.csv"))
    assert [(r["k"], r["source_rank"]) for r in readers.read_folder(spark, str(tmp_path / "x"), "k int, s string").collect()] == [(1, 0)]
    (tmp_path / "y").mkdir()
    with pytest.raises(FileNotFoundError):
        readers.read_folder(spark, str(tmp_path / "y"), "k int, s string")


def test_failing_stage_leaves_tables_as_they_were(spark):
    from grainmill.sources.stages import table_stage

    spark.sql("DROP TABLE IF EXISTS stage_in")
    spark.range(3).write.saveAsTable("stage_in")
    before = {r[0] for r in readers.list_tables(spark).collect()}

    @table_stage("stage_in", "stage_in")
    def failing(frame):
        return {"tables": {"stage_in": frame.limit(1), "stage_out": frame.select(F.raise_error(F.lit("no")).alias("x"))}}

    with pytest.raises(Exception, match="no"):
        failing(spark)
    assert {r[0] for r in readers.list_tables(spark).collect()} == before and spark.table("stage_in").count() == 3

    @table_stage("stage_in", "stage_in")
    def halved(frame):
        return {"tables": {"stage_in": frame.limit(1)}}

    halved(spark)
    assert {r[0] for r in readers.list_tables(spark).collect()} == before and spark.table("stage_in").count() == 1
    table_stage("stage_in", "stage_in")(lambda frame: {})(spark)
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("stage_in")]


def test_readers_find_a_table_at_every_step(spark, monkeypatch):
    """At each change of the catalog, before and after it, the old rows or the new ones are there."""
    spark.range(3).write.saveAsTable("steps_a")
    seen, statements, run = [], [], stages._run

    def watched(session, statement):
        for moment in (lambda: run(session, statement), lambda: None):
            seen.append(tuple(spark.table(n).count() if spark.catalog.tableExists(n) else None for n in ("steps_a", "steps_b")))
            moment()
        statements.append(statement)

    monkeypatch.setattr(stages, "_run", watched)
    for n in range(4, 8):
        stages.replace_tables(spark, {"steps_a": spark.range(n), "steps_b": spark.range(n)})
        assert spark.table("steps_a").count() == spark.table("steps_b").count() == n
    assert all(a is not None for a, _ in seen)
    assert [a for a, _ in seen] == sorted(a for a, _ in seen)  # never back to older rows
    assert len([t.name for t in spark.catalog.listTables() if stages.VERSION.search(t.name)]) >= 4  # the previous versions are kept
    writers.write_table(spark.range(9), "steps_a")
    assert spark.table("steps_a").count() == 9
    stages.replace_tables(spark, {}, ["steps_a", "steps_b"])
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("steps_")]


@pytest.mark.parametrize("first", [True, False])
def test_a_failure_at_any_step_leaves_the_old_tables(spark, monkeypatch, first):
    """With plain tables at first, and with views of an earlier stage."""
    run, at = stages._run, 0
    while True:
        names = [f"fails_{first}_{at}_a".lower(), f"fails_{first}_{at}_b".lower(), f"fails_{first}_{at}_c".lower()]
        for n in names[:2]:
            spark.range(3).write.saveAsTable(n)
        if not first:
            stages.replace_tables(spark, {n: spark.range(3) for n in names[:2]})
        calls = 0

        def failing(session, statement, at=at):
            nonlocal calls
            calls += 1
            if calls == at + 1 and not statement.startswith("DROP"):
                raise RuntimeError("no")
            run(session, statement)

        monkeypatch.setattr(stages, "_run", failing)
        try:
            stages.replace_tables(spark, {n: spark.range(5) for n in names})
            failed = False
        except RuntimeError:
            failed = True
        monkeypatch.setattr(stages, "_run", run)
        assert [spark.table(n).count() for n in names[:2]] == ([3, 3] if failed else [5, 5])
        assert spark.catalog.tableExists(names[2]) == (not failed)
        stages.replace_tables(spark, {}, names)
        if not failed:
            break
        at += 1
    assert at >= 3


def test_folder_for_intermediate_tables(spark, monkeypatch):
    from types import SimpleNamespace

    from grainmill import session

    assert "grainmill-" in session.own_folder(spark)
    cluster = SimpleNamespace(sparkContext=SimpleNamespace(master="spark://x:1"), conf=spark.conf, _jvm=spark._jvm, _jsc=spark._jsc)
    with pytest.raises(ValueError, match="shared folder"):
        session.own_folder(cluster)
