import pytest

from tidewater.sources.evolution import EvolvingTable, merged, misfits


def land(folder, name, text):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text)


def told(table, *columns):
    return sorted((tuple(r[c] for c in columns) for r in table.read().collect()), key=str)


def test_three_landings_with_an_added_a_widened_and_a_broken_column(spark, tmp_path):
    source, mark = tmp_path / "in" / "orders", str(tmp_path / "mark")
    table = EvolvingTable(spark, str(tmp_path / "t"), "erp", multi_line=True, stops=True)
    with pytest.raises(ValueError, match="no schema"):
        table.read()
    land(source / "dt=2024-01-01", "a.csv", "id,amount,day\n1,10,2024-01-01\n2,,2024-01-02\n")
    assert table.ingest(str(source), mark) == 1  # once for the first schema
    assert table.schema().simpleString() == "struct<id:bigint,amount:bigint,day:date>"
    # another order of columns, a new one, wider amounts, and a quoted line feed
    land(source / "dt=2024-01-02", "b.csv", 'note,day,amount,id\n"two\nlines",2024-01-03,7.5,3\n')
    again = EvolvingTable(spark, str(tmp_path / "t"), "erp", multi_line=True, stops=True)  # as after a restart of the driver
    assert again.ingest(str(source), mark) == 1
    assert again.schema().simpleString() == "struct<id:bigint,amount:double,day:date,note:string>"
    # values that fit no column, and a file without one
    land(source / "dt=2024-01-03", "c.csv", "id,amount,day\n4,lots,someday\nx5,1,2024-01-05\n")
    assert again.ingest(str(source), mark) == 0
    assert again.schema(1).simpleString() == "struct<id:bigint,amount:bigint,day:date>" and len(again.log.last()["versions"]) == 2
    assert told(again, "id", "amount", "note") == sorted([(1, 10.0, None), (2, None, None), (3, 7.5, "two\nlines"), (4, None, None), (None, 1.0, None)], key=str)
    assert {r["_rescued_data"] for r in again.read().collect()} == {None, '{"amount":"lots","day":"someday"}', '{"id":"x5"}'}
    assert {(r["_batch_id"], r["_source_system"]) for r in again.read().collect()} == {("0", "erp"), ("1", "erp"), ("2", "erp")}
    # nothing new: nothing happens; an overwritten file isn't read again; a batch that comes again replaces itself
    assert again.ingest(str(source), mark) == 0 and again.read().count() == 5
    again._take(spark.createDataFrame([(str(source / "dt=2024-01-03" / "c.csv"),)], "path string"), 2)
    assert again.read().count() == 5


def test_many_files_in_small_batches(spark, tmp_path):
    source = tmp_path / "in"
    for i in range(6):
        land(source, f"{i}.csv", f"k,{'abc'[i % 3]}\n{i},{i}\n")
    table = EvolvingTable(spark, str(tmp_path / "t"), "crm")
    table.ingest(str(source), str(tmp_path / "mark"), files_per_batch=2)
    assert set(table.schema().fieldNames()) == {"k", "a", "b", "c"}
    assert told(table, "k", "a", "b", "c") == sorted([(i, *[i if i % 3 == j else None for j in range(3)]) for i in range(6)], key=str)


def test_types(spark):
    rows = spark.createDataFrame([("1", "1.5", "true", "2024-01-01", "2024-01-01 10:00:00", "x", None), ("-2", "2", "FALSE", "2024-02-29", "2024-01-02", "1", None)], "a string, b string, c string, d string, e string, f string, g string")
    found = misfits(rows, rows.columns)
    assert merged(None, found).simpleString() == "struct<a:bigint,b:double,c:boolean,d:date,e:timestamp,f:string,g:string>"
    old = merged(None, misfits(rows.selectExpr("a", "d", "f AS s", "a AS n"), ["a", "d", "s", "n"]))
    assert old.simpleString() == "struct<a:bigint,d:date,s:string,n:bigint>"
    # wider where that fits more, though some values fit neither; strings and misfits change nothing
    odd = spark.createDataFrame([("1.5", "2024-01-01 10:00:00", "1", "x", "true"), ("lots", "someday", "2", None, None)], "a string, d string, s string, n string, z string")
    assert merged(old, misfits(odd, odd.columns)).simpleString() == "struct<a:double,d:timestamp,s:string,n:bigint,z:boolean>"
    assert merged(old, misfits(rows.limit(0), [])) == old
