import json

from conftest import at, table

from feedlens.operators.normalize import normalize
from feedlens.operators.quality import rejected_rows
from feedlens.schema import BRONZE_COLS, RAW_SCHEMA, FeedConfig
from feedlens.sources.files import preview_json, read_drop, write_json


def drop(folder, **files):
    for name, content in files.items():
        (folder / name.replace("__", ".")).write_text(content, encoding="utf-8")
    return str(folder)


def test_json_types_and_corrupt_lines(spark, tmp_path):
    lines = [
        json.dumps({"item_id": "a", "text": "one", "reactions": 3, "extra": 1}),
        json.dumps({"item_id": "b", "text": "two", "reactions": "4", "comments": 2.5}),
        '{"item_id": "c", "text": ',
    ]
    rows = read_drop(spark, drop(tmp_path, x__jsonl="\n".join(lines)))
    assert rows.columns == RAW_SCHEMA.fieldNames()
    assert table(rows, "item_id", "reactions", "comments") == [
        ("a", 3, None), ("b", None, None), (None, None, None)]
    assert tuple(rejected_rows(rows).first()) == (1, 3)
    done = normalize(rows, FeedConfig(), at("2026-01-01"))
    assert table(done, "item_id", "reactions", "comments") == [("a", 3, 0), ("b", 0, 0)]


def test_csv_by_name_in_any_order(spark, tmp_path):
    folder = drop(
        tmp_path,
        a__csv='text,source\n"hello, ""you""\nthere",sample\n',
        b__csv="source,item_id,text,reactions,other\nfile,7,plain,12,zz\nfile,8,odd,many,zz\n",
        c__csv="text\nonly text\n", d__csv="")
    rows = read_drop(spark, folder)
    assert rows.columns == RAW_SCHEMA.fieldNames()
    assert table(rows, "item_id", "text", "source", "reactions") == [
        ("7", "plain", "file", 12), ("8", "odd", "file", None),
        (None, 'hello, "you"\nthere', "sample", None), (None, "only text", None, None)]


def test_many_csv_files_take_a_fixed_number_of_jobs(spark, tmp_path):
    headers = ("text,item_id", "item_id,text,extra", "TEXT ,lang,item_id")
    values = {0: "t{0},{0}", 1: "{0},t{0},x", 2: "t{0},en,{0}"}
    jobs = {}
    for count in (40, 80):
        folder = tmp_path / str(count)
        folder.mkdir()
        for k in range(count):
            (folder / f"{k}.csv").write_text(f"{headers[k % 3]}\n{values[k % 3].format(k)}\n")
        spark.sparkContext.setJobGroup(f"csv-{count}", "reading")
        rows = read_drop(spark, str(folder))
        assert table(rows, "item_id", "text") == sorted((str(k), f"t{k}") for k in range(count))
        jobs[count] = len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"csv-{count}"))
    spark.sparkContext.setJobGroup("", "")
    assert jobs[80] <= jobs[40] + 1


def test_json_and_csv_together_other_files_left_out(spark, tmp_path):
    folder = drop(tmp_path, a__json='{"text": "j"}', b__csv="text\nc\n", c__txt="text\nt\n",
                  d__CSV="text\nupper\n")
    (tmp_path / "sub").mkdir()
    drop(tmp_path / "sub", e__json='{"text": "deep"}')
    assert table(read_drop(spark, folder), "text") == [("c",), ("j",)]


def test_odd_file_names(spark, tmp_path):
    (tmp_path / "a [1] {x} 100%.json").write_text('{"text": "j"}')
    (tmp_path / "b (2) *.csv").write_text("text\nc\n")
    assert table(read_drop(spark, str(tmp_path)), "text") == [("c",), ("j",)]


def test_empty_folder(spark, tmp_path):
    rows = read_drop(spark, str(tmp_path))
    assert rows.schema == RAW_SCHEMA and rows.count() == 0
    assert normalize(rows, FeedConfig(), at("2026-01-01")).columns == list(BRONZE_COLS)


def test_preview_and_json_round_trip(spark, feed, tmp_path):
    rows = feed(*[{"item_id": f"i{k:02d}", "text": f"text {k}"} for k in range(12)])
    write_json(rows, str(tmp_path / "out"))
    shown = preview_json(spark, str(tmp_path / "out"))
    assert shown.columns == ["item_id", "item_type", "lang", "text"]
    assert [r["item_id"] for r in shown.collect()] == [f"i{k:02d}" for k in range(10)]
    assert table(read_drop(spark, str(tmp_path / "out")), "item_id", "text") == \
        table(rows, "item_id", "text")


def test_rejects_of_both_formats_and_their_causes(spark, tmp_path):
    from feedlens.operators.quality import counting_rejects, reject_report
    from feedlens.sources.files import list_drop, read_paths

    folder = drop(tmp_path, a__json='{"text": "j", "item_id": "1", "reactions": "many"}\n{broken\n'
                                    '{"item_id": "2", "text": " "}\n{"text": "no key"}\n',
                  b__csv="text,item_id,reactions\nc,3,x7\nd,4,8\n,5,1\n")
    rows = read_paths(spark, list_drop(spark, folder), rejects=True)
    expected = [("corrupt_line", 1), ("no_key", 1), ("no_text", 2), ("wrong_type", 2)]
    assert table(reject_report(rows)) == expected
    taken, seen = counting_rejects(rows)
    taken.write.format("noop").mode("overwrite").save()
    assert sorted(seen.get.items()) == expected
    assert taken.columns == read_drop(spark, folder).columns
    assert table(taken) == table(read_drop(spark, folder))
    only_text = drop(tmp_path / "x", **{}) if (tmp_path / "x").mkdir() is None else None
    assert read_paths(spark, list_drop(spark, only_text), rejects=True).count() == 0
