"""Readers keep every valid record; the session takes its cluster's settings."""
import gzip
import os
import subprocess
import sys

import pytest
from pyspark.sql import types as T

from jobsift.session import scratch_path
from jobsift.sinks import writers
from jobsift.sources import files

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("salary_min", T.DoubleType()), T.StructField("area", T.ArrayType(T.StringType())),
                       T.StructField("company", T.StructType([T.StructField("display_name", T.StringType())])), T.StructField("extra", T.StringType())])


def folder(spark, name, **texts):
    path = scratch_path(spark, name).replace("file:", "")
    for f, t in texts.items():
        f = f"{path}/{f.replace('__', '.')}"
        os.makedirs(os.path.dirname(f), exist_ok=True)
        with open(f, "wb") as out:
            out.write(t if isinstance(t, bytes) else t.encode())
    return path


def test_mistyped_fields_cost_no_record(spark):
    path = folder(spark, "loose", a__jsonl='{"id":1,"salary_min":40000,"area":["France","Paris"],"company":{"display_name":"A"}}\n'
                  '{"id":"2","salary_min":"40000","area":"France","company":"B","extra":{"k":[1,"x"]}}\n\n'
                  '{"id":null,"salary_min":"n/a","area":[1,null],"other":true}\n{broken\n[1]\n')
    rows = files.scan_jsonl(spark, path, SCHEMA).drop("_file").collect()
    assert sorted([tuple(r) for r in rows], key=str) == sorted([
        (1, 40000.0, ["France", "Paris"], ("A",), None), (2, 40000.0, ["France"], None, '{"k":[1,"x"]}'), (None, None, ["1", None], None, None)], key=str)
    report = files.rejects_report(spark, path).first()
    assert (report["n_good"], report["n_bad"]) == (3, 2)
    kept = files.scan_jsonl(spark, path, SCHEMA, keep_corrupt=True)
    assert sorted(r[0] for r in kept.where("_corrupt is not null").select("_corrupt").collect()) == ["[1]", "{broken"]


def test_documents_and_reports(spark):
    path = folder(spark, "docs", a__json='[{"id":1},\n {"id":"2"}, 3]', b__json='{"id":\n 4}', c__json="not json", d__json=" ")
    assert sorted(r.id for r in files.scan_json_docs(spark, path, SCHEMA).collect()) == [1, 2, 4]
    got = {os.path.basename(r._file): (r.n_good, r.n_bad) for r in files.docs_report(spark, path).collect()}
    assert got == {"a.json": (2, 1), "b.json": (1, 0), "c.json": (0, 1)}


def test_csv_by_header(spark):
    path = folder(spark, "csv kinds", a__csv="job_title,entreprise,ville\r\n\"Data \"\"X\"\"\nEngineer\",ACME,Paris\r\n",
                  b__csv="﻿ville,job_title\nLyon,\" Analyst \"\n", c__csv="ville\n")
    wanted = T.StructType([T.StructField(n, T.StringType()) for n in ("title", "job_title", "entreprise", "ville")])
    rows = files.scan_csv(spark, path, wanted).collect()
    assert sorted(map(tuple, rows), key=str) == sorted([(None, 'Data "X"\nEngineer', "ACME", "Paris"), (None, " Analyst ", None, "Lyon")], key=str)
    assert set(files.scan_csv(spark, path).columns) == {"job_title", "entreprise", "ville"}


def test_csv_round_trip(spark):
    rows = [(1, 'a "quoted", text\nover\r\nlines\\', 1.5), (2, "", None), (3, None, -2.0), (4, "  spaces  ", 0.0), (5, "\\", 1.0)]
    df = spark.createDataFrame(rows, "id long, t string, v double")
    back = files.scan_csv(spark, writers.write_csv(df.repartition(3), scratch_path(spark, "csv_rt")), df.schema)
    assert sorted(map(tuple, back.collect())) == rows


def test_damaged_file_fails_or_is_reported(spark):
    whole = gzip.compress(b'{"id":1}\n' * 50_000)
    path = folder(spark, "damaged", a__jsonl='{"id":7}\n', b__jsonl__gz=whole[:len(whole) // 2])
    with pytest.raises(Exception):
        files.scan_mixed_dir(spark, path, SCHEMA, lines_glob="*.jsonl*").count()
    assert files.scan_mixed_dir(spark, path, SCHEMA, lines_glob="*.jsonl*", skip_unreadable=True).where("id = 7").count() == 1
    assert files.files_report(spark, path, lines_glob="*.jsonl*").count() == 2


def test_snapshot_or_empty_frame(spark):
    empty = scratch_path(spark, "no_snapshot").replace("file:", "")
    os.makedirs(empty)
    got = files.read_snapshot(spark, empty, SCHEMA)
    assert got.count() == 0 and got.schema == SCHEMA


CHILD = """
import sys
from pyspark import SparkConf
from pyspark.sql import SparkSession
from jobsift import session
s = session.build_session()
print("GOT", s.sparkContext.master, s.conf.get("spark.sql.shuffle.partitions"))
class Far:
    def __getattr__(self, name):
        return getattr(s, name)
    class conf:
        get = staticmethod(lambda k, d=None: None if k == "spark.checkpoint.dir" else s.conf.get(k, d))
    class sparkContext:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)
try:
    session.checkpoint_root(Far())
except ValueError as e:
    print("RAISED", e)
"""


def test_command_line_settings_win_and_a_shared_folder_is_asked_for():
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = os.environ | {"PYSPARK_SUBMIT_ARGS": "--master local[2] --conf spark.sql.shuffle.partitions=77 pyspark-shell", "PYTHONPATH": root}
    out = subprocess.run([sys.executable, "-c", CHILD], env=env, capture_output=True, text=True, timeout=120).stdout
    assert "GOT local[2] 77" in out and "RAISED set spark.checkpoint.dir" in out


CELLS = ["", "plain", 'quo"te', "a,b", "line\nend", "cr\r\nlf", '"', '""', "\n", "\n\n,\"", " spaces ", 'x"\n"y', "é\n", "long " * 30, "0"]


def small_ranges(spark, size):
    """Splits of so many bytes; returns what undoes it."""
    keys = {"spark.sql.files.maxPartitionBytes": size, "spark.sql.files.openCostInBytes": 0}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    return lambda: [spark.conf.set(k, v) for k, v in old.items()]


@pytest.mark.parametrize("size", [300, 5000])
def test_csv_inside_a_file_is_read_in_ranges(spark, size):
    """Cells with line ends, commas and quotes across many ranges, cells longer than a range, no quotes at all: as the csv module."""
    import csv
    import random
    from collections import Counter
    rnd = random.Random(size)
    rows = [[str(i), rnd.choice(CELLS), rnd.choice(CELLS)] for i in range(700)] + [["9999", "big\n" * 700, "end"]] + [["x", "y", "z"]]
    path = scratch_path(spark, "ranges").replace("file:", "")
    os.makedirs(path)
    for name, head, some, end in (("a.csv", ["id", "u", "v"], rows, "\r\n"), ("b.csv", ["v", "id"], [[r[2], r[0]] for r in rows], "\n"),
                                  ("c.csv", ["id", "n"], [[str(i), str(i * 7)] for i in range(2000)], "\n"), ("d.csv", ["id"], [], "\n"), ("e.csv", [], [], "\n\n \n")):
        with open(f"{path}/{name}", "w", newline="", encoding="utf-8") as f:
            csv.writer(f, lineterminator=end).writerows([head, *some] if head else [[], []])
    undo = small_ranges(spark, size)
    try:
        df = files.scan_csv(spark, path)
        assert df.rdd.getNumPartitions() > 10
        got = Counter(tuple(r[c] for c in ("id", "u", "v", "n")) for r in df.collect())
    finally:
        undo()
    want = Counter((r[0], r[1] or None, r[2] or None, None) for r in rows) + Counter((r[0], None, r[2] or None, None) for r in rows)
    want += Counter((str(i), None, None, str(i * 7)) for i in range(2000))
    assert got == want


def test_csv_line_functions():
    """Both regular expressions against a plain state machine, and their composition."""
    import random
    import re

    import numpy as np

    from jobsift.sources import csvsplit as cs

    def walk(line, inside):
        state = "q" if inside else "start"
        i = 0
        while i < len(line):
            c = line[i]
            if state == "q":
                if c == '"' and line[i + 1:i + 2] == '"':
                    i += 1
                elif c == '"':
                    state = "text"
            elif c == ",":
                state = "start"
            else:
                state = "q" if state == "start" and c == '"' else "text"
            i += 1
        return state == "q"

    opens, stays = (re.compile(p.replace(r"\z", r"\Z")) for p in (cs._OPENS, cs._STAYS_OPEN))
    rnd = random.Random(1)
    lines = ["".join(rnd.choice('",ab"') for _ in range(rnd.randrange(9))) for _ in range(20000)]
    out, inside = (np.array([f(x) for x in lines]) for f in (lambda x: '"' in x and bool(opens.search(x)), lambda x: '"' not in x or bool(stays.search(x))))
    assert out.tolist() == [walk(x, False) for x in lines] and inside.tolist() == [walk(x, True) for x in lines]
    for first in (False, True):
        want = [first]
        for x in lines[:500]:
            want.append(walk(x, want[-1]))
        assert cs.states(out[:500], inside[:500], first).tolist() == want


@pytest.mark.parametrize("size", [400])
def test_json_documents_in_ranges_equal_whole_files(spark, size):
    """One array over many ranges, with braces, quotes and escapes in its texts, deep entries and entries that are no objects;
    and documents that are no JSON, each in its own way."""
    import json
    import random
    rnd = random.Random(size)
    texts = ["", "}", "{", '"', '\\"', "]}", 'a "quoted}" {text', "\\", "x" * 300, "é}\n", "[[["]
    array = [{"id": i, "extra": rnd.choice(texts), "area": [rnd.choice(texts)], "company": {"display_name": rnd.choice(texts), "deep": {"a": [{"b": {}}]}}} for i in range(60)]
    array[40:40] = [3, "te}xt", None, [1, {"x": {}}], []]
    good = {"a": json.dumps(array), "b": json.dumps(array, indent=1, ensure_ascii=False), "c": json.dumps(array[0]) + "\n ", "d": "[]", "e": " [1, 2 ] ", "f": "﻿[{}]",
            "g": json.dumps([array[1]] * 3) + "\n", "h": '[{"id":1},2]', "i": '[2,{"id":5}]'}
    broken = {"m": good["a"][:-1], "n": good["a"][1:], "o": good["a"].replace("}, {", "} {", 1), "p": good["a"].replace(": ", " ", 1), "q": "[{}]]", "r": '{"id":1}{"id":2}',
              "s": "not json", "t": '[{"id":1},]', "u": '{"id":1', "v": '{"id":1}}', "w": '[,{"id":1}]', "x": '[{"id":1}', "y": '{"id":1}, 2', "z": '[{"id": "}'}
    path = folder(spark, "ranges_json", **{f"{k}__json": t for k, t in (good | broken).items()})
    undo = small_ranges(spark, size)
    try:
        rows = files.scan_json_docs(spark, path, SCHEMA, split_over=0)
        got = sorted(map(str, rows.collect()))
        report = {os.path.basename(r._file): (r.n_good, r.n_bad) for r in files.docs_report(spark, path, split_over=0).collect()}
    finally:
        undo()
    assert got == sorted(map(str, files.scan_json_docs(spark, path, SCHEMA).collect())) and len(got) > 120
    want = {os.path.basename(r._file): (r.n_good, r.n_bad) for r in files.docs_report(spark, path).collect()}
    assert report == want and all(want[f"{k}.json"] == (0, 1) for k in broken)


def test_lines_with_anything_behind_their_object_are_rejects(spark):
    lines = ['{"id":1}', '{"id":2} ', '\t{"id":3}\r', '{"id":4} x', '{"id":5}{"id":6}', '{"id":7}}', '{"id":8},"end":2', '{"id":9},"x":1', "﻿{\"id\":10}", '{"v":1,"end":3,"id":11}', "null", "1"]
    path = folder(spark, "behind", a__jsonl="\n".join(lines))
    assert sorted(r.id for r in files.scan_jsonl(spark, path, SCHEMA).collect()) == [1, 2, 3, 10, 11]
    report = files.rejects_report(spark, path).first()
    assert (report["n_good"], report["n_bad"]) == (5, 7)


def _parsers(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("parseJson")


def test_a_line_is_parsed_once(spark):
    from jobsift.plans import job
    from jobsift.schema import RAW_API
    from jobsift.streaming import ingest
    root = scratch_path(spark, "once")
    spark.createDataFrame([('{"data":{"title":"T"}}',), ("{broken",)], "value string").write.text(root)
    assert _parsers(ingest.parsed(spark.read.text(root), RAW_API)) == 1
    feed = job.load_feed(spark, root, RAW_API)
    assert _parsers(feed) == 1 and [r["title"] for r in feed.collect()] == ["T"]


def test_what_counts_as_an_object(spark):
    from jobsift.sources import lenient
    texts = ["{}", " {\"a\":{\"b\":1}} ", "\ufeff{\"a\":{}}", "{\"a\":null}", "{\"a\":[{\"b\":1}]}", "{\"a\":\"x\"}",
             "null", "[{}]", "\"s\"", "1", "", None, "{} {}", "{},\"v\":{}", "{\"a\":1}, \"x\":1"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, value string")
    got = lenient.records(df, spark.createDataFrame([], "a struct<b int>").schema, corrupt="bad").orderBy("i").collect()
    assert [r["a"] is None or r["a"]["b"] for r in got] == [True, 1, None, *[True] * 12]
    assert [r["bad"] for r in got] == [*[None] * 6, *texts[6:]]
