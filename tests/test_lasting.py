"""Quantiles by ranges, answers that last, leases, batches that come twice, and sheets."""

import json
import random
import time
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from parlance.operators import model_map, report
from parlance.plans import jobs as plans
from parlance.sources import readers
from parlance.streaming import jobs

FAST = model_map.Limits(per_second=0, pause=0.0, tries=1)


@pytest.mark.parametrize("held", [3, 100_000])
def test_quantiles_are_exact(spark, held):
    r = random.Random(held)
    groups = {"a": [r.gauss(0, 9) for _ in range(900)], "b": [float(r.randrange(5)) for _ in range(400)], "c": [7.5], None: [1.0, 2.0], "none": [None]}
    groups["a"] += [1e9] * 300 + [None] * 20
    rows = [(g, x, "n") for g, v in groups.items() for x in v]
    r.shuffle(rows)
    shares = {"least": 0.0, "q1": 0.1, "q5": 0.5, "q9": 0.9, "most": 1.0}
    got = {x["g"]: x for x in report.quantiles(spark.createDataFrame(rows, "g string, v double, _n string").repartition(5), ["g"], "v", shares, held).collect()}
    assert set(got) == set(groups)
    for g, v in groups.items():
        known = [x for x in v if x is not None]
        for name, q in shares.items():
            assert got[g][name] == (pytest.approx(np.quantile(known, q), rel=1e-12, abs=1e-12) if known else None)
    assert report.quantiles(spark.createDataFrame([], "g string, v double"), ["g"], "v", shares).count() == 0


def test_quantile_plan_has_no_percentile(spark, capsys):
    df = spark.createDataFrame([("a", 1.0, "t")], "g string, v double, t string")
    report.daily_report(df, "t", F.col("t"), "g").explain()
    report.metrics_report(df, "g", [], "t").explain()
    assert "percentile(" not in capsys.readouterr().out


class Counted:
    """Writes each question down before it answers."""

    def __init__(self, path, fails=""):
        self.path, self.fails = path, fails

    def ask(self, prompt):
        with open(self.path, "a") as out:
            out.write(json.dumps(prompt) + "\n")
        if self.fails and self.fails in prompt:
            raise ConnectionError("no answer")
        return f"re: {prompt}"


def asked(path):
    return [json.loads(x) for x in path.read_text().splitlines()] if path.exists() else []


def test_answers_last(spark, tmp_path):
    log = tmp_path / "log"
    df = spark.createDataFrame([(i, f"p{i % 7}" if i < 20 else None) for i in range(21)], "row_id int, prompt string")
    make = lambda: Counted(str(log))
    store = model_map.Answers(spark, f"file://{tmp_path}/store", chunk=3)
    out = store.ask(df, make, "m", limits=FAST)
    for _ in range(2):  # a second action asks no more
        assert {r["row_id"]: r["response"] for r in out.collect()} == {i: f"re: p{i % 7}" for i in range(20)}
    assert sorted(asked(log)) == [f"p{i}" for i in range(7)]
    # Neither does another job, but for what is new, nor a model for another's answers.
    more = df.union(spark.createDataFrame([(30, "new")], df.schema))
    assert model_map.Answers(spark, f"file://{tmp_path}/store").ask(more, make, "m", limits=FAST).count() == 21
    assert len(asked(log)) == 8
    both = model_map.by_models(df, {"m": make, "n": make}, limits=FAST, store=store)
    assert both.count() == both.count() == 40 and len(asked(log)) == 15


def test_failures_are_asked_again(spark, tmp_path):
    log = tmp_path / "log"
    df = spark.createDataFrame([(1, "good"), (2, "bad")], "row_id int, prompt string")
    store = model_map.Answers(spark, f"file://{tmp_path}/store")
    first = {r["row_id"]: r["response"] for r in store.ask(df, lambda: Counted(str(log), "bad"), "m", limits=FAST, rounds=2).collect()}
    assert first == {1: "re: good", 2: "<|wrong data|>"} and sorted(asked(log)) == ["bad", "bad", "good"]
    again = {r["row_id"]: r["response"] for r in store.ask(df, lambda: Counted(str(log)), "m", limits=FAST).collect()}
    assert again == {1: "re: good", 2: "re: bad"} and len(asked(log)) == 4


def test_a_job_that_dies_midway_repeats_one_chunk(spark, tmp_path):
    log = tmp_path / "log"
    df = spark.createDataFrame([(i, f"p{i}") for i in range(60)], "row_id int, prompt string")

    class Dies(Counted):
        def ask(self, prompt):
            if len(asked(log)) >= 40 and not (tmp_path / "died").exists():
                (tmp_path / "died").touch()
                raise SystemExit("lost")
            return super().ask(prompt)

    store = model_map.Answers(spark, f"file://{tmp_path}/store", chunk=10)
    with pytest.raises(Exception):  # noqa: B017
        store.ask(df, lambda: Dies(str(log)), "m", limits=FAST).collect()
    assert store.ask(df, lambda: Counted(str(log)), "m", limits=FAST).filter("response like 're: %'").count() == 60
    assert set(asked(log)) == {f"p{i}" for i in range(60)} and len(asked(log)) <= 60 + 25


def test_evaluation_asks_each_once(spark, tmp_path):
    log = tmp_path / "log"

    class Judge(Counted):
        def ask(self, prompt):
            super().ask(prompt)
            return "准确性：【1】兜底 是否为兜底回复：【0】{{1}}"

    df = spark.createDataFrame([(i, f"p{i}", f"c{i}") for i in range(6)], "row_id int, p string, c string")
    out = plans.filtered(df, {"a": lambda: Judge(str(log)), "b": lambda: Judge(str(log))}, {"a2": lambda: Judge(str(log))}, "p", "c", FAST)
    out.count()
    out.count()
    assert len(asked(log)) == len(set(asked(log))) + 6  # two models have the same six questions


def test_two_steps(spark, tmp_path):
    df = spark.createDataFrame([(1, "why"), (2, "bad")], "row_id int, q string")
    log = tmp_path / "log"
    got = {r["row_id"]: r for r in model_map.two_step(df, lambda: Counted(str(log), "bad"), "q", limits=FAST).collect()}
    assert got[1]["strategy"].startswith("re: ") and got[1]["strategy"] in got[1]["answer"] and "why" in got[1]["answer"]
    assert got[2]["strategy"] == got[2]["answer"] == "<|wrong data|>"
    assert sum("按策略回答" in x for x in asked(log)) == 1


# --- leases -----------------------------------------------------------------------------------


def test_a_killed_job_is_taken_over(spark, tmp_path):
    folder = f"file://{tmp_path}/jobs"
    files = jobs._Files(spark, f"{folder}/2024-05-06")
    files.store.mkdirs(files.at(""))
    dead = jobs.Lease(files, "raw", 2.0)
    assert dead.take()
    dead._stop.set()  # the driver is gone: nobody renews
    assert jobs.run_once(spark, folder, "raw", "2024-05-06", lambda: None, lease=2.0) == "running"
    time.sleep(3.2)
    ran = []
    assert jobs.run_once(spark, folder, "raw", "2024-05-06", lambda: ran.append(1), lease=2.0) == "done" and ran == [1]
    assert not dead.held() and jobs.run_once(spark, folder, "raw", "2024-05-06", lambda: ran.append(2), lease=2.0) == "earlier"


def test_a_long_job_keeps_its_lease(spark, tmp_path):
    folder, seen = f"file://{tmp_path}/jobs", []

    def work():
        for _ in range(3):
            time.sleep(1.5)
            seen.append(jobs.run_once(spark, folder, "raw", "d", lambda: seen.append("both"), lease=2.0))

    assert jobs.run_once(spark, folder, "raw", "d", work, lease=2.0) == "done" and seen == ["running"] * 3


def test_a_job_taken_for_dead_knows(spark, tmp_path):
    folder = f"file://{tmp_path}/jobs"

    def work(held):
        assert held()
        files = jobs._Files(spark, f"{folder}/d")
        files.make("raw.lock.000000002")
        files.write("raw.lock.000000002", "another")
        assert not held()

    assert jobs.run_once(spark, folder, "raw", "d", work, lease=60) == "lost"
    assert not jobs._Files(spark, f"{folder}/d").has("raw.done")
    assert jobs.run_once(spark, folder, "raw", "d", lambda: None, lease=60) == "running"


def test_of_many_that_start_one_runs(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    def work():
        time.sleep(1)

    with ThreadPoolExecutor(6) as pool:
        said = list(pool.map(lambda _: jobs.run_once(spark, f"file://{tmp_path}", "raw", "d", work, lease=30), range(6)))
    assert said.count("done") == 1 and set(said) <= {"done", "running", "earlier"}


# --- batches that come twice ------------------------------------------------------------------


@pytest.mark.parametrize("form", ["parquet", "json"])
def test_each_row_once(spark, tmp_path, form):
    source, out = str(tmp_path / "in"), f"file://{tmp_path}/out"
    write = jobs.append_once(spark, out, "s1", form)
    stops = iter((True, False, False))

    def stopped_between(batch, number):
        write(batch, number)
        if next(stops, False):
            raise RuntimeError("stopped between write and checkpoint")

    assert jobs.appended(spark, out, "x long", form).count() == 0
    spark.range(5).withColumnRenamed("id", "x").write.mode("append").parquet(source)
    with pytest.raises(Exception, match="stopped"):
        jobs.new_days(spark, source, "x long", str(tmp_path / "ck"), stopped_between)
    assert jobs.appended(spark, out, "x long", form).count() == 5
    spark.range(5, 9).withColumnRenamed("id", "x").write.mode("append").parquet(source)
    for _ in range(2):
        jobs.new_days(spark, source, "x long", str(tmp_path / "ck"), stopped_between)
    assert sorted(r["x"] for r in jobs.appended(spark, out, "x long", form).collect()) == list(range(9))
    # What was broken off is not read, and is replaced when it comes again.
    broken = tmp_path / "out" / "stream=s1" / "batch=7"
    broken.mkdir()
    (broken / f"part-0.{form}").write_text('{"x": 77}' if form == "json" else "broken")
    assert jobs.appended(spark, out, "x long", form).count() == 9
    write(spark.range(1).withColumnRenamed("id", "x"), 7)
    write(spark.range(100).withColumnRenamed("id", "x"), 7)
    assert jobs.appended(spark, out, "x long", form).filter("batch = 7").count() == 1


# --- sheets -------------------------------------------------------------------------------------

MAIN = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'


def workbook(path, sheets, shared=()):
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
        names = "".join(f'<sheet name="{n}" sheetId="{k}" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships" r:id="rId{k}"/>' for k, (n, _) in enumerate(sheets, 1))
        out.writestr("xl/workbook.xml", f"<workbook {MAIN}><sheets>{names}</sheets></workbook>")
        links = "".join(f'<Relationship Id="rId{k}" Target="worksheets/sheet{k}.xml"/>' for k in range(1, len(sheets) + 1))
        out.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">{links}</Relationships>')
        out.writestr("xl/sharedStrings.xml", f"<sst {MAIN}>" + "".join(f"<si>{s}</si>" for s in shared) + "</sst>")
        for k, (_, rows) in enumerate(sheets, 1):
            out.writestr(f"xl/worksheets/sheet{k}.xml", f"<worksheet {MAIN}><sheetData>{rows}</sheetData></worksheet>")


def test_sheets(spark, tmp_path):
    path = str(tmp_path / "a b.xlsx")
    rows = '<row r="1"><c r="A1" t="s"><v>0</v></c><c r="C1" t="inlineStr"><is><t>n</t></is></c></row><row r="2"><c r="A2" t="s"><v>1</v></c><c r="B2"><v>1.5</v></c><c r="C2"><v>3</v></c></row>'
    rows += '<row r="4"><c r="B4" t="b"><v>1</v></c><c r="C4" t="str"><f>x</f><v>made</v></c></row>'
    many = "".join(f'<row><c t="inlineStr"><is><t>v{i}</t></is></c></row>' for i in range(5001))
    workbook(path, [("first", rows), ("long", many)], ["<t>name</t>", "<r><t>二 </t></r><r><t>runs</t></r><rPh><t>no</t></rPh>"])
    df = readers.read_table(spark, path)
    assert df.columns == ["name", "Unnamed: 1", "n"]
    assert [tuple(r) for r in df.collect()] == [("二 runs", "1.5", "3"), ("", "", ""), ("", "True", "made")]
    long = readers.read_sheet(spark, path, "long")
    assert long.columns == ["v0"] and long.count() == long.distinct().count() == 5000
    (tmp_path / "csv.xlsx").write_text('﻿a,b\n"x\ny",\n,"q""r"\n', encoding="utf-8")
    assert [tuple(r) for r in readers.read_sheet(spark, str(tmp_path / "csv.xlsx")).collect()] == [("x\ny", ""), ("", 'q"r')]
