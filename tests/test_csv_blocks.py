import csv
import os
import random

import pytest

from usagelens.sources import employees as E

NAMES = ["email", "full_name", "practice", "level", "location"]


def value(r):
    return "".join(r.choice(['a', 'B', ' ', ',', '"', '\n', '\r\n', 'é', "'", '\\', '']) for _ in range(r.randrange(9)))


def written(path, rows, header=NAMES, end="\r\n", quoting=csv.QUOTE_MINIMAL):
    with open(path, "w", newline="", encoding="utf-8") as f:
        csv.writer(f, lineterminator=end, quoting=quoting).writerows([header, *rows])


def python_rows(path):
    with open(path, newline="", encoding="utf-8") as f:
        return [tuple(d[c].strip() for c in NAMES) for d in csv.DictReader(f)]


def spark_rows(frame):
    return [tuple(r[c] for c in NAMES) for r in sorted(frame.collect(), key=lambda r: tuple(r["_order"]))]


@pytest.mark.parametrize("end", ["\r\n", "\n"])
def test_a_split_file_reads_as_python_reads_it(spark, tmp_path, end):
    r = random.Random(9)
    rows = [(f"e{i}", *[value(r) for _ in NAMES[1:]]) for i in range(3000)]
    written(f"{tmp_path}/a.csv", rows, end=end)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        frame = E.read_employee_csv(spark, str(tmp_path))
        blocks = E._lines(spark, [str(tmp_path)]).select("block").distinct().count()
        assert spark_rows(frame) == python_rows(f"{tmp_path}/a.csv") and blocks > 5
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_many_files_take_few_jobs(spark, tmp_path):
    r = random.Random(4)
    want = []
    os.mkdir(f"{tmp_path}/in")
    for i in range(300):
        header = NAMES + ["extra"] if i % 3 else NAMES[::-1]
        written(f"{tmp_path}/in/f{i:04d}.csv", [[f"{i}-{j}-{c}" + value(r) for c in header] for j in range(3)], header,
                quoting=csv.QUOTE_ALL if i % 2 else csv.QUOTE_MINIMAL)
        want += python_rows(f"{tmp_path}/in/f{i:04d}.csv")
    spark.sparkContext.setJobGroup("csv", "csv")
    frame = E.read_employee_csv(spark, f"{tmp_path}/in")
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("csv"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert spark_rows(frame) == want and jobs < 20


def test_edges(spark, tmp_path):
    os.mkdir(f"{tmp_path}/d")
    for name, text in [("a", ""), ("b", "﻿email,full_name,practice,level,location\r\n\r\nx@y, n ,p\r\n"),
                       ("c", 'email,full_name,practice,level,location\nq@y,"a ""b""\n\n c",p,l,"z"'), ("d", ",".join(NAMES))]:
        with open(f"{tmp_path}/d/{name}.csv", "w", newline="", encoding="utf-8") as f:
            f.write(text)
    assert spark_rows(E.read_employee_csv(spark, f"{tmp_path}/d")) == [("x@y", "n", "p", "", ""), ("q@y", 'a "b"\n\n c', "p", "l", "z")]
    # Quotes inside unquoted fields: that file is read whole, the others are not touched by it.
    with open(f"{tmp_path}/d/e f.csv", "w", newline="") as f:
        f.write(",".join(NAMES) + '\ns@y,5" pipe,p,l,z\nt@y,n,p,l,z\n')
    got = spark_rows(E.read_employee_csv(spark, f"{tmp_path}/d"))
    assert [g[0] for g in got] == ["x@y", "q@y", "s@y", "t@y"] and got[2][1] == '5" pipe'
    with open(f"{tmp_path}/d/g.csv", "w") as f:
        f.write("email,full_name\na,b\n")
    with pytest.raises(ValueError, match="no column"):
        E.read_employee_csv(spark, f"{tmp_path}/d")
    with pytest.raises(ValueError, match="no employee CSV"):
        E.read_employee_csv(spark, f"{tmp_path}/d/a.csv")


def test_a_task_joins_records_while_its_lines_pass(spark, tmp_path):
    import pyarrow as pa

    taken = []

    def batches():
        for k in range(50):
            taken.append(k)
            value = ['q,"a', 'b"', f"x{k},y"] * 10
            yield pa.RecordBatch.from_pydict({"path_no": [0] * 30, "file": ["f"] * 30, "block": [0] * 30, "value": value,
                                              "odd": [v.count('"') % 2 for v in value], "base": [0] * 30})

    first = next(E._record_batches(batches()))
    assert len(taken) == 1 and first.num_rows == 20 and first["record"][0].as_py() == 'q,"a\nb"'
    written(f"{tmp_path}/a.csv", [(f"e{i}", 'a\n"b"', "p", "l", "z") for i in range(50)])
    stages = E.csv_records(spark, [str(tmp_path)])._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in stages
