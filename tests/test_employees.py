"""S2, S3, S8, J4 on FIXTURES §4.4."""

import os
import threading
from concurrent.futures import ThreadPoolExecutor

from usagelens.sources import employees as E
from usagelens.sources import store


def write_text(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_first_row_wins_and_strip(spark, scratch):
    p = f"{scratch}/a/employees.csv"
    write_text(p, "email,full_name,practice,level,location\n"
                  " a@x , Ann  ,ML,L1,Paris\n"
                  "a@x,Other,Data,L2,Rome\n"
                  "A@x,Upper,ML,L3,Oslo\n"
                  "b@x,,Data,L10,Rome\n")
    rows = {r.email: r for r in E.load_employee_csv(spark, p).collect()}
    assert set(rows) == {"a@x", "A@x", "b@x"}          # plain text key: case matters
    assert (rows["a@x"].full_name, rows["a@x"].practice) == ("Ann", "ML")
    assert rows["b@x"].full_name == ""


def test_header_by_name_and_path_order(spark, scratch):
    write_text(f"{scratch}/p1/x.csv", "location,level,practice,full_name,email\nRome,L2,Data,First,c@x\n")
    write_text(f"{scratch}/p2/x.csv", "email,full_name,practice,level,location\nc@x,Second,ML,L1,Oslo\n")
    rows = E.load_employee_csv(spark, [f"{scratch}/p1", f"{scratch}/p2"]).collect()
    assert [(r.email, r.full_name, r.location) for r in rows] == [("c@x", "First", "Rome")]


def test_many_copies_of_one_email_keep_the_first(spark, scratch):
    body = "".join(f"hot@x,Name{i},P,L1,Loc\n" for i in range(5000))
    write_text(f"{scratch}/hot/e.csv", "email,full_name,practice,level,location\n" + body)
    rows = E.load_employee_csv(spark, f"{scratch}/hot").collect()
    assert [(r.email, r.full_name) for r in rows] == [("hot@x", "Name0")]


def test_insert_or_ignore_across_loads(spark, scratch):
    root = f"{scratch}/store"
    write_text(f"{scratch}/l1/e.csv", "email,full_name,practice,level,location\na@x,Ann,ML,L1,Paris\n")
    write_text(f"{scratch}/l2/e.csv", "email,full_name,practice,level,location\n"
                                      "a@x,Changed,ML,L1,Paris\nb@x,Bob,ML,L2,Rome\n")
    assert store.append_employees(spark, root, f"{scratch}/l1") == 1
    assert store.append_employees(spark, root, f"{scratch}/l2") == 1
    assert store.append_employees(spark, root, f"{scratch}/l2") == 0   # second load adds nothing
    rows = {r.email: r.full_name for r in store.read_employees(spark, root).collect()}
    assert rows == {"a@x": "Ann", "b@x": "Bob"}


def test_two_loads_side_by_side_keep_one_row_per_email(spark, scratch, monkeypatch):
    root = f"{scratch}/store"
    head = "email,full_name,practice,level,location\n"
    for k in (0, 1):
        write_text(f"{scratch}/l{k}/e.csv", head + "".join(f"u{i}@x,Load{k},ML,L1,Paris\n" for i in range(k * 10, k * 10 + 30)))
    both, decide = threading.Barrier(2), store.insert_or_ignore

    def together(stored, incoming):
        assert stored is None
        both.wait(120)
        return decide(stored, incoming)

    monkeypatch.setattr(store, "insert_or_ignore", together)
    with ThreadPoolExecutor(2) as pool:
        added = list(pool.map(lambda k: store.append_employees(spark, root, f"{scratch}/l{k}"), (0, 1)))
    assert added == [30, 30]
    monkeypatch.undo()
    rows = store.read_employees(spark, root).collect()
    assert sorted(r.email for r in rows) == sorted(f"u{i}@x" for i in range(40))
    shared = {r.full_name for r in rows if 10 <= int(r.email[1:-2]) < 30}
    assert len(shared) == 1  # of one load, the same for every reader
    assert store.append_employees(spark, root, f"{scratch}/l1") == 0
    write_text(f"{scratch}/l2/e.csv", head + "new@x,New,ML,L1,Paris\nu0@x,Late,ML,L1,Paris\n")
    assert store.append_employees(spark, root, f"{scratch}/l2") == 1
    assert {r.full_name for r in store.read_employees(spark, root).collect() if r.email == "u0@x"} == {"Load0"}


def test_files_of_stores_made_before_loads_had_names_are_read_first(spark, scratch):
    root = f"{scratch}/store"
    old = spark.createDataFrame([("a@x", "Old", "ML", "L1", "Paris")], "email string, full_name string, practice string, "
                                "level string, location string")
    old.write.parquet(store.employees_path(root))
    write_text(f"{scratch}/l1/e.csv", "email,full_name,practice,level,location\na@x,New,ML,L1,Paris\nb@x,Bob,ML,L2,Rome\n")
    assert store.append_employees(spark, root, f"{scratch}/l1") == 1
    assert {r.email: r.full_name for r in store.read_employees(spark, root).collect()} == {"a@x": "Old", "b@x": "Bob"}


def test_csv_round_trip(spark, scratch):
    df = spark.createDataFrame([("a@x", "Doe, Jane", " ML ", "L1", "Paris")],
                               "email string, full_name string, practice string, level string, location string")
    E.write_employee_csv(df, f"{scratch}/out")
    r = E.load_employee_csv(spark, f"{scratch}/out").first()
    assert (r.full_name, r.practice) == ("Doe, Jane", "ML")
