import importlib.util
import re
import subprocess
import sys
from collections import Counter
from pathlib import Path

import corpus_pipeline
from odd import SF_SMALL, odd_documents

import __spark_entry__ as entry
from usagelens.llm import quality


def staged(spark, docs, sf_dir, folder):
    out = []
    for k, (_, function) in enumerate(corpus_pipeline.STAGES):
        function(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        out.append(docs)
    return out


def test_stages_decide_over_what_came_before(spark, scratch):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    good, single, clean, mixed, packed = staged(spark, docs, SF_SMALL, scratch)
    for d in (good, single, clean, mixed):
        assert d.columns == docs.columns
    model = quality.train(docs, spark.read.parquet(f"{SF_SMALL}/labels.parquet"))
    kept = {r.doc_id for r in quality.score(docs, model).where("predicted = 1").collect()}
    assert {r.doc_id for r in good.collect()} == kept
    texts = [r.text for r in single.collect()]
    assert max(Counter(texts).values()) == 1 and {r.doc_id for r in single.collect()} <= kept
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in single.collect()}
    assert not any(re.search(r'(?i)token = "[0-9a-f]{40}"', r.text) for r in clean.collect())
    copies = Counter(r.doc_id for r in mixed.collect())
    assert set(copies) <= {r.doc_id for r in clean.collect()} and max(copies.values()) <= 2
    assert Counter(r.doc_id for r in packed.where("start = 0").collect()) == copies
    run = corpus_pipeline.run(spark, SF_SMALL)
    key = ("doc_id", "start", "length", "ids_crc32")
    assert sorted(map(tuple, run.select(*key).collect())) == sorted(map(tuple, packed.select(*key).collect()))


def test_stages_take_odd_and_empty_tables(spark, scratch):
    for k, rows in enumerate((None, [])):
        out = staged(spark, odd_documents(spark, rows), SF_SMALL, f"{scratch}/{k}")
        assert (out[-1].count() > 0) == (rows is None)


def test_registered_names():
    names = set(entry.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
    assert set(entry.oracle_sql()) <= names


def test_nothing_else_imports_the_subpackage(tmp_path):
    root = Path(importlib.util.find_spec("usagelens").origin).parent
    for path in root.rglob("*.py"):
        if "llm" not in path.relative_to(root).parts:
            assert "usagelens.llm" not in path.read_text(), path
    code = ("import sys\nsys.modules['usagelens.llm'] = sys.modules['corpus_pipeline'] = None\n"
            "import __spark_entry__ as e\nassert e.queries() and 'pipeline' not in e.queries()")
    subprocess.run([sys.executable, "-c", code], cwd=root.parent, check=True)
