import hashlib
import zlib
from collections import defaultdict

from odd import PROSE, SF_SMALL, doc, odd_documents, odd_rows

from usagelens.llm import merkle


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(r, text):
    fields = (r[0], r[3], r[2], r[4], text)
    return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields])


def tree(leaves):
    """(last node, per leaf its (left, right) siblings level by level)."""
    paths, level, members = [[] for _ in leaves], list(leaves), [[i] for i in range(len(leaves))]
    while len(level) > 1:
        above, groups = [], []
        for at in range(0, len(level), 16):
            run = level[at:at + 16]
            for k, mine in enumerate(members[at:at + 16]):
                for i in mine:
                    paths[i].append((run[:k], run[k + 1:]))
            above.append(digest(*run))
            groups.append([i for mine in members[at:at + 16] for i in mine])
        level, members = above, groups
    return level[0], paths


def brute(rows):
    by_source = defaultdict(list)
    for r in rows:
        by_source[r[3]].append((leaf(r, r[1]), r))
    sources = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in sources:
        by_source[s].sort(key=lambda x: (x[1][0] is not None, x[1][0] or 0, x[0]))
        trees[s] = tree([x[0] for x in by_source[s]])
    root, tops = tree([trees[s][0] for s in sources]) if sources else (None, [])
    out = []
    for s, top in zip(sources, tops):
        for (own, r), path in zip(by_source[s], trees[s][1]):
            path = path + top
            text = r[1]
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and text is not None:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            node = leaf(r, text)
            for left, right in path:
                node = digest(*left, node, *right)
            proof = digest(*[d for left, right in path for d in left + right])
            out.append((r[0], own, trees[s][0], root, proof, node, node == root))
    return sorted(out, key=repr)


def found(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def test_manifest_equals_brute_force(spark):
    rows = odd_rows()
    got = merkle.verified_manifest(odd_documents(spark, rows), rows_per_task=4)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert found(got) == brute(rows)


def test_three_levels_and_many_sources(spark):
    rows = [doc(i, f"{PROSE[:i % 90]} Text {i}", "hot") for i in range(600)]
    rows += [doc(i, "Same Text", f"source {i % 40}") for i in range(100)]
    rows += [doc(7, PROSE, "copies")] * 70 + [doc(None, PROSE, None)] * 33
    got = found(merkle.verified_manifest(odd_documents(spark, rows), rows_per_task=50))
    assert got == brute(rows)
    assert {r[-1] for r in got} == {True, False}


def test_given_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in docs.collect()]
    assert found(merkle.verified_manifest(docs)) == brute(rows)


def test_small_tables(spark):
    assert found(merkle.verified_manifest(odd_documents(spark, []))) == []
    one = [doc(3, "One")]
    got = found(merkle.verified_manifest(odd_documents(spark, one)))
    assert got == brute(one) and got[0][1] == got[0][3] and got[0][4] == digest()


def test_a_changed_sibling_breaks_every_proof_through_it(spark):
    rows = [doc(i, f"Text {i}") for i in range(40)]
    before = {r[0]: r for r in found(merkle.verified_manifest(odd_documents(spark, rows)))}
    rows[20] = doc(20, "Other")
    after = {r[0]: r for r in found(merkle.verified_manifest(odd_documents(spark, rows)))}
    assert all(before[i][4] != after[i][4] for i in range(40) if i != 20) and before[20][4] == after[20][4]
    assert all(before[i][1] == after[i][1] for i in range(40) if i != 20)


def test_no_text_in_the_final_plan(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    plan = merkle.manifest(docs)._jdf.queryExecution().executedPlan().toString()
    assert "text" not in plan
