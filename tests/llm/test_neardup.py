import random
import re
from collections import defaultdict

import numpy as np
import pytest
from odd import PROSE, SF_SMALL, doc, odd_documents, odd_rows

from usagelens.llm import neardup


def brute(rows, words):
    """doc row -> (set size, component id), by all pairs."""
    sets = []
    for r in rows:
        w = re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), r[1] or ""))
        sets.append({tuple(w[k:k + words]) for k in range(len(w) - words + 1)} if len(w) >= words else ({tuple(w)} if w else set()))
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = group[i], group[j]
                group = [b if g == a else g for g in group]
    least = defaultdict(list)
    for g, r in zip(group, rows):
        if r[0] is not None:
            least[g].append(r[0])
    return sorted(((r[0], len(s), min(least[g]) if least[g] else None) for g, r, s in zip(group, rows, sets)), key=repr), group


def found(frame):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in frame.collect()), key=repr)


@pytest.mark.parametrize("words", [2, 5])
def test_groups_equal_brute_force(spark, words):
    rows = odd_rows()
    got = neardup.near_duplicates(odd_documents(spark), words)
    want, group = brute(rows, words)
    assert found(got) == want
    got = got.collect()
    assert all(r.kept == (r.doc_id is not None and r.doc_id == r.component_id) for r in got)
    assert sum(r.keeper for r in got) == len(set(group))


def test_documents_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert found(neardup.near_duplicates(docs, 2)) == brute(rows, 2)[0]


def test_family_whose_members_meet_only_in_tiles(spark):
    """Copies of copies around the limit, in tiles of two members: every link counts."""
    rng = random.Random(5)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(70):
        w = list(base if i < 35 or not rows else rows[rng.randrange(len(rows))][1].split())
        for _ in range(rng.randrange(1, 5)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(10 ** 6)}"
        rows.append(doc(i, " ".join(w)))
    got = neardup.near_duplicates(odd_documents(spark, rows), 2, tile=2)
    assert found(got) == brute(rows, 2)[0]


def site(pages, seed=4):
    """Pages of one template (150 of 190 words), every tenth with a partner that is linked with it."""
    rng = random.Random(seed)
    head, rows = [f"t{k}" for k in range(150)], []
    for p in range(pages):
        own = [f"p{rng.randrange(10 ** 9)}" for _ in range(40)]
        if p % 10 == 9:
            own = rows[-1][1].split()[150:]
            for _ in range(4):
                own[rng.randrange(40)] = f"q{rng.randrange(10 ** 9)}"
        rows.append(doc(p, " ".join(head + own)))
    return rows


def test_pages_of_one_template_make_rows_in_proportion(spark, monkeypatch):
    """A crowded bucket of texts that are alike but not linked: rows to compare grow with the
    pages, not with their square, and no link is lost."""
    counts = []
    count = neardup._row_count
    monkeypatch.setattr(neardup, "_row_count", lambda open_, tile: counts.append(count(open_, tile)) or counts[-1])
    before, after = {}, {}
    for pages in (300, 1200):
        rows = site(pages)
        got = neardup.near_duplicates(odd_documents(spark, rows), 2, tile=16)
        comps = {r.doc_id: r.component_id for r in got.collect()}
        assert all(comps[p] == (p - 1 if p % 10 == 9 else p) for p in comps)
        if pages == 300:
            assert found(got) == brute(rows, 2)[0]
        before[pages], after[pages] = counts[-2:]
    assert before[1200] > 8 * before[300]               # as band buckets: with the square
    assert after[1200] < 6 * max(after[300], 20) and after[1200] < before[1200] / 10


def test_crowded_buckets_of_linked_families(spark):
    """Families around the limit inside a crowd: dealing anew or not, all links are found."""
    rng = random.Random(6)
    base, rows = [f"w{i}" for i in range(90)], []
    for i in range(160):
        w = list(base if i < 80 else rows[rng.randrange(len(rows))][1].split())
        for _ in range(rng.randrange(1, 9)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(10 ** 6)}"
        rows.append(doc(i, " ".join(w)))
    assert found(neardup.near_duplicates(odd_documents(spark, rows), 2, tile=4)) == brute(rows, 2)[0]


def test_deduplicate_keeps_one_row_of_each_group(spark):
    rows = odd_rows() + [doc(20 + k, PROSE) for k in range(30)]
    frame = odd_documents(spark, rows)
    out = neardup.deduplicate(frame, 5)
    assert out.schema.simpleString() == frame.schema.simpleString()
    kept, group = sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in out.collect()), brute(rows, 5)[1]
    members = defaultdict(list)
    for g, r in zip(group, rows):
        members[g].append((r[0] is None, r[0] or 0, r[1] or ""))
    assert kept == sorted(min(m, key=lambda x: x[:2]) for m in members.values())


def test_empty_tables(spark):
    empty = odd_documents(spark, [])
    assert neardup.near_duplicates(empty).count() == 0 and neardup.deduplicate(empty).count() == 0


def test_sketch_estimates_similarity():
    rng = np.random.default_rng(1)
    shared, a, b = (rng.integers(0, 1 << 63, n).astype(np.uint64) for n in (8000, 1000, 1000))
    x, y = (np.unique(np.concatenate([shared, z])) for z in (a, b))
    equal = (neardup.sketch(x) == neardup.sketch(y)).mean()
    assert abs(float(neardup.estimate(equal, len(x), len(y))) - 0.8) < 0.1
    assert neardup.sketch(x[:1]).shape == (neardup.REGISTERS,)
    assert np.array_equal(neardup.unpack_set(neardup.pack_set(x)), x >> np.uint64(16))


def test_empty_registers_borrow_evenly():
    rng = np.random.default_rng(8)
    for n in (2, 4, 5, 8, 20):
        for _ in range(200):
            h = np.unique(rng.integers(0, 1 << 64, n, dtype=np.uint64))
            share = np.unique(neardup.sketch(h), return_counts=True)[1] / neardup.REGISTERS
            if len(share) == n:  # no two runs in one bucket or of one value
                assert share.max() < 1 / n + 6 * (1 / n * (1 - 1 / n) / neardup.REGISTERS) ** 0.5


def test_short_documents_at_the_limit_are_linked(spark):
    """Pairs of one run less, and of a fifth less, of short documents: none is lost."""
    rows, sizes = [], [(n, n - 1) for n in range(4, 22)] + [(5 * k, 4 * k) for k in range(1, 11)] + [(10, 7), (33, 26)]
    for n, m in sizes:
        for _ in range(40):
            w = [f"w{len(rows)}x{k}" for k in range(n + 4)]
            rows += [doc(len(rows) + 1, " ".join(w)), doc(len(rows) + 2, " ".join(w[:m + 4]))]
    got = {r.doc_id: r for r in neardup.near_duplicates(odd_documents(spark, rows)).collect()}
    lost = [(n, m) for k, (n, m) in enumerate(s for s in sizes for _ in range(40))
            if (got[2 * k + 2].component_id == 2 * k + 1) != (100 * m >= 80 * n)]
    assert got[1].n_shingles == 4 and got[2].n_shingles == 3 and not lost


def test_a_common_run_is_no_bucket_of_its_own():
    """Short sets that share a frequent run are bucketed by their rarer ones."""
    rng = np.random.default_rng(9)
    common = np.uint64(5)
    sets = [np.sort(np.append(rng.integers(1 << 60, 1 << 64, 9, dtype=np.uint64), common)) for _ in range(500)]
    counts = np.bincount(neardup.run_class(np.concatenate(sets)), minlength=1 << neardup.RUN_CLASS_BITS)
    assert not any(common in neardup.first_runs(s, counts, 80) for s in sets)
    assert {len(neardup.first_runs(s, counts, 80)) for s in sets} == {3}
