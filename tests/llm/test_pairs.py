"""Near copies of texts and vectors against brute force."""

import random

import numpy as np
import pytest
from llm_brute import brute_links, shingles, smallest

from plumbline.llm import jaccard, vectors
from plumbline.llm.components import components
from plumbline.llm.jaccard import shingle_links
from plumbline.llm.text import shingle_sets, word_runs
from plumbline.llm.vectors import near_vectors


def family(rng, n, size, edits):
    words = [f"w{rng.randint(0, 10**6)}" for _ in range(size)]
    out = []
    for _ in range(n):
        copy = list(words)
        for _ in range(rng.randint(0, edits)):
            copy[rng.randrange(size)] = f"x{rng.randint(0, 10**6)}"
        out.append(" ".join(copy))
    return out


def test_components_of_a_long_path_a_star_and_a_loop(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 140)] + [(7, 7), (None, 3), (200, 201)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    nodes = {n for e in edges for n in e if n is not None and e[0] != e[1] and None not in e}
    assert got == smallest(nodes, [e for e in edges if None not in e])


def test_components_of_nothing(spark):
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_links_of_families_equal_brute_force(spark):
    rng = random.Random(11)
    texts = [t for size, edits in ((40, 1), (90, 3), (90, 6), (200, 9), (12, 1), (5, 1), (300, 30)) for t in family(rng, 14, size, edits)]
    shared = " ".join(f"p{i}" for i in range(60))
    texts += [shared + " " + t for t in family(rng, 6, 50, 50)] + ["", "a b", "A b", "a  b"]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in shingle_links(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = smallest([i for i, _ in rows], brute_links(rows))
    assert got == {i: (len(shingles(t)), want[i]) for i, t in rows}


def test_chain_of_links_through_a_group_of_one_prefix(spark):
    # Neighbours are similar, ends are not.
    words = [f"c{i}" for i in range(100)]
    rows = [(i, " ".join(words[:60] + [f"n{j}" if j < 3 * i else f"m{j}" for j in range(40)])) for i in range(12)]
    got = {r.doc_id: r.component_id for r in shingle_links(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == smallest(range(12), brute_links(rows))


def test_odd_documents_and_empty_tables(odd_docs, no_docs):
    rows = sorted((r.doc_id or -1, r.n_shingles, r.component_id or -1) for r in shingle_links(odd_docs).collect())
    texts = [(r.doc_id, r.text) for r in odd_docs.collect()]
    want = smallest({i for i, _ in texts if i is not None}, brute_links(list({t: None for t in texts})))
    assert rows == sorted((i or -1, len(shingles(t)), want.get(i, -1)) for i, t in texts)
    assert shingle_links(no_docs).collect() == []


def test_words_are_those_between_blanks_at_any_run_size(monkeypatch):
    import pyarrow as pa

    from plumbline.llm import text

    rng = random.Random(2)
    texts = ["".join(rng.choice("aAbB \t\n\x0bé漢ñ.") for _ in range(rng.choice([0, 1, 7, 60]))) for _ in range(400)] + [None, " "]
    column = pa.array(texts).slice(2)
    for size in (32, 1 << 20):
        monkeypatch.setattr(text, "TOGETHER", size)
        names, row = {}, 0
        for _, _, _, hashes, start in word_runs(column):
            for a, b in zip(start[:-1], start[1:], strict=True):
                words = (column[row].as_py() or "").encode().lower().split()
                assert len(words) == b - a
                for w, h in zip(words, hashes[a:b].tolist(), strict=True):
                    assert names.setdefault(w, h) == h
                row += 1
        assert row == len(column) and len(set(names.values())) == len(names)
        assert [len(s) for s in shingle_sets(column, 5)] == [len(shingles(t)) for t in column.to_pylist()]


def test_vectors_equal_brute_force_with_small_tiles(spark, monkeypatch):
    monkeypatch.setattr(vectors, "TILE", 16)
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(40, 16))
    x = np.concatenate([centres[rng.integers(0, 40, 300)] + rng.normal(size=(300, 16)) * 0.12, rng.normal(size=(100, 16)), np.repeat(centres[:1], 30, 0)])
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    got = {r.vec_id: r for r in near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()}
    x = x.astype(np.float32).astype(float)
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    link = (u @ u.T >= 0.95) & ~np.eye(len(x), dtype=bool)
    found = sum(r.n_links for r in got.values())
    assert 0.9 * link.sum() <= found <= link.sum()
    want = smallest(range(len(x)), list(zip(*np.nonzero(link), strict=True)))
    assert sum(got[i].component_id == want[i] for i in got) >= 0.97 * len(got)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())


def test_odd_vectors_link_with_nothing(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [nan, 1.0]), (7, [inf, 1.0]),
        (8, [1.0, None]), (9, [1.0, 0.0, 0.0]), (10, [1.0, 0.0]), (None, [1.0, 0.0]), (11, [1e-30, 0.0]),
    ]
    got = {r.vec_id: (r.n_links, r.component_id) for r in near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()}
    assert {i: got[i] for i in (1, 2, 10, 11)} == {1: (3, 1), 2: (3, 1), 10: (3, 1), 11: (3, 1)}
    assert all(got[i] == (0, i) for i in (3, 4, 5, 6, 7, 8, 9))
    assert near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []


def test_different_vectors_under_one_id_are_counted_apart(spark):
    rows = [(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 0.01]), (3, [0.0, 1.0]), (4, [0.5, -0.5])]
    got = near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == [(1, 1, 1), (1, 1, 1), (2, 1, 1), (3, 1, 1), (4, 0, 4)]


def test_percent_is_checked(no_docs):
    with pytest.raises(ValueError):
        shingle_links(no_docs, percent=0)
    assert jaccard.SKETCH == 8


def test_far_copies_in_a_large_family_are_not_compared_one_by_one(spark, monkeypatch):
    # Near copies link with each other; far ones have too many words of their own to link with any.
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)]

    def copy(i, edits):
        at = set(rng.sample(range(400), edits))
        return " ".join(f"x{i}_{j}" if j in at else w for j, w in enumerate(words))

    rows = [(i, copy(i, 1 + i % 6 if i < 150 else 15 + i % 6)) for i in range(300)]
    rows += [(300 + i, " ".join(words[: 300 + 10 * i])) for i in range(8)]
    given = []
    plausible = jaccard._plausible
    monkeypatch.setattr(jaccard, "_plausible", lambda pairs, *more: given.append(pairs.distinct().count()) or plausible(pairs, *more))
    got = {r.doc_id: r.component_id for r in shingle_links(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == smallest([i for i, _ in rows], brute_links(rows))
    assert given[1] <= 2 * len(rows)


@pytest.mark.parametrize("percent", [40, 75, 100])
def test_links_across_components_in_crowded_lists(spark, monkeypatch, percent):
    monkeypatch.setattr(jaccard, "CROWDED", 0)
    rng = random.Random(percent)
    rows = list(enumerate(t for size, edits in ((60, 25), (30, 9), (9, 3), (6, 1)) for t in family(rng, 40, size, edits)))
    rows += [(len(rows) + i, " ".join(t.split()[rng.randint(0, 20) : rng.randint(30, 60)])) for i, t in rows[:40]]
    got = {r.doc_id: r.component_id for r in shingle_links(spark.createDataFrame(rows, "doc_id long, text string"), percent=percent).collect()}
    assert got == smallest([i for i, _ in rows], brute_links(rows, percent))
