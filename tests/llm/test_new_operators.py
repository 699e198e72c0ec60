"""URL filters, fill-in-the-middle and hard negatives against plain computations."""

import hashlib
import random
import re

import numpy as np
import pytest

from plumbline.llm import hardnegatives, infill
from plumbline.llm.hardnegatives import hard_negatives
from plumbline.llm.infill import fim_digests, fim_texts, parsed, plan_cuts, unit_starts
from plumbline.llm.urlfilter import filter_urls, learn_urls, parse_rules, seed_urls
from pyspark.sql import functions as F

RULES = ["allow org/", "block example.org/es/", "block example.org/en/1", "allow com/fr/", "block com/de/"]


def plain_fim(doc_id, text):
    """Output, form, sizes and units by the rule's own words."""
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    hexed = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(hexed[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    pre, mid, suf = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    if h[3] % 100 < 20:
        return n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


def odd_texts():
    rng = random.Random(5)
    letters = "abZ \n.<>PSM/é漢😀"
    rows = [(i, "".join(rng.choice(letters) for _ in range(rng.choice([0, 1, 2, 9, 60])))) for i in range(300)]
    long = ["a" * 200_000, "x " * 60_000, "é" * 70_000 + "<P" + "b" * 70_000]
    return [*rows, *((1000 + i, t) for i, t in enumerate(long)), (2, rows[2][1]), (2, "other"), (None, "one two"), (7, None)]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("chunk", [1, 4096])
def test_fill_in_middle_equals_the_plain_rule(spark, monkeypatch, chunk):
    monkeypatch.setattr(infill, "CHUNK", chunk)
    rows = odd_texts() if chunk > 1 else odd_texts()[:300]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, form string")
    key = lambda r: (r[0] is None, r[0] or 0, *map(str, r[1:]))
    want = []
    for i, t in rows:
        n, form, a, b, out = plain_fim(i, t)
        want.append((i, n, form, a, b, sha(out), sha(t or "")))
    assert sorted(map(tuple, fim_digests(docs, 3).collect()), key=key) == sorted(want, key=key)
    texts = [(i, *plain_fim(i, t)[:4], plain_fim(i, t)[4], t or "") for i, t in rows]
    assert sorted(map(tuple, fim_texts(docs).collect()), key=key) == sorted(texts, key=key)
    assert {w[2] for w in want} == {"plain", "spm", "psm"}


def test_fill_in_middle_of_nothing(spark):
    assert fim_digests(spark.createDataFrame([], "doc_id string, text string")).collect() == []


def test_output_is_parsed_in_any_pieces():
    rng = random.Random(1)
    for form in ("psm", "spm"):
        for _ in range(200):
            part = ["".join(rng.choice("<PSM>a") for _ in range(rng.randint(0, 6))) for _ in range(3)]
            if any(m in "".join(part) for m in ("<P>", "<S>", "<M>")) or any(m in p for p in part for m in ("<P>", "<S>", "<M>")):
                continue
            order = ("<P>", 0, "<S>", 2, "<M>", 1) if form == "psm" else ("<S>", 2, "<P>", 0, "<M>", 1)
            out = "".join(x if isinstance(x, str) else part[x] for x in order).encode()
            cut = sorted(rng.randint(0, len(out)) for _ in range(4))
            pieces = [out[a:b] for a, b in zip([0, *cut], [*cut, len(out)], strict=True)]
            got = {0: b"", 1: b"", 2: b""}
            for p, piece in parsed(form, pieces):
                got[p] += piece
            assert [got[i].decode() for i in range(3)] == part


def test_units_start_where_the_pattern_matches():
    for text in ("", "ab1c", "é漢a b", "😀😀x", "\nA\n"):
        starts, at = [], 0
        for unit in re.findall(r"[A-Za-z]+|[^A-Za-z]", text):
            starts.append(at)
            at += len(unit.encode())
        assert unit_starts(text.encode()).tolist() == starts
    assert plan_cuts(1, b"")[:2] == (0, "plain")


def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), path


def plain_rule(host, path):
    best = None
    for line in RULES:
        verdict, text = line.split(" ")
        h, p = text.split("/", 1)
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(text) > len(best[0])):
            best = text, verdict
    return best


def test_urls_are_cut_and_ruled_as_stated(spark):
    urls = [
        None, "", "no scheme", "http://", "HTTP://A.Example.ORG/es/1", "https://example.org/en/12?x", "https://example.org/en/2",
        "https://sub.example.com/de/3#a", "https://example.com?de/3", "https://xcom/de/3", "https://com/fr/9", "http://É.Org/",
        "http://org", "a://b://c.org/x", "http://example.org/ES/1", "http://u:p@h.com:80/de/", "http://x.net/" + "a/" * 300_000,
        "http://example.org/es/1", "http://example.org/es/1",
    ]
    pages = spark.createDataFrame([(i, u, "h", "r") for i, u in enumerate(urls)], "page_id long, url string, host string, row string")
    model = learn_urls(seed_urls(spark))
    rows = filter_urls(pages, model, parse_rules(RULES)).collect()
    assert [(r.host, r["row"]) for r in rows] == [("h", "r")] * len(urls)
    for r in rows:
        f, (host, path) = r.url_filter, plain_parts(r.url)
        rule = plain_rule(host, path)
        assert (f.host, f.path) == (host, path)
        assert f.rule == (rule and rule[0])
        assert f.verdict == (rule[1] if rule else "block" if f.chance >= 0.5 else "allow")
        assert 0 <= f.chance <= 1
    assert filter_urls(pages.limit(0), model).collect() == []


def test_unseen_hosts_are_judged_by_their_words(spark):
    model = learn_urls(seed_urls(spark))
    bad = ["https://m.cheap-pills.example.com/en/4", "http://free-bets.example.net/de/8", "https://adult-x.example.org/fr/2", "http://spam-farm.example.net/en/7"]
    good = [f"https://{w}.example.{t}/en/5" for w in ("thther", "tionble", "blog.ththan", "city-library", "musicschool") for t in ("net", "com")]
    pages = spark.createDataFrame([(u,) for u in bad + good], "url string")
    got = {r.url: r.url_filter.verdict for r in filter_urls(pages, model).collect()}
    assert [got[u] for u in bad] == ["block"] * len(bad)
    assert [got[u] for u in good] == ["allow"] * len(good)


def test_url_model_does_not_depend_on_layout_or_batch(spark):
    seeds = seed_urls(spark)
    one, two = learn_urls(seeds.repartition(1)), learn_urls(seeds.repartition(7).union(seeds))
    assert (one.weights == two.weights).all() and one.bias == two.bias
    hosts, paths = [b"a.b", b"casino.example.com", b""] * 5, [b"/x", b"", b""] * 5
    alone = [one.chances([h], [p])[0] for h, p in zip(hosts, paths, strict=True)]
    assert one.chances(hosts, paths).tolist() == alone


def test_labels_of_one_kind_or_none(spark):
    none = spark.createDataFrame([], "url string, verdict string")
    assert learn_urls(none).chances([b"x"], [b""])[0] == pytest.approx(0.5)
    only = spark.createDataFrame([("http://a", "block"), (None, "allow"), ("http://b", "?")], "url string, verdict string")
    assert learn_urls(only).chances([b"x"], [b""])[0] > 0.99
    with pytest.raises(ValueError):
        parse_rules(["deny x/"])


def plain_negatives(rows, every=5):
    """Anchors are the ids divisible by ``every``; all integers are Python's."""
    out = []
    whole = [(i, y, v) for i, y, v in rows if i is not None and y is not None and v is not None and None not in v]
    for i, y, v in (r for r in whole if r[0] % every == 0):
        scored = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), j, z) for j, z, w in whole if j != i and len(w) == len(v))
        for s, j, _ in [x for x in scored if x[2] == y][:5]:
            fit = [x for x in scored if x[2] != y and 30 * -s <= 100 * -x[0] <= 90 * -s][:10]
            out += [(i, j, k, x[1], -s, -x[0]) for k, x in enumerate(fit, 1)]
    return out


def vectors(seed, n, dims, spread):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dims)) * 40
    label = rng.integers(0, 4, n)
    x = np.floor(centres[rng.integers(0, 6, n)] + rng.normal(size=(n, dims)) * spread).astype(int)
    return [(i, int(y), [int(a) for a in v]) for i, (y, v) in enumerate(zip(label, x, strict=True))]


KIND = "vec_id long, label int, vector array<long>, score string, chunk int"


def mined(spark, rows, every=5, partitions=3):
    df = spark.createDataFrame([(*r, "s", 1) for r in rows], KIND).repartition(partitions)
    return sorted(map(tuple, hard_negatives(df, F.col("vec_id") % every == 0).collect()))


@pytest.mark.parametrize("seed,n,dims,spread,chunk,block", [(1, 400, 24, 25, 1024, 4096), (2, 300, 7, 60, 7, 32), (3, 200, 40, 5, 1024, 16)])
def test_negatives_equal_brute_force(spark, monkeypatch, seed, n, dims, spread, chunk, block):
    monkeypatch.setattr(hardnegatives, "CHUNK", chunk)
    monkeypatch.setattr(hardnegatives, "BLOCK", block)
    rows = vectors(seed, n, dims, spread)
    want = plain_negatives(rows)
    assert want and mined(spark, rows) == sorted(want)


def test_odd_rows_of_vectors(spark):
    rows = [
        (0, 1, [3, 4]), (0, 1, [4, 3]), (5, 1, [3, 4]), (6, 1, [5, 5]), (6, 1, [5, 5]), (7, 2, [2, 3]), (8, 2, [2, 3]), (9, 2, [2, 3]),
        (None, 2, [2, 3]), (11, None, [2, 3]), (12, 2, None), (13, 2, [2, None]), (14, 2, [2]), (15, 3, []), (16, 3, []), (17, 4, []),
        (20, 5, [1]), (21, 6, [-1, -1]), (25, 6, [-2, -2]), (30, 6, [0, 0]),
    ]
    assert mined(spark, rows) == sorted(plain_negatives(rows))
    assert mined(spark, []) == []
    big = [(0, 1, [1 << 40, 3]), (1, 1, [1 << 40, 5]), (2, 2, [1 << 39, 7]), (3, 2, [(1 << 39) + 1, 7])]
    got = mined(spark, big)
    assert [(a, p, r, n) for a, p, r, n, _, _ in got] == [(a, p, r, n) for a, p, r, n, _, _ in plain_negatives(big)]
    assert all(s == (1 << 63) - 1 for *_, s, _ in got)


def test_thresholds_prune_pairs():
    rows = np.array([r[2] for r in vectors(4, 500, 64, 5)])
    windows = hardnegatives.Windows(np.arange(5), [0] * 5, [np.inf] * 5, True, 3)
    search = hardnegatives.Searcher(np.arange(5), np.zeros(5, int), rows[:5], windows, np.arange(5))
    floor = 0.75 * (rows[:5].astype(float) ** 2).sum(1)
    scores, alive, places = search.scores(rows, floor)
    exact = rows[:5] @ rows.T
    assert 0 < len(places) < len(rows)
    assert ((exact >= floor[:, None]).sum(1) <= alive.sum(1)).all()
    assert (scores[alive] == exact[:, places][alive]).all()
    left = np.ones(exact.shape, bool)
    left[:, places] = ~alive
    assert (exact < floor[:, None])[left].all()
