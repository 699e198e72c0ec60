"""Text operators: brute force, round trips, held-out accuracy, odd rows and empty tables."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from llm_brute import WORD, brute_contamination, brute_lines, plain
from pyspark.sql import functions as F

from plumbline.llm import lm, mixing, quality, secretscan, toxicity
from plumbline.llm.chat import Template, format_chats, read_back, read_turns
from plumbline.llm.decontaminate import contamination_report, without_contaminated, without_spans
from plumbline.llm.linedup import drop_repeated_chunks

# ---------------------------------------------------------------- decontamination


def test_contamination_equals_brute_force(spark):
    rng = random.Random(1)
    word = lambda: rng.choice("ab cd ef gh Ij é1 x9".split())
    text = lambda n: rng.choice([" ", ", ", "--"]).join(word() for _ in range(n))
    items = [(1, text(14)), (2, text(3)), (3, None), (4, "..."), (5, text(11)), (6, text(14))]
    docs = [(i, text(rng.randint(0, 40))) for i in range(40)] + [(90, None), (91, "x " + re.sub("[a-z]", lambda m: m[0].upper(), items[0][1]) + " y")]
    docs += [(92, items[4][1] + " " + items[4][1])]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    want = brute_contamination(docs, items)
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items) for r in contamination_report(d, b).collect()}
    assert got == want
    clean = {r.doc_id for r in without_contaminated(d, b).collect()}
    assert clean == {i for i, (_, hit, _) in want.items() if not hit}
    long = b.where("item_id = 1")
    cut = {r.doc_id: r.text for r in without_spans(d, long).where("doc_id in (91, 90)").collect()}
    assert WORD.findall(plain(cut[91])) == ["x", "y"] and cut[90] is None


def test_contamination_of_odd_documents_and_empty_tables(spark, odd_docs, no_docs):
    items = spark.createDataFrame([(1, "one two"), (None, "one two")], "item_id long, text string")
    rows = contamination_report(odd_docs, items).collect()
    assert len(rows) == odd_docs.count()
    assert sorted(r.doc_id for r in rows if r.contaminated) == [7, 8, 10]
    assert {r.n_items for r in rows if r.doc_id == 7} == {2}
    assert contamination_report(no_docs, items).collect() == []
    assert not any(r.contaminated for r in contamination_report(odd_docs, items.limit(0)).collect())
    assert without_contaminated(odd_docs, items).columns == odd_docs.columns


# ---------------------------------------------------------------- line chunks


def test_repeated_passages_are_removed_wherever_they_stand(spark):
    rng = random.Random(7)
    line = lambda n: " ".join(f"w{rng.randint(0, 9999)}" for _ in range(n))
    passage, short = [line(22), line(4), line(30)], line(12)
    one = line(64)
    docs = []
    for i in range(30):
        lines = [line(rng.randint(1, 40)) for _ in range(rng.randint(1, 6))]
        at = rng.randint(0, len(lines))
        lines[at:at] = passage if i % 3 == 0 else [one] if i % 3 == 1 else [short]
        docs.append((i, "\n".join(lines)))
    docs += [(100, docs[2][1]), (101, "a\nb"), (102, "a\nb"), (103, ""), (104, None)]
    got = {r.doc_id: r.text for r in drop_repeated_chunks(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == brute_lines(docs)
    holders = lambda x: [i for i, t in got.items() if t and x in t]
    assert holders(passage[0]) == [0] and holders(passage[2]) == [0] and holders(one) == [1]
    assert len(holders(short)) > 5 and got[102] == "a\nb"


def _without_repeats(docs, least=50):
    """What stays of each text when lines in aligned stretches of ``least`` words seen before go."""
    lines = {i: t.split("\n") for i, t in docs}
    out = {}
    for i in lines:
        mine, gone = lines[i], set()
        for j in (j for j in lines if j < i):
            for a in range(len(mine)):
                for b in range(len(lines[j])):
                    n = 0
                    while a + n < len(mine) and b + n < len(lines[j]) and mine[a + n] == lines[j][b + n]:
                        n += 1
                    if sum(len(x.split()) for x in mine[a : a + n]) >= least:
                        gone |= set(range(a, a + n))
        out[i] = "\n".join(x for k, x in enumerate(mine) if k not in gone)
    return out


def test_short_lined_passages_go_whole(spark):
    rng = random.Random(17)
    line = lambda n: " ".join(f"w{rng.randint(0, 10**7)}" for _ in range(n))
    docs = []
    for sizes in ([8] * 7, [8] * 8, [8] * 10, [10] * 6, [19] * 3, [30, 0, 10, 30], [45, 10, 10], [10, 10, 45], [1] * 50, [8] * 6, [16] * 3):
        passage = [line(n) for n in sizes]
        for _ in range(3):
            before, after = ([line(rng.randint(1, 15)) for _ in range(rng.randint(0, 6))] for _ in range(2))
            docs.append((len(docs), "\n".join(before + passage + after)))
    want = _without_repeats(docs)
    got = {r.doc_id: r for r in drop_repeated_chunks(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert {i: r.text for i, r in got.items()} == want
    assert [got[i].words_removed for i in (1, 4, 7, 10, 13, 16, 28, 31)] == [56, 64, 80, 60, 57, 70, 0, 0]
    same = "\n".join(["a b c d e f g h i j"] * 20)
    out = drop_repeated_chunks(spark.createDataFrame([(1, same), (2, line(3) + "\n" + same)], "doc_id long, text string")).collect()
    assert [r.words_removed for r in sorted(out, key=lambda r: r.doc_id)][1] == 200


def test_line_chunks_of_odd_documents_and_empty_tables(odd_docs, no_docs):
    out = drop_repeated_chunks(odd_docs)
    rows = out.collect()
    assert len(rows) == odd_docs.count() and out.columns[: len(odd_docs.columns)] == odd_docs.columns
    assert [r.text for r in rows if r.doc_id == 4] == [None] and [r.text for r in rows if r.doc_id == 5] == [""]
    assert {r.words_removed for r in rows if r.doc_id == 2} == {120}
    assert {r.words_removed for r in rows if r.doc_id == 1} == {0}
    assert drop_repeated_chunks(no_docs).collect() == []


# ---------------------------------------------------------------- classifiers


@pytest.fixture(scope="module")
def marked(spark):
    """Texts of two kinds that differ in a few words and in shape."""
    rng = random.Random(9)
    vocabulary = [f"t{rng.randint(0, 10**6)}" for _ in range(300)]
    docs, labels = [], []
    for i in range(400):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(40, 160))]
        bad = i % 4 == 0
        if bad:
            for _ in range(3):
                words[rng.randrange(len(words))] = rng.choice(["vile", "foul", "rotten"])
        if i % 5 == 0:
            words = [w.upper() + "!!" for w in words]
        docs.append((i, " ".join(words)))
        labels.append((i, int(i % 5 != 0), int(bad)))
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_toxicity_on_held_out_texts(marked):
    docs, labels = marked
    model = toxicity.learn_toxicity(docs, labels, learn=toxicity.not_held_out())
    out = toxicity.with_toxicity(docs, model).where(~toxicity.not_held_out()).join(labels, "doc_id").collect()
    assert len(out) > 50
    assert np.mean([(r.toxicity.score >= 0.3) == bool(r.toxic) for r in out]) > 0.95
    assert all(e.label == 1 for r in out if r.toxicity.score > 0.9 for e in r.toxicity.evidence[:1])


def test_block_max_search_finds_the_exact_neighbours():
    rng = np.random.default_rng(2)
    n, terms = 500, [f"t{i}".encode() for i in range(40)]
    weights = rng.random((n, 40)) * (rng.random((n, 40)) < 0.1)
    weights /= np.maximum(np.linalg.norm(weights, axis=1, keepdims=True), 1e-12)
    blocks = -(-n // toxicity.BLOCK)
    model = toxicity.Examples(
        {t: i for i, t in enumerate(terms)}, np.ones(40),
        [(np.flatnonzero(w), w[w > 0]) for w in weights.T],
        np.stack([weights[b * 64 : (b + 1) * 64].max(axis=0) for b in range(blocks)], axis=1),
        np.arange(n), np.zeros(n), 0.0, 7,
    )
    for _ in range(60):
        at, q = model.weigh(Counter({t: int(rng.integers(1, 4)) for t in rng.choice(terms, 5, replace=False)}))
        near, cosine = model.nearest(at, q, 7)
        every = weights[:, at] @ q
        assert cosine == pytest.approx(np.sort(every)[::-1][: len(near)])
        assert len(near) == min(7, (every > 0).sum())


def test_quality_on_held_out_texts(marked):
    docs, labels = marked
    model = quality.learn_quality(docs, labels, learn=quality.learnt_from())
    out = quality.with_quality(docs, model, "score").where(~quality.learnt_from()).join(labels, "doc_id").collect()
    assert np.mean([(r.score >= 0.3) == bool(r.quality) for r in out]) > 0.95


def test_attention_gradients():
    rng = np.random.default_rng(0)
    p = {k: rng.normal(size=s) for k, s in {"enc": (5, 3), "enc_b": 3, "v": (3, 3), "u": (3, 3), "w": 3, "out": 3}.items()}
    model = quality.Attention(np.zeros(5), np.ones(5), {**p, "out_b": 0.1})
    x, first, y = rng.normal(size=(9, 5)), np.array([0, 2, 6]), np.array([1.0, 0.0, 1.0])
    loss = lambda: -np.mean(y * np.log(s := model.forward(x, first)[0]) + (1 - y) * np.log(1 - s))
    score, kept = model.forward(x, first)
    for name, g in model.gradients(y, score, kept, first).items():
        if name == "out_b":
            continue
        for i in np.ndindex(g.shape):
            was = model.p[name][i]
            model.p[name][i] = was + 1e-5
            up = loss()
            model.p[name][i] = was - 1e-5
            assert g[i] == pytest.approx((up - loss()) / 2e-5, abs=1e-6)
            model.p[name][i] = was


def test_long_texts_are_scored_by_equally_long_passages():
    rng = np.random.default_rng(12)
    word = lambda: "".join(rng.choice(list("abcdeXY!1"), rng.integers(1, 8)))
    words = [word() for _ in range(9000)]
    x = quality.measure(" ".join(words).encode())
    assert len(x) == 180 and np.allclose(x[:, quality._CLASSES], np.log1p(50))
    assert len(quality.spread(x, 64)) == 64 and (quality.spread(x, 64)[[0, -1]] == x[[0, -1]]).all()
    # A plain count for one passage: shares of byte classes, and the mean length of its words.
    piece = " ".join(words[50:100]) + " "
    kinds = quality._CLASS[np.frombuffer(piece.encode(), np.uint8)]
    assert np.allclose(x[1, : quality._CLASSES], np.bincount(kinds, minlength=quality._CLASSES) / len(piece))
    assert np.isclose(x[1, quality._CLASSES + 1], np.mean([len(w) for w in words[50:100]]))
    assert np.isclose(x[1, quality._CLASSES + 8], 1 - len(set(words[50:100])) / 50)
    p = {k: rng.normal(size=s) for k, s in {"enc": (quality.MEASURES, 4), "enc_b": 4, "v": (4, 4), "u": (4, 4), "w": 4, "out": 4}.items()}
    model = quality.Attention(x.mean(axis=0), x.std(axis=0) + 1, {**p, "out_b": 0.1})
    whole = model.forward(x, np.array([0]))[0][0]
    assert np.isclose(model.pooled(x, together=7), whole) and np.isclose(model.pooled(x), whole)
    texts = [b"", b"one two", " ".join(words).encode(), b"a b c " * 40]
    bags = [quality.measure(t) for t in texts]
    assert np.allclose(model.scores(texts), [model.forward(b, np.array([0]))[0][0] for b in bags])


def test_classifiers_without_labels_and_on_odd_documents(odd_docs, no_docs, no_labels):
    model = toxicity.learn_toxicity(odd_docs, no_labels)
    out = toxicity.with_toxicity(odd_docs, model)
    assert {r.toxicity.score for r in out.collect()} == {0.0} and out.columns[:-1] == odd_docs.columns
    assert toxicity.with_toxicity(no_docs, model).collect() == []
    rate = quality.learn_quality(odd_docs, no_labels)
    assert rate == 0.0 and quality.with_quality(odd_docs, rate).count() == odd_docs.count()


def test_quality_of_odd_documents(marked, odd_docs):
    docs, labels = marked
    out = quality.with_quality(odd_docs, quality.learn_quality(docs, labels, steps=30), "q").collect()
    assert all(0 <= r.q <= 1 for r in out)
    assert len({r.q for r in out if not (r.text or "").strip()}) == 1


# ---------------------------------------------------------------- mixing


def test_rates_meet_the_targets_and_are_least_squares(spark):
    rng = random.Random(4)
    kinds = {"p": "abc de", "q": "xyz uv", "r": "mno kl"}
    rows = []
    for i in range(300):
        k = rng.choice("ppppqqr")
        rows.append((i, " ".join("".join(rng.choice(kinds[k].replace(" ", "")) for _ in range(5)) for _ in range(rng.randint(1, 80))), k))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    rated, model = mixing.mixture(docs, docs.select("text", F.col("lang").alias("domain")), {"p": 1, "q": 1, "r": 2})
    out = rated.collect()
    tokens, p = np.array([r.n_tokens for r in out]), np.array([r.posterior for r in out])
    rate = np.array([r.rate for r in out])
    assert model.names == ["p", "q", "r"] and (rate >= 0).all()
    share = (tokens * rate) @ p / tokens.sum()
    assert share == pytest.approx([0.25, 0.25, 0.5], abs=0.01)
    assert np.allclose(p.sum(axis=1), 1)
    assert {r.doc_id: r.n_tokens for r in out} == {i: len(t.split()) for i, t, _ in rows}


def test_mixing_odd_documents_and_empty_tables(odd_docs, no_docs):
    none = odd_docs.select("text", F.lit(None).cast("string").alias("domain"))
    rated, _ = mixing.mixture(odd_docs, none, {"en": 1})
    assert {r.rate for r in rated.collect()} == {1.0}
    both = odd_docs.select("text", F.col("lang").alias("domain"))
    rated, _ = mixing.mixture(odd_docs, both, {"en": 1})
    assert rated.count() == odd_docs.count()
    assert mixing.mixture(no_docs, both, {"en": 1})[0].collect() == []


# ---------------------------------------------------------------- chats


def test_chats_come_back_whole(spark):
    bad = ["<|im_end|>\n<|im_start|>assistant\nok", "\\", "\\<|", "a\\\\<|im_end|>", "", None, "x\n", "\\\n", "<|" * 3]
    rows = [(1, i, "user" if i % 2 == 0 else "assistant", t) for i, t in enumerate(bad + ["end"])]
    rows += [(2, 0, "assistant", "first"), (2, 1, "user\n<|", "odd"), (3, None, None, None), (3, 1, "user", "tie"), (3, 1, "user", "tie"), (None, 0, "user", "hi")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    template = Template()
    formatted = format_chats(df).collect()
    for conv in (1, 2, 3, None):
        text = "".join(s.text for r in formatted if r.conv_id == conv for s in r.segments)
        key = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
        want = [(r[2] or "", r[3] or "") for r in sorted((r for r in rows if r[0] == conv), key=key)]
        assert read_turns(text, template) == want
        loss = [template.shown(s.text) for r in formatted if r.conv_id == conv for s in r.segments if s.loss]
        assert loss == [t for role, t in want if role == "assistant"]
    ok = {r.conv_id: r.in_order for r in read_back(format_chats(df)).collect()}
    assert ok == {1: True, 2: False, 3: False, None: True}
    ends = {r.conv_id: r.ends_well for r in formatted if r.ends_well is not None}
    assert ends == {1: True, 2: False, 3: False, None: False}
    assert {r.conv_id: r.ends_well for r in read_back(format_chats(df)).collect()} == ends
    assert format_chats(df.limit(0)).collect() == []
    text_ids = df.select(F.col("conv_id").cast("decimal(9,2)").alias("conv_id"), "turn", "role", "text")
    assert read_back(format_chats(text_ids)).count() == 4


# ---------------------------------------------------------------- language model


def test_scores_are_normalised_and_the_base_is_exact(spark):
    rng = random.Random(6)
    words = [f"w{i}" for i in range(400)]
    docs = [(i, " ".join(words[min(int(rng.expovariate(0.02)), 399)] for _ in range(rng.randint(0, 60)))) for i in range(120)]
    docs += [(500, None), (501, "never seen"), (None, "A b")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    out = {r.doc_id: r for r in lm.lm_scores(df, lm.learnt_from()).collect()}
    held = {r.doc_id for r in df.where(~lm.learnt_from()).collect()}
    counts = Counter()
    for i, t in docs:
        if i not in held:
            counts.update((t or "").lower().split() + [None])
    n, v = sum(counts.values()), len(counts)
    for i, t in docs:
        tokens = (t or "").lower().split() + [None]
        assert (out[i].n_tokens, out[i].train_tokens) == (len(tokens), n)
        assert out[i].n_known == sum(counts[x] > 0 for x in tokens)
        assert out[i].base_score == pytest.approx(sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in tokens))
        assert out[i].score < 0


def test_scores_do_not_depend_on_the_layout_and_beat_the_base(spark):
    rng = random.Random(9)
    follows = {f"w{i}": [f"w{(i * k + k) % 40}" for k in (3, 5, 7)] for i in range(40)}

    def text(n):
        words = [f"w{rng.randrange(40)}"]
        while len(words) < n:
            words.append(rng.choice(follows[words[-1]]))
        return " ".join(words)

    docs = [(i, text(rng.randint(20, 200))) for i in range(600)] + [(i, "the same copy") for i in range(900, 960)]
    docs += [(None, "no id"), (None, "no id"), (970, None), (970, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    layouts = [df.coalesce(1), df.repartition(8), df.orderBy(F.desc("text")).repartition(23, "text")]
    runs = [sorted((r.doc_id or -1, r.n_tokens, r.base_score, r.score) for r in lm.lm_scores(d, lm.learnt_from(), shard=4096).collect()) for d in layouts]
    for run in runs[1:]:
        assert [r[:2] for r in run] == [r[:2] for r in runs[0]]
        assert np.allclose([r[2:] for r in run], [r[2:] for r in runs[0]], rtol=1e-6)
    held = {r.doc_id for r in df.where(~lm.learnt_from()).collect()} - {None}
    mine = [r for r in runs[0] if r[0] in held and r[0] < 600]
    tokens = sum(r[1] for r in mine)
    assert sum(r[3] for r in mine) / tokens > sum(r[2] for r in mine) / tokens + 0.05


def test_common_words_are_cut_by_whole_levels(spark, monkeypatch):
    monkeypatch.setattr(lm, "COMMON", 5)
    texts = spark.createDataFrame([("a a a a b b b c c d d e f g h",)], "text string")
    counts, words = lm.count_words(texts)
    assert sorted(counts.common_n.tolist(), reverse=True) == [4, 3, 2, 2] and words.count() == 8
    assert counts.tokens == 16 and counts.types == 9


def test_symbols_after_a_context_sum_to_one():
    rng = np.random.default_rng(1)
    model = lm.LogBilinear(rng.normal(size=(lm.SYMBOLS + 1, 8)), rng.normal(size=(2, 8, 8)), rng.normal(size=(lm.SYMBOLS, 8)), rng.normal(size=lm.SYMBOLS))
    total = np.exp(model.log_probabilities(np.array([lm.START, 3]), np.array([lm.START, 9]))).sum(axis=1)
    assert total == pytest.approx([1, 1])


def test_model_of_nothing(spark, no_docs):
    assert lm.lm_scores(no_docs, lm.learnt_from()).collect() == []
    one = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    row = lm.lm_scores(one, F.lit(False)).first()
    assert (row.train_tokens, row.n_known, row.base_score) == (0, 0, 0.0)


# ---------------------------------------------------------------- secrets


def test_secrets_are_told_from_harmless_words(spark, odd_docs, no_docs):
    rng = random.Random(8)
    hexa = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    key = lambda: "AKIA" + "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567") for _ in range(16))
    docs = []
    for i in range(240):
        thing = [f"password={hexa(18)}", key(), f"mail{i}.name{i}@example{i}.com", f"{rng.randint(10**15, 10**16 - 1)}"][i % 4]
        docs.append((i, f"the word and the other word {thing} then the end of the text", f"src/{i}.txt"))
    df = spark.createDataFrame(docs, "doc_id long, text string, path string")
    out = secretscan.scan_secrets(df, path="path").collect()
    assert len(out) == 240 and {r.pos for r in out} == {6}
    assert all(r.secret == (r.doc_id % 4 < 2) for r in out)
    assert secretscan.scan_secrets(odd_docs).collect() == [] and secretscan.scan_secrets(no_docs).collect() == []


def test_secrets_are_candidates_beside_any_mark(spark):
    rng = random.Random(18)
    held = [f"{rng.getrandbits(160):040x}" for _ in range(60)]
    forms = ['"{}"!!', '"{}"###', '{{"api_key":"{}"}}', "https://user:{}@host.org/x", "https://{}@host.org", "?key={}&x=1", "db2_password={}", "aws.secret={}",
             "`{}`", "[{}]", "<{}>", "|{}|", "**{}**", "x={};y", "é{}é", "-{}-", "_{}_", "/{}/", "+{}+", "@{}@", ".{}.", "{}…", "\\\"token\\\":\\\"{}\\\"", "redis://:{}@host"]
    forms += [m + "{}" + m for m in "!#$%&*,;:=?^~"]
    docs = [(i, f"the word {f.format(held[i])} then") for i, f in enumerate(forms)]
    docs.append((99, f'{{"a":"{held[58]}","b":"{held[59]}"}}'))
    found = secretscan.candidates(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    value = lambda i: {r.value for r in found if r.doc_id == i}
    assert [f for i, f in enumerate(forms) if held[i] not in value(i)] == []
    assert value(99) == {held[58], held[59]} and {r.pos for r in found if r.doc_id == 0} == {2}
    names = {r.doc_id: r.name for r in found}
    assert [names[i] for i in (2, 5, 6, 7)] == ["api_key", "key", "db2_password", "aws.secret"]
